"""Tidemark: lakehouse analytics as plain DataFrame functions on PySpark."""
