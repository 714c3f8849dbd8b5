"""JSON text access."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strict_number(text: Column, path: str, kind: str) -> Column:
    """Value at ``path`` as ``kind`` only if the JSON holds a number there, otherwise NULL.

    A JSON string of digits is not a number, so the stored type is looked at before the cast.
    """
    variant = F.try_parse_json(text)
    node = F.try_variant_get(variant, path, "variant")
    is_number = F.schema_of_variant(node).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    return F.when(is_number, F.try_variant_get(variant, path, kind))


def scalar(text: Column, path: str) -> Column:
    return F.get_json_object(text, path)


def pair_value(pairs: Column, name: str, kind: str) -> Column:
    """Value of the first ``(name, value)`` struct called ``name``, cast to ``kind`` or NULL."""
    hit = F.filter(pairs, lambda p: p["name"] == F.lit(name))
    return F.get(hit, 0)["value"].try_cast(kind)
