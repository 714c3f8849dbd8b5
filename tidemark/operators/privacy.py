"""Masking, role views, row policies, entitlements, and encryption with one key per entity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_BY_TYPE = {"string": "", "int": 0, "bigint": 0, "double": 0.0, "float": 0.0, "boolean": False, "date": "1970-01-01"}


def mask(col: Column, kind: str, data_type: str = "string") -> Column:
    """Masked value. Short texts are hidden whole, so a mask never returns its input."""
    if kind == "ALWAYS_NULL":
        return F.lit(None).cast(data_type)
    if kind == "SHA256":
        return F.sha2(col.cast("string"), 256)
    if kind == "EMAIL_MASK":
        return F.when(col.rlike("^[^@]+@[^@]+$"), F.regexp_replace(col, "^[^@]+@", "XXXXX@")).when(
            col.isNotNull(), F.sha2(col, 256))
    if kind in ("LAST_FOUR", "FIRST_FOUR"):
        size, hidden = F.length(col), F.greatest(F.length(col) - 4, F.lit(0))
        stars = F.repeat(F.lit("X"), hidden)
        shown = F.concat(stars, F.right(col, F.lit(4))) if kind == "LAST_FOUR" else F.concat(F.left(col, F.lit(4)), stars)
        return F.when(size > 4, shown).otherwise(F.repeat(F.lit("X"), size))
    if kind == "DEFAULT":
        value = F.lit(_BY_TYPE.get(data_type)).cast(data_type)
        return F.when(col.isNotNull(), value)
    raise ValueError(f"unknown mask {kind}")


def role_view(df: DataFrame, policies: dict[str, dict[str, str]], role: str) -> DataFrame:
    """Columns as one role may see them.

    ``policies`` maps a column to ``role -> CLEAR, a mask kind, or DENIED``. A role without a rule
    for a governed column is denied. Denied columns are left out, so selecting one fails.
    """
    types = dict(df.dtypes)
    out = []
    for c in df.columns:
        rule = policies[c].get(role, "DENIED") if c in policies else "CLEAR"
        if rule == "CLEAR":
            out.append(F.col(c))
        elif rule != "DENIED":
            out.append(mask(F.col(c), rule, types[c]).alias(c))
    return df.select(*out)


def row_access(df: DataFrame, policies: list[tuple[set[str], Column]], user: str) -> DataFrame:
    """Rows granted to a user: the OR of their predicates; no grant, no rows."""
    granted = [p for users, p in policies if user in users]
    return df.filter(reduce(lambda a, b: a | b, granted) if granted else F.lit(False))


def entitled(df: DataFrame, grants: DataFrame, user: str, key: str, user_col: str = "user") -> DataFrame:
    """Rows whose key a grant table gives to the user."""
    return df.join(grants.filter(F.col(user_col) == user).select(key).distinct(), key, "left_semi")


def anonymize(df: DataFrame, plan: dict[str, str]) -> DataFrame:
    """Apply a column-wise plan: KEEP, DROP or a mask kind. Columns without an entry are dropped."""
    types = dict(df.dtypes)
    kept = [c for c in df.columns if plan.get(c, "DROP") != "DROP"]
    return df.select(*[F.col(c) if plan[c] == "KEEP" else mask(F.col(c), plan[c], types[c]).alias(c) for c in kept])


def plan_from_findings(df: DataFrame, findings: DataFrame, default: str = "DROP") -> dict[str, str]:
    """Anonymisation plan from per-column findings (a handful of rows)."""
    # Fixed choice: how each kind of data is hidden.
    how = {"EMAIL_ADDRESS": "EMAIL_MASK", "IP_ADDRESS": "SHA256", "CREDIT_CARD_NUMBER": "LAST_FOUR"}
    kinds = {r["column_name"]: r["info_type"] for r in findings.select("column_name", "info_type").distinct().collect()}
    return {c: how.get(kinds[c], "ALWAYS_NULL") if c in kinds else default for c in df.columns}


def make_keys(df: DataFrame, key: str, secret: str) -> DataFrame:
    """One 256-bit key per entity, derived from a secret the caller holds."""
    return df.select(key).distinct().withColumns({
        "data_key": F.unhex(F.sha2(F.concat(F.lit(secret), F.col(key).cast("string")), 256)),
        "disabled": F.lit(False),
    })


def encrypt(df: DataFrame, keys: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """AES-GCM per row with the entity's key; the entity id is the additional data.

    A row whose entity has no enabled key fails the job: it must neither vanish nor stay in clear.
    """
    aad = F.col(key).cast("string")
    joined = df.join(keys.filter(~F.col("disabled")).select(key, "data_key"), key, "left")
    missing = F.raise_error(F.concat(F.lit("no enabled key for "), F.coalesce(F.col(key).cast("string"), F.lit("a row without id"))))
    joined = joined.withColumn("data_key", F.when(F.col("data_key").isNull(), missing.cast("binary")).otherwise(F.col("data_key")))
    sealed = {c: F.aes_encrypt(F.col(c).cast("string"), F.col("data_key"), F.lit("GCM"), F.lit("DEFAULT"), F.lit(""), aad) for c in cols}
    return joined.withColumns(sealed).select(*df.columns)


def decrypt(df: DataFrame, keys: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Clear text of the rows whose key is still enabled; others are gone."""
    aad = F.col(key).cast("string")
    joined = df.join(keys.filter(~F.col("disabled")).select(key, "data_key"), key)
    opened = {c: F.aes_decrypt(F.col(c), F.col("data_key"), F.lit("GCM"), F.lit("DEFAULT"), aad).cast("string") for c in cols}
    return joined.withColumns(opened).select(*df.columns)


def shred(keys: DataFrame, key: str, forget: DataFrame) -> DataFrame:
    """Disable and erase the keys of the entities to forget."""
    gone = forget.select(key).distinct().withColumn("__gone", F.lit(True))
    joined = keys.join(gone, key, "left")
    gone = F.coalesce("__gone", F.lit(False))
    return joined.withColumns({
        "disabled": F.col("disabled") | gone, "data_key": F.when(~gone, F.col("data_key")),
    }).drop("__gone")
