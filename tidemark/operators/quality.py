"""Data quality: rules, profiles, duplicates, orphans, repair and sensitive-data findings."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tidemark.sources.readers import latest_by

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
PROFILABLE = NUMERIC + (T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def profilable(df: DataFrame) -> tuple[list[str], list[str]]:
    """Columns a profile covers, and those it skips (arrays, structs, maps, binaries)."""
    kept = [f.name for f in df.schema.fields if isinstance(f.dataType, PROFILABLE)]
    return kept, [f"{f.name} ({f.dataType.simpleString()})" for f in df.schema.fields if f.name not in kept]


# Sizes of the sketches: distinct values (2 ** 12 registers), quantiles, and items tracked for the most frequent values.
DISTINCT_LOG, QUANTILE_K, ITEMS = 12, 200, 384
_SPREAD = 32


def _bounds(c: str, numeric: bool) -> Column:
    """A value with what orders it, so that bounds of several parts can be compared."""
    number, text = (F.col(c).cast("double"), F.lit(None).cast("string")) if numeric else (F.lit(None).cast("double"), F.col(c).cast("string"))
    return F.when(F.col(c).isNotNull(), F.struct(number.alias("number"), text.alias("text"), F.col(c).cast("string").alias("value")))


def sketch_profile(df: DataFrame, keys: list[str] = (), cols: list[str] | None = None) -> DataFrame:
    """Profiles that add up: one row per ``keys`` and column, of counts, sums and sketches, which ``merge_profiles`` joins.

    One pass. Each column keeps a sketch of its distinct values, of its quantiles and of its most frequent values, all of fixed
    size, so no value is shuffled; what many tasks found is joined by 32 tasks, and then column by column.
    """
    keys, (names, _) = list(keys), profilable(df)
    names = [c for c in (cols or names) if c not in keys]
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)}
    aggs = [F.count("*").alias("__rows")]
    for c in names:
        num = F.col(c).cast("double")
        aggs += [
            F.count(c).alias(f"{c}__values"),
            F.hll_sketch_agg(F.col(c).cast("string"), F.lit(DISTINCT_LOG)).alias(f"{c}__distinct"),
            F.expr(f"approx_top_k_accumulate(CAST(`{c}` AS STRING), {ITEMS}) FILTER (WHERE `{c}` IS NOT NULL)").alias(f"{c}__items"),
            F.min(_bounds(c, c in numeric)).alias(f"{c}__low"), F.max(_bounds(c, c in numeric)).alias(f"{c}__high"),
            *([F.avg(num).alias(f"{c}__mean"), F.var_pop(num).alias(f"{c}__variance"), F.expr(f"kll_sketch_agg_double(CAST(`{c}` AS DOUBLE), {QUANTILE_K})").alias(f"{c}__quantiles")]
              if c in numeric else [F.lit(None).cast(k).alias(f"{c}__{f}") for f, k in (("mean", "double"), ("variance", "double"), ("quantiles", "binary"))]),
        ]
    wide = df.withColumn("__spread", F.spark_partition_id() % _SPREAD).groupBy(*keys, "__spread").agg(*aggs)
    fields = ("values", "distinct", "items", "low", "high", "mean", "variance", "quantiles")
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("__rows").alias("rows"), *[F.col(f"{c}__{f}").alias(f) for f in fields]) for c in names]
    parts = wide.select(*keys, F.explode(F.array(*rows)).alias("__part")).select(*keys, "__part.*")
    return merge_profiles(parts, keys)


def merge_profiles(parts: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Profiles of several days, files or tasks as one per ``keys`` and column."""
    n, mean = F.col("values").cast("double"), F.col("mean")
    total = F.sum(F.when(mean.isNotNull(), n))
    centre = F.sum(n * mean) / total
    spread = F.sum(n * (F.col("variance") + mean * mean)) / total - centre * centre
    return parts.groupBy(*keys, "column_name").agg(
        F.sum("rows").alias("rows"), F.sum("values").alias("values"),
        F.hll_union_agg("distinct").alias("distinct"), F.expr(f"approx_top_k_combine(items, {ITEMS})").alias("items"),
        F.min("low").alias("low"), F.max("high").alias("high"), centre.alias("mean"), F.when(spread < 0, 0.0).otherwise(spread).alias("variance"),
        F.expr("kll_merge_agg_double(quantiles) FILTER (WHERE quantiles IS NOT NULL)").alias("quantiles"),
    )


def read_profile(profiles: DataFrame, keys: list[str] = (), most: int = 10) -> DataFrame:
    """What mergeable profiles say: counts, range, mean, deviation, and estimates with their bounds.

    Distinct values are off by some two per cent; a quartile by 1.7 % of the rows in rank; the count of a frequent value by at
    most ``top_error``, and none above that is missing. With fewer values than ``ITEMS`` the counts are exact.
    """
    n = F.col("values").cast("double")
    sampled = F.when(n > 1, F.sqrt(F.col("variance") * n / (n - 1)))
    quartiles = F.when(F.col("mean").isNotNull(), F.expr("kll_sketch_get_quantile_double(quantiles, array(0.25D, 0.5D, 0.75D))"))
    items = F.expr(f"approx_top_k_estimate(items, {most})")
    distinct = F.hll_sketch_estimate("distinct")
    return profiles.select(
        *keys, "column_name", F.col("rows").alias("row_count"), (F.col("rows") - F.col("values")).alias("null_count"), distinct.alias("distinct_estimate"),
        F.col("low.value").alias("min_value"), F.col("high.value").alias("max_value"), "mean", sampled.alias("std"), quartiles.alias("quartiles"),
        F.transform(items, lambda i: F.struct(i["item"].alias("value"), i["count"].alias("n"))).alias("top"),
        F.when(distinct <= ITEMS // 2, 0).otherwise(F.ceil(n * 3.5 * 0.75 / ITEMS)).cast("long").alias("top_error"),
    )


def profile(df: DataFrame, sample_pct: float = 100.0, seed: int = 42, exact: bool = False) -> DataFrame:
    """One row per column: nulls, distinct values, range, mean, deviation, quartiles, from one pass and sketches of fixed size.

    With ``exact`` distinct values and quartiles are counted, at the cost of a shuffle of all values. A table without rows has none here.
    """
    names, _ = profilable(df)
    src = df.select(*names) if sample_pct >= 100 else df.select(*names).sample(fraction=sample_pct / 100, seed=seed)
    out = read_profile(sketch_profile(src)).drop("top", "top_error")
    if not exact:
        return out
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("number")) for c in names]))
    counts = src.select(cells.alias("c")).select("c.*").filter("value IS NOT NULL").groupBy("column_name", "value", "number").agg(F.count("*").alias("n"))
    quartiles = F.expr("percentile(number, array(0.25D, 0.5D, 0.75D), n)")  # over distinct values with their counts
    known = counts.groupBy("column_name").agg(F.count("*").alias("__distinct"), quartiles.alias("__quartiles"))
    joined = out.join(known, "column_name", "left")
    return joined.withColumns({"distinct_estimate": F.coalesce("__distinct", F.lit(0).cast("long")), "quartiles": F.col("__quartiles")}).drop("__distinct", "__quartiles")


def top_values(df: DataFrame, cols: list[str], n: int) -> DataFrame:
    """Most frequent values of each column: one scan, counted with map-side combine."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols]))
    counts = df.select(cells.alias("c")).groupBy("c.column_name", "c.value").agg(F.count("*").alias("n"))
    w = Window.partitionBy("column_name").orderBy(F.desc("n"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def recommend_rules(df: DataFrame, prof: DataFrame, most_values: int = 10) -> DataFrame:
    """Rules the rows support: not null, unique, range, and a value list for text columns of few values.

    Estimates only choose the columns to look at; uniqueness and value lists are counted exactly.
    """
    names = [c for c in df.columns if not isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType))]
    texts = [c for c in names if isinstance(df.schema[c].dataType, T.StringType)]
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in names]))
    counts = df.select(cells.alias("c")).select("c.*").filter("value IS NOT NULL").groupBy("column_name", "value").agg(F.count("*").alias("n"))
    ranked = F.row_number().over(Window.partitionBy("column_name").orderBy("value"))
    sizes = counts.groupBy("column_name").agg(F.max("n").alias("most_often"), F.count("*").alias("values"))
    few = counts.join(sizes.filter(F.col("values") <= most_values), "column_name").filter(F.col("column_name").isin(texts))
    lists = few.withColumn("at", ranked).groupBy("column_name").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: F.concat(F.lit("'"), x["value"], F.lit("'"))), ", ").alias("listed"))
    known = prof.join(sizes, "column_name", "left").join(lists, "column_name", "left")
    rules = F.array_compact(F.array(
        F.when(F.col("null_count") == 0, F.concat(F.col("column_name"), F.lit(" IS NOT NULL"))),
        F.when((F.col("most_often") == 1) & (F.col("null_count") == 0), F.concat(F.lit("unique("), "column_name", F.lit(")"))),
        F.when(F.col("mean").isNotNull(), F.concat_ws("", "column_name", F.lit(" BETWEEN "), "min_value", F.lit(" AND "), "max_value")),
        F.when(F.col("listed").isNotNull(), F.concat("column_name", F.lit(" IN ("), "listed", F.lit(")"))),
    ))
    return known.select("column_name", F.explode(rules).alias("rule"))


def run_rules(
    df: DataFrame,
    rules: dict[str, tuple],
    bindings: list[tuple[str, str, str]],
    row_filters: dict[str, str],
) -> DataFrame:
    """Check every (rule, column, row filter) binding in one pass over the table.

    ``rules`` maps an id to ``(dimension, SQL predicate with $column)`` or ``(dimension, predicate, True)``. A row
    whose checked column is NULL counts as a null, neither success nor failure; with True the predicate judges it too.
    """
    def parts(rule: str, col: str, flt: str) -> tuple[Column, Column, Column]:
        text = rules[rule][1].replace("$column", f"`{col}`")
        in_scope = F.expr(row_filters[flt])
        judges_null = len(rules[rule]) > 2 and rules[rule][2]
        is_null = F.lit(False) if judges_null else F.col(col).isNull()
        ok = F.coalesce(F.expr(text), F.lit(False)) & ~is_null
        return in_scope, ok, is_null

    aggs, rows = [], []
    for i, (rule, col, flt) in enumerate(bindings):
        in_scope, ok, is_null = parts(rule, col, flt)
        aggs += [
            F.count_if(in_scope).alias(f"{i}_all"),
            F.count_if(in_scope & ok).alias(f"{i}_ok"),
            F.count_if(in_scope & is_null).alias(f"{i}_null"),
        ]
        rows.append(F.struct(
            F.lit(rule).alias("rule_id"), F.lit(rules[rule][0]).alias("dimension"), F.lit(col).alias("column_id"),
            F.lit(flt).alias("row_filter"), F.col(f"{i}_all").alias("rows_validated"),
            F.col(f"{i}_ok").alias("success_count"), F.col(f"{i}_null").alias("null_count"),
        ))
    out = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    failed = F.col("rows_validated") - F.col("success_count") - F.col("null_count")

    def share(c: Column) -> Column:
        return F.round(F.try_divide(c.cast("double"), F.col("rows_validated").cast("double")), 6)

    return out.withColumns({
        "failed_count": failed,
        "success_percentage": share(F.col("success_count")),
        "failed_percentage": share(failed),
        "null_percentage": share(F.col("null_count")),
    })


class RowRule(NamedTuple):
    """A rule on single values of a column: the share of the judged rows that has to pass.

    With ``ignore_null`` a missing value is not judged; without, it fails.
    """

    name: str
    column: str
    holds: Column
    threshold: float = 1.0
    ignore_null: bool = False


def range_rule(
    name: str, column: str, low=None, high=None, strict_low: bool = False, strict_high: bool = False, threshold: float = 1.0, ignore_null: bool = False
) -> RowRule:
    """Values between two bounds, either of which may be missing or, if strict, not reached."""
    c, holds = F.col(column), F.lit(True)
    if low is not None:
        holds = holds & (c > F.lit(low) if strict_low else c >= F.lit(low))
    if high is not None:
        holds = holds & (c < F.lit(high) if strict_high else c <= F.lit(high))
    return RowRule(name, column, holds, threshold, ignore_null)


def set_rule(name: str, column: str, values: list, threshold: float = 1.0, ignore_null: bool = False) -> RowRule:
    """Values out of a list."""
    return RowRule(name, column, F.col(column).isin(values), threshold, ignore_null)


def not_null_rule(name: str, column: str, threshold: float = 1.0) -> RowRule:
    """Values that are there."""
    return RowRule(name, column, F.col(column).isNotNull(), threshold)


def check_rows(df: DataFrame, rules: list[RowRule]) -> DataFrame:
    """``rule, column_name, evaluated, passed_count, null_count, ratio, threshold, passed`` of each rule, in one pass.

    Where no row is judged the ratio is missing and the rule has passed.
    """
    aggs, rows = [], []
    for i, rule in enumerate(rules):
        missing = F.col(rule.column).isNull()
        judged = ~missing if rule.ignore_null else F.lit(True)
        good = F.coalesce(rule.holds, F.lit(False)) & (judged if rule.ignore_null else F.lit(True))
        aggs += [F.count_if(judged).alias(f"{i}_judged"), F.count_if(good).alias(f"{i}_good"), F.count_if(missing).alias(f"{i}_null")]
        rows.append(F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.column).alias("column_name"), F.col(f"{i}_judged").alias("evaluated"),
                             F.col(f"{i}_good").alias("passed_count"), F.col(f"{i}_null").alias("null_count"), F.lit(float(rule.threshold)).alias("threshold")))
    out = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    ratio = F.try_divide(F.col("passed_count").cast("double"), F.col("evaluated").cast("double"))
    return out.withColumn("ratio", ratio).withColumn("passed", F.coalesce(ratio >= F.col("threshold"), F.lit(True)))


def score(results: DataFrame, keys: list[str]) -> DataFrame:
    """Success share over all rules of a key; an empty check counts as passed."""
    ok, checked = F.sum(F.coalesce("success_count", F.lit(0))), F.sum(F.coalesce("rows_validated", F.lit(0)))
    share = F.when(checked == 0, F.lit(1.0)).otherwise(F.try_divide(ok.cast("double"), checked.cast("double")))
    return results.groupBy(*keys).agg(
        F.count_distinct("column_id").alias("columns_validated"),
        F.round(share, 6).alias("success_percentage"),
        F.round(1 - share, 6).alias("failed_percentage"),
    )


def duplicates(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows whose column group occurs more than once; NULL keys never match, as in a USING join."""
    repeated = df.groupBy(*cols).agg(F.count("*").alias("__n")).filter("__n > 1").drop("__n")
    return df.join(repeated, cols, "left_semi")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows with a key the parent lacks."""
    known = child.filter(F.col(child_key).isNotNull())
    return known.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def key_check(df: DataFrame, keys: list[str]) -> DataFrame:
    """Assertion counts of a key: groups that repeat, and rows with a NULL part."""
    null_part = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    return df.groupBy(*keys).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(null_part, F.col("n"))), F.lit(0)).alias("null_key_rows"),
    )


def quarantine(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Split rows into those that meet every rule and the rest, with the names of the rules broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(F.expr(p), F.lit(False)), n) for n, p in rules.items()]))
    tagged = df.withColumn("failed_rules", broken)
    return tagged.filter(F.size("failed_rules") == 0).drop("failed_rules"), tagged.filter(F.size("failed_rules") > 0)


def repair(bad: DataFrame, fixes: dict[str, tuple[str, Column]]) -> DataFrame:
    """Apply ``rule -> (column, expression)`` to the rows that broke that rule."""
    out = bad
    for rule, (col, expr) in fixes.items():
        out = out.withColumn(col, F.when(F.array_contains("failed_rules", rule), expr).otherwise(F.col(col)))
    return out.drop("failed_rules")


# Patterns of the public forms of each kind of data.
SENSITIVE = {
    "EMAIL_ADDRESS": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "IP_ADDRESS": r"\b(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\b",
    "CREDIT_CARD_NUMBER": r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b",
    "US_SOCIAL_SECURITY_NUMBER": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "DATE": r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b",
    "DATE_OF_BIRTH": r"(?i)\b(?:born|birth|birthday|birthdate|dob)\b\W{0,3}(?:on )?[0-9]{4}-[0-9]{2}-[0-9]{2}\b",
    "GENDER": r"\b(?:male|female|Male|Female)\b",
}


def luhn_ok(number: Column) -> Column:
    """Checksum of a card number."""
    digits = F.reverse(F.regexp_replace(number, "[^0-9]", ""))
    at = F.transform(F.split(digits, ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(at, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def scan_sensitive(df: DataFrame, key: str, cols: list[str], kinds: list[str]) -> DataFrame:
    """One row per finding: column, kind and quote. Card numbers must pass their checksum."""
    def findings(c: str, kind: str) -> Column:
        hits = F.regexp_extract_all(F.col(c), F.lit(SENSITIVE[kind]), F.lit(0))
        if kind == "CREDIT_CARD_NUMBER":
            hits = F.filter(hits, luhn_ok)
        named = [F.lit(c).alias("column_name"), F.lit(kind).alias("info_type")]
        return F.transform(hits, lambda q: F.struct(*named, q.alias("quote")))

    found = [findings(c, kind) for c in cols for kind in kinds]
    empty = F.array().cast("array<struct<column_name:string,info_type:string,quote:string>>")
    rows = F.flatten(F.array(*[F.coalesce(f, empty) for f in found]))
    return df.select(key, F.explode(rows).alias("f")).select(key, "f.*")


def scan_names(df: DataFrame, key: str, col: str, names: DataFrame, name: str) -> DataFrame:
    """Findings of dictionary words: tokens joined to a name table."""
    words = df.select(key, F.explode(F.array_distinct(F.split(F.col(col), r"[^\p{L}]+"))).alias(name)).filter(F.col(name) != "")
    hits = words.join(names.select(name).distinct(), name, "left_semi")
    return hits.select(key, F.lit(col).alias("column_name"), F.lit("PERSON_NAME").alias("info_type"), F.col(name).alias("quote"))


def latest_findings(findings: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """Newest finding per column and kind."""
    return latest_by(findings, keys, order_by)
