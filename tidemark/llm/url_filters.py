"""URL filters: rules on host and path prefixes, found by a sort-merge sweep.

A rule fits its host, all subdomains, and every path that starts with its path. Written with the host's labels reversed
(``org.example``), a break, and the path, a rule is a prefix and stands for an interval of keys. A URL gives one key per
suffix of its host, so that a fitting rule is a prefix of one of its keys. Rules and keys are sorted together. Intervals of
prefixes are nested or apart, so at any key the active rules are a stack: the last rule that began, and the rules it lies in.
The stack of each rule is worked out beforehand, and the sweep only carries the last rule.

The sorted sweep runs in range blocks. Each block takes over the last rule of the blocks before it, from a summary of one
row per block, so no host, however frequent, has to fit in one task. Equal keys are swept once. Only DataFrame functions run.

Defined results: a null URL, or one without ``://``, has an empty host and path, and no rule fits it unless its host is
empty too. Of rules with the same host and path the first verdict in alphabetical order holds. An empty rule table leaves
every URL to the default. Repeated rows get a row each; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.registry import query, session_of
from tidemark.session import Tables, materialize

BREAK = "\u0001"  # sorts below every character of a host or path
DEFAULT = "allow"

# The rules of the query as (host, path, verdict).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: str) -> dict:
    """Columns ``host`` (A-Z lower-cased) and ``path`` of a URL column."""
    rest = f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END"
    host = F.regexp_extract(F.expr(rest), "^([^/?#]*)", 1)
    path = F.regexp_extract(F.expr(rest), "^[^/?#]*([^?#]*)", 1)
    return {"host": F.translate(host, _UPPER, _LOWER), "path": path}


def rule_table(rules: DataFrame) -> DataFrame:
    """``key``, and ``stack``: this rule and the rules it lies in, the longest first."""
    one = rules.groupBy(F.translate("host", _UPPER, _LOWER).alias("host"), "path").agg(F.min("verdict").alias("verdict"))
    keyed = one.select(
        F.expr(f"concat(array_join(reverse(split(host, '[.]')), '.'), '{BREAK}', path)").alias("key"),
        F.struct(F.expr("-(char_length(host) + char_length(path))").alias("order"), F.concat("host", "path").alias("rule"), "verdict").alias("it"),
    )
    pieces = keyed.select("key", F.explode(F.expr("transform(sequence(1, char_length(key)), n -> left(key, n))")).alias("piece"))
    outer = keyed.select(F.col("key").alias("piece"), F.struct(F.col("key").alias("k"), "it").alias("part"))
    return pieces.join(outer, "piece").groupBy("key").agg(
        F.reverse(F.sort_array(F.collect_list("part"))).alias("stack")  # at most one for each character of the key
    )


def sweep(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest rule that is a prefix of each distinct ``key`` of the first table; both have ``key``, rules have ``stack``."""
    none = F.lit(None).cast(rules.schema["stack"].dataType)
    events = rules.select("key", F.lit(0).alias("kind"), "stack").unionByName(keys.select("key", F.lit(1).alias("kind"), none.alias("stack")))
    order = [F.col("key"), F.col("kind")]
    cut = materialize(events.repartitionByRange(*order).withColumn("block", F.spark_partition_id()), "url-sweep")
    begun = F.when(F.col("kind") == 0, F.struct("key", "stack"))
    tops = cut.groupBy("block").agg(F.max(begun).alias("top"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select("block", F.max("top").over(earlier).alias("carried"))
    so_far = Window.partitionBy("block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = cut.select("block", "key", "kind", F.max(begun).over(so_far).alias("top")).filter("kind = 1")
    return (
        swept.join(F.broadcast(carried), "block")  # one row per block
        .withColumn("active", F.coalesce(F.col("top"), F.col("carried")).getField("stack"))
        .select("key", F.expr("get(filter(active, r -> startswith(key, r.k)), 0).it").alias("it"))
    )


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of each URL."""
    parts = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    parts = parts.withColumns(split_url("url")).select("page_id", "host", "path")
    urls = parts.select("host", "path").distinct()
    suffixes = "transform(sequence(1, size(labels)), n -> array_join(slice(labels, 1, n), '.'))"
    probes = (
        urls.withColumn("labels", F.expr("reverse(split(host, '[.]'))"))
        .select("host", "path", F.explode(F.expr(suffixes)).alias("suffix"))
        .select("host", "path", F.concat("suffix", F.lit(BREAK), "path").alias("key"))
    )
    found = sweep(probes.select("key").distinct(), rule_table(rules)).filter("it IS NOT NULL")
    best = probes.join(found, "key").groupBy("host", "path").agg(F.min("it").alias("it"))  # the longest has the least order
    return parts.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("it.rule").alias("rule"), F.coalesce(F.col("it.verdict"), F.lit(default)).alias("verdict")
    )


def _sql() -> str:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return f"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {values}),
u AS (SELECT page_id, row_number() OVER () AS k, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, k, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT k, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(rverdict, length(rhost || rpath)) AS verdict
  FROM s JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY k)
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT}') AS verdict FROM s LEFT JOIN m USING (k)
"""


@query("op5_url_filters", _sql())
def op5_url_filters(t: Tables) -> DataFrame:
    """Verdict on every page's URL."""
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    rules = session_of(t).sql(f"SELECT * FROM VALUES {values} AS r(host, path, verdict)")
    return url_filter(t.pages, rules)
