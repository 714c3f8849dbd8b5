"""Filter interaction audit: what each filter removes after any others, by galloping merges of posting lists.

Every document is judged by every filter. The failing documents of a filter in one part are kept as a sorted posting list,
cut into ranges of ids; so are the labelled documents. One row of ``postings`` holds the lists of one part and one range, so
ranges need nothing from each other. For each set of earlier filters a galloping merge makes the union of their lists, and a
galloping difference takes it from the list of the next one; sizes are summed over the ranges. All orders of the filters are
read off these sums, as what comes before a filter matters only as a set.

Ranges come from a range partitioning by id, with a spread for ids of many rows, so no part and no id has to fit in one task;
a range has at most ``RANGE_ROWS`` rows. Copies are found by a 128-bit hash of the text; the rows of a text that occurs twice
are joined to its least id, and Spark splits that join where one text holds many rows.

Defined results: a null text is empty. A null source is the part ''. A row is a copy if a smaller id has its text; a null id is
neither a copy nor makes one, and has no labels. Repeated rows count each. Of labels on one id any 1 counts; null labels and
labels of no document do not. Without documents there are no parts and no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.arrays import text_runs
from tidemark.llm.registry import query, task_count
from tidemark.session import Tables, materialize

FILTERS = "ABCDE"
RANGE_ROWS = 1 << 16
SPREAD = 1024
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 50, 65, 5

# Bytes that a count leaves out.
_UPPER = bytes(range(65, 91))
_SYMBOLS = b"#$%&*|"
_INNER = bytes(range(0x80, 0xC0))  # of a code point, all bytes but its first


def failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails, A lowest."""
    words = text.split()  # runs of bytes other than \x20 and \x09-\x0D
    chars = len(text.translate(None, _INNER))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * (len(text) - len(text.translate(None, _UPPER))) > UPPER_PERCENT * chars) << 2
        | (len(text) != len(text.translate(None, _SYMBOLS))) << 3
    )


def _judged(batches):
    for rows, data, offsets in text_runs(batches):
        whole = data.tobytes()
        texts = [whole[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("part"), rows.column("doc_id"),
                pa.array([failures(x) for x in texts], pa.int32()),
                pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in texts], pa.binary()),
                pa.array(np.arange(len(texts), dtype=np.int32) % SPREAD),
            ],
            names=["part", "doc_id", "fails", "text", "spread"],
        )


def judge(docs: DataFrame, part_col: str, id_col: str, text_col: str) -> DataFrame:
    """``part, doc_id, fails, spread`` of every row, all five filters in the bits of ``fails``."""
    id_type = docs.schema[id_col].dataType.simpleString()
    taken = docs.select(F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    judged = materialize(taken.mapInArrow(_judged, f"part string, doc_id {id_type}, fails int, text binary, spread int"), "audit-judged")
    least = judged.groupBy("text").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1").select("text", "least")
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).cast("int")
    return judged.join(least, "text", "left").select("part", "doc_id", F.col("fails").bitwiseOR(copy * 16).alias("fails"), "spread")


def gallop(ids: Sequence[int], start: int, target: int) -> int:
    """First place from ``start`` on whose id is not below ``target``: strides double until they pass it, then bisection."""
    stride, n = 1, len(ids)
    while start + stride < n and ids[start + stride] < target:
        start += stride
        stride <<= 1
    return bisect_left(ids, target, start, min(start + stride + 1, n))


def union(lists: list[Sequence[int]]) -> list[int]:
    """Ids that are in any of the sorted lists: the list with the least id gives all it has up to the next list's."""
    heads = sorted(([x, 0] for x in lists if x), key=lambda head: head[0][0])
    out: list[int] = []
    while len(heads) > 1:
        (ids, at), bound = heads[0], heads[1][0][heads[1][1]]
        end = gallop(ids, at, bound)
        out += ids[at:end]
        if end < len(ids) and ids[end] == bound:  # the next list gives it
            end += 1
        if end == len(ids):
            del heads[0]
            continue
        heads[0][1], k = end, 0
        while k + 1 < len(heads) and heads[k + 1][0][heads[k + 1][1]] < ids[end]:
            heads[k], heads[k + 1] = heads[k + 1], heads[k]
            k += 1
    for ids, at in heads:
        out += ids[at:]
    return out


def difference(ids: Sequence[int], gone: Sequence[int]) -> list[int]:
    """Ids of a sorted list that are not in the other one."""
    out: list[int] = []
    at = k = 0
    while at < len(ids):
        k = gallop(gone, k, ids[at])
        if k == len(gone):
            out += ids[at:]
            break
        end = gallop(ids, at, gone[k])
        out += ids[at:end]
        at = end + (end < len(ids) and ids[end] == gone[k])
    return out


def shared(ids: Sequence[int], others: Sequence[int]) -> int:
    """Number of ids that both sorted lists have."""
    n = at = k = 0
    while at < len(ids):
        k = gallop(others, k, ids[at])
        if k == len(others):
            break
        if others[k] == ids[at]:
            n, at = n + 1, at + 1
        else:
            at = gallop(ids, at, others[k])
    return n


LISTS = [*FILTERS, "good", "toxic"]


def _listed(batches):
    """Posting lists of the rows of a task, which are sorted by part and id: one row per part and range."""

    def block(part, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        fails, marks = (rows.column(c).to_numpy() for c in ("fails", "marks"))
        places = [np.flatnonzero(fails >> k & 1) for k in range(len(FILTERS))] + [np.flatnonzero(marks >> k & 1) for k in range(2)]
        ids = pa.array([rows.column("doc_id").to_pylist()], pa.list_(rows.schema.field("doc_id").type))
        return pa.RecordBatch.from_arrays([pa.array([part]), ids, *(pa.array([p], pa.list_(pa.int32())) for p in places)], names=["part", "ids", *LISTS])

    part, held, size = None, [], 0
    for batch in batches:
        parts = batch.column("part").to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)] if len(parts) else []
        for a, b in zip(edges[:-1], edges[1:]):
            if held and (parts[a] != part or size + b - a > RANGE_ROWS):
                yield block(part, held)
                held, size = [], 0
            part = parts[a]
            held.append(batch.slice(a, b - a))
            size += b - a
    if held:
        yield block(part, held)


def postings(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per part and range of ids: ``part``, ``ids`` in order, and sorted lists of places in ``ids``: of the documents
    that fail each filter (``A`` to ``E``), and of those labelled ``good`` and ``toxic``."""
    spark = docs.sparkSession
    judged = judge(docs, part_col, id_col, text_col)
    marked = (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).cast("int") + F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).cast("int") * 2).alias("marks"))
    )
    rows = judged.join(marked, "doc_id", "left").select("part", "doc_id", "fails", F.coalesce("marks", F.lit(0)).alias("marks"), "spread")
    rows = materialize(rows, "audit-rows")  # the range partitioning reads it twice
    id_type = rows.schema["doc_id"].dataType.simpleString()
    ranged = rows.repartitionByRange(task_count(spark), "doc_id", "spread").sortWithinPartitions("part", "doc_id", "spread")
    return ranged.mapInArrow(_listed, f"part string, ids array<{id_type}>, " + ", ".join(f"{name} array<int>" for name in LISTS))


COUNTS = ["documents", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def sizes(n: int, lists: list[Sequence[int]], good: Sequence[int], toxic: Sequence[int]) -> list[tuple[int, ...]]:
    """For each filter and set of filters before it: filter, set as bits, then ``COUNTS`` of one part and range."""
    every = len(lists)
    unions = [union([lists[k] for k in range(every) if s >> k & 1]) for s in range(1 << every)]
    out = []
    for f, ids in enumerate(lists):
        rest = [s for s in range(1 << every) if not s >> f & 1]
        removed = {s: difference(ids, unions[s]) for s in rest}
        alone = len(removed[rest[-1]])  # after all the others
        orders = sum(factorial(s.bit_count()) * factorial(every - 1 - s.bit_count()) * len(removed[s]) for s in rest)
        for s in rest:
            out.append((
                f, s, n, n - len(unions[s]) - len(removed[s]), len(removed[s]), len(ids) - len(removed[s]), alone,
                shared(removed[s], good), shared(removed[s], toxic), orders,
            ))
    return out


def _sized(batches):
    for batch in batches:
        for row in batch.to_pylist():
            found = sizes(len(row["ids"]), [row[f] for f in FILTERS], row["good"], row["toxic"])
            columns = list(zip(*found))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * len(found)), *(pa.array(c, pa.int32()) for c in columns[:2]), *(pa.array(c, pa.int64()) for c in columns[2:])],
                names=["part", "filter", "before", *COUNTS],
            )


def every_order(spark) -> DataFrame:
    """The steps of all orders of the filters: 600 rows of fixed content."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            rows.append(("".join(FILTERS[k] for k in order), step, f, before))
            before |= 1 << f
    return spark.createDataFrame(rows, "filter_order string, step int, filter int, before int")


def interactions(lists: DataFrame) -> DataFrame:
    """``part, filter_order, step`` and ``COUNTS`` of every part, order and step, from ``postings``."""
    summed = (
        lists.mapInArrow(_sized, "part string, filter int, before int, " + ", ".join(f"{c} long" for c in COUNTS))
        .groupBy("part", "filter", "before")
        .agg(*(F.sum(c).alias(c) for c in COUNTS))
    )
    return summed.join(F.broadcast(every_order(lists.sparkSession)), ["filter", "before"]).select("part", "filter_order", "step", *COUNTS)


_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
m AS (SELECT text, min(doc_id) AS least FROM t GROUP BY text),
w AS (SELECT part, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, coalesce(doc_id > least, false) AS copy FROM t JOIN m USING (text)),
l AS (SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [len(words) < {MIN_WORDS},
  100 * len(list_distinct(words)) < {DISTINCT_PERCENT} * len(words),
  100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {UPPER_PERCENT} * length(text), regexp_matches(text, '[#$%&*|]'), copy] AS fails
  FROM w LEFT JOIN l USING (doc_id)),
g AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
d AS (SELECT unnest(range(1, 6)) AS k),
o AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS ks FROM d a, d b, d c, d, d e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT array_to_string(list_transform(ks, lambda k: substr('{FILTERS}', k::INT, 1)), '') AS filter_order, step, ks[step] AS f, ks[:step - 1] AS earlier
  FROM (SELECT ks, unnest(range(1, 6)) AS step FROM o)),
v AS (SELECT part, filter_order, step, f, n, good, toxic, fails[f] AS hit, len(list_filter(earlier, lambda k: fails[k])) > 0 AS gone,
  len(list_filter(fails, lambda x: x)) = 1 AS single FROM g, s),
a AS (SELECT part, filter_order, step, f, sum(n) FILTER (NOT gone AND NOT hit) AS kept, sum(n) FILTER (hit AND NOT gone) AS removed,
  sum(n) FILTER (hit AND gone) AS redundant, sum(n) FILTER (hit AND single) AS unique_fails,
  sum(n) FILTER (hit AND NOT gone AND good) AS good_lost, sum(n) FILTER (hit AND NOT gone AND toxic) AS toxic_lost FROM v GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, {", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in COUNTS[1:-1])},
  coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley FROM a
"""


@query("op11_filter_audit", _SQL)
def op11_filter_audit(t: Tables) -> DataFrame:
    """What each step of each order of the five filters removes in each source."""
    return interactions(postings(t.documents, t.labels)).drop("documents")
