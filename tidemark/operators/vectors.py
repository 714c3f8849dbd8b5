"""Vector distance, exact and probed nearest-neighbour search, and text embeddings."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.functions.search import tokens
from tidemark.operators.aggregates import top_per_group
from tidemark.session import materialize

# Bytes of vectors one block holds in memory.
BLOCK_BYTES = 2 << 20
# Blocks of base vectors that a task streams in a search for one text; fewer do not pay for its start.
TASK_BLOCKS = 8
# Vectors an index is fitted on at most, and codes of a block whose vectors are measured exactly.
TRAIN_ROWS, RERANK = 16_384, 64
# Distances one step computes at a time.
MATRIX_CELLS = 1_000_000
_DIGITS = 9


def distance(a: Column, b: Column, kind: str = "cosine") -> Column:
    """Distance of two array columns: ``cosine``, ``euclidean`` or ``dot`` (negated product)."""
    def total(pairs: Column) -> Column:
        return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)

    def wide(v: Column) -> Column:
        return v.cast("array<double>")

    a, b = wide(a), wide(b)
    dot = total(F.zip_with(a, b, lambda x, y: x * y))
    if kind == "dot":
        return -dot
    if kind == "euclidean":
        return F.sqrt(total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))
    norm = F.sqrt(total(F.transform(a, lambda x: x * x))) * F.sqrt(total(F.transform(b, lambda x: x * x)))
    return 1 - F.try_divide(dot, norm)


def has_length(vec: Column, size: int) -> Column:
    """Guard against missing and truncated embeddings."""
    return F.coalesce(F.size(vec) == size, F.lit(False))


def _gaps(q: np.ndarray, b: np.ndarray, kind: str) -> np.ndarray:
    """Distances of every query row to every base row of one in-memory block."""
    dot = q @ b.T
    if kind == "dot":
        return -dot
    qq, bb = (q * q).sum(1), (b * b).sum(1)
    if kind == "euclidean":
        return np.sqrt(np.maximum(qq[:, None] + bb[None, :] - 2 * dot, 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        return 1 - dot / np.sqrt(qq[:, None] * bb[None, :])


def _vectors(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows of an Arrow list column by length of their vectors: places, and one matrix per length."""
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    out = {}
    for n in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == n)
        flat = column.take(pa.array(at)).flatten().cast(pa.float64())
        out[int(n)] = at, flat.to_numpy(zero_copy_only=False).reshape(len(at), int(n))
    return out


def _nearest(places: np.ndarray, q: np.ndarray, bid: np.ndarray, b: np.ndarray, k: int, kind: str) -> pd.DataFrame:
    """The ``k`` nearest base rows per query, a slice of queries at a time to bound the distance matrix and the rows of equal distance."""
    step = max(1, MATRIX_CELLS // max(len(bid), 1))
    return pd.concat([_first([_nearest_slice(places[i:i + step], q[i:i + step], bid, b, k, kind)], k) for i in range(0, len(places), step)])


def _nearest_slice(places: np.ndarray, q: np.ndarray, bid: np.ndarray, b: np.ndarray, k: int, kind: str) -> pd.DataFrame:
    """One slice; a distance that is no number is no match. Rows at the last distance are all kept: the id decides later."""
    d = np.round(_gaps(q, b, kind), _DIGITS)
    d[np.isnan(d)] = np.inf
    take = min(k, d.shape[1])
    bar = np.partition(d, take - 1, axis=1)[:, take - 1] if take else np.zeros(len(d))
    rows, cols = np.nonzero((d <= bar[:, None]) & np.isfinite(d))
    return pd.DataFrame({"place": places[rows], "distance": d[rows, cols], "base_id": bid[cols]})


def _first(found: list[pd.DataFrame], k: int) -> pd.DataFrame:
    """The ``k`` nearest per query of several finds; equal distances go to the smaller id."""
    every = pd.concat(found).sort_values(["place", "distance", "base_id"], kind="stable")
    return every.groupby("place", sort=False).head(k)


def _ids(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


class _Queries:
    """Queries of one block, and the nearest base rows seen so far."""

    def __init__(self, k: int, kind: str):
        self.k, self.kind = k, kind
        self.parts: list[pa.RecordBatch] = []
        self.ids, self.by_size, self.best = None, {}, []

    def meet(self, batch: pa.RecordBatch) -> None:
        if self.ids is None:
            whole = pa.Table.from_batches(self.parts).combine_chunks() if self.parts else None
            self.ids = whole.column("query_id").combine_chunks() if whole else pa.array([])
            self.by_size = _vectors(whole.column("vec").combine_chunks()) if whole else {}
        base_ids = _ids(batch.column("base_id"))
        for size, (at, b) in _vectors(batch.column("vec")).items():
            if size in self.by_size:
                places, q = self.by_size[size]
                self.best = [_first([*self.best, _nearest(places, q, base_ids[at], b, self.k, self.kind)], self.k)]

    def found(self, base_type: pa.DataType) -> pa.RecordBatch | None:
        if not self.best or not len(self.best[0]):
            return None
        best = self.best[0]
        return pa.RecordBatch.from_arrays(
            [self.ids.take(pa.array(best["place"].to_numpy())), pa.array(best["base_id"], base_type), pa.array(best["distance"].to_numpy())],
            names=["query_id", "base_id", "distance"],
        )


def _runs(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices of sorted batches whose integer ``columns`` do not change, with their values."""
    for batch in batches:
        if len(batch):
            keys = np.column_stack([batch.column(c).to_numpy() for c in columns])
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for a, b in zip(edges[:-1], edges[1:]):
                yield tuple(keys[a].tolist()), batch.slice(a, b - a)


def _as_list(vec: str) -> Column:
    return F.col(vec).cast("array<double>")


def vector_search(
    base: DataFrame, queries: DataFrame, k: int, kind: str = "cosine",
    b_id: str = "base_id", b_vec: str = "embedding", q_id: str = "query_id", q_vec: str = "embedding", task_blocks: int = 1,
) -> DataFrame:
    """Exact top ``k`` base vectors per query, as (query_id, base_id, distance, rank).

    Queries are cut into blocks of bounded bytes; a task holds one block, and base vectors stream past it, so it gives ``k``
    rows a query however many there are. Where there are few blocks of queries, the base is cut as well, so that tasks read
    about as many base vectors as there are queries to share them, or ``task_blocks`` blocks. Only vectors of equal length meet, whatever other lengths
    there are. Missing vectors match nothing, and neither do distances that are no number.
    """
    shares = _blocks(_values(queries, q_vec))
    pieces = max(1, -(-_blocks(_values(base, b_vec)) // max(shares, task_blocks)))
    base_type, query_type = dict(base.dtypes)[b_id], dict(queries.dtypes)[q_id]
    spread = F.pmod(F.xxhash64("base_id"), F.lit(pieces)) * shares
    b = base.filter(F.col(b_vec).isNotNull()).select(F.col(b_id).alias("base_id"), _as_list(b_vec).alias("vec"))
    b = b.select(F.explode(F.sequence(spread, spread + (shares - 1))).alias("block"), F.lit(1).alias("side"), F.lit(None).cast(query_type).alias("query_id"), "base_id", "vec")
    share = F.pmod(F.xxhash64("query_id"), F.lit(shares))
    q = queries.filter(F.col(q_vec).isNotNull()).select(F.col(q_id).alias("query_id"), _as_list(q_vec).alias("vec"))
    q = q.select(F.explode(F.sequence(share, share + (pieces - 1) * shares, F.lit(shares).cast("long"))).alias("block"), F.lit(0).alias("side"), "query_id", F.lit(None).cast(base_type).alias("base_id"), "vec")
    dealt = q.unionByName(b).repartition(pieces * shares, "block").sortWithinPartitions("block", "side")
    arrow_type = to_arrow_type(base.schema[b_id].dataType)

    def work(batches):
        block, held = None, None
        for (at, side), rows in _runs(batches, "block", "side"):
            if at != block:
                if held and (done := held.found(arrow_type)):
                    yield done
                block, held = at, _Queries(k, kind)
            if side:
                held.meet(rows)
            else:
                held.parts.append(rows)
        if held and (done := held.found(arrow_type)):
            yield done

    near = dealt.mapInArrow(work, f"query_id {query_type}, base_id {base_type}, distance double")
    return top_per_group(near, ["query_id"], [F.asc("distance"), F.asc("base_id")], k)


def _blocks(values: int) -> int:
    """Blocks that hold so many doubles."""
    return max(1, -(-values * 8 // BLOCK_BYTES))


def _values(df: DataFrame, vec: str) -> int:
    """Numbers in all vectors of a column."""
    return df.agg(F.sum(F.size(vec))).first()[0] or 0


# --- an index for approximate search -----------------------------------------------------------


class Codebook(NamedTuple):
    """Centres of the lists, and of each stretch of the residuals (stretches by centres by width)."""

    lists: np.ndarray
    words: np.ndarray

    def codes(self, residuals: np.ndarray) -> np.ndarray:
        """Nearest word of each stretch, one byte each."""
        out = np.empty((len(residuals), len(self.words)), np.uint8)
        for m, (part, words) in enumerate(zip(np.split(residuals, len(self.words), axis=1), self.words)):
            out[:, m] = ((words * words).sum(1) - 2 * part @ words.T).argmin(1)
        return out

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        """Residuals the codes stand for."""
        return np.concatenate([words[codes[:, m]] for m, words in enumerate(self.words)], axis=1)


def _lloyd(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """``k`` centres by Lloyd's rounds from evenly spaced points; empty cells keep their centre."""
    order = np.lexsort(points.T)
    centres = points[order[np.linspace(0, len(points) - 1, k).astype(int)]].copy() if len(points) else np.zeros((k, points.shape[1]))
    for _ in range(rounds if len(points) else 0):
        cell = ((centres * centres).sum(1) - 2 * points @ centres.T).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, points)
        n = np.bincount(cell, minlength=k)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def train_codebook(base: DataFrame, vec: str, lists: int, width: int = 4, sample: int = TRAIN_ROWS, seed: int = 42) -> Codebook:
    """Codebook of an index, fitted on at most ``sample`` vectors (chosen by a hash); each stretch has ``width`` numbers.

    Lists come from k-means; one task per stretch then finds 256 words for the residuals of the sample.
    """
    fixed = base.filter(F.col(vec).isNotNull()).select(_as_list(vec).alias("vec"))
    size = fixed.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is None or size["n"] % width:
        raise ValueError("an index needs vectors whose length is a multiple of the width")
    few = materialize(fixed.filter(F.size("vec") == size["n"]).orderBy(F.xxhash64("vec", F.lit(seed))).limit(sample), "index-sample")
    model = KMeans(k=lists, seed=seed, featuresCol="v").fit(few.select(array_to_vector("vec").alias("v")))
    centres = np.array(model.clusterCenters())
    stretches = size["n"] // width

    def cut(batches):
        for batch in batches:
            for _, x in _vectors(batch.column("vec")).values():
                parts = (x - centres[_gaps(x, centres, "euclidean").argmin(1)]).reshape(-1, width)
                at = np.tile(np.arange(stretches, dtype=np.int32), len(x))
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.FixedSizeListArray.from_arrays(pa.array(parts.ravel()), width).cast(pa.list_(pa.float64()))], names=["stretch", "part"])

    def words(table: pa.Table) -> pa.Table:
        points = table.column("part").combine_chunks().flatten().to_numpy().reshape(-1, width)
        return pa.table({"stretch": table.column("stretch")[:1], "words": pa.array([_lloyd(points, 256).tobytes()], pa.binary())})

    parts = few.mapInArrow(cut, "stretch int, part array<double>").groupBy("stretch").applyInArrow(words, "stretch int, words binary")
    found = {r["stretch"]: np.frombuffer(r["words"]).reshape(256, width) for r in parts.collect()}  # 256 * length numbers
    return Codebook(centres, np.stack([found[m] for m in range(stretches)]))


def build_index(base: DataFrame, codebook: Codebook, b_id: str = "base_id", b_vec: str = "embedding", copies: int = 1) -> DataFrame:
    """The index of every vector of the codebook's length: blocks of the lists, as (list_id, piece, ids, codes, vectors).

    A vector lies in its ``copies`` nearest lists, coded by the residual to each. Vectors without near neighbours, where cells say
    little, need several copies to be met in few lists. A long list is cut into blocks of bounded bytes, one row each. Write the
    result where it is used again.
    """
    lists, words = codebook
    size, copies = lists.shape[1], min(copies, len(lists))
    id_type = dict(base.dtypes)[b_id]
    arrow_type = to_arrow_type(base.schema[b_id].dataType)
    stored = np.float32 if dict(base.dtypes)[b_vec] == "array<float>" else np.float64
    rows = base.filter(F.size(b_vec) == size).select(F.col(b_id).alias("base_id"), _as_list(b_vec).alias("vec"))
    pieces = max(1, 2 * copies * _blocks(rows.count() * size) // len(lists))  # twice the mean, as lists are uneven

    def place(batches):
        for batch in batches:
            for at, x in _vectors(batch.column("vec")).values():
                near = np.argsort(_gaps(x, lists, "euclidean"), axis=1, kind="stable")[:, :copies]
                who, where = np.repeat(np.arange(len(x)), copies), near.ravel()
                codes = codebook.codes(x[who] - lists[where])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(where.astype(np.int32)), batch.column("base_id").take(pa.array(at[who])),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array([v.tobytes() for v in x[who].astype(stored)], pa.binary())],
                    names=["list_id", "base_id", "codes", "vector"])

    def pack(table: pa.Table) -> pa.Table:
        whole = {c: pa.array([b"".join(table.column(c).to_pylist())], pa.binary()) for c in ("codes", "vector")}
        ids = pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), table.column("base_id").combine_chunks().cast(arrow_type))
        return pa.table({"list_id": table.column("list_id")[:1], "piece": table.column("piece")[:1], "ids": ids, **whole})

    placed = rows.mapInArrow(place, f"list_id int, base_id {id_type}, codes binary, vector binary")
    dealt = placed.withColumn("piece", F.pmod(F.xxhash64("base_id"), F.lit(pieces)).cast("int"))
    return dealt.groupBy("list_id", "piece").applyInArrow(pack, f"list_id int, piece int, ids array<{id_type}>, codes binary, vector binary")


def search_index(
    index: DataFrame, codebook: Codebook, queries: DataFrame, k: int, fraction: float, rerank: int = RERANK,
    q_id: str = "query_id", q_vec: str = "embedding",
) -> DataFrame:
    """Approximate top ``k`` by Euclidean distance: each query looks into the nearest ``fraction`` of the lists.

    In each block of a list the codes are rated by the distance of the query to what they stand for, a matrix product for many
    queries at once, which costs less than to add up tables code by code; the ``rerank`` best are measured exactly. A task holds one block, and the queries that probe it stream past. With ``fraction`` 1 and ``rerank`` no
    less than a block holds, the result is exact, as is ``vector_search``.
    """
    lists, words = codebook
    size, probes = lists.shape[1], max(1, int(len(lists) * fraction))
    id_type, query_type = dict(index.dtypes)["ids"][len("array<"):-1], dict(queries.dtypes)[q_id]
    arrow_type = to_arrow_type(index.schema["ids"].dataType.elementType)

    def route(batches):
        for batch in batches:
            for at, x in _vectors(batch.column("vec")).values():
                near = np.argsort(_gaps(x, lists, "euclidean"), axis=1, kind="stable")[:, :probes]
                who = np.repeat(np.arange(len(x)), probes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near.ravel().astype(np.int32)), batch.column("query_id").take(pa.array(at[who])), pa.array([v.tobytes() for v in x[who]], pa.binary())],
                    names=["list_id", "query_id", "vector"])

    def measure(held: pa.RecordBatch, asked: pa.RecordBatch) -> pa.RecordBatch | None:
        ids = held.column("ids")[0].values
        codes = np.frombuffer(held.column("codes")[0].as_buffer(), np.uint8).reshape(len(ids), len(words))
        raw = held.column("vector")[0].as_buffer()
        known = np.frombuffer(raw, np.float32 if raw.size == 4 * len(ids) * size else np.float64).reshape(len(ids), size)
        q = np.frombuffer(b"".join(asked.column("vector").to_pylist())).reshape(-1, size)
        coded = (lists[held.column("list_id")[0].as_py()] + codebook.decoded(codes)).astype(np.float32)
        half = (coded * coded).sum(1) / 2
        who, which, gaps = [], [], []
        step = max(1, MATRIX_CELLS // len(ids))
        for a in range(0, len(q), step):
            rated = half - q[a:a + step].astype(np.float32) @ coded.T  # order of the distances to the decoded vectors
            best = np.argpartition(rated, rerank - 1, axis=1)[:, :rerank] if len(ids) > rerank else np.tile(np.arange(len(ids)), (len(rated), 1))
            for j, near in enumerate(best, a):
                exact = np.round(np.sqrt(((known[near].astype(np.float64) - q[j]) ** 2).sum(1)), _DIGITS)
                kept = exact <= np.partition(exact, min(k, len(exact)) - 1)[min(k, len(exact)) - 1]
                who.append(np.full(int(kept.sum()), j))
                which.append(near[kept])
                gaps.append(exact[kept])
        place, base = np.concatenate(who), np.concatenate(which)
        return pa.RecordBatch.from_arrays(
            [asked.column("query_id").take(pa.array(place)), ids.take(pa.array(base)).cast(arrow_type), pa.array(np.concatenate(gaps))], names=["query_id", "base_id", "distance"])

    def work(batches):
        key, held = None, None
        for (list_id, piece, side), rows in _runs(batches, "list_id", "piece", "side"):
            if (list_id, piece) != key:
                key, held = (list_id, piece), None
            if not side:
                held = rows.slice(0, 1)
            elif held is not None:
                yield measure(held, rows)

    pieces = [r["piece"] for r in index.select("piece").distinct().collect()]  # as many as one list has blocks
    nothing = {"ids": f"array<{id_type}>", "codes": "binary", "query_id": query_type}
    blocks = index.select("list_id", "piece", F.lit(0).alias("side"), "ids", "codes", "vector", F.lit(None).cast(query_type).alias("query_id"))
    asked = (
        queries.filter(F.size(q_vec) == size).select(F.col(q_id).alias("query_id"), _as_list(q_vec).alias("vec"))
        .mapInArrow(route, f"list_id int, query_id {query_type}, vector binary")
        .select("list_id", F.explode(F.array(*[F.lit(p) for p in sorted(pieces)] or [F.lit(0)])).alias("piece"), F.lit(1).alias("side"),
                *[F.lit(None).cast(nothing[c]).alias(c) for c in ("ids", "codes")], "vector", "query_id")
    )
    dealt = blocks.unionByName(asked).repartition("list_id", "piece").sortWithinPartitions("list_id", "piece", "side")
    near = dealt.mapInArrow(work, f"query_id {query_type}, base_id {id_type}, distance double")
    # a vector may be met in several lists, at the same exact distance
    return top_per_group(near.repartition("query_id").distinct(), ["query_id"], [F.asc("distance"), F.asc("base_id")], k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact (query_id, base_id) pairs that were found, over all queries."""
    hits = exact.select("query_id", "base_id").join(found.select("query_id", "base_id", F.lit(1).alias("hit")), ["query_id", "base_id"], "left")
    return hits.agg(F.countDistinct("query_id").alias("queries"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))


def match_top(near: DataFrame, left_key: str, name: str) -> DataFrame:
    """Array of the matched ids per query, nearest first (``k`` entries at most)."""
    pairs = F.array_sort(F.collect_list(F.struct("rank", "base_id")))
    return near.groupBy(F.col("query_id").alias(left_key)).agg(F.transform(pairs, lambda p: p["base_id"]).alias(name))


def similar_split(base: DataFrame, vec: str, query: list[float], threshold: float, labels: tuple[str, str], kind: str = "cosine") -> DataFrame:
    """Label rows by whether they are nearer to one query vector than a threshold."""
    gap = distance(F.col(vec), F.array(*[F.lit(float(x)) for x in query]), kind)
    return base.withColumn("distance", gap).withColumn("side", F.when(gap < threshold, labels[0]).otherwise(labels[1]))


def fit_embedder(df: DataFrame, col: str, size: int = 256) -> PipelineModel:
    """Default text embedding: hashed token counts, weighted by rarity, of unit length."""
    words = df.select(tokens(F.col(col)).alias("__tokens"))
    stages = [
        HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=size),
        IDF(inputCol="__tf", outputCol="__idf"),
        Normalizer(inputCol="__idf", outputCol="__unit"),
    ]
    return Pipeline(stages=stages).fit(words)


def embed(df: DataFrame, col: str, embedder, name: str = "embedding") -> DataFrame:
    """Add an embedding column, from a fitted pipeline or any ``pandas_udf`` on text."""
    if isinstance(embedder, PipelineModel):
        out = embedder.transform(df.withColumn("__tokens", tokens(F.col(col))))
        return out.withColumn(name, vector_to_array("__unit", "float32")).drop("__tokens", "__tf", "__idf", "__unit")
    return df.withColumn(name, embedder(F.col(col)))


def distinct_values(tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct values of every text column whose name does not end in ``_id``."""
    parts = []
    for name, df in tables.items():
        cols = [c for c, kind in df.dtypes if kind == "string" and not c.lower().endswith("_id")]
        if cols:
            cell = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("text_content")) for c in cols]))
            parts.append(df.select(F.lit(name).alias("table_name"), cell.alias("v")).select("table_name", "v.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter("text_content IS NOT NULL").distinct()


def best_column(meta: DataFrame, probe: DataFrame, vec: str, k: int = 1) -> DataFrame:
    """The ``k`` column values nearest to a search text; ``probe`` is its one embedded row.

    The search reads its base twice, so values and vectors are written before.
    """
    place = F.to_json(F.struct("table_name", "column_name", "text_content"))
    named = materialize(meta.select(place.alias("base_id"), vec), "named-values")
    near = vector_search(named, probe.select(F.lit(0).alias("query_id"), F.col(vec).alias("q")), k, "cosine", b_vec=vec, q_vec="q", task_blocks=TASK_BLOCKS)
    back = F.from_json("base_id", "table_name string, column_name string, text_content string")
    return near.select(back.alias("m"), F.round("distance", 6).alias("distance"), "rank").select("m.*", "distance", "rank")
