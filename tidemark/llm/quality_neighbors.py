"""Quality by nearest-neighbour voting: labelled documents, as latent-semantic vectors, vote on every document by similarity.

A text is a bag of hashed terms: its lower-cased words, the shapes of its words (runs of capitals, letters, digits and signs),
words that follow themselves, and the order of magnitude of its number of words. Counts are damped by a logarithm, weighted
by the inverse document frequency, scaled to length one, and projected onto the leading eigenvectors of the term-by-term
product matrix of the labelled texts. The labelled vectors are broadcast; each task multiplies blocks of documents with
blocks of them, so every cosine is computed exactly, and keeps the ``NEIGHBOURS`` largest of each document. A label counts with its
similarity to the power ``SHARPNESS``.

Learning takes at most ``FIT_ROWS`` labelled rows, chosen by a hash of their ids; equal texts among them count once. The driver
sees sums of ``TERMS`` by ``TERMS`` numbers and the vectors of the labelled rows, never a text. Every document is scored whole.

Defined results: a null text is empty; an empty one has the term of no words only. What resembles no labelled text gets the share
of good labels; without labels that is ``PRIOR``. Labels of one id, or of equal texts, are averaged; null labels and null ids
are not used. Repeated rows are scored each. Of equal similarities at the last place any may count. A null
``doc_id`` is held in (not held out). Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.arrays import LOWER, mix, prefix_hash, row_of, span_hash, text_runs, word_spans
from tidemark.llm.registry import query
from tidemark.session import Tables, materialize

FIT_ROWS = 8192
TERMS, RANK = 1024, 32
NEIGHBOURS, SHARPNESS = 7, 4
BLOCK = 512  # documents, and labelled vectors times eight, of one product
PRIOR, LEAST_WEIGHT = 0.5, 1e-3
SLABS = 16  # parts of the product matrix that are summed on their own

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[48:58] = 65, 48
_SHAPE[97:123] = _SHAPE[128:] = 97
_WORD, _FORM, _AGAIN, _SIZE = (np.uint64(k) for k in (1, 2, 3, 4))


def damped_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row per text: logarithms of one plus the counts of its hashed terms."""
    n = len(offsets) - 1
    small = LOWER[data]
    starts, ends, before = word_spans(small, offsets)
    rows = row_of(before)
    words = span_hash(prefix_hash(small), starts, ends)
    shape = _SHAPE[data]
    kept = np.ones(len(data), dtype=bool)
    kept[1:] = shape[1:] != shape[:-1]
    kept[starts] = True
    place = np.cumsum(kept)
    forms = span_hash(prefix_hash(shape[kept]), place[starts] - 1, place[ends - 1])
    again = np.flatnonzero((words[1:] == words[:-1]) & (rows[1:] == rows[:-1]))
    sizes = np.frexp(np.diff(before).astype(float))[1].astype(np.uint64)
    hashes = np.concatenate([mix(words + _WORD), mix(forms + _FORM), np.full(len(again), mix(np.array([_AGAIN]))[0]), mix(mix(sizes) + _SIZE)])
    at = np.concatenate([rows, rows, rows[again], np.arange(n)])
    counts = np.bincount(at * TERMS + (hashes % np.uint64(TERMS)).astype(np.int64), minlength=n * TERMS)
    return np.log1p(counts.reshape(n, TERMS).astype(np.float32))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; a row of zeros stays."""
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def fit_rows(docs: DataFrame, labels: DataFrame, label: str, usable: Column, most: int) -> DataFrame:
    """``text_id``, ``label`` and ``text`` of the learning rows, equal texts once."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg(F.col(label).cast("double")).alias("label"))
    few = known.filter(usable).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chosen = rows.join(F.broadcast(few), "doc_id")  # at most FIT_ROWS ids
    return chosen.groupBy(F.sha2("text", 256).alias("text_id")).agg(F.avg("label").alias("label"), F.first("text").alias("text"))


def _summed(parts: DataFrame, length: int) -> dict[int, np.ndarray]:
    """Sum of the arrays of each slab, one task per slab; as many numbers as the slabs hold reach the driver."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(length)
        for chunk in table.column("sums").chunks:
            for held in chunk:
                total += np.frombuffer(held.as_buffer(), np.float64)
        return pa.table({"slab": table.column("slab")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    found = parts.groupBy("slab").applyInArrow(add, "slab int, sums binary").collect()
    return {r["slab"]: np.frombuffer(r["sums"], np.float64) for r in found}


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.float32).reshape(-1, TERMS)


class Model:
    """What the tasks need to score: weights of terms, projection, labelled vectors and their labels."""

    def __init__(self, weights: np.ndarray, projection: np.ndarray, vectors: np.ndarray, labels: np.ndarray):
        self.weights, self.projection, self.vectors, self.labels = weights, projection, vectors, labels
        self.prior = float(labels.mean()) if len(labels) else PRIOR

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return scaled(scaled(counts * self.weights) @ self.projection)

    def score(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Weighted share of good labels among the nearest of each row."""
        latent = self.latent(counts)
        out = np.empty(len(latent))
        for a in range(0, len(latent), BLOCK):
            best, good = np.zeros((len(latent[a : a + BLOCK]), 0), np.float32), np.zeros((len(latent[a : a + BLOCK]), 0))
            for b in range(0, len(self.vectors), 8 * BLOCK):
                cosines = latent[a : a + BLOCK] @ self.vectors[b : b + 8 * BLOCK].T
                near = np.argpartition(-cosines, neighbours - 1, axis=1)[:, :neighbours] if cosines.shape[1] > neighbours else np.arange(cosines.shape[1])[None].repeat(len(cosines), 0)
                best = np.hstack([best, np.take_along_axis(cosines, near, 1)])
                good = np.hstack([good, self.labels[b + near]])
            order = np.argsort(-best, axis=1, kind="stable")[:, :neighbours]
            weight = np.maximum(np.take_along_axis(best, order, 1), 0).astype(float) ** SHARPNESS
            votes = (weight * np.take_along_axis(good, order, 1)).sum(1) + LEAST_WEIGHT * self.prior
            out[a : a + BLOCK] = votes / (weight.sum(1) + LEAST_WEIGHT)
        return np.clip(out, 0.0, 1.0)


def fit(rows: DataFrame) -> Model:
    """The model of the learning rows; their texts stay in the tasks."""

    def counted(batches):
        for part, data, offsets in text_runs(batches):
            held = [row.tobytes() for row in damped_counts(data, offsets)]
            yield pa.RecordBatch.from_arrays([part.column("text_id"), part.column("label"), pa.array(held, pa.binary())], names=["text_id", "label", "counts"])

    counted_rows = materialize(rows.mapInArrow(counted, "text_id string, label double, counts binary"), "quality-fit")

    def frequencies(batches):
        total = np.zeros(TERMS + 1)
        for batch in batches:
            held = _matrix(batch)
            total[:TERMS] += (held > 0).sum(0)
            total[TERMS] += len(held)
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slab", "sums"])

    found = _summed(counted_rows.mapInArrow(frequencies, "slab int, sums binary"), TERMS + 1).get(0, np.zeros(TERMS + 1))
    weights = (np.log((1 + found[TERMS]) / (1 + found[:TERMS])) + 1).astype(np.float32)

    def products(batches):
        total = np.zeros((TERMS, TERMS))
        for batch in batches:
            held = scaled(_matrix(batch) * weights)
            total += held.T @ held
        cut = total.reshape(SLABS, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(SLABS), pa.int32()), pa.array([c.tobytes() for c in cut], pa.binary())], names=["slab", "sums"])

    slabs = _summed(counted_rows.mapInArrow(products, "slab int, sums binary"), TERMS * TERMS // SLABS)
    if not slabs:
        return Model(weights, np.zeros((TERMS, RANK), np.float32), np.zeros((0, RANK), np.float32), np.zeros(0))
    _, axes = np.linalg.eigh(np.concatenate([slabs[k] for k in range(SLABS)]).reshape(TERMS, TERMS))
    projection = np.ascontiguousarray(axes[:, ::-1][:, :RANK], dtype=np.float32)
    blank = Model(weights, projection, np.zeros((0, RANK), np.float32), np.zeros(0))

    def vectors(batches):
        for batch in batches:
            held = [v.tobytes() for v in blank.latent(_matrix(batch))]
            yield pa.RecordBatch.from_arrays([batch.column("text_id"), batch.column("label"), pa.array(held, pa.binary())], names=["text_id", "label", "latent"])

    known = counted_rows.mapInArrow(vectors, "text_id string, label double, latent binary").toArrow().sort_by("text_id")  # RANK numbers a learning row
    latent = np.frombuffer(b"".join(known.column("latent").to_pylist()), np.float32).reshape(-1, RANK)
    return Model(weights, projection, latent, known.column("label").to_numpy())


def neighbour_quality(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None, label: str = "quality", most: int = FIT_ROWS, neighbours: int = NEIGHBOURS
) -> DataFrame:
    """``doc_id`` and ``score`` of every document; ``usable`` is the condition (on ``doc_id``) of the labels to learn from."""
    model = fit(fit_rows(docs, labels, label, F.lit(True) if usable is None else usable, most))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FIT_ROWS vectors of RANK numbers, and TERMS times RANK
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def score(batches):
        for part, data, offsets in text_runs(batches):
            found = shared.value.score(damped_counts(data, offsets), neighbours)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(score, f"doc_id {id_type}, score double")


@query("op12_neighbour_quality")
def op12_neighbour_quality(t: Tables) -> DataFrame:
    """Score of every document, by votes of the labels that are not held out."""
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    scored = neighbour_quality(t.documents, t.labels, ~out)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
