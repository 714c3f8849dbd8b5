"""Toxicity: a weighted lexicon, found by Aho-Corasick in folded text, normalised by length.

Folding lower-cases, turns look-alike letters and digits inside words into plain letters, and makes everything else one
space, so that a term is found however it is written. The lexicon is a short list of insults plus terms learned from
labelled documents: words, and beginnings of words, whose share in toxic documents is far above that in others, weighted by
the logarithm of that ratio. A term inside an exception phrase does not count. Matched weights, alone and against the
length of the text, are turned into a score by a logistic regression on the same labelled documents.

Learning takes at most ``FIT_ROWS`` labelled rows, chosen by a hash of their ids; near copies among them count once. Texts
never pass through the driver: it sees counts of the candidate terms that pass the limits, at most ``MOST_TERMS``, and three
numbers per learning row. Every document is scored whole.

Defined results: a null or empty text is scored by the constant of the regression. Labels of ids with several rows count as
toxic if one does; null labels are not used. Without both kinds of labels the regression is ``PRIOR``. Repeated rows are scored
each. A null ``doc_id`` is held in (not held out). Other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.arrays import LOWER, prefix_hash, shingles, signed, span_hash, text_runs, word_spans
from tidemark.llm.registry import query
from tidemark.session import Tables, materialize

FIT_ROWS, MOST_TERMS = 20_000, 4000
SHORTEST, LONGEST = 4, 10  # letters of a learned beginning
LEAST_DOCS, LEAST_WEIGHT = 5, 2.0
PRIOR = (-4.0, 1.0, 0.0, 0.0)  # constant, and the three features

# Insults with their weight before learning, phrases that use one harmlessly, and look-alike letters.
INSULTS = {w: 3.0 for w in "idiot moron stupid loser worthless pathetic clown trash disgusting scum dumb imbecile filth".split()}
EXCEPTIONS = ["trash can", "trash bin", "clown fish", "clownfish", "pond scum", "sore loser rule", "not stupid", "not worthless"]
LOOKALIKES = dict(zip("авекмнорстухіјѕԁɡһӏ" + "οαερτυκνι" + "0134578", "abekmhopctyxijsdghl" + "oaeptukvi" + "oieastb", strict=True))

_FOLD = str.maketrans(LOOKALIKES)
_INSIDE = re.compile(r"(?<=\w)[@$](?=\w)")
_SIGNS = {"@": "a", "$": "s"}
_REST = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """Letters only, single spaces, one at each end."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if "@" in text or "$" in text:
        text = _INSIDE.sub(lambda m: _SIGNS[m[0]], text)
    return f" {_REST.sub(' ', text).translate(_FOLD).strip()} "


def automaton(terms: dict[str, float], exceptions=EXCEPTIONS):
    """Aho-Corasick automaton of terms, each at the beginning of a word, and of whole exception phrases (weight None)."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for term, weight in terms.items():
        found.add_word(f" {term}", (len(term) + 1, weight))
    for phrase in exceptions:
        words = fold(phrase)
        found.add_word(words, (len(words), None))
    found.make_automaton()
    return found


def matched(folded: str, known) -> tuple[float, float]:
    """Weights of distinct matched words, and of all matched words; a word counts with its heaviest term."""
    at: dict[int, tuple[float, int]] = {}
    spared = []
    for end, (size, weight) in known.iter(folded):
        start = end - size + 1
        if weight is None:
            spared.append((start, end))
        elif weight > at.get(start, (0.0, 0))[0]:
            at[start] = weight, end
    words: dict[str, float] = {}
    total = 0.0
    for start, (weight, _) in at.items():
        if not any(a <= start < b for a, b in spared):
            word = folded[start + 1 : folded.index(" ", start + 1)]
            words[word] = max(weight, words.get(word, 0.0))
            total += weight
    return sum(words.values()), total


def measured(folded: str, known) -> tuple[float, float, float]:
    """Features: distinct weight, the same over the logarithm of the words, and weight per word."""
    n = max(folded.count(" ") - 1, 0)
    distinct, total = matched(folded, known)
    return min(distinct, 30.0), min(distinct, 30.0) / np.log2(4 + n), min(total / (n + 10), 1.0) * 10


def _near_copy_ids(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Least shingle hash of each text: near copies almost always share it."""
    data = LOWER[data]
    starts, ends, before = word_spans(data, offsets)
    hashes, rows = shingles(span_hash(prefix_hash(data), starts, ends), before, 4)
    out = np.full(len(offsets) - 1, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(out, rows, hashes)
    return out


def _word_counts(batches):
    """Distinct words of each text, counted by label per task."""
    counts: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            for word in set(fold(text).split()):
                counts[word][toxic] += 1
    if counts:
        words = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(words), *(pa.array([counts[w][k] for w in words], pa.int64()) for k in (0, 1))], names=["word", "clean", "toxic"]
        )


def _with_copy_ids(batches):
    for part, data, offsets in text_runs(batches):
        yield pa.RecordBatch.from_arrays(
            [part.column("toxic"), part.column("text"), pa.array(signed(_near_copy_ids(data, offsets)))], names=["toxic", "text", "copy"]
        )


def fit_rows(docs: DataFrame, labels: DataFrame, usable: Column, most: int) -> DataFrame:
    """``toxic`` and ``text`` of the learning rows, near copies once."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    few = known.filter(usable).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chosen = rows.join(F.broadcast(few), "doc_id").select("toxic", "text")  # at most FIT_ROWS ids
    return chosen.mapInArrow(_with_copy_ids, "toxic int, text string, copy long").groupBy("copy").agg(
        F.max_by("toxic", F.struct("text", "toxic")).alias("toxic"), F.max("text").alias("text")
    )


def learn_terms(rows: DataFrame) -> dict[str, float]:
    """Weights of the terms; a beginning is left out where a shorter one says as much."""
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    terms = dict(INSULTS)
    if not clean or not toxic:
        return terms
    counts = rows.mapInArrow(_word_counts, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    begins = F.explode(F.expr(f"transform(sequence({SHORTEST}, least({LONGEST}, greatest({SHORTEST}, char_length(word)))), n -> left(word, n))"))
    stems = counts.filter(f"char_length(word) >= {SHORTEST}").select(begins.alias("term"), "clean", "toxic")
    stems = stems.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    ratio = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    strong = stems.filter(F.col("toxic") >= LEAST_DOCS).withColumn("weight", ratio).filter(F.col("weight") >= LEAST_WEIGHT)
    found = strong.orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "term").limit(MOST_TERMS).collect()
    for r in sorted(found, key=lambda r: len(r["term"])):
        shorter = max((terms.get(r["term"][:n], 0.0) for n in range(SHORTEST, len(r["term"]))), default=0.0)
        if r["weight"] > shorter + 0.3:
            terms[r["term"]] = max(float(r["weight"]), terms.get(r["term"], 0.0))
    return terms


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Constant and slopes of a logistic regression, by Newton steps with a ridge on the slopes."""
    if not len(y) or y.min() == y.max():
        return np.array(PRIOR)
    a = np.column_stack([np.ones(len(x)), x])
    keep = np.diag([0.0] + [ridge] * x.shape[1])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + keep + 1e-6 * np.eye(len(w)), a.T @ (y - p) - keep @ w)
        w += np.clip(step, -5, 5)
    return w


def toxicity(docs: DataFrame, labels: DataFrame, usable: Column | None = None, fit: int = FIT_ROWS) -> DataFrame:
    """``doc_id`` and ``score`` of every document; ``usable`` is the condition (on ``doc_id``) of the labels to learn from."""
    spark = docs.sparkSession
    rows = materialize(fit_rows(docs, labels, F.lit(True) if usable is None else usable, fit), "toxic-fit")
    terms = learn_terms(rows)

    def features(batches):
        known = automaton(terms)
        for batch in batches:
            found = [measured(fold(t), known) for t in batch.column("text").to_pylist()]
            a = np.array(found, dtype=float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array(a[:, k]) for k in range(3))], names=["toxic", "a", "b", "c"])

    table = rows.select("toxic", "text").mapInArrow(features, "toxic int, a double, b double, c double").toPandas()  # one row per learning row
    w = fit_logistic(table[["a", "b", "c"]].to_numpy(), table["toxic"].to_numpy(dtype=float))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast((terms, w))  # at most MOST_TERMS terms

    def score(batches):
        terms, w = shared.value
        known = automaton(terms)
        for batch in batches:
            found = [measured(fold(t or ""), known) for t in batch.column("text").to_pylist()]
            z = w[0] + np.array(found, dtype=float).reshape(-1, 3) @ w[1:]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(score, f"doc_id {id_type}, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


@query("op9_toxicity")
def op9_toxicity(t: Tables) -> DataFrame:
    """Score of every document, learned from the labels that are not held out."""
    scored = toxicity(t.documents, t.labels, ~held_out())
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
