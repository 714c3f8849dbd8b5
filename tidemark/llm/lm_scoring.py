"""LM scoring by prediction by partial matching: log probability of each text under a byte-context trie.

The model predicts each byte of the lower-cased text, and an end, from the ``ORDER`` bytes before it. Contexts of all lengths form a
trie of counts. Coding starts at the longest context seen in training; a symbol not seen there costs an escape (the number
of distinct symbols over that number plus the count, method C) and the next shorter context is asked, without the symbols
the longer one has ruled out (exclusion), down to equal shares of all bytes left.

The trie covers the whole training text and is never held in one place. Documents are taken in chunks of neighbouring rows.
Each chunk lists the distinct (context, symbol) strings and words in it, with its training counts, as sorted arrays per hash
bucket. Buckets add the counts up; each distinct string gets its code length, next to all strings with the same last two
context bytes, which is all that escapes and exclusions need besides a 256 x 256 table; and buckets send every chunk back
the code lengths it asked for. A chunk then needs only its own answers. A string occurs once per chunk, so no bucket grows
faster than the number of chunks over the number of buckets.

Defined results: a null text is an empty one; it has only its end. A null ``doc_id`` is a training row. Repeated rows are
counted and scored each. Without training rows every byte costs the same. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.arrays import LOWER, U64, column_bytes, mix, prefix_hash, row_of, runs, signed, span_hash, word_spans
from tidemark.llm.registry import query, task_count
from tidemark.session import Tables, materialize

ORDER = 4  # the packed strings below are written for this length
CHUNK_ROWS = 4096
START, END = 0xFF, 0xFE  # bytes that UTF-8 never holds
END_WORD = U64(0x656E64)
GRAMS, WORDS = 0, 1
_ASKED = "kind int, chunk long, bucket int, keys binary, counts binary, total long, distinct long"


def with_chunks(docs: DataFrame, rows: int = CHUNK_ROWS) -> DataFrame:
    """Adds ``chunk``: which neighbouring rows of a file belong together, the same in every scan of the table."""
    return docs.withColumn("chunk", F.xxhash64(F.col("_metadata.file_path"), F.expr(f"_metadata.row_index div {rows}")))


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed string of each byte and of each end, and its row. Packed from the nearest context byte to the farthest,
    then the symbol, so that a shorter context is a prefix."""
    rows = len(offsets) - 1
    lead = np.full(ORDER, START, dtype=np.uint8)
    # every text stands between ORDER start bytes and an end
    size = np.diff(offsets) + ORDER + 1
    at = np.concatenate([[0], np.cumsum(size)])
    padded = np.full(at[-1], START, dtype=np.uint8)
    row = np.repeat(np.arange(rows), np.diff(offsets))
    padded[np.arange(len(data)) - offsets[row] + at[row] + ORDER] = data
    padded[at[1:] - 1] = END
    wide = padded.astype(U64)
    n = len(padded) - len(lead)
    key = wide[ORDER - 1 : ORDER - 1 + n] << U64(32)
    for back in range(1, ORDER):
        key |= wide[ORDER - 1 - back : ORDER - 1 - back + n] << U64(32 - 8 * back)
    key |= wide[ORDER:]
    owner = np.repeat(np.arange(rows), size)[ORDER:]
    real = np.repeat(at[:-1] + ORDER, size)[ORDER:] <= np.arange(ORDER, len(padded))
    return key[real], owner[real]


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word, and of each row's end."""
    starts, ends, before = word_spans(data, offsets)
    hashes = span_hash(prefix_hash(data), starts, ends)
    rows = len(offsets) - 1
    return np.concatenate([hashes, np.full(rows, END_WORD)]), np.concatenate([row_of(before), np.arange(rows)])


def _totals(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of the counts of each."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def _distinct(keys: np.ndarray, rows: np.ndarray, train: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their training counts, by a sort of keys that carry the training flag in a low bit."""
    if bits < 64:
        tagged = np.sort(keys << U64(1) | train[rows].astype(U64))
        keys, flag = tagged >> U64(1), (tagged & U64(1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
        return keys[first], np.add.reduceat(flag, first) if len(first) else flag
    return _totals(keys, train[rows].astype(np.int64))


def _bucket_rows(kind: int, chunk: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> list[tuple]:
    at = (mix(keys) % U64(buckets)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    keys, counts = keys[order], counts[order]
    cut = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=buckets))])
    return [
        (kind, chunk, b, keys[cut[b] : cut[b + 1]].tobytes(), counts[cut[b] : cut[b + 1]].astype("<i8").tobytes(), None, None)
        for b in range(buckets) if cut[b] < cut[b + 1]
    ]


def _frame(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    names = ["kind", "chunk", "bucket", "keys", "counts", "total", "distinct"]
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)


def _requests(buckets: int):
    """Distinct strings and words of each chunk; rows of a chunk come one after another."""

    def extract(batches):
        chunk, held = None, {GRAMS: [], WORDS: []}

        def flush():
            for kind, parts in held.items():
                if parts:
                    keys, counts = _totals(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
                    yield _frame(_bucket_rows(kind, chunk, keys, counts, buckets))
                    parts.clear()

        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            data = LOWER[data]
            of = batch.column("chunk").to_numpy()
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            cuts = np.r_[0, np.flatnonzero(of[1:] != of[:-1]) + 1, len(of)] if len(of) else []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if of[lo] != chunk:
                    yield from flush()
                    chunk = int(of[lo])
                for a, b in runs(offsets[lo : hi + 1]):
                    a, b = a + lo, b + lo
                    text, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                    keys, rows = _grams(text, at)
                    held[GRAMS].append(_distinct(keys, rows, train[a:b], 40))
                    keys, rows = _words(text, at)
                    held[WORDS].append(_distinct(keys, rows, train[a:b], 64))
        yield from flush()

    return extract


def _keys(blob) -> np.ndarray:
    return np.frombuffer(blob, dtype=U64)


def _add_up(table: pa.Table) -> pa.Table:
    """One bucket: words are answered with their counts; strings pass on, with one more row of their sums (chunk null)."""
    kind, bucket = table.column("kind")[0].as_py(), table.column("bucket")[0].as_py()
    chunks = table.column("chunk").to_pylist()
    keys = [_keys(b) for b in table.column("keys").to_pylist()]
    counts = [np.frombuffer(b, dtype="<i8") for b in table.column("counts").to_pylist()]
    every, summed = _totals(np.concatenate(keys), np.concatenate(counts))
    if kind == GRAMS:
        rows = [(kind, c, bucket, k.tobytes(), b"", None, None) for c, k in zip(chunks, keys)]
        rows.append((kind, None, bucket, every.tobytes(), summed.tobytes(), None, None))
    else:
        rows = [(kind, c, bucket, k.tobytes(), summed[np.searchsorted(every, k)].tobytes(), None, None) for c, k in zip(chunks, keys)]
        rows.append((kind, None, bucket, b"", b"", int(summed.sum()), int((summed > 0).sum())))
    return pa.Table.from_batches([_frame(rows)])


def _unpacked(batches):
    for batch in batches:
        for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(signed(_keys(keys))), pa.array(np.frombuffer(counts, dtype="<i8"))], names=["gram", "count"])


class _Level:
    """Contexts of one length with their symbols, from packed (context, symbol) entries and counts over 0."""

    def __init__(self, entries: np.ndarray, counts: np.ndarray):
        self.entries, self.counts = _totals(entries, counts)
        nodes = self.entries >> U64(8)
        self.first = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]]) if len(nodes) else np.zeros(0, int)
        self.nodes = nodes[self.first]
        self.total = np.add.reduceat(self.counts, self.first) if len(nodes) else self.counts
        self.symbols = np.diff(np.r_[self.first, len(nodes)])

    @staticmethod
    def _find(among: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(among):
            return np.zeros(len(wanted), bool), np.zeros(len(wanted), int)
        at = np.minimum(np.searchsorted(among, wanted), len(among) - 1)
        return among[at] == wanted, at

    def node(self, wanted):
        return self._find(self.nodes, wanted)

    def count(self, wanted):
        found, at = self._find(self.entries, wanted)
        return np.where(found, self.counts[at] if len(self.counts) else 0, 0)

    def exclude(self, shorter: _Level) -> None:
        """What is left of the shorter context of each node once this node's symbols are taken out: count and symbols."""
        up = self.nodes >> U64(8)
        _, at = shorter.node(up)
        same = shorter.count((self.entries >> U64(16)) << U64(8) | self.entries & U64(255))
        gone = np.add.reduceat(same, self.first) if len(self.first) else same
        self.rest_total = shorter.total[at] - gone
        self.rest_symbols = shorter.symbols[at] - self.symbols


def code_lengths(grams: np.ndarray, levels: list[_Level]) -> np.ndarray:
    """log10 probability of the symbol of each packed string; ``levels`` by context length, from 0."""
    symbol = grams & U64(255)
    out = np.zeros(len(grams))
    coded = np.zeros(len(grams), bool)
    escaped_from = np.full(len(grams), -1)  # node one level longer that was escaped from or passed
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        context = grams >> U64(8 * (ORDER - k) + 8)
        found, at = level.node(context)
        fresh = escaped_from < 0
        total, symbols = (x[at] if len(x) else np.zeros(len(grams)) for x in (level.total, level.symbols))
        if k + 1 < len(levels) and len(levels[k + 1].nodes):
            longer = np.maximum(escaped_from, 0)
            total = np.where(fresh, total, levels[k + 1].rest_total[longer])
            symbols = np.where(fresh, symbols, levels[k + 1].rest_symbols[longer])
        active = found & ~coded & (symbols > 0)
        n = level.count(context << U64(8) | symbol)
        hit = active & (n > 0)
        size = np.maximum(total + symbols, 1).astype(float)
        out[hit] += np.log10(n[hit] / size[hit])
        miss = active & ~hit
        out[miss] += np.log10(symbols[miss] / size[miss])
        coded |= hit
        escaped_from = np.where(found, at, -1)
    seen = int(levels[0].symbols[0]) if len(levels[0].symbols) else 0
    out[~coded] -= np.log10(max(256 - seen, 1))
    return out


def _model(pairs: np.ndarray, pair_counts: np.ndarray, buckets: int):
    """Code length of every distinct string of one group, which holds all strings with the same last two context bytes."""

    def build(table: pa.Table) -> pa.Table:
        grams = table.column("gram").to_numpy().view(U64)
        counts = table.column("count").to_numpy()
        used = counts > 0
        trained, n = grams[used], counts[used]
        levels = [_Level(pairs & U64(255), pair_counts), _Level(pairs, pair_counts)]
        for k in range(2, ORDER + 1):
            levels.append(_Level(trained >> U64(8 * (ORDER - k) + 8) << U64(8) | trained & U64(255), n))
        for shorter, longer in zip(levels, levels[1:]):
            longer.exclude(shorter)
        lengths = code_lengths(grams, levels)
        order = np.argsort(grams)
        rows = _bucket_rows(GRAMS, 0, grams[order], lengths[order].view(np.int64), buckets)
        return pa.Table.from_batches([_frame(rows)])

    return build


def _answer(asked: pa.Table, model: pa.Table) -> pa.Table:
    keys = np.concatenate([_keys(b) for b in model.column("keys").to_pylist()] or [np.zeros(0, U64)])
    lengths = np.concatenate([np.frombuffer(b, dtype="<f8") for b in model.column("counts").to_pylist()] or [np.zeros(0)])
    order = np.argsort(keys)
    keys, lengths = keys[order], lengths[order]
    rows = []
    for chunk, bucket, blob in zip(*(asked.column(c).to_pylist() for c in ("chunk", "bucket", "keys"))):
        rows.append((GRAMS, chunk, bucket, blob, lengths[np.searchsorted(keys, _keys(blob))].astype("<f4").tobytes(), None, None))
    return pa.Table.from_batches([_frame(rows)])


def _score(total: int, distinct: int):
    norm = total + 0.5 * (distinct + 1)

    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        known = {}
        for kind, shape in ((GRAMS, "<f4"), (WORDS, "<i8")):
            mine = answers.filter(pa.compute.equal(answers.column("kind"), kind))
            keys = np.concatenate([_keys(b) for b in mine.column("keys").to_pylist()] or [np.zeros(0, U64)])
            values = np.concatenate([np.frombuffer(b, dtype=shape) for b in mine.column("counts").to_pylist()] or [np.zeros(0, shape)])
            order = np.argsort(keys)
            known[kind] = keys[order], values[order]
        data, offsets = column_bytes(docs.column("text"))
        out = [[], [], [], []]
        for a, b in runs(offsets):
            text, at = LOWER[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]
            rows = b - a
            keys, values = known[WORDS]
            words, of = _words(text, at)
            order = np.argsort(words)
            count, of = values[np.searchsorted(keys, words[order])], of[order]
            out[0].append(np.bincount(of, minlength=rows))
            out[1].append(np.bincount(of[count > 0], minlength=rows))
            out[2].append(np.bincount(of, weights=np.log10((count + 0.5) / norm), minlength=rows))
            keys, values = known[GRAMS]
            grams, of = _grams(text, at)
            tagged = np.sort(grams << U64(24) | of.astype(U64))
            grams, of = tagged >> U64(24), (tagged & U64((1 << 24) - 1)).astype(np.int64)
            first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
            cost = np.repeat(values[np.searchsorted(keys, grams[first])].astype(float), np.diff(np.r_[first, len(grams)]))
            out[3].append(np.bincount(of, weights=cost, minlength=rows))
        n_tokens, n_known, base, model = (np.concatenate(x) if x else np.zeros(0) for x in out)
        n = docs.num_rows
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": pa.array(~docs.column("train").to_numpy().astype(bool)),
            "n_tokens": pa.array(n_tokens.astype(np.int64)), "n_known": pa.array(n_known.astype(np.int64)),
            "train_tokens": pa.array(np.full(n, total, dtype=np.int64)), "base_score": pa.array(base.astype(float)),
            "score": pa.array(model.astype(float)),
        })

    return score


def lm_score(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every row of a table read from files; ``train`` is the condition of the rows to learn from."""
    spark = docs.sparkSession
    buckets = task_count(spark)
    rows = with_chunks(docs).select(
        "chunk", F.col(id_col).alias("doc_id"), F.coalesce(train, F.lit(True)).alias("train"), F.col(text_col).cast("string").alias("text")
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()
    asked = rows.select("chunk", "train", "text").mapInArrow(_requests(buckets), _ASKED)
    added = materialize(asked.groupBy("kind", "bucket").applyInArrow(_add_up, _ASKED), "lm-counts")
    total, distinct = added.filter(f"kind = {WORDS} AND chunk IS NULL").agg(F.sum("total"), F.sum("distinct")).first()
    strings = added.filter(f"kind = {GRAMS} AND chunk IS NULL").select("keys", "counts").mapInArrow(_unpacked, "gram long, count long")
    # nearest context byte and symbol: at most 256 x 256 rows
    pair = F.shiftright("gram", 32) * 256 + F.expr("gram & 255")
    pairs = strings.filter("count > 0").groupBy(pair.alias("pair")).agg(F.sum("count").alias("n")).orderBy("pair").collect()
    first = np.array([r["pair"] for r in pairs], dtype=U64)
    counts = np.array([r["n"] for r in pairs], dtype=np.int64)
    near = F.pmod(F.xxhash64(F.shiftright("gram", 24)), F.lit(buckets))
    model = strings.withColumn("near", near).groupBy("near").applyInArrow(_model(first, counts, buckets), _ASKED)
    wanted = added.filter(f"kind = {GRAMS} AND chunk IS NOT NULL").select("chunk", "bucket", "keys")
    answered = wanted.groupBy("bucket").cogroup(model.groupBy("bucket")).applyInArrow(_answer, _ASKED)
    answers = answered.unionByName(added.filter(f"kind = {WORDS} AND chunk IS NOT NULL")).select("kind", "chunk", "keys", "counts")
    shape = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_score(total or 0, distinct or 0), shape)


@query("op1_lm_scoring")
def op1_lm_scoring(t: Tables) -> DataFrame:
    """Score of every document under a model of the documents that are not held out."""
    return lm_score(t.documents, F.crc32(F.col("doc_id").cast("string")) % 5 != 1)
