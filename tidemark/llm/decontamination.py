"""Benchmark decontamination by templates.

Words become tokens: lower-cased, without signs around them. Numbers, names (capitalised inside a sentence; names in a row are
one) and units after a number become typed placeholders, so a question that was given other numbers or names keeps its
template. Windows of ``WIDTH`` tokens with at least ``LITERALS`` plain words are hashed, once with names as placeholders and
once with names as words, and a third time all windows as they stand, whatever they hold. The windows of documents are joined
to those of the benchmark by hash. A match counts if it holds no placeholder, or if along its diagonal (the same shift between
document and item) every value of the item always stands for the same value of the document and the other way round. So a
verbatim copy is always found, and a literal window next to values that contradict each other is not one.

Documents send on only windows whose hash may be in the benchmark, by a bitmap of fixed size, so the join moves few
rows. All windows of all texts are looked at, in the widths that the benchmark has.

Defined results: null and empty texts, documents or items, match nothing. An item with fewer tokens than a window is one
window; with fewer than ``LITERALS`` plain words it is matched as it stands, not with other values. Repeated documents are reported by id, once; equal items are reported
each. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.arrays import LOWER, U64, mix, prefix_hash, row_of, signed, span_hash, text_runs, word_spans
from tidemark.llm.bitmap import bitmap, may_hold
from tidemark.llm.registry import query
from tidemark.session import Tables, materialize

WIDTH, LITERALS = 8, 5

# Units, after a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ml l liter "
    "liters litre litres s sec second seconds min minute minutes h hour hours day days week weeks month months year years degree "
    "degrees percent dollar dollars cent cents euro euros mph kmh mol volt volts watt watts joule joules newton newtons"
).split()
_NUMBER, _NAME, _UNIT = (U64(x) for x in (1, 2, 3))
_LITERAL = 2  # the reading of all tokens as they stand
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:"]] = True


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer("".join(UNITS).encode(), np.uint8)
    ends = np.cumsum([len(u) for u in UNITS])
    return np.sort(span_hash(prefix_hash(data), np.r_[0, ends[:-1]], ends))


_KNOWN_UNITS = _unit_hashes()


def tokens(data: np.ndarray, offsets: np.ndarray):
    """Hash, kind (0 word, else placeholder) and row of each token."""
    starts, ends, before = word_spans(data, offsets)
    rows = row_of(before)
    core = _LETTER[data] | _DIGIT[data]
    n = len(data)
    place = np.arange(n)
    nxt = np.minimum.accumulate(np.where(core, place, n)[::-1])[::-1] if n else place
    prv = np.maximum.accumulate(np.where(core, place, -1)) if n else place
    lo = nxt[starts] if n else starts
    real = lo < ends
    stops = _STOP[data[ends - 1]] if n else np.zeros(0, bool)
    first = np.ones(len(starts), bool)
    first[1:] = stops[:-1] | (rows[1:] != rows[:-1])
    if len(starts) > 1:  # a line starts a sentence
        lines = np.concatenate([[0], np.cumsum(data == 10)])
        first[1:] |= lines[starts[1:]] != lines[ends[:-1]]
    lo, hi, rows, first = lo[real], prv[ends[real] - 1] + 1 if n else ends[real], rows[real], first[real]
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    capitals = np.concatenate([[0], np.cumsum(_UPPER[data])])
    hashes = span_hash(prefix_hash(LOWER[data]), lo, hi)
    lead = data[lo] if n else lo
    number = _DIGIT[lead] if len(lo) else np.zeros(0, bool)
    number = number | ((digits[hi] - digits[lo] > 0) & (digits[hi] - digits[lo] == hi - lo))
    capital = (_UPPER[lead] | ((lead == 0xC3) & (data[np.minimum(lo + 1, n - 1)] < 0x9F))) if len(lo) else np.zeros(0, bool)
    name = capital & ~first & (capitals[hi] - capitals[lo] <= 1) & (hi - lo > 1) & ~number
    kind = np.zeros(len(lo), U64)
    kind[number] = _NUMBER
    kind[name] = _NAME
    after = np.zeros(len(lo), bool)
    after[1:] = number[:-1] & (rows[1:] == rows[:-1])
    at = np.minimum(np.searchsorted(_KNOWN_UNITS, hashes), len(_KNOWN_UNITS) - 1)
    kind[after & (_KNOWN_UNITS[at] == hashes) & (kind == 0)] = _UNIT
    return hashes, kind, rows


def templates(data: np.ndarray, offsets: np.ndarray):
    """The three readings of each text: names as placeholders, names as words, and all as it stands.

    Each has the hash, kind and row of its tokens. The kinds of the last one only say which tokens are values, by
    themselves and not by those before them.
    """
    hashes, kind, rows = tokens(data, offsets)
    again = np.zeros(len(rows), bool)
    again[1:] = (kind[1:] == _NAME) & (kind[:-1] == _NAME) & (rows[1:] == rows[:-1])
    yield hashes[~again], kind[~again], rows[~again]
    yield hashes, np.where(kind == _NAME, U64(0), kind), rows
    at = np.minimum(np.searchsorted(_KNOWN_UNITS, hashes), len(_KNOWN_UNITS) - 1)
    yield hashes, np.where(kind == _NUMBER, kind, np.where(_KNOWN_UNITS[at] == hashes, _UNIT, U64(0))), rows


def windows(hashes, kind, rows, n_rows: int, width: int, literals: int = LITERALS):
    """Hash, row, place and first token of each window of one reading with enough words."""
    before = np.searchsorted(rows, np.arange(n_rows + 1))
    place = np.arange(len(rows)) - before[rows]
    size = np.diff(before)
    at = np.flatnonzero(place <= size[rows] - width)
    words = np.concatenate([[0], np.cumsum(kind == 0)])
    at = at[words[at + width] - words[at] >= min(literals, width)]
    code = np.where(kind == 0, hashes, kind)
    acc = np.full(len(at), U64(width))
    for j in range(width):
        acc = mix(acc * U64(31) + code[at + j])
    return acc, rows[at], place[at], at


def _found(widths_of: dict[int, list[int]], id_name: str, packed=None, whole_items: bool = False):
    """Rows of windows, in the widths of each reading: all of an item, or those of a document that the bitmap lets through."""

    def run(batches):
        for part, data, offsets in text_runs(batches):
            for names, (hashes, kind, rows) in enumerate(templates(data, offsets)):
                n = part.num_rows
                size = np.diff(np.searchsorted(rows, np.arange(n + 1)))
                plain = kind if names != _LITERAL else np.zeros_like(kind)
                for width in widths_of[names]:
                    key, row, place, at = windows(hashes, plain, rows, n, width)
                    keep = np.ones(len(key), bool)
                    if whole_items:  # items shorter than a window are one window
                        keep = (size[row] == width) | (width == max(widths_of[names]))
                    key = mix(key + U64(names))
                    if packed is not None:
                        keep &= may_hold(packed.value, signed(key))
                    key, row, place, at = key[keep], row[keep], place[keep], at[keep]
                    slots = []
                    for a in at.tolist():
                        k = kind[a : a + width]
                        slots.append([f"{t}:{h:x}" for t, h in zip(k[k > 0].tolist(), hashes[a : a + width][k > 0].tolist())])
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id").take(pa.array(row)), pa.array(signed(key)), pa.array(place.astype(np.int64)),
                         pa.array(np.full(len(key), names, np.int32)), pa.array(np.full(len(key), width, np.int32)), pa.array(slots, pa.list_(pa.string()))],
                        names=[id_name, "key", f"{id_name}_at", "reading", "width", f"{id_name}_slots"],
                    )

    return run


def _shape(df: DataFrame, name: str) -> str:
    return f"{name} {df.schema['id'].dataType.simpleString()}, key long, {name}_at long, reading int, width int, {name}_slots array<string>"


def find_leaks(docs: DataFrame, items: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``item_id``, ``n_windows`` (of the item) and ``n_changed`` (values that were replaced) of each leak."""
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text_col).cast("string").alias("text"))
    items = items.select(F.col(item_id).alias("id"), F.col(text_col).cast("string").alias("text"))
    templated = list(range(LITERALS, width + 1))
    widths = {0: templated, 1: templated, _LITERAL: list(range(1, width + 1))}
    known = materialize(items.mapInArrow(_found(widths, "item_id", whole_items=True), _shape(items, "item_id")), "item-windows")
    held = known.select("reading", "width").distinct().collect()  # at most the widths of each reading
    asked = {reading: sorted(r["width"] for r in held if r["reading"] == reading) for reading in widths}
    packed = docs.sparkSession.sparkContext.broadcast(bitmap(known, "key"))
    seen = docs.mapInArrow(_found(asked, "doc_id", packed), _shape(docs, "doc_id"))
    pairs = seen.join(known.drop("width"), ["key", "reading"]).withColumn("pairs", F.arrays_zip("doc_id_slots", "item_id_slots"))
    literal = F.col("reading") == _LITERAL
    # literal windows count their tokens as the reading with names as words does, so both share a diagonal
    along = pairs.groupBy("doc_id", "item_id", F.least("reading", F.lit(1)).alias("names"), (F.col("doc_id_at") - F.col("item_id_at")).alias("shift")).agg(
        F.collect_set("item_id_at").alias("places"),  # at most the windows of one item
        F.array_distinct(F.flatten(F.collect_list(F.when(~literal, F.col("pairs"))))).alias("pairs"),
        F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("all_pairs"),
        F.max(F.size("pairs") == 0).alias("plain"),
        F.max(~literal).alias("templated"),
        F.max(literal).alias("literal"),
    )

    def one_to_one(c: str):
        return F.expr(f"size({c}) = size(array_distinct({c}.doc_id_slots)) AND size({c}) = size(array_distinct({c}.item_id_slots))")

    leaks = along.filter(F.col("plain") | (F.col("templated") & one_to_one("pairs")) | (F.col("literal") & one_to_one("all_pairs")))
    return leaks.groupBy("doc_id", "item_id").agg(
        F.max(F.size("places")).cast("long").alias("n_windows"),
        F.max(F.expr("size(filter(pairs, p -> p.doc_id_slots <> p.item_id_slots))")).cast("long").alias("n_changed"),
    )


@query("op6_decontamination")
def op6_decontamination(t: Tables) -> DataFrame:
    """Every document that holds a benchmark item, or one with other values, next to the item."""
    return find_leaks(t.documents, t.benchmark)
