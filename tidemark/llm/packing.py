"""Best-fit packing: a configuration linear program over the length histogram.

Texts become token ids; a document longer than a sequence is cut into full pieces. What is packed after that is only the
histogram of piece lengths, at most one number per length, so it fits anywhere whatever the number of documents. A
configuration is a set of lengths that fits one sequence. The linear program asks for the fewest sequences whose
configurations hold all pieces; multiplicative weights solve it, and each step prices lengths and finds the best
configuration by knapsack dynamic programming. The fractional numbers of sequences are rounded down, and what they leave
is packed best-fit, longest first. Each configuration then stands for runs of numbered pieces of its lengths, and pieces
find their sequence and offset by a join on length and number.

Defined results: a null or empty text is one piece holding only the end token. Repeated rows are packed each. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.arrays import text_runs
from tidemark.llm.numbering import number_within
from tidemark.llm.registry import query
from tidemark.llm.wordbpe import tokenizer
from tidemark.session import Tables, materialize

LENGTH = 4096
END_ID = 1
STEPS, RATE = 160, 2.0  # of multiplicative weights
SCALES = (1.0, 0.75, 0.5, 0.25, 0.0)  # of the fractional solution, before it is rounded down
TOKENIZERS = "/opt/tokenizers"
TOKENIZER = "word_bpe_49k.json"


def pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` of each piece, with its ``ids`` if asked for."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches):
        known = tokenizer(tokenizer_path)
        for part, data, offsets in text_runs(batches, most=1 << 19):
            whole = data.tobytes()
            at = offsets.tolist()
            doc, piece, start, size, crc, held = [], [], [], [], [], []
            for i, ids in enumerate(known.ids([whole[a:b] for a, b in zip(at, at[1:])])):
                ids += end
                for k, a in enumerate(range(0, len(ids), 4 * length)):
                    these = ids[a : a + 4 * length]
                    doc.append(i), piece.append(k), start.append(a // 4), size.append(len(these) // 4), crc.append(zlib.crc32(these))
                    if with_ids:
                        held.append(np.frombuffer(these, dtype="<i4"))
            columns = [part.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, size, crc)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(held, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(cut, shape)


def _knapsack(value: np.ndarray, lengths: np.ndarray, length: int) -> list[int]:
    """Indexes into ``lengths`` (descending), with repeats, of the most valuable set that fits: one best value per capacity."""
    best = np.zeros(length + 1)
    chosen = np.full(length + 1, -1)
    first = len(lengths) - np.searchsorted(lengths[::-1], np.arange(length + 1), side="right")
    for c in range(int(lengths[-1]), length + 1):
        n = first[c]
        total = value[n:] + best[c - lengths[n:]]
        i = int(np.argmax(total))  # of equal values the longest length
        if total[i] > best[c - 1]:
            best[c], chosen[c] = total[i], n + i
        else:
            best[c] = best[c - 1]
    out, c = [], length
    while c > 0:
        if chosen[c] < 0:
            c -= 1
        else:
            out.append(int(chosen[c]))
            c -= int(lengths[chosen[c]])
    return out


def fractional(histogram: dict[int, int], length: int, steps: int) -> list[tuple[dict[int, int], float]]:
    """Configurations and numbers of sequences that hold no more pieces than there are, by multiplicative weights.

    A length's price falls as its share of packed pieces grows; each step adds the configuration that is worth most at these
    prices, as often as its scarcest length allows in a step. Prices start a little above proportion for long pieces, as
    short ones can still fill gaps later.
    """
    lengths = np.array(sorted(histogram, reverse=True))
    price = lengths * (1 + lengths / length / 8)
    amount = np.array([histogram[x] for x in lengths], dtype=float)
    packed = np.zeros(len(lengths))
    found: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        weight = np.exp(-RATE * (packed - packed.min()))
        config = Counter(_knapsack(weight * price, lengths, length))
        index = np.array(list(config))
        count = np.minimum(np.array([config[i] for i in index]), amount[index])
        times = float((amount[index] / count).min())
        packed[index] += count * times / amount[index]
        found.append((index, count, times))
    most = max(packed.max(), 1.0)
    return [({int(lengths[i]): int(c) for i, c in zip(index, count)}, times / most) for index, count, times in found]


def best_fit(histogram: dict[int, int], length: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing over whole groups: equal pieces go together into the fullest equal sequences they fit."""
    groups: dict[int, list[tuple[dict[int, int], int]]] = {}  # by room left
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        for room in sorted(r for r in groups if r >= size):
            kept = []
            for config, count in groups.pop(room):
                each = min(room // size, left)
                if not each:
                    kept.append((config, count))
                    continue
                take = min(count, left // each)
                left -= take * each
                groups.setdefault(room - each * size, []).append((config | {size: each}, take))
                if count > take:
                    kept.append((config, count - take))
            if kept:
                groups.setdefault(room, []).extend(kept)
            if not left:
                break
        if left:
            each = length // size
            if full := left // each:
                groups.setdefault(length - each * size, []).append(({size: each}, full))
            if rest := left - full * each:
                groups.setdefault(length - rest * size, []).append(({size: rest}, 1))
    return [x for held in groups.values() for x in held]


def plan(histogram: dict[int, int], length: int = LENGTH, steps: int = STEPS) -> list[tuple[dict[int, int], int]]:
    """Configurations and whole numbers of sequences that hold every piece of the histogram once.

    The fractional solution is rounded down after scaling it by one of ``SCALES``; what is left is packed best-fit. The
    scale that needs the fewest sequences wins, the largest of equals.
    """
    whole = [({length: 1}, histogram[length])] if histogram.get(length) else []
    partial = {k: n for k, n in histogram.items() if k < length and n}
    solved = fractional(partial, length, steps) if partial else []
    tried = []
    for scale in SCALES:
        left, out = dict(partial), list(whole)
        for config, times in solved:
            count = min([int(scale * times + 1e-9), *(left[k] // n for k, n in config.items())])
            if count:
                out.append((config, count))
                for k, n in config.items():
                    left[k] -= n * count
        tried.append(out + best_fit({k: n for k, n in left.items() if n}, length))
    return min(tried, key=lambda x: sum(count for _, count in x))


def place(cut: DataFrame, length: int = LENGTH, steps: int = STEPS) -> DataFrame:
    """``sequence_id`` and ``offset`` of each piece. ``cut`` is read three times, so pass a written table."""
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # one row per length
    taken, rows, first = Counter(), [], 0
    for config, count in plan(histogram, length, steps):
        offset = 0
        for size, each in config.items():
            rows.append((size, taken[size], taken[size] + each * count, each, first, offset))
            taken[size] += each * count
            offset += size * each
        first += count
    spark = cut.sparkSession
    shape = "size long, low long, high long, each long, first long, place long"
    runs = spark.createDataFrame(rows, shape)  # as many rows as configurations have lengths, whatever the number of pieces
    numbered = number_within(cut, "length", ["doc_id", "piece", "ids_crc32"], "rank")
    fits = (F.col("length") == F.col("size")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    step = F.col("rank") - F.col("low")
    return numbered.join(F.broadcast(runs), fits).select(
        *cut.columns,
        (F.col("first") + F.floor(step / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("place") + step % F.col("each") * F.col("size")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer_path: str | None = None, length: int = LENGTH, steps: int = STEPS, with_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its sequence and place there."""
    path = tokenizer_path or str(Path(TOKENIZERS) / TOKENIZER)
    return place(materialize(pieces(docs, path, length, with_ids=with_ids, id_col=id_col, text_col=text_col), "pieces"), length, steps)


@query("op10_packing")
def op10_packing(t: Tables) -> DataFrame:
    """Sequence of every piece of every document."""
    return pack(t.documents)
