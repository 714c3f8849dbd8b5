"""N-gram Jaccard join: count vectors in a tree of boxes bound the overlap, survivors are verified.

Each text becomes the set of its distinct word shingles, and texts with equal sets become one class. A class is a point: its
shingles are hashed into ``GROUPS`` groups and counted. The overlap of two sets is at most the sum of the coordinates'
minima, so a pair whose sum is too low is never looked at, nor is any box of points whose upper corner is too low.

Points meet in blocks. Two sets that are similar enough share one of the first few shingles of a common order, so a class
goes to the block of each of its first shingles. The order puts frequent shingles last: frequencies come from a table of
counters of fixed size filled from all texts, and any such order keeps the result exact. In a block, classes are first
compared with its best-linked class, which settles groups of near copies with one pair each. Then only classes that are
still in different components are compared, by the tree. Large blocks are cut by set size and then into segments, and
every pair of segments is compared, so no pair is lost and no block has to fit in one task.

Defined results: null and wordless texts have an empty set and are linked with nothing. A null ``doc_id`` is carried along.
Repeated rows are copies of each other. Two sets count as equal if a 64-bit sum over their shingles and their size agree.
Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.arrays import LOWER, U64, mix, prefix_hash, row_of, shingles, signed, span_hash, text_runs, word_spans
from tidemark.llm.bitmap import bitmap, may_hold
from tidemark.llm.components import components
from tidemark.llm.registry import query, task_count
from tidemark.session import Tables, drop_materialized, materialize

WIDTH, PERCENT = 4, 85
GROUPS, FINE = 32, 256  # coordinates of a point, and of the finer one a pair is held to before its sets are fetched
COUNTERS, SLICES = 1 << 18, 64  # frequency table, and the parts it is added up in
SEGMENT = 4096  # classes of a block compared at once
LEAF = 16
MOST = 255  # of a count kept in one byte


def _sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, each row's in ascending order, and the number before each row."""
    data = LOWER[data]
    starts, ends, before = word_spans(data, offsets)
    hashes, rows = shingles(span_hash(prefix_hash(data), starts, ends), before, width)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])] if len(hashes) else np.zeros(0, bool)
    hashes, rows = hashes[new], rows[new]
    return hashes, np.searchsorted(rows, np.arange(len(offsets)))


def _set_ids(hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[U64(0)], np.cumsum(mix(hashes ^ U64(0xA5A5A5A5A5A5A5A5)))])
    return mix(sums[before[1:]] - sums[before[:-1]])


def _fine_vectors(hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Counts of each row's shingles in ``FINE`` groups."""
    rows = len(before) - 1
    cell = row_of(before) * FINE + ((hashes >> U64(8)) % U64(FINE)).astype(np.int64)
    return np.bincount(cell, minlength=rows * FINE).astype("<u4").reshape(rows, FINE)


def _packed(counts: np.ndarray) -> np.ndarray:
    """Counts as one byte each; the largest byte stands for itself and all above it."""
    return np.minimum(counts, MOST).astype(np.uint8)


def _unpacked(blobs: list[bytes], n: np.ndarray) -> np.ndarray:
    """Upper bounds of the counts: exact ones, and the set's size where the byte is at its largest."""
    counts = np.frombuffer(b"".join(blobs), dtype=np.uint8).reshape(-1, FINE).astype(np.int64)
    return np.where(counts == MOST, np.maximum(n, MOST)[:, None], counts)


def describe(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id``, set size ``n``, set id ``h`` and count vectors (``vector``, and the finer ``fine``) of each row; after them,
    with ``slice`` set, the frequency table of each task in slices."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        counters = np.zeros(COUNTERS, dtype=np.int64)
        ids = None
        for part, data, offsets in text_runs(batches):
            hashes, before = _sets(data, offsets, width)
            rows = part.num_rows
            np.add(counters, np.bincount((hashes >> U64(20)).astype(np.int64) % COUNTERS, minlength=COUNTERS), out=counters)
            cell = row_of(before) * GROUPS + (hashes % U64(GROUPS)).astype(np.int64)
            vectors = np.bincount(cell, minlength=rows * GROUPS).astype("<u4").reshape(rows, GROUPS)
            fine = _packed(_fine_vectors(hashes, before))
            ids = part.column("doc_id")
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.diff(before).astype(np.int64)), pa.array(signed(_set_ids(hashes, before))),
                 pa.array([v.tobytes() for v in vectors], pa.binary()), pa.array([v.tobytes() for v in fine], pa.binary()), pa.nulls(rows, pa.int32())],
                names=["doc_id", "n", "h", "vector", "fine", "slice"],
            )
        if ids is not None:
            cut = counters.astype("<i8").reshape(SLICES, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(SLICES, ids.type), pa.nulls(SLICES, pa.int64()), pa.nulls(SLICES, pa.int64()),
                 pa.array([c.tobytes() for c in cut], pa.binary()), pa.nulls(SLICES, pa.binary()), pa.array(range(SLICES), pa.int32())],
                names=["doc_id", "n", "h", "vector", "fine", "slice"],
            )

    return docs.mapInArrow(run, f"doc_id {id_type}, n long, h long, vector binary, fine binary, slice int")


def _frequencies(described: DataFrame) -> np.ndarray:
    """Logarithm (base 2) of the texts per counter, one byte each: ``COUNTERS`` bytes, whatever the number of texts."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(COUNTERS // SLICES, dtype=np.int64)
        for blob in table.column("vector"):
            total += np.frombuffer(blob.as_py(), dtype="<i8")
        level = np.floor(np.log2(np.maximum(total, 1))).astype(np.uint8)
        return pa.table({"slice": table.column("slice")[:1], "levels": pa.array([level.tobytes()], pa.binary())})

    parts = described.filter("slice IS NOT NULL").groupBy("slice").applyInArrow(add, "slice int, levels binary").collect()
    out = np.zeros((SLICES, COUNTERS // SLICES), dtype=np.uint8)
    for r in parts:
        out[r["slice"]] = np.frombuffer(r["levels"], dtype=np.uint8)
    return out.ravel()


def first_shingles(docs: DataFrame, width: int, percent: int, levels, buckets: int) -> DataFrame:
    """``bucket``, ``keys``, ``sets``: the first shingles of every set in the common order, as arrays per bucket."""

    def run(batches):
        held, size = [], 0

        def flush():
            keys, sets = (np.concatenate(x) for x in zip(*held))
            held.clear()
            at = (mix(keys) % U64(buckets)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            keys, sets = keys[order], sets[order]
            cut = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=buckets))])
            full = np.flatnonzero(np.diff(cut))
            return pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), pa.array([keys[cut[b] : cut[b + 1]].tobytes() for b in full], pa.binary()),
                 pa.array([sets[cut[b] : cut[b + 1]].tobytes() for b in full], pa.binary())],
                names=["bucket", "keys", "sets"],
            )

        frequent = levels.value
        for _, data, offsets in text_runs(batches):
            hashes, before = _sets(data, offsets, width)
            n = np.diff(before)
            rows = row_of(before)
            order = np.lexsort((hashes, frequent[(hashes >> U64(20)).astype(np.int64) % COUNTERS], rows))
            place = np.arange(len(hashes)) - before[rows]
            prefix = n + (-n * percent // 100) + 1  # n - ceil(n * percent / 100) + 1
            taken = order[place < prefix[rows]]
            held.append((hashes[taken], _set_ids(hashes, before)[rows[taken]]))
            size += len(taken)
            if size > 1 << 19:
                yield flush()
                size = 0
        if held:
            yield flush()

    return docs.mapInArrow(run, "bucket int, keys binary, sets binary")


def _shared(table: pa.Table) -> pa.Table:
    """``key`` and set ``h`` of every shingle that comes first in more than one set."""
    keys = np.concatenate([np.frombuffer(b, U64) for b in table.column("keys").to_pylist()])
    sets = np.concatenate([np.frombuffer(b, U64) for b in table.column("sets").to_pylist()])
    order = np.lexsort((sets, keys))
    keys, sets = keys[order], sets[order]
    new = np.r_[True, (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1])]
    keys, sets = keys[new], sets[new]
    again = np.r_[False, keys[1:] == keys[:-1]]
    many = again | np.r_[again[1:], False]
    return pa.table({"key": signed(keys[many]), "h": signed(sets[many])})


def _enough(overlap, n_a, n_b, percent: int):
    """Whether 100 * overlap >= percent * union."""
    return (100 + percent) * overlap >= percent * (n_a + n_b)


def box_pairs(n: np.ndarray, vectors: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (of ``left``, of ``right``) whose summed coordinate minima allow enough overlap.

    The points of ``right`` are packed into a tree: sorted by size, then in slices by their heaviest coordinates, ``LEAF`` to
    a box. A box keeps its upper corner and its least size; queries go down only where the corner allows enough overlap.
    """
    if not len(left) or not len(right):
        return np.zeros(0, int), np.zeros(0, int)
    sliced = np.argsort(n[right], kind="stable")
    slices = np.arange(len(right)) // (LEAF * LEAF)
    packed = right[sliced[np.lexsort((vectors[right[sliced], 0], slices))]]
    corners, least = [vectors[packed].astype(np.int64)], [n[packed]]
    while len(least[-1]) > LEAF:
        starts = np.arange(0, len(least[-1]), LEAF)
        corners.append(np.maximum.reduceat(corners[-1], starts, axis=0))
        least.append(np.minimum.reduceat(least[-1], starts))
    found = []
    for some in np.array_split(left, -(-len(left) // 256)):
        queries = np.repeat(some, len(least[-1]))
        nodes = np.tile(np.arange(len(least[-1])), len(some))
        for level in range(len(least) - 1, -1, -1):
            keep = np.zeros(len(nodes), bool)
            for a in range(0, len(nodes), 1 << 16):
                q, k = queries[a : a + (1 << 16)], nodes[a : a + (1 << 16)]
                keep[a : a + len(q)] = _enough(np.minimum(vectors[q], corners[level][k]).sum(axis=1), n[q], least[level][k], percent)
            queries, nodes = queries[keep], nodes[keep]
            if level:
                below = nodes[:, None] * LEAF + np.arange(LEAF)
                real = below < len(least[level - 1])
                queries, nodes = np.repeat(queries, LEAF)[real.ravel()], below[real]
        found.append((queries, packed[nodes]))
    return np.concatenate([q for q, _ in found]), np.concatenate([p for _, p in found])


def _unsettled(percent: int):
    """Pairs of one block whose components differ and whose bounds allow a link: that of the boxes, and that of the finer vectors."""

    def run(table: pa.Table) -> pa.Table:
        h, n, label, block, part = (table.column(c).to_numpy() for c in ("h", "n", "label", "block", "part"))
        blobs = table.column("fine").to_pylist()
        out = [], []
        order = np.argsort(block, kind="stable")
        cuts = np.r_[0, np.flatnonzero(np.diff(block[order])) + 1, len(order)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            rows = order[a:b]
            finer = _unpacked([blobs[k] for k in rows], n[rows])
            vectors = finer.reshape(len(rows), GROUPS, -1).sum(axis=2)  # the boxes are those of joined groups
            home, guest = np.flatnonzero(part[rows] == 0), np.flatnonzero(part[rows] == 1)
            for right in (home, guest):
                p, q = box_pairs(n[rows], vectors, home, right, percent)
                ok = label[rows[p]] != label[rows[q]]
                p, q = p[ok], q[ok]
                for k in range(0, len(p), 1 << 13):
                    x, y = p[k : k + (1 << 13)], q[k : k + (1 << 13)]
                    close = _enough(np.minimum(finer[x], finer[y]).sum(axis=1), n[rows[x]], n[rows[y]], percent)
                    out[0].append(h[rows[x[close]]])
                    out[1].append(h[rows[y[close]]])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
        a, b = np.minimum(a, b), np.maximum(a, b)
        pairs = np.unique(np.stack([a, b], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _set_blobs(width: int):
    def run(batches):
        for part, data, offsets in text_runs(batches):
            hashes, before = _sets(data, offsets, width)
            blobs = [hashes[a:b].tobytes() for a, b in zip(before[:-1], before[1:])]
            found = pa.array(signed(_set_ids(hashes, before)))
            yield pa.RecordBatch.from_arrays([part.column("h"), pa.array(blobs, pa.binary()), found], names=["h", "items", "found"])

    return run


def _verified(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right")):
                p, q = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = np.sort(np.concatenate([p, q]))  # two sets, so an element comes at most twice
                keep.append(bool(_enough(int((both[1:] == both[:-1]).sum()), len(p), len(q), percent)))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return run


def _links(pairs: DataFrame, rows: DataFrame, classes: DataFrame, width: int, percent: int, label: str) -> DataFrame:
    """The pairs that are links, written: those that the finer count vectors allow, by the whole sets of the classes in them."""
    points = classes.select("h", "n", "fine")
    sides = pairs.join(points.toDF("a", "n_a", "v_a"), "a").join(points.toDF("b", "n_b", "v_b"), "b")
    close = materialize(sides.mapInArrow(_bounded_finely(percent), "a long, b long"), "close-pairs")
    ends = close.select(F.col("a").alias("h")).unionByName(close.select(F.col("b").alias("h"))).distinct()
    wanted = materialize(ends.join(classes.select("h", "rep"), "h").withColumn("hash", F.xxhash64("rep")), "pair-ends")
    bits = rows.sparkSession.sparkContext.broadcast(bitmap(wanted, "hash"))

    def likely(batches):
        for batch in batches:
            yield batch.filter(pa.array(may_hold(bits.value, batch.column("hash").to_numpy())))

    texts = rows.withColumn("hash", F.xxhash64("doc_id"))
    texts = texts.mapInArrow(likely, texts.schema).join(wanted.select(F.col("rep").alias("doc_id"), "h"), "doc_id").select("h", "text")
    # rows of one id may hold other texts
    sets = texts.mapInArrow(_set_blobs(width), "h long, items binary, found long").filter("h = found")
    sets = materialize(sets.groupBy("h").agg(F.min("items").alias("items")), "pair-sets")
    right = close.join(sets.select(F.col("h").alias("b"), F.col("items").alias("right")), "b")
    both = right.join(sets.select(F.col("h").alias("a"), F.col("items").alias("left")), "a")
    links = materialize(both.select("a", "b", "left", "right").mapInArrow(_verified(percent), "a long, b long"), label)
    drop_materialized(close, wanted, sets)
    return links


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (least ``doc_id`` reachable by links) of each row."""
    spark = docs.sparkSession
    buckets = task_count(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    described = materialize(describe(rows, width), "shingle-sets")
    levels = spark.sparkContext.broadcast(_frequencies(described))  # one byte per counter
    owners = described.filter("slice IS NULL")
    classes = owners.filter("n > 0").groupBy("h").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.min("vector").alias("vector"), F.min("fine").alias("fine"))
    classes = materialize(classes, "classes")
    shared = first_shingles(rows.select("text"), width, percent, levels, buckets).groupBy("bucket").applyInArrow(_shared, "key long, h long")
    every = materialize(shared, "shared-shingles")
    # shingles that the same classes share make one block
    content = every.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("h")).alias("x"), F.bit_xor(F.xxhash64("h", F.lit(1))).alias("y"))
    shared = materialize(every.join(content.groupBy("n", "x", "y").agg(F.min("key").alias("key")), "key").select("key", "h"), "blocks")
    drop_materialized(every)

    # the class that shares most stands for its block
    degree = shared.groupBy("h").agg(F.count("*").alias("degree"))
    members = materialize(degree.join(classes.drop("fine"), "h"), "block-members")
    ranked = shared.join(members.select("h", "degree"), "h")
    centre = ranked.groupBy("key").agg(F.max(F.struct("degree", "h")).alias("c")).select("key", F.col("c.h").alias("centre"))
    star = shared.join(centre, "key").filter("h <> centre").select(F.least("h", "centre").alias("a"), F.greatest("h", "centre").alias("b")).distinct()
    points = members.select("h", "n", "vector")
    sides = star.join(points.toDF("a", "n_a", "v_a"), "a").join(points.toDF("b", "n_b", "v_b"), "b")
    allowed = materialize(sides.mapInArrow(_bounded(percent, GROUPS), "a long, b long"), "star-pairs")
    links = _links(allowed, rows, classes, width, percent, "star-links")

    labels = materialize(components(links, "a", "b"), "labels")
    labelled = members.join(labels, F.col("h") == F.col("node"), "left").withColumn("label", F.coalesce("component", "h"))
    placed = shared.join(labelled.select("h", "n", "label"), "h")
    mixed = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("key")
    left = materialize(_cross_pairs(placed.join(mixed, "key"), classes.select("h", "fine"), percent, buckets).join(allowed, ["a", "b"], "left_anti"), "cross-pairs")
    links = links.unionByName(_links(left, rows, classes, width, percent, "cross-links"))
    drop_materialized(shared, members, allowed, labels, left)

    groups = components(links, "a", "b")
    joined = classes.select("h", "rep").join(groups, F.col("h") == F.col("node"), "left").withColumn("component", F.coalesce("component", "h"))
    least = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    of = joined.join(least, "component").select("h", "component_id")
    return owners.select("doc_id", "n", F.when(F.col("n") > 0, F.col("h")).alias("h")).join(of, "h", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _bounded(percent: int, groups: int):
    """Pairs whose summed coordinate minima allow a link."""

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u4").reshape(-1, groups) for c in ("v_a", "v_b"))
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            keep = pa.array(_enough(np.minimum(a, b).sum(axis=1, dtype=np.int64), n_a, n_b, percent))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return run


def _bounded_finely(percent: int):
    """Pairs whose finer count vectors allow a link."""

    def run(batches):
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            a, b = (_unpacked(batch.column(c).to_pylist(), n) for c, n in (("v_a", n_a), ("v_b", n_b)))
            keep = pa.array(_enough(np.minimum(a, b).sum(axis=1), n_a, n_b, percent))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return run


def _cross_pairs(placed: DataFrame, vectors: DataFrame, percent: int, buckets: int) -> DataFrame:
    """Bounded pairs of different components in the blocks of ``placed``; ``vectors`` has the count vector of each class.

    Sizes of linked sets differ by at most the similarity, so a block is cut into bands of sizes, and a class visits its own
    band and, as a guest, the next. A band of many classes is cut into segments, and each pair of segments is a block.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / percent)) + 1e-9))
    homes = placed.withColumn("band", band.cast("long"))
    sizes = homes.groupBy("key", "band").agg(F.count("*").alias("many"))
    visits = homes.withColumn("visit", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("band", F.col("band") + F.col("visit"))
    cut = visits.join(sizes, ["key", "band"]).withColumn("segments", F.ceil(F.col("many") / SEGMENT).cast("int"))
    own = F.pmod(F.xxhash64("h", F.lit(7)), F.col("segments")).cast("int")
    # homes of one segment meet the homes of every segment from it on, and guests meet the homes of every segment
    other = F.explode(F.sequence(F.lit(0), F.col("segments") - 1))
    spread = cut.withColumn("own", own).withColumn("other", other)
    home_block = F.xxhash64("key", "band", F.least("own", "other"), F.greatest("own", "other"))
    as_home = spread.filter("visit = 0").select("h", "n", "label", home_block.alias("block"), F.lit(0).alias("part"))
    guest_block = F.xxhash64("key", "band", "other", "other")
    as_guest = spread.filter("visit = 1").select("h", "n", "label", guest_block.alias("block"), F.lit(1).alias("part"))
    dealt = as_home.unionByName(as_guest).join(vectors, "h").withColumn("bucket", F.pmod("block", F.lit(buckets * 8)))
    return dealt.groupBy("bucket").applyInArrow(_unsettled(percent), "a long, b long").distinct()


@query("op3_jaccard_join")
def op3_jaccard_join(t: Tables) -> DataFrame:
    """Component of every document under links of 85 % shared four-word shingles."""
    return jaccard_components(t.documents)
