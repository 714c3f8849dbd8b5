"""The parts the operators are made of, and results on the given tables."""

import random
import time
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import documents
from tidemark.llm import QUERIES
from tidemark.llm.arrays import column_bytes, prefix_hash, runs, sliding_min, span_hash, word_spans
from tidemark.llm.packing import best_fit, plan
from tidemark.llm.sharding import differencing


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\té日", max_size=12), max_size=8))
def test_word_spans(texts):
    import pyarrow as pa

    data, offsets = column_bytes(pa.array(texts, pa.string()))
    starts, ends, before = word_spans(data, offsets)
    got = [bytes(data[a:b]) for a, b in zip(starts, ends)]
    for k, text in enumerate(texts):
        assert got[before[k] : before[k + 1]] == text.encode().split()
    hashes = span_hash(prefix_hash(data), starts, ends)
    assert len(set(hashes.tolist())) == len(set(got))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=60), st.integers(1, 9))
def test_sliding_min(values, width):
    got = sliding_min(np.array(values, dtype=np.uint64), width)
    assert got.tolist() == [min(values[k : k + width]) for k in range(len(values) - width + 1)]


def test_runs_keep_long_rows_whole():
    assert list(runs(np.array([0, 3, 3, 50, 52]), 5)) == [(0, 2), (2, 3), (3, 4)]


def test_differencing_beats_greedy():
    r = random.Random(5)
    items = [(r.randint(1, 10_000), k) for k in range(400)]
    of = differencing(items, 8)
    sums = Counter()
    for size, k in items:
        sums[of[k]] += size
    assert len(of) == 400 and max(sums.values()) - min(sums.values()) <= 5


@settings(max_examples=20, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20))
def test_plans_hold_every_piece(histogram):
    for found in (plan(histogram, 64, 20), best_fit(histogram, 64)):
        total = Counter()
        for config, count in found:
            assert count > 0 and sum(k * n for k, n in config.items()) <= 64
            for k, n in config.items():
                total[k] += n * count
        assert total == Counter(histogram)


def test_plan_needs_fewer_sequences_than_best_fit():
    r = random.Random(1)
    histogram = Counter(r.randint(1300, 1500) for _ in range(5000))
    assert sum(n for _, n in plan(histogram)) < sum(n for _, n in best_fit(histogram, 4096))


def test_word_tokenizer_equals_the_library():
    from tidemark.llm.wordbpe import WordTokenizer

    known = WordTokenizer("/opt/tokenizers/word_bpe_49k.json")
    r = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCÉéñßüïŒ日Σς01 .,!?'&$-\n\t\x1c\x85"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(400)]
    texts += ["<|endoftext|> x", "<|ENDOFTEXT|>", "it's don't 'S", "a.b,c. ...,,, &&&. the&&&.", "x" * 2000]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in known.library.encode_batch(texts, add_special_tokens=False)]
    assert known.ids([t.encode() for t in texts]) == want


def test_suffix_order(spark):
    from tidemark.llm.suffix_order import suffix_ranks

    r = random.Random(2)
    strings = {s: [r.randint(1, 3) for _ in range(r.randint(1, 40))] for s in range(12)}
    rows = [(s, i, x) for s, text in strings.items() for i, x in enumerate(text)]
    got = suffix_ranks(spark.createDataFrame(rows, "sid long, i long, name long")).collect()
    order = [strings[x["sid"]][x["i"] :] for x in sorted(got, key=lambda x: x["rank"])]
    assert len(got) == len(rows) and order == sorted(order)


def test_box_pairs_lose_none():
    from tidemark.llm.jaccard_join import GROUPS, box_pairs

    r = np.random.default_rng(4)
    vectors = r.integers(0, 4, (300, GROUPS)).astype(np.uint32)
    vectors[150:] = vectors[:150]
    vectors[150:, 0] += 1
    n = vectors.sum(axis=1).astype(np.int64)
    every = np.arange(300)
    got = set(zip(*(x.tolist() for x in box_pairs(n, vectors, every, every, 85))))
    want = {(a, b) for a in range(300) for b in range(300) if 185 * np.minimum(vectors[a], vectors[b]).sum() >= 85 * (n[a] + n[b])}
    assert got == want and any(a != b for a, b in want)


def test_components(spark):
    from tidemark.llm.components import components

    links = [(k, k + 1) for k in range(30)] + [(100, 101), (102, 101), (70, 70), (200, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert all(got[k] == 0 for k in range(31)) and got[101] == got[102] == 100 and got[300] == 200 and 70 not in got


def test_numbers_without_gaps(spark):
    from tidemark.llm.numbering import number_within

    got = number_within(spark.range(500).selectExpr("id % 3 AS k", "id"), "k", ["id"], "at").collect()
    for key in range(3):
        assert sorted(r["at"] for r in got if r["k"] == key) == list(range(sum(r["k"] == key for r in got)))


def test_learned_lexicon_finds_disguised_terms():
    from tidemark.llm.toxicity import INSULTS, automaton, fold, matched

    known = automaton(INSULTS)
    assert matched(fold("What an 1d10t!"), known)[0] == matched(fold("an іdіоt"), known)[0] == 3.0
    assert matched(fold("put it in the trash can"), known)[0] == 0
    assert matched(fold("tr@sh and more tr@sh"), known) == (3.0, 6.0)
    assert matched(fold("nothing here"), known) == (0, 0)


def test_held_out_toxicity(spark):
    got = QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.01").filter("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    rows = got.join(labels, "doc_id").collect()
    toxic, clean = ([r["score"] for r in rows if r["toxic"] == k] for k in (1, 0))
    wins = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean)
    assert wins / (len(toxic) * len(clean)) >= 0.85


def test_written_tables_leave_no_shuffle_files(spark):
    from tidemark.session import materialize

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {n for k in range(disk.getAllFiles().size()) if (n := disk.getAllFiles().apply(k).getName()).startswith("shuffle_")}
    before = shuffles()
    out = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "groups")
    for _ in range(50):  # they go in the background
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before and out.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"  # of the caller's queries


def test_near_copies_keep_only_tables_that_are_read(spark, edge):
    import os

    from tidemark.llm.jaccard_join import jaccard_components
    from tidemark.session import written_tables

    before = len(written_tables())
    got = jaccard_components(spark.read.parquet(f"{edge}/documents.parquet"), 5, 80)
    left = {os.path.basename(p).rsplit("-", 1)[0] for p in written_tables()[before:] if os.path.isdir(p.removeprefix("file://"))}
    assert left <= {"shingle-sets", "classes", "small-star", "star-links", "cross-links"}
    assert got.count() == len(documents())


def test_near_copies_move_only_rows_that_may_go(spark, edge):
    """Rows of one key and rows that are not the least of their group are grouped, others pass by."""
    import corpus_pipeline as cp

    rows = [(1, "a b c d e f", "en", "s2", 11), (1, "a b c d e f", "en", "s1", 11), (2, "a b c d e f", "en", "s0", 11), (3, "u v w x y z", "en", "s", 11), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    single = cp.one_of_each(spark, docs, edge)
    assert sorted(map(tuple, single.collect()), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)
    assert single._jdf.queryExecution().optimizedPlan().toString().startswith("Union")


def test_window_answers_grow_with_the_windows_alone():
    """Each part was compared with all repeated windows before, which took 9.9 CPU seconds here."""
    import pyarrow as pa

    from tidemark.llm.suffix_dedup import _window_answers

    rng = np.random.default_rng(3)
    every = rng.integers(0, 1 << 62, 700_000).astype(np.uint64)
    keys = [np.unique(rng.choice(every, 400)) for _ in range(3000)]
    counts = [rng.integers(1, 3, len(k)).astype(np.uint8) for k in keys]
    table = pa.table({"chunk": np.arange(3000), "keys": [k.tobytes() for k in keys], "counts": [c.tobytes() for c in counts]})
    began = time.process_time()
    got = _window_answers(table)
    assert time.process_time() - began < 3
    total = Counter()
    for k, c in zip(keys, counts):
        total.update(dict(zip(k.tolist(), c.tolist())))
    assert [np.frombuffer(b, np.uint64).tolist() for b in got.column("keys").to_pylist()] == [[x for x in k.tolist() if total[x] >= 2] for k in keys]


def test_kinds_of_segments_need_no_table(spark, edge):
    """All segments of a mark are in one bucket, so kinds are counted there; texts that lose nothing are not moved."""
    from tidemark.llm import suffix_dedup as sd
    from tidemark.session import written_tables

    docs = spark.read.parquet(f"{edge}/documents.parquet").select("doc_id", "text")
    before = len(written_tables())
    sd.repeated_spans(sd._keyed(docs), 240, ordered=False)
    assert len(written_tables()) - before == 3  # segments, spans at the edges, their texts
    _, same = sd.cut_repeats(docs, 240)
    assert same._jdf.queryExecution().optimizedPlan().toString().startswith("Union")
