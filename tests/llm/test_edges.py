"""Every operator on awkward tables, against plain Python or SQL, and on empty ones."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import CONVERSATIONS, documents, prose, rows_of
from tests.oracle import compare
from tidemark.llm import ORACLES, QUERIES

SMALL = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def low(text):
    return (text or "").encode().translate(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(name, spark, empty):
    assert QUERIES[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", ["op2_quality_rules", "op5_url_filters"])
def test_matches_sql(name, spark, edge, sql_on):
    assert compare(QUERIES[name](spark, edge), sql_on(edge), ORACLES[name]) == []


def held(doc_id, remainder):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == remainder


def test_lm_scores(spark, edge):
    order = 4
    rows = documents()
    words, contexts = Counter(), [defaultdict(Counter) for _ in range(order + 1)]

    def coded(text):
        return b"\xff" * order + low(text) + b"\xfe"

    for i, text in rows:
        if not held(i, 1):
            words.update(low(text).split())
            words["end"] += 1
            s = coded(text)
            for p in range(order, len(s)):
                for k in range(order + 1):
                    contexts[k][s[p - k : p]][s[p]] += 1
    total, distinct = sum(words.values()), len(words)

    def log_probability(context, symbol):
        out, ruled_out = 0.0, set()
        for k in range(order, -1, -1):
            left = {a: n for a, n in contexts[k].get(context[order - k :], {}).items() if a not in ruled_out}
            if left:
                size = sum(left.values()) + len(left)
                if symbol in left:
                    return out + math.log10(left[symbol] / size)
                out += math.log10(len(left) / size)
                ruled_out |= set(left)
        return out - math.log10(256 - len(ruled_out))

    want = []
    for i, text in rows:
        w = low(text).split() + ["end"]
        base = sum(math.log10((words[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w)
        s = coded(text)
        score = sum(log_probability(s[p - order : p], s[p]) for p in range(order, len(s)))
        want.append((str(i), held(i, 1), len(w), sum(words[x] > 0 for x in w), total, base, score))
    got = [(str(r[0]), *r[1:]) for r in QUERIES["op1_lm_scoring"](spark, edge).collect()]
    for a, b in zip(sorted(got, key=lambda r: (r[:5], round(r[5], 3))), sorted(want, key=lambda r: (r[:5], round(r[5], 3))), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-4)


def components(rows, width, percent):
    sets = []
    for _, text in rows:
        w = low(text).split()
        sets.append(frozenset(tuple(w[j : j + width]) for j in range(len(w) - width + 1)) or (frozenset([tuple(w)]) if w else frozenset()))
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and find(a) != find(b):
                up[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted((str(i), len(sets[k]), str(least.get(find(k)) if sets[k] else i)) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80)])
def test_jaccard_components(spark, edge, width, percent):
    from tidemark.llm.jaccard_join import jaccard_components

    got = jaccard_components(spark.read.parquet(f"{edge}/documents.parquet"), width, percent).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == components(documents(), width, percent)


def test_sharding(spark, edge):
    got = QUERIES["op4_sharding"](spark, edge).collect()
    texts = {}
    slots = defaultdict(list)
    for r in got:
        assert texts.setdefault(r["text_crc32"], r["shard"]) == r["shard"]
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in documents())
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want


def repeats(rows, length):
    seen = Counter()
    texts = [(t or "").encode() for _, t in rows]
    for t in texts:
        seen.update(t[p : p + length] for p in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        cover = np.zeros(len(t) + 1, int)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                cover[p] += 1
                cover[p + length] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((str(i), len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("length", [400, 60])
def test_repeats_are_cut(spark, edge, length):
    from tidemark.llm.suffix_dedup import remove_repeats

    docs = spark.read.parquet(f"{edge}/documents.parquet").filter("doc_id IS NULL OR doc_id <> 9")
    got = remove_repeats(docs, length).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == repeats([r for r in documents() if r[0] != 9], length)


def test_shorter_passages_are_reported(spark, tmp_path):
    rng = random.Random(7)

    def words(size):
        return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(size // 3))[:size]

    fifty, long, least = words(310), words(700), words(240)
    rows = [(k, words(900)) for k in range(8)]
    rows += [(10, words(500) + fifty + words(300)), (11, fifty + words(90)), (12, words(77) + fifty + words(400) + fifty)]
    rows += [(20, words(130) + long + words(200)), (21, words(350) + long[100:650] + fifty + words(20)), (22, words(50) + least), (23, least[:239] + words(300))]
    rows += [(30, rows[0][1]), (31, "é" * 700), (32, None), (32, ""), (None, fifty), (33, words(60)), (33, words(60) + least)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((str(r[0]), *r[1:]) for r in QUERIES["op7_suffix_dedup"](spark, str(tmp_path)).collect())
    assert [r[:5] for r in got] == repeats(rows, 400)
    assert [(r[0], r[1], r[5]) for r in got] == sorted(r[:3] for r in repeats(rows, 240))
    assert ("11", 400, 0, 310) in [(*r[:3], r[5]) for r in got]


def test_parts_of_open_windows_follow_their_number():
    from tidemark.llm.suffix_dedup import CHUNK_WINDOWS, _parts

    assert [_parts(n, 211) for n in (0, 5, 300 * CHUNK_WINDOWS - 1)] == [211, 211, 300]


def test_leaks(spark, edge):
    got = {(r["doc_id"], r["item_id"]): r["n_changed"] for r in QUERIES["op6_decontamination"](spark, edge).collect()}
    assert got == {(13, 2): 3, (10, 3): 0, (11, 3): 0, (12, 3): 0}  # the first name stands in no window with enough plain words


def test_changed_values_have_to_agree(spark):
    from tidemark.llm.decontamination import find_leaks

    text = "please mix {} kg of the fine sand with {} kg of white lime and then slowly add {} kg of cold water"
    items = spark.createDataFrame([(1, text.format(5, 7, 5))], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, text.format(8, 2, 8)), (2, text.format(8, 2, 9)), (3, text.format(8, 8, 8)), (4, "nothing of the kind is said here at all")], "doc_id long, text string"
    )
    assert [(r["doc_id"], r["n_changed"]) for r in find_leaks(docs, items).collect()] == [(1, 2)]


def test_verbatim_copies_of_any_item_are_found(spark):
    from tidemark.llm.decontamination import find_leaks

    texts = ["What is 12 + 30 - 7 * 4 / 2?", "Add 3 to 4 and halve it", "Name Paris", "1 2 3 4 5 6 7 8 9 10", "days pass by in 3 hours"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    copies = [(k, f"Some words come 5 {text} then others follow") for k, text in enumerate(texts)]
    docs = spark.createDataFrame(copies + [(9, "what is 12 + 30 - 7 * 4 / 5? add 3 to 5 and cut it, 1 2 3 4 5 6 7 9 8 10")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["item_id"], r["n_changed"]) for r in find_leaks(docs, items).collect()) == [(k, k, 0) for k in range(5)]


def test_quotes(spark, edge):
    got = QUERIES["op8_quotation"](spark, edge).collect()
    assert len(got) == len(CONVERSATIONS)
    first = {r["turn"]: r for r in got if r["conv_id"] == 1}
    assert [(first[k]["reply_to"], first[k]["depth"], first[k]["position"], first[k]["n_quotes"]) for k in range(4)] == [
        (None, 0, 0, 0), (0, 1, 1, 1), (1, 2, 2, 2), (0, 1, 3, 1)
    ]
    assert first[1]["own_text"] == "I am fine thanks a lot for asking me"
    assert first[2]["own_text"] == "Good to hear that indeed my friend"
    assert [r["reply_to"] for r in got if r["conv_id"] != 1] == [None] * 6
    assert sorted(r["position"] for r in got if r["conv_id"] == 2) == [0, 1, 2]


def test_short_quotes_of_longer_messages(spark):
    from tidemark.llm.quotation import link_quotes

    rows = [
        (1, 0, "user", "Well that all sounds good to me so let us meet"), (1, 1, "user", "something else is what I would rather do today"),
        (1, 2, "user", "> sounds good to me\nglad to hear"), (1, 3, "user", "> rather do\nwhy"), (1, 4, "user", "> good sounds\nno"),
        (1, 5, "user", "> glad\nyes"), (2, 0, "user", "sounds good to me"), (2, 1, "user", "> never said here at all\nx"),
    ]
    got = link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(r["conv_id"], r["turn"]): r["reply_to"] for r in got if r["reply_to"] is not None} == {(1, 2): 0, (1, 3): 1, (1, 5): 2}


def test_toxicity_scores(spark, edge):
    got = QUERIES["op9_toxicity"](spark, edge).collect()
    assert len(got) == len(documents())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] == held(r["doc_id"], 0) for r in got)


def test_packing(spark, edge):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file("/opt/tokenizers/word_bpe_49k.json")
    want = []
    for i, text in documents():
        ids = known.encode(text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            piece = np.array(ids[k : k + 4096], dtype="<u4").tobytes()
            want.append((str(i), k // 4096, k, len(piece) // 4, zlib.crc32(piece)))
    got = QUERIES["op10_packing"](spark, edge).collect()
    assert sorted((str(r[0]), *r[1:5]) for r in got) == sorted(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held_pieces in sequences.values():
        at = 0
        for offset, length in sorted(held_pieces):
            assert offset == at
            at += length
        assert at <= 4096


def test_pipeline(spark, edge, empty):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, empty).count() == 0
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    judged = {r["doc_id"] for r in QUERIES["op2_quality_rules"](spark, edge).collect() if r["kept"]}
    good = corpus_pipeline.good_quality(spark, docs, edge)
    assert {r["doc_id"] for r in good.collect()} == judged - {None}
    single = corpus_pipeline.one_of_each(spark, good, edge)
    kept = [(r["doc_id"], r["text"]) for r in good.select("doc_id", "text").collect()]
    assert {r["doc_id"] for r in single.collect()} == {int(c) for _, _, c in components(kept, 5, 80)}
    cut = {r["doc_id"]: r["text"] for r in corpus_pipeline.without_repeats(spark, single, edge).collect()}
    for i, n, gone, _, digest in repeats([(r["doc_id"], r["text"]) for r in single.collect()], corpus_pipeline.PASSAGE_BYTES):
        if n > gone:
            assert hashlib.sha256(cut[int(i)].encode()).hexdigest() == digest
    assert all(tuple(stage(spark, docs, edge).columns) == tuple(corpus_pipeline.COLUMNS) for _, stage in corpus_pipeline.STAGES[:-1])


def test_pipeline_judges_each_text_of_an_id(spark, edge):
    import corpus_pipeline as cp

    a, b, c, d = (prose(seed, 120) for seed in (20, 21, 22, 23))
    leak = d + " If Carol buys 7 apples for 9 dollars each then how much does she pay to Dave in total."
    rows = [(1, a), (1, "junk"), (2, b), (2, a + " stone"), (2, b), (3, c), (4, c + " river"), (4, d), (5, leak), (5, b + " " + c)]
    table = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t in rows for s in ("one", "two")], "doc_id long, text string, lang string, source string, n_chars long")

    def left(df):
        return sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in df.collect())

    def want(*pairs):
        return sorted((i is None, i, t) for i, t in pairs)

    assert left(cp.good_quality(spark, table, edge)) == want(*[r for r in rows if r[1] != "junk" for _ in range(2)])
    single = cp.one_of_each(spark, table.filter("text <> 'junk' AND doc_id < 5"), edge)
    assert left(single) == want((1, a), (2, b), (3, c), (4, d)) and {r["source"] for r in single.collect()} == {"one"}
    some = table.filter("doc_id = 5 AND source = 'one'")
    assert left(cp.without_leaks(spark, some, edge)) == want((5, b + " " + c))
    nameless = some.withColumn("doc_id", F.lit(None).cast("long"))
    assert left(cp.without_leaks(spark, nameless, edge)) == want((None, b + " " + c))
    assert len(left(cp.one_of_each(spark, nameless, edge))) == 2


def test_rows_of_tables():
    assert len(rows_of("documents")) == len(documents())
