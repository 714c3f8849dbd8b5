"""Filter audit, neighbour voting and fill-in-middle: their parts, awkward tables against plain Python or SQL, held-out labels."""

import hashlib
import itertools
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tests.conftest import FOLDER
from tests.llm.conftest import documents, prose, rows_of
from tests.oracle import compare, connect
from tidemark.llm import ORACLES, QUERIES
from tidemark.llm import filter_audit as fa, infill, quality_neighbors as qn
from tidemark.llm.arrays import column_bytes

sorted_ids = st.sets(st.integers(0, 60)).map(sorted)


@settings(max_examples=200, deadline=None)
@given(st.lists(sorted_ids, max_size=6), sorted_ids)
def test_galloping_merges(lists, ids):
    assert fa.union(lists) == sorted(set().union(*lists))
    for other in lists:
        assert fa.difference(ids, other) == sorted(set(ids) - set(other))
        assert fa.shared(ids, other) == len(set(ids) & set(other))


def test_gallop_finds_the_first_place():
    ids = [2, 4, 4 + 1, 9, 100, 1000, 1001]
    for start, target in itertools.product(range(len(ids)), range(0, 1003)):
        want = next((k for k in range(start, len(ids)) if ids[k] >= target), len(ids))
        assert fa.gallop(ids, start, target) == want


@pytest.mark.parametrize("name", ["op11_filter_audit", "op13_infill"])
def test_awkward_tables_match_sql(name, spark, edge, sql_on):
    assert compare(QUERIES[name](spark, edge), sql_on(edge), ORACLES[name]) == []


def audit_of(rows, marks):
    """Every part, order and step, document by document. ``rows``: part, id, text; ``marks``: id to (good, toxic)."""
    least = {}
    for _, i, text in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    judged = []
    for part, i, text in rows:
        words = (text or "").encode().split()
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text or "") > 5 * len(text or ""),
            "D": any(c in "#$%&*|" for c in text or ""), "E": i is not None and least[text or ""] < i,
        }
        judged.append((part or "", {f for f in fails if fails[f]}, *marks.get(i, (0, 0))))
    out, shapley = {}, Counter()
    for part in {r[0] for r in judged}:
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                mine = [r for r in judged if r[0] == part]
                left = [r for r in mine if not r[1] & set(order[: step - 1])]
                gone = [r for r in left if f in r[1]]
                shapley[part, f] += len(gone)
                out[part, "".join(order), step] = (
                    len(left) - len(gone), len(gone), sum(f in r[1] for r in mine) - len(gone), sum(r[1] == {f} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)
                )
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_against_every_document(spark, edge):
    rows = [(part, i, text) for i, text in documents() for part in (("a", None) if i is None or i % 3 else ("b",))]
    marks, table = {}, rows_of("labels")
    for i, quality, toxic in table:
        if i is not None:
            good, bad = marks.get(i, (0, 0))
            marks[i] = (max(good, int(quality == 1)), max(bad, int(toxic == 1)))
    docs = spark.createDataFrame([(i, part, text) for part, i, text in rows], "doc_id long, source string, text string")
    labels = spark.createDataFrame(table, "doc_id long, quality int, toxic int")
    lists = fa.postings(docs, labels)
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in fa.COUNTS[1:]) for r in fa.interactions(lists).collect()}
    assert got == audit_of(rows, marks)
    held = lists.filter("part = 'a'").collect()
    assert sorted(str(i) for r in held for i in r["ids"]) == sorted(str(i) for part, i, _ in rows if part == "a")
    assert all(list(r[f]) == sorted(set(r[f])) for r in held for f in fa.LISTS)


def test_ranges_add_up(spark, monkeypatch):
    docs = spark.createDataFrame([(k // 3 if k % 7 else None, "s", prose(k % 40, k % 90)) for k in range(400)], "doc_id long, source string, text string")
    labels = spark.createDataFrame([(k, k % 2, k % 3) for k in range(150)], "doc_id long, quality int, toxic int")
    want = fa.interactions(fa.postings(docs, labels)).collect()
    rows = pa.RecordBatch.from_pydict({"part": ["s"] * 9 + ["t"] * 3, "doc_id": list(range(12)), "fails": [k % 32 for k in range(12)], "marks": [k % 4 for k in range(12)]})
    monkeypatch.setattr(fa, "RANGE_ROWS", 4)
    cut = list(fa._listed([rows.slice(k, 2) for k in range(0, 12, 2)]))
    assert [(b.column("part")[0].as_py(), len(b.column("ids")[0])) for b in cut] == [("s", 4), ("s", 4), ("s", 1), ("t", 3)]
    assert cut[1].column("A")[0].as_py() == [k - 4 for k in range(4, 8) if k % 2]
    assert sorted(want) == sorted(fa.interactions(fa.postings(docs.repartition(5), labels)).collect())


texts = st.text(alphabet="ab<PSM>é日😀 \n", max_size=40)


@settings(max_examples=300, deadline=None)
@given(texts, st.integers(0, 10_000))
def test_infill_round_trip(text, key):
    raw = text.encode()
    got = infill.transform(raw, str(key))
    h = [int(hashlib.sha256(f"1:{key}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        want = infill.Infill(n, "plain", None, None, raw)
    elif h[3] % 100 < 20:
        want = infill.Infill(n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}".encode())
    else:
        want = infill.Infill(n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}".encode())
    assert got == want
    assert infill.restore(got.output, got.form) == raw


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=30), st.data())
def test_rotation_exchanges_neighbours(data, draw):
    start, cut, end = sorted(draw.draw(st.tuples(*[st.integers(0, len(data))] * 3)))
    held = bytearray(data)
    infill.rotate(held, start, cut, end)
    assert bytes(held) == data[:start] + data[cut:end] + data[start:cut] + data[end:]


def test_outputs_are_texts(spark, edge):
    done = infill.fill_in_middle(spark.read.parquet(f"{edge}/documents.parquet"), plain=0, spm=50)
    back = {(str(r["doc_id"]), r["text"]) for r in infill.restore_texts(done).collect()}
    assert back == {(str(i), t or "") for i, t in documents()}
    assert {r["form"] for r in done.collect()} == {"plain", "psm", "spm"}


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def test_neighbour_scores(spark, edge):
    got = QUERIES["op12_neighbour_quality"](spark, edge).collect()
    assert len(got) == len(documents())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) and r["held_out"] == held_out(r["doc_id"]) for r in got)


def test_blocks_give_the_exact_neighbours():
    rng = np.random.default_rng(3)
    texts = [prose(int(k), int(rng.integers(0, 60))) for k in rng.integers(0, 200, 900)]
    counts = qn.damped_counts(*column_bytes(pa.array(texts)))
    axes = rng.normal(size=(qn.TERMS, qn.RANK)).astype(np.float32)
    known = qn.scaled(rng.normal(size=(5000, qn.RANK))).astype(np.float32)
    model = qn.Model(np.ones(qn.TERMS, np.float32), axes, known, rng.integers(0, 2, 5000).astype(float))
    latent = model.latent(counts)
    cosines = latent @ known.T
    for k, score in enumerate(model.score(counts, 7)):
        near = np.argsort(-cosines[k])[:7]
        weight = np.maximum(cosines[k][near], 0).astype(float) ** qn.SHARPNESS
        assert score == pytest.approx(((weight * model.labels[near]).sum() + qn.LEAST_WEIGHT * model.prior) / (weight.sum() + qn.LEAST_WEIGHT), abs=1e-4)


def test_terms_are_counted_per_text():
    texts = ["a b a", "", "A  B\nA", None, "x" * 300, "one!! TWO!! one!!", "a a a"]
    counts = qn.damped_counts(*column_bytes(pa.array(texts)))
    assert counts.shape == (len(texts), qn.TERMS)
    total = np.expm1(counts).sum(1).round().astype(int).tolist()
    assert total == [3 + 3 + 1, 1, 3 + 3 + 1, 1, 1 + 1 + 1, 3 + 3 + 1, 3 + 3 + 2 + 1]  # words, shapes, repeats, size
    assert (counts[1] == counts[3]).all() and not (counts[0] == counts[6]).all()


def test_held_out_labels_are_met(spark, edge):
    con = connect(FOLDER.replace("0.001", "0.01"))
    quality = dict(con.sql("SELECT doc_id, quality FROM labels").fetchall())
    got = QUERIES["op12_neighbour_quality"](spark, FOLDER.replace("0.001", "0.01")).collect()
    judged = [(quality[r["doc_id"]], r["score"], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in quality]
    good, bad = ([j[1:] for j in judged if j[0] == y] for y in (1, 0))
    above = np.mean([g[0] > b[0] for g in good for b in bad])
    assert above > 0.97 and np.mean([p for _, p in good]) > 0.95 and np.mean([1 - p for _, p in bad]) > 0.7


def test_held_out_labels_are_not_learned(spark, edge):
    docs = spark.createDataFrame([(k, prose(k, 80) if k % 2 else "junk " * 40, "x", "y") for k in range(60)], "doc_id long, text string, lang string, source string")
    truth = spark.createDataFrame([(k, k % 2, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    turned = spark.createDataFrame([(k, 1 - k % 2 if held_out(k) else k % 2, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    out = ~(qn.F.crc32(qn.F.col("doc_id").cast("string")) % 5 == 0)
    one, two = ({r["doc_id"]: r["score"] for r in qn.neighbour_quality(docs, labels, out).collect()} for labels in (truth, turned))
    assert one == two
    assert all((s > 0.5) == bool(k % 2) for k, s in one.items())
    none = qn.neighbour_quality(docs, truth.limit(0)).collect()
    assert {r["score"] for r in none} == {qn.PRIOR}
