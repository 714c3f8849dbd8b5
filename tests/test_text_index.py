"""The positional index against a search of the texts."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.search import matches, tokens
from tidemark.operators import relational as rel, text_index as x
from tidemark.session import scratch_path

TERMS = ["the with", "license", "nosuchword", "the en", "`of the`", "`the`", "`of the of`", "``", "", " ?! ", "`the with`", "en", "of of the", "Ünï", "`ab ab ab`", "x1"]
ROWS = [
    (1, "Of the OF the of, THE", "en"), (1, "of_the nothing", None), (None, "the\nof  the with", "en"), (2, None, None), (3, "", "the"), (4, "with-the", "with"),
    (5, "ünï ÜNÏ codé 日本語 of日本the", "x"), (6, "ab ab", "y"), (7, "ab ab ab ab", "y"), (8, "x1 1x x1y", "of the"), (9, "🙂the🙂of🙂the", "z"), (1, "Of the OF the of, THE", "en"),
]


@pytest.fixture(scope="module")
def table(spark):
    path = scratch_path(spark, "texts")
    spark.createDataFrame(ROWS, "doc_id long, text string, lang string").repartition(4).write.parquet(path)
    return spark.read.parquet(path)


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("cols", [["text"], ["text", "lang"], None])
def test_index_finds_what_search_finds(spark, table, cols):
    index = x.open_index(spark, x.write_index(table, ["text", "lang"], scratch_path(spark, "index"), 4), 4)
    for term in TERMS:
        want = rel.search(table, cols or ["text", "lang"], term)
        assert _rows(x.indexed_search(table, index, term, cols)) == _rows(want), term
        assert x.find_rows(index, term, cols).count() == want.count()
        files = x.files_opened(index, term, cols).first()
        hidden = want.select(F.input_file_name().alias("f")).distinct().count() if want.count() else 0
        assert (files.files, files.opened) == (4, hidden)


def test_search_is_by_whole_tokens(spark, table):
    """Against the tokens themselves, cut in Python."""
    import regex

    for term in TERMS:
        words = [w for w in regex.split(r"[^\p{L}\p{N}]+", term.strip("`").lower()) if w]
        phrase = term.startswith("`") and len(term) > 1
        for text, found in table.select("text", matches(F.col("text"), term).alias("found")).collect():
            cut = [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]
            runs = [cut[k:k + len(words)] for k in range(len(cut))]
            want = bool(words) and (words in runs if phrase else set(words) <= set(cut))
            assert (found or False) == want, (term, text)
    assert table.select(F.max(F.size(tokens(F.col("text"))))).first()[0] == 6


def test_positions_are_places_of_the_token(spark, table):
    index = x.open_index(spark, x.write_index(table.filter("doc_id = 7"), ["text"], scratch_path(spark, "index")))
    assert [(r.token, r.column, r.ends, r.positions) for r in index.postings.collect()] == [("ab", "text", [4], [0, 1, 2, 3])]


def test_blocks_hold_every_place(monkeypatch):
    import pyarrow as pa

    texts = [["a", "b", "a"], None, [], ["b"], ["a"], ["c"] * 5]
    batch = pa.RecordBatch.from_pydict({"file": [1, 1, 1, 1, 2, 2], "row": [3, 4, 5, 6, 0, 1], "c0": pa.array(texts, pa.list_(pa.string()))})
    for most in (1, 3, 100):
        monkeypatch.setattr(x, "RUN_TOKENS", most)
        found = set()
        for block in x._cut([batch], ["text"]):
            for r in block.to_pylist():
                start = 0
                for row, end in zip(r["rows"], r["ends"], strict=True):
                    found |= {(r["file"], row, r["token"], p) for p in r["positions"][start:end]}
                    start = end
                assert start == len(r["positions"])
        assert found == {(f, n, w, k) for f, n, text in zip([1, 1, 1, 1, 2, 2], [3, 4, 5, 6, 0, 1], texts) for k, w in enumerate(text or [])}


def test_kept_index_is_written_once_per_state_of_the_files(spark):
    path = scratch_path(spark, "texts")
    spark.createDataFrame([(1, "one two")], "id long, text string").write.parquet(path)
    first = x.kept_index(spark.read.parquet(path), ["text"])
    again = x.kept_index(spark.read.parquet(path), ["text"])
    assert first.postings.inputFiles() == again.postings.inputFiles()
    spark.createDataFrame([(2, "two three")], "id long, text string").write.mode("append").parquet(path)
    later = x.kept_index(spark.read.parquet(path), ["text"])
    assert x.find_rows(first, "two").count() == 1 and x.find_rows(later, "two").count() == 2


def test_index_of_an_empty_table(spark, table):
    index = x.open_index(spark, x.write_index(table.filter("doc_id = 99"), ["text"], scratch_path(spark, "index")))
    assert x.indexed_search(table, index, "the").count() == 0


def test_tokens_of_a_token_text(spark):
    import pyarrow as pa
    from tidemark.functions.search import token_text

    odd = [None, "", " ", "a", "A1_b-\u00c9t\u00e9", "\u00bfQu\u00e9? \u2014 no\u2026", "\u0130x \u03a3\u03a3", "\x00a\x7fb\u00a0c", "\u65e5\u672c\u3002\u8a9e\U0001f642x", "e\u0301a", "\u0661\u00b2\u2167", "z"]
    rows = spark.createDataFrame([(t,) for t in odd], "t string").select(tokens(F.col("t")), F.coalesce(token_text(F.col("t")), F.lit(""))).collect()
    texts = pa.array(["x", *[r[1] for r in rows]])
    want = [r[0] or [] for r in rows]
    assert x._token_lists(texts.slice(1)).to_pylist() == want
    batch = pa.RecordBatch.from_pydict({"file": [1] * len(odd), "row": [*range(len(odd))], "c0": texts.slice(1)})
    assert [v for part in x._tokenized([batch], 1) for v in part.column("c0").to_pylist()] == want


def test_lists_are_packed_and_read_back(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    lists = [[0, 3], [65_536], [], [1, 2_000_000_000, 5]]
    held = pa.array([[7], *lists], pa.list_(pa.int32())).slice(1)
    packed = next(x._packed([pa.RecordBatch.from_pydict(dict.fromkeys(x._LISTS, pa.concat_arrays([held])))]))
    pq.write_table(pa.Table.from_batches([packed]), tmp_path / "packed.parquet")
    for c in x._LISTS:
        assert [r[0] for r in spark.read.parquet(str(tmp_path / "packed.parquet")).select(x._numbers(c)).collect()] == lists


def test_rows_of_one_row_group_are_dealt_to_many_tasks(spark):
    path = scratch_path(spark, "texts")
    spark.range(5_000).selectExpr("id", "concat('w', id % 7, ' ', repeat('long text ', 20)) AS text").coalesce(1).write.parquet(path)
    table = spark.read.parquet(path)
    hidden = table.metadataColumn("_metadata")
    rows = x._dealt(table, table.select(F.xxhash64(hidden["file_path"]).alias("file"), hidden["row_index"].alias("row")))
    tasks = rows.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r[1] for r in tasks) == 5_000 and max(r[1] for r in tasks) < 2_500


def test_places_leave_in_bounded_pieces(spark, table, monkeypatch):
    """Lists of a block are cut in Python: no row of the search carries the lists of its block along."""
    import numpy as np
    import pyarrow as pa

    pack = lambda *numbers: np.array(numbers, np.int32).tobytes()
    blocks = pa.RecordBatch.from_pydict({
        "token": ["a", "b", "c"], "column": ["text"] * 3, "file": [7, 7, 8], "rows": [pack(*range(100)), pack(0, 3), pack(5)],
        "ends": [pack(*range(2, 202, 2)), pack(1, 3), pack(1)], "positions": [pack(*range(200)), pack(1, 7, 9), pack(4)],
    })
    monkeypatch.setattr(x, "PLACES", 16)
    rows = list(x._places(iter([blocks]), None))
    assert max(map(len, rows)) < 32 and len(rows) > 3
    want = [(7, "text", r, 0) for r in [*range(100), 0, 3]] + [(8, "text", 5, 0)]
    assert [tuple(r.values()) for b in rows for r in b.to_pylist()] == want
    starts = [tuple(r.values()) for b in x._places(iter([blocks]), ["b", "a", "b"]) for r in b.to_pylist()]
    assert starts[:2] == [(7, "text", 0, -1), (7, "text", 0, 0)] and starts[200:] == [(7, "text", r, p - s) for s in (0, 2) for r, p in ((0, 1), (3, 7), (3, 9))]

    index = x.open_index(spark, x.write_index(table, ["text"], scratch_path(spark, "index"), 4), 4)
    assert "Generate" not in x.find_rows(index, "`of the`")._jdf.queryExecution().executedPlan().toString()
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= x.RUN_BYTES
