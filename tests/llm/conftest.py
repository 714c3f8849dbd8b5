"""Small tables with every awkward case: nulls, empty and very long texts, ties, repeated rows, clashing column names."""

import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

CLASHES = "h n chunk key sid bucket length block rank label words features kept hash part slice pairs verdict rule host path".split()
WORDS = "the of and to in a is river stone copper lantern quiet harbour winter signal meadow orbit candle thunder velvet marble".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (r.choice([".", ",", ""]) if r.random() < 0.2 else "") for _ in range(n))


def documents() -> list[tuple]:
    base, long = prose(1, 220), prose(2, 30_000)
    passage = prose(3, 120)
    texts = [
        None, "", " \n\t ", "one", "two words", base, base, base.replace("river", "stream", 2), base.upper(), long,
        prose(4, 90) + " " + passage + " " + prose(5, 60), prose(6, 40) + " " + passage + "\n" + prose(7, 80), passage,
        prose(8, 70) + " If Carol buys 7 apples for 9 dollars each then how much does she pay to Dave in total. " + prose(9, 30),
        "line again\n" * 40, "a" * 3000, "é ñ ß ü 日本語 😀 " * 60, prose(10, 60) + " you idiot, what a m0ron " + prose(11, 20),
        "Ab$% | &&& ***" * 30, "x" * 399, "y" * 400, "tie tie tie tie", "tie tie tie tie",
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(5, base), (None, prose(12, 55)), (None, None)]  # a repeated row, and rows without an id
    return rows


def _table(rows: list[tuple], schema: pa.Schema, clash: bool = True) -> pa.Table:
    table = pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)
    for name in CLASHES if clash else []:
        if name not in table.column_names:
            table = table.append_column(name, pa.array(["clash"] * len(rows), pa.string()))
    return table


SCHEMAS = {
    "documents": pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]),
    "labels": pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())]),
    "benchmark": pa.schema([("item_id", pa.int64()), ("text", pa.string())]),
    "pages": pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())]),
    "conversations": pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]),
}
URLS = [
    None, "", "no scheme", "http://", "http://ORG/x", "http://a.ORG/es/1", "https://example.org/es/2?q#f", "https://blog.example.org/en/17/", "https://x.com/fr/",
    "https://x.com/de", "https://x.com/de/1#t", "https://notexample.org/es/", "https://example.org?x=/es/", "https://xorg/", "://org/", "https://x.com/fr/", "https://com/de/",
]


def rows_of(name: str) -> list[tuple]:
    if name == "documents":
        return [(i, t, None if i == 5 else "en", "src", len(t or "")) for i, t in documents()]
    if name == "labels":
        return [(i, 1, None if i == 3 else int(i == 17)) for i in range(20)] + [(17, 1, 0), (None, 1, 1)]
    if name == "benchmark":
        return [(0, None), (1, ""), (2, "If Alice buys 5 apples for 3 dollars each then how much does she pay to Bob in total."), (3, prose(3, 60)), (3, prose(3, 60)), (None, "few words")]
    if name == "pages":
        return [(i if i else None, u, "") for i, u in enumerate(URLS)]
    return CONVERSATIONS


CONVERSATIONS = [
    (1, 0, "user", "Hello there my friend how are you today\nSecond line of the first message is here"),
    (1, 1, "assistant", "> Hello there my friend\n> how are you today\nI am fine thanks a lot for asking me"),
    (1, 2, "user", "Ann wrote:\n>> Hello there my friend how are you today\n> I am fine thanks a lot for asking me\nGood to hear that indeed my friend"),
    (1, 3, "user", "> second line of the first message\n> is here\nThird reply"),
    (2, 0, "user", None), (2, 1, "user", "> never said by anyone at all ever\nx"), (2, 1, "user", "> never said by anyone at all ever\nx"),
    (None, 0, "user", "lost"), (3, None, "user", "> lost\nlost"), (4, 0, "user", ""),
]


def _write(folder, rows_for) -> str:
    for name, schema in SCHEMAS.items():
        pq.write_table(_table(rows_for(name), schema), f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def edge(tmp_path_factory) -> str:
    return _write(tmp_path_factory.mktemp("edge"), rows_of)


@pytest.fixture(scope="session")
def empty(tmp_path_factory) -> str:
    return _write(tmp_path_factory.mktemp("empty"), lambda name: [])


@pytest.fixture(scope="session")
def sql_on():
    def connect(folder: str):
        con = duckdb.connect()
        for name in SCHEMAS:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
        return con

    return connect
