"""Fill-in-middle transformation by in-place block rotation.

A text is cut at two code points into prefix, middle and suffix, which are put into the order a model learns to fill from:
``<P>`` prefix ``<S>`` suffix ``<M>`` middle (psm), or ``<S>`` suffix ``<P>`` prefix ``<M>`` middle (spm). The cuts are found
by a scan over the UTF-8 bytes, the sentinels are inserted before the segments they announce in one bytearray, and
neighbouring segments are exchanged there by three reversals, without a second copy of the text. The inverse finds the
sentinels, undoes the rotations and takes the sentinels out, so every text is restored byte by byte.

Where a text is cut, and whether at all, depends on the id alone: the first groups of eight hexadecimal digits of the SHA-256
of ``seed:id``. Each row is worked on by itself; texts come in runs of bounded bytes, or one by one if they are longer.

Defined results: a null or empty text stays plain (``n`` 0), as does one that holds a sentinel. A null id counts as the empty
string. Repeated rows give equal results each. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.arrays import text_runs
from tidemark.llm.registry import query
from tidemark.session import Tables

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 1
PLAIN_PERCENT, SPM_PERCENT = 10, 20  # texts left as they are; cut texts whose suffix comes first


class Infill(NamedTuple):
    """A transformed text and how it was made; sizes in code points, None if plain."""

    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def rotate(buffer: bytearray, start: int, cut: int, end: int) -> None:
    """Exchange the neighbouring segments ``[start, cut)`` and ``[cut, end)`` in place, by three reversals."""
    view = memoryview(buffer)
    for a, b in ((start, cut), (cut, end), (start, end)):
        segment = np.frombuffer(view[a:b], np.uint8)
        half = len(segment) // 2
        if half:
            head, tail = segment[:half], segment[len(segment) - half :][::-1]
            held = head.copy()
            head[:] = tail
            tail[:] = held


def draws(key: str, seed: int = SEED) -> tuple[int, ...]:
    """Four numbers of 32 bits that depend on the id alone."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4))


def transform(text: bytes, key: str, seed: int = SEED, plain: int = PLAIN_PERCENT, spm: int = SPM_PERCENT) -> Infill:
    """One text in its form."""
    heads = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80  # bytes at which a code point starts
    n = int(np.count_nonzero(heads))
    h = draws(key, seed)
    if not n or h[2] % 100 >= 100 - plain or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return Infill(n, "plain", None, None, text)
    cuts = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if n == len(text):
        first, second = cuts
    else:
        places = np.append(np.flatnonzero(heads), len(text))
        first, second = (int(places[c]) for c in cuts)
    buffer = bytearray(text)
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle, suffix, len(buffer))  # prefix, suffix, middle
    form = "psm"
    if h[3] % 100 < spm:
        rotate(buffer, 0, middle, middle + len(buffer) - suffix)  # suffix, prefix, middle
        form = "spm"
    return Infill(n, form, cuts[0], cuts[1] - cuts[0], bytes(buffer))


def restore(output: bytes, form: str) -> bytes:
    """The text that ``transform`` was given, from its output and form."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    if form == "spm":
        rotate(buffer, 0, buffer.index(PREFIX), buffer.index(MIDDLE))
    suffix, middle = buffer.index(SUFFIX), buffer.index(MIDDLE)
    rotate(buffer, suffix, middle, len(buffer))
    second = suffix + len(buffer) - middle  # prefix, middle, suffix again
    for at, sentinel in ((second, SUFFIX), (suffix, MIDDLE), (0, PREFIX)):
        del buffer[at : at + len(sentinel)]
    return bytes(buffer)


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, plain: int = PLAIN_PERCENT, spm: int = SPM_PERCENT
) -> DataFrame:
    """Every document transformed: ``doc_id, n, form, prefix_chars, middle_chars, output``."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def work(batches):
        for rows, data, offsets in text_runs(batches):
            whole = data.tobytes()
            found = [
                transform(whole[a:b], key or "", seed, plain, spm)
                for a, b, key in zip(offsets[:-1], offsets[1:], rows.column("key").to_pylist())
            ]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *(pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds))],
                names=["doc_id", *Infill._fields],
            )

    taken = docs.select(F.col(id_col).alias("doc_id"), F.col(id_col).cast("string").alias("key"), F.col(text_col).cast("string").alias("text"))
    return taken.mapInArrow(work, f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore_texts(transformed: DataFrame) -> DataFrame:
    """``text`` of each transformed row in place of ``output``."""
    columns = [c for c in transformed.columns if c not in ("output", "text")]
    schema = ", ".join(f"`{c}` {transformed.schema[c].dataType.simpleString()}" for c in columns)

    def work(batches):
        for rows, data, offsets in text_runs(batches, "output"):
            whole = data.tobytes()
            texts = [restore(whole[a:b], form) for a, b, form in zip(offsets[:-1], offsets[1:], rows.column("form").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in columns), pa.array(texts, pa.string())], names=[*columns, "text"])

    return transformed.select(*columns, "output").mapInArrow(work, f"{schema}, text string")


_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
d AS (SELECT *, length(text)::BIGINT AS n, {", ".join(f"('0x' || substr(h, {8 * k + 1}, 8))::BIGINT AS h{k + 1}" for k in range(4))} FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {100 - PLAIN_PERCENT} THEN 'plain'
    WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM d),
s AS (SELECT *, '<P>' || substr(text, 1, a) AS p, '<M>' || substr(text, a + 1, b - a) AS m, '<S>' || substr(text, b + 1, n - b) AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN p || s || m ELSE s || p || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM s
"""


@query("op13_infill", _SQL)
def op13_infill(t: Tables) -> DataFrame:
    """Form, sizes and checksums of every document, transformed and restored."""
    done = restore_texts(fill_in_middle(t.documents).withColumn("output_sha256", F.sha2("output", 256)))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", F.sha2("text", 256).alias("restored_sha256"))
