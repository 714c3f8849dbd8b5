"""Positional text index: where each token stands, so words and phrases are found without reading the texts.

Postings say at which places of one column of which rows a token stands. Rows are named by their file and their number in it, so
ids may repeat or be missing, and a search opens only the files that hold a hit. The postings of a token are blocks: one per stretch
of rows that a task cuts together, so that a frequent token is moved as lists of numbers, each list as the bytes of its 32-bit numbers.
Blocks lie in token buckets, sorted by token, with a membership filter of the tokens in each file, so a lookup skips files and row
groups of the index as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tidemark.functions.search import phrase_words, token_text
from tidemark.session import scratch_path, scratch_root

BUCKETS = 32
RUN_TOKENS = 1 << 22  # tokens of a block's rows at most, but for a single longer text
RUN_BYTES = 24 << 20  # of text that is cut at once, but for a single longer text
BATCH_BYTES = 8 << 20  # of blocks that leave a Python worker at once, but for a single longer block
PLACES = 1 << 16  # found places that do
CHUNK_BYTES = 12 << 20  # of the table's files, whose rows are dealt to one task
FILTER_TOKENS = 20_000  # a file's membership filter is sized for; without a number each takes a megabyte
LAYOUT = 3  # goes up when the files of an index change their meaning, so that kept ones are not misread
_BLOCK = "token string, column string, file long, rows binary, ends binary, positions binary"
_LISTS = ("rows", "ends", "positions")
_IN_TOKEN = np.array([b > 127 or chr(b).isalnum() for b in range(256)])  # of the bytes of a ``token_text``


class TextIndex(NamedTuple):
    """A written index: ``bucket`` and blocks of postings, and the ``file`` numbers with their paths.

    In a block, ``positions`` lists the places of the token row by row; those of the row ``rows[k]`` stop at ``ends[k]``.
    """

    postings: DataFrame
    files: DataFrame
    buckets: int
    packed: DataFrame  # the blocks as they are written, each list as the bytes of its numbers


def _bounded(spark: SparkSession) -> None:
    """Texts and blocks go to a Python worker by their bytes: ten thousand rows of them may be any number."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(RUN_BYTES))


def _place(df: DataFrame) -> tuple[Column, Column]:
    hidden = df.metadataColumn("_metadata")
    return hidden["file_path"], hidden["row_index"]


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def _blocks(file: int, column: str, rows: np.ndarray, texts: pa.ListArray) -> Iterator[pa.RecordBatch]:
    """Blocks of the tokens of some rows of a file."""
    sizes = texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    held = texts.flatten().dictionary_encode()
    codes, words = held.indices.to_numpy(), held.dictionary
    if not len(codes):
        return
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.sort(codes.astype(np.int64) << 32 | np.arange(len(codes))) & 0xFFFFFFFF  # by token, then row, then place
    code, row, place = codes[order], row[order], place[order].astype(np.int32)
    new_word = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    new_row = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (row[1:] != row[:-1])])
    row_starts = np.searchsorted(new_row, new_word)  # rows before each word
    word_ends, row_ends = np.r_[new_word[1:], len(code)], np.r_[row_starts[1:], len(new_row)]
    stops = np.r_[new_row[1:], len(code)] - np.repeat(new_word, row_ends - row_starts)
    lists = lambda starts, n, values: pa.ListArray.from_arrays(pa.array(np.r_[starts, n].astype(np.int32)), pa.array(values.astype(np.int32)))
    yield pa.RecordBatch.from_arrays(
        [words.take(pa.array(code[new_word])), pa.array([column] * len(new_word)), pa.array(np.full(len(new_word), file)),
         lists(row_starts, len(new_row), rows[row[new_row]]), lists(row_starts, len(new_row), stops), lists(new_word, word_ends[-1], place)],
        names=["token", "column", "file", "rows", "ends", "positions"])


def _cut(batches: Iterator[pa.RecordBatch], cols: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        file, row = batch.column("file").to_numpy(), batch.column("row").to_numpy()
        for k, column in enumerate(cols):
            texts = batch.column(f"c{k}")
            sizes = np.r_[0, np.cumsum(texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]
            a = 0
            while a < len(batch):
                b = max(a + 1, int(np.searchsorted(sizes, sizes[a] + RUN_TOKENS, side="right")) - 1)
                b = min(b, a + int(np.argmax(np.r_[file[a:] != file[a], True])))  # rows of one file
                yield from _blocks(int(file[a]), column, row[a:b], texts.slice(a, b - a))
                a = b


def _token_lists(texts: pa.Array) -> pa.ListArray:
    """Tokens of each ``token_text``."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    inside = _IN_TOKEN[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = ends[:-1][np.diff(ends) > 0]  # a token ends with its text
    first[begins] = inside[begins]
    held, starts = data[inside], np.flatnonzero(first[inside]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.r_[starts, np.int32(len(held))]), pa.py_buffer(held))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(np.flatnonzero(first), ends).astype(np.int32)), words)


def _tokenized(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[pa.RecordBatch]:
    """The same rows with the tokens of their texts, a bounded number of bytes at once."""
    for batch in batches:
        texts = [batch.column(f"c{k}") for k in range(columns)]
        sizes = np.r_[0, np.cumsum(sum(pc.binary_length(t).to_numpy(zero_copy_only=False).astype(np.int64) for t in texts))]
        a = 0
        while a < len(batch):
            b = max(a + 1, int(np.searchsorted(sizes, sizes[a] + RUN_BYTES, side="right")) - 1)
            lists = [_token_lists(t.slice(a, b - a)) for t in texts]
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([part.column("file"), part.column("row"), *lists], names=["file", "row", *[f"c{k}" for k in range(columns)]])
            a = b


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with each list as the bytes of its numbers: one value in place of one per number in all that follows."""
    for batch in batches:
        columns = {c: batch.column(c) for c in batch.schema.names}
        for c in _LISTS:
            ends, numbers = columns[c].offsets.to_numpy() * np.int32(4), columns[c].values.to_numpy()
            columns[c] = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(ends), pa.py_buffer(numbers)])
        sizes = np.r_[0, np.cumsum(sum(pc.binary_length(columns[c]).to_numpy().astype(np.int64) for c in _LISTS))]
        a, whole = 0, pa.RecordBatch.from_pydict(columns)
        while a < len(whole):
            b = max(a + 1, int(np.searchsorted(sizes, sizes[a] + BATCH_BYTES, side="right")) - 1)
            yield whole.slice(a, b - a)
            a = b


def _places(batches: Iterator[pa.RecordBatch], words: list[str] | None) -> Iterator[pa.RecordBatch]:
    """``file``, ``column`` and ``row`` of the places of packed blocks, a bounded number at once, read block by block.

    With the ``words`` of a phrase, ``start`` is where the phrase would have to start for its word to stand there, else each row
    comes once with 0.
    """
    held, size = [], 0

    def flush():
        file, column, row, start = zip(*held)
        n = [len(r) for r in row]
        columns = [np.repeat(np.array(file, np.int64), n), pa.array(column, pa.string()).take(pa.array(np.repeat(np.arange(len(n)), n))), np.concatenate(row), np.concatenate(start)]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["file", "column", "row", "start"])

    for batch in batches:
        tokens, names, files = (batch.column(c).to_pylist() for c in ("token", "column", "file"))
        for k, token in enumerate(tokens):
            rows, ends, positions = (np.frombuffer(batch.column(c)[k].as_buffer(), np.int32) for c in _LISTS)
            if words is not None:
                rows = np.repeat(rows, np.diff(np.r_[0, ends]))
            for shift in [0] if words is None else [i for i, w in enumerate(words) if w == token]:
                for a in range(0, len(rows), PLACES):
                    part = rows[a : a + PLACES]
                    held.append((files[k], names[k], part.astype(np.int64), np.zeros(len(part), np.int32) if words is None else positions[a : a + PLACES] - np.int32(shift)))
                    size += len(part)
                    if size >= PLACES:
                        yield flush()
                        size = 0
    if held:
        yield flush()


@F.arrow_udf(ArrayType(IntegerType()))
def _numbers(packed: pa.Array) -> pa.Array:
    """The lists of ``_packed``."""
    ends = np.cumsum(pc.binary_length(packed).to_numpy(zero_copy_only=False) // 4)
    numbers = np.frombuffer(b"".join(packed.to_pylist()), np.int32)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(numbers))


def _dealt(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows dealt to tasks in chunks of neighbours, in order, if the row groups of the files leave more than half as much again as a core's share to one task."""
    hidden = df.metadataColumn("_metadata")
    read = df.groupBy(hidden["file_path"].alias("path"), hidden["file_size"].alias("size"), F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"))
    tasks = read.groupBy("task").agg(F.sum("n").alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("n"))
    size = read.select("path", "size").distinct().agg(F.sum("size").alias("size"))
    most, n, size = tasks.select("most", "n", size.scalar().alias("size")).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    if not n or 2 * cores * most <= 3 * n:
        return rows
    chunks = max(2 * cores, -(-size // CHUNK_BYTES))
    chunk = F.floor(F.col("row") / max(1, n // chunks))
    return rows.repartition(chunks, F.col("file"), chunk).sortWithinPartitions("file", "row")


def write_index(df: DataFrame, cols: list[str], path: str, buckets: int = BUCKETS) -> str:
    """Write the index of text columns of a table read from parquet files, as it is read.

    A row group is read by one task, so the rows of few row groups are dealt out first. Each task makes blocks of its rows; they are
    moved once, gathered by bucket, where AQE cuts a frequent token into several files.
    """
    _bounded(df.sparkSession)
    file, row = _place(df)
    names = [f"c{k}" for k in range(len(cols))]
    rows = _dealt(df, df.select(F.xxhash64(file).alias("file"), row.alias("row"), *[F.col(c).alias(n) for c, n in zip(cols, names)]))
    texts = rows.select("file", "row", *[F.coalesce(token_text(F.col(n)), F.lit("")).alias(n) for n in names])
    blocks = texts.mapInArrow(lambda batches: _packed(_cut(_tokenized(batches, len(cols)), cols)), _BLOCK)
    tagged = blocks.withColumn("bucket", _bucket(F.col("token"), buckets)).hint("rebalance", F.col("bucket"))
    writer = tagged.sortWithinPartitions("bucket", "token", "column", "file").write.partitionBy("bucket")
    options = {"parquet.bloom.filter.enabled#token": "true", "parquet.bloom.filter.expected.ndv#token": str(FILTER_TOKENS), "compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
    writer.options(**options, **{f"parquet.enable.dictionary#{c}": "false" for c in _LISTS}).parquet(f"{path}/postings")
    df.select(file.alias("path")).distinct().withColumn("file", F.xxhash64("path")).write.parquet(f"{path}/files")
    return path


def open_index(spark: SparkSession, path: str, buckets: int = BUCKETS) -> TextIndex:
    postings = spark.read.schema(f"{_BLOCK}, bucket int").parquet(f"{path}/postings")
    return TextIndex(postings.withColumns({c: _numbers(c) for c in _LISTS}), spark.read.parquet(f"{path}/files"), buckets, postings)


def kept_index(df: DataFrame, cols: list[str], buckets: int = BUCKETS) -> TextIndex:
    """The index of a table as its files are now: written once under the shared folder, and opened by all later searches.

    Names, sizes and times of the files tell whether they are the same. Two sessions that write at once each write their own; the
    pointer to a whole index is written last.
    """
    spark, hidden = df.sparkSession, df.metadataColumn("_metadata")
    files = df.select(*[hidden[c].alias(c) for c in ("file_path", "file_size", "file_modification_time")]).distinct()
    state = files.agg(F.count("*"), F.bit_xor(F.xxhash64(*files.columns))).first()
    mark = "-".join(format(x or 0, "x").replace("-", "m") for x in state) + f"-{buckets}-" + "-".join(c.encode().hex() for c in cols)
    pointer = f"{scratch_root(spark)}/text-index-{LAYOUT}-{mark}"
    try:
        path = spark.read.schema("path string").parquet(pointer).first()
    except AnalysisException:
        path = None
    if path is None:
        written = write_index(df, cols, scratch_path(spark, "text-index"), buckets)
        spark.range(1).select(F.lit(written).alias("path")).coalesce(1).write.mode("overwrite").parquet(pointer)
        return open_index(spark, written, buckets)
    return open_index(spark, path["path"], buckets)


def find_rows(index: TextIndex, term: str, cols: list[str] | None = None) -> DataFrame:
    """``file`` and ``row`` of the rows that a search for ``term`` finds in one of the columns (all indexed ones by default).

    Every token of the term has to stand in the column, in any place; those of a term in backticks one after the other.
    """
    words, phrase = phrase_words(term)
    distinct = sorted(set(words))
    hits = index.packed.filter(F.col("token").isin(distinct))
    if distinct:
        hits = hits.filter(F.col("bucket").isin([_bucket(F.lit(w), index.buckets) for w in distinct]))
    if cols is not None:
        hits = hits.filter(F.col("column").isin(cols))
    run = words if phrase and len(words) > 1 else None
    _bounded(hits.sparkSession)
    found = hits.drop("bucket").mapInArrow(lambda batches: _places(batches, run), "file long, column string, row long, start int")
    if run:  # each place of a column holds one token
        found = found.groupBy("file", "row", "column", "start").agg(F.count("*").alias("n")).filter(F.col("n") == len(words))
    elif len(distinct) > 1:
        found = found.groupBy("file", "row", "column").agg(F.count("*").alias("n")).filter(F.col("n") == len(distinct))
    return found.select("file", "row").distinct()


def files_opened(index: TextIndex, term: str, cols: list[str] | None = None) -> DataFrame:
    """How many files of the table a search has to open, of all."""
    hit = find_rows(index, term, cols).select("file").distinct().withColumn("opened", F.lit(1))
    return index.files.join(hit, "file", "left").agg(F.count("*").alias("files"), F.count("opened").alias("opened"))


def indexed_search(df: DataFrame, index: TextIndex, term: str, cols: list[str] | None = None) -> DataFrame:
    """Rows of the indexed table that a search finds; only files with hits are opened."""
    found = find_rows(index, term, cols)
    paths = [r["path"] for r in index.files.join(found.select("file").distinct(), "file", "left_semi").select("path").collect()]  # names of files
    if not paths:
        return df.limit(0)
    some = df.sparkSession.read.schema(df.schema).parquet(*paths)
    file, row = _place(some)
    return some.withColumns({"__file": F.xxhash64(file), "__row": row}).join(
        found.withColumnsRenamed({"file": "__file", "row": "__row"}), ["__file", "__row"], "left_semi").select(*df.columns)
