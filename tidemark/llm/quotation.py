"""Quotation linking: messages lose their quotes and follow the message they quote.

Lines that begin with ``>`` are quoted, as deep as there are marks; neighbouring lines of one depth are a passage. A passage is
normalised (marks, case, signs and white space do not matter) and its runs of ``RUN`` words are hashed; so are those of the own words
of every message of the conversations that quote. A passage of fewer words is one run, and is looked for among the runs of as many
words of the messages of its conversation. A passage goes back to the earlier message that shares most of its
runs, if that is at least ``SHARE`` per cent of them; of several the latest. A message replies to the original of its first passage of the least
depth that has one. Conversations are then ordered by reply: a message is followed by its replies, earliest first.

Only runs of the same conversation meet, and equal runs of a message count once. Numbering is a global sort in range blocks,
so a very long conversation does not have to fit in one task.

Defined results: a null text is kept null and quotes nothing. A line that ends in ``wrote:`` before a quote belongs to the
quote. Messages without a known original start a thread. Of rows with the same conversation and turn all are returned, and the least text stands
for them as an original. Null conversations and turns are never linked. Other columns but the role are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.registry import query
from tidemark.operators.ordered import number_rows
from tidemark.session import Tables, materialize

RUN, SHARE = 5, 80


def _words(text: str) -> str:
    return f"filter(split(lower({text}), '[^\\\\p{{L}}\\\\p{{N}}]+'), w -> w <> '')"


def _runs(words: str, width: str) -> str:
    """Hashes of the runs of ``width`` words; fewer words have none."""
    all_runs = f"transform(sequence(0, size({words}) - {width}), i -> xxhash64({width}, slice({words}, i + 1, {width})))"
    return f"array_distinct(CASE WHEN {width} = 0 OR size({words}) < {width} THEN CAST(array() AS array<bigint>) ELSE {all_runs} END)"


def parse(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``own_text`` and ``passages`` (depth and text, in order) of each message."""
    mark = "'^[ \\\\t]*((>[ \\\\t]?)+)'"
    depth = f"length(regexp_replace(regexp_extract(line, {mark}, 1), '[^>]', ''))"
    lines = f"transform(split(text, '\\n'), line -> named_struct('depth', {depth}, 'line', regexp_replace(line, {mark}, '')))"
    # a line like "Ann wrote:" before a quote goes with it
    lead = "l.depth = 0 AND l.line RLIKE 'wrote:[ \\\\t]*$' AND coalesce(get(lines, i + 1).depth, 0) > 0"
    own = f"filter(lines, (l, i) -> l.depth = 0 AND NOT ({lead}))"
    starts = "filter(sequence(0, size(lines) - 1), i -> lines[i].depth > 0 AND (i = 0 OR lines[i - 1].depth <> lines[i].depth))"
    ends = "filter(sequence(0, size(lines) - 1), i -> lines[i].depth > 0 AND coalesce(get(lines, i + 1).depth, 0) <> lines[i].depth)"
    cut = "named_struct('depth', lines[s].depth, 'text', array_join(transform(slice(lines, s + 1, ends[k] - s + 1), l -> l.line), ' '))"
    return (
        messages.select("conv_id", "turn", "role", "text", F.expr(lines).alias("lines"))
        .withColumns({"starts": F.expr(starts), "ends": F.expr(ends)})
        .select(
            "conv_id", "turn", "role",
            F.when(F.expr("exists(lines, l -> l.depth > 0)"), F.trim(F.array_join(F.expr(f"transform({own}, l -> l.line)"), "\n"))).otherwise(F.col("text")).alias("own_text"),
            F.coalesce(F.expr(f"transform(starts, (s, k) -> {cut})"), F.expr("CAST(array() AS array<struct<depth:int,text:string>>)")).alias("passages"),
        )
    )


def reply_links(parsed: DataFrame) -> DataFrame:
    """``conv_id``, ``turn`` and ``reply_to`` (turn of the original) of the messages whose quotes have one."""
    quoting = parsed.filter("size(passages) > 0 AND conv_id IS NOT NULL AND turn IS NOT NULL")
    passages = quoting.select("conv_id", "turn", F.posexplode("passages").alias("at", "p")).select("conv_id", "turn", "at", "p.depth", F.expr(_words("p.text")).alias("w"))
    passages = passages.withColumn("width", F.least(F.size("w"), F.lit(RUN)))
    passages = passages.select("conv_id", "turn", "at", "depth", "width", F.expr(_runs("w", "width")).alias("runs")).withColumn("n", F.size("runs"))
    asked = passages.select("conv_id", "turn", "at", "depth", "n", F.explode("runs").alias("run")).distinct()
    inside = parsed.join(quoting.select("conv_id").distinct(), "conv_id", "left_semi")
    one = inside.groupBy("conv_id", "turn").agg(F.min("own_text").alias("own_text")).select("conv_id", "turn", F.expr(_words("own_text")).alias("w"))
    one = one.join(passages.select("conv_id", "width").distinct(), "conv_id")  # at most ``RUN`` widths each
    said = one.select("conv_id", F.col("turn").alias("original"), F.explode(F.expr(_runs("w", "width"))).alias("run"))
    shared = asked.join(said, ["conv_id", "run"]).filter("original < turn")
    counted = shared.groupBy("conv_id", "turn", "at", "depth", "n", "original").agg(F.count("*").alias("hits")).filter(f"100 * hits >= {SHARE} * n")
    best = counted.groupBy("conv_id", "turn", "at", "depth").agg(F.max(F.struct("hits", "original")).alias("best"))
    return best.groupBy("conv_id", "turn").agg(F.min(F.struct("depth", "at", "best")).alias("m")).select("conv_id", "turn", F.col("m.best.original").alias("reply_to"))


def reply_paths(links: DataFrame) -> DataFrame:
    """``conv_id``, ``turn`` and ``path``: the turns from the start of the thread to the message. Known ways double with each round."""
    ways = materialize(links.select("conv_id", "turn", F.col("reply_to").alias("top"), F.array(F.col("reply_to").cast("long"), F.col("turn").cast("long")).alias("path")), "reply-ways")
    while True:
        upper = ways.select("conv_id", F.col("turn").alias("top"), F.col("top").alias("next"), F.col("path").alias("above"))
        joined = ways.join(upper, ["conv_id", "top"], "left")
        grown = F.when(F.col("above").isNull(), F.col("path")).otherwise(F.expr("concat(above, slice(path, 2, size(path)))"))
        ways = joined.select("conv_id", "turn", F.coalesce("next", "top").alias("top"), grown.alias("path"), F.col("next").isNotNull().alias("moved"))
        ways = materialize(ways, "reply-ways")
        if not ways.filter("moved").limit(1).count():
            return ways.select("conv_id", "turn", "path")
        ways = ways.drop("moved")


def link_quotes(messages: DataFrame) -> DataFrame:
    """Every message without its quotes, with what it replies to and its ``position`` in the reply order of its conversation."""
    parsed = materialize(parse(messages), "messages")
    links = materialize(reply_links(parsed), "reply-links")
    paths = reply_paths(links)
    placed = parsed.join(links, ["conv_id", "turn"], "left").join(paths, ["conv_id", "turn"], "left")
    placed = placed.withColumn("path", F.coalesce("path", F.array(F.col("turn").cast("long"))))
    order = [F.col(c) for c in ("conv_id", "path", "role", "own_text")]
    numbered = materialize(number_rows(placed, order, "number"), "reply-order")
    first = numbered.groupBy("conv_id").agg(F.min("number").alias("first")).withColumnRenamed("conv_id", "conversation")
    return numbered.join(first, F.col("conv_id").eqNullSafe(F.col("conversation"))).select(
        "conv_id", "turn", "role", "reply_to", (F.size("path") - 1).cast("long").alias("depth"), (F.col("number") - F.col("first")).alias("position"),
        F.size("passages").cast("long").alias("n_quotes"), "own_text",
    )


@query("op8_quotation")
def op8_quotation(t: Tables) -> DataFrame:
    """Every message of every conversation, in reply order and without quotes."""
    return link_quotes(t.conversations)
