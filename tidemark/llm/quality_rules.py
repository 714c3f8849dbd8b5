"""Quality rules: distance of a document's histograms from those of its language.

Two histograms are taken of each text, one of character classes and one of common words. The language reference is the
same histogram pooled over all documents of that language. A document is rejected where the Jensen-Shannon distance
(square root of the divergence in bits, 0 to 1) is over a limit and the text is long enough for the histogram to mean
anything. Only DataFrame functions are used; features are computed once and written, so the second pass reads a few
numbers per document instead of its text.

Defined results: a null text is an empty one (no words, rejected by the base rule). A null ``lang`` is a language of its
own. Repeated rows are judged each. Other columns of the input are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.registry import query
from tidemark.session import Tables, materialize

MIN_WORDS = 50
CHAR_LIMIT, CHAR_GUARD = 0.3, 200  # distance; characters a text needs before it is judged
WORD_LIMIT, WORD_NOISE, WORD_GUARD = 0.18, 1.5, 100  # distance; what chance adds, over the root of the words; words

# Character classes and common words of four languages.
CLASSES = {"upper": "[A-Z]", "digit": "[0-9]", "stop": "[.,;:!?]", "symbol": "[#*$%&|<>]"}
COMMON = (
    "the of and to in a is that der die und den von das zu mit de la le les et des un une el que los las en y por con"
).split()
SPACES = "[\\\\x20\\\\x09-\\\\x0D]+"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is then computed once and not for each element."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _repeat_words() -> str:
    """Words inside a three-word window that occurs at least twice: windows are sorted with their places, equal ones meet."""
    window = "xxhash64(w[i], w[i + 1], w[i + 2])"
    sorted_windows = f"sort_array(transform(sequence(0, size(w) - 3), i -> struct({window} AS h, i AS i)))"
    found = "filter(p, (e, j) -> coalesce(e.h = get(p, j - 1).h, false) OR coalesce(e.h = get(p, j + 1).h, false))"
    covered = f"size(array_distinct(flatten(transform({found}, e -> array(e.i, e.i + 1, e.i + 2)))))"
    plain = "transform(sequence(0, size(w) - 3), i -> " + window + ")"
    any_twice = _let(plain, "h", "size(array_distinct(h)) < size(h)")
    body = f"CASE WHEN size(w) < 4 THEN 0 WHEN NOT {any_twice} THEN 0 ELSE {_let(sorted_windows, 'p', covered)} END"
    return f"CAST({_let('words', 'w', body)} AS LONG)"


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts of each text: the base metrics, ``char_bins`` and ``word_bins`` (each ends with all the rest)."""
    d = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    d = d.withColumn("words", F.expr(f"filter(split(text, '{SPACES}'), w -> w != '')"))
    listed = ", ".join(f"'{w}'" for w in COMMON)
    per_word = ", ".join(f"size(c) - size(array_remove(c, '{w}'))" for w in COMMON)
    common = "filter(transform(words, w -> rtrim(',.;:!?', lower(w))), w -> w IN (" + listed + "))"
    lines = "filter(split(text, '\\n'), l -> l RLIKE '[^\\\\x20\\\\x09-\\\\x0D]')"
    return d.select(
        "doc_id", "lang",
        F.size("words").cast("long").alias("n_words"),
        F.expr("aggregate(words, 0L, (a, w) -> a + char_length(w))").alias("word_chars"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.expr(f"CAST({_let(lines, 'l', 'size(l) - size(array_distinct(l))')} AS LONG)").alias("n_dup_lines"),
        F.expr(_repeat_words()).alias("n_repeat_words"),
        F.array(*[F.regexp_count("text", F.lit(p)).cast("long") for p in CLASSES.values()]).alias("classes"),
        F.expr(_let(common, "c", f"transform(array({per_word}, size(c)), n -> CAST(n AS LONG))")).alias("found"),
    ).select(
        "doc_id", "lang", "n_words", "word_chars", "n_dup_lines", "n_repeat_words", "n_chars",
        F.col("classes")[len(CLASSES) - 1].alias("n_symbols"),
        F.expr("concat(classes, array(n_chars - word_chars, word_chars - aggregate(classes, 0L, (a, x) -> a + x)))").alias("char_bins"),
        F.expr(f"concat(slice(found, 1, {len(COMMON)}), array(n_words - found[{len(COMMON)}]))").alias("word_bins"),
    )


def references(found: DataFrame) -> DataFrame:
    """Both histograms of each language, summed over all documents."""
    def pooled(bins: str, n: int) -> Column:
        return F.array(*[F.sum(F.col(bins)[i]) for i in range(n)]).alias("ref_" + bins)

    return found.groupBy("lang").agg(pooled("char_bins", len(CLASSES) + 2), pooled("word_bins", len(COMMON) + 1))


def js_distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance of two arrays of counts; 0 if either is empty."""
    total = "aggregate({0}, 0L, (a, x) -> a + x)"
    share = "transform({0}, x -> x / CAST({1} AS DOUBLE))"
    part = "CASE WHEN x > 0 THEN x * log2(2 * x / (x + y)) ELSE 0D END"
    halves = f"zip_with(s.p, s.q, (x, y) -> {part}), zip_with(s.q, s.p, (x, y) -> {part})"
    summed = f"aggregate(concat({halves}), 0D, (a, x) -> a + x)"
    n, m = total.format(p), total.format(q)
    both = f"named_struct('p', {share.format(p, 't.n')}, 'q', {share.format(q, 't.m')})"
    body = f"CASE WHEN t.n = 0 OR t.m = 0 THEN 0D ELSE {_let(both, 's', f'sqrt(greatest(0D, {summed} / 2))')} END"
    return F.expr(_let(f"named_struct('n', {n}, 'm', {m})", "t", body))


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    char_limit: float = CHAR_LIMIT, char_guard: int = CHAR_GUARD, word_limit: float = WORD_LIMIT, word_noise: float = WORD_NOISE, word_guard: int = WORD_GUARD,
) -> DataFrame:
    """Base metrics, both distances and the verdict ``kept`` of each document."""
    found = materialize(features(docs, id_col, text_col, lang_col), "quality-features")
    both = found.join(references(found), "lang", "left").select(
        "*", js_distance("char_bins", "ref_char_bins").alias("char_distance"), js_distance("word_bins", "ref_word_bins").alias("word_distance")
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    far = ((F.col("n_chars") >= char_guard) & (F.col("char_distance") > char_limit)) | (
        (F.col("n_words") >= word_guard) & (F.col("word_distance") > word_limit + word_noise / F.sqrt("n_words"))
    )
    return both.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "char_distance", "word_distance", base_failed.alias("base_failed"), (~base_failed & ~far).alias("kept"),
    )


def _sql() -> str:
    common = ", ".join(f"len(list_filter(c, lambda w: w = '{w}'))" for w in COMMON)
    listed = ", ".join(f"'{w}'" for w in COMMON)
    ws = r"[\x20\x09-\x0D]+"
    classes = ", ".join(f"len(regexp_extract_all(text, '{p}'))" for p in CLASSES.values())
    n_char, n_word = len(CLASSES) + 2, len(COMMON) + 1

    def share(of: str, n: int) -> str:
        return f"list_transform({of}, lambda x: x / (list_sum({of}))::DOUBLE)"

    def distance(bins: str, n: int) -> str:
        p, q = f"p_{bins}", f"q_{bins}"
        one = "list_sum(list_transform(range(1, {n} + 1), lambda i: CASE WHEN {a}[i] > 0 THEN {a}[i] * log2(2 * {a}[i] / ({a}[i] + {b}[i])) ELSE 0 END))"
        return f"sqrt(greatest(0, ({one.format(n=n, a=p, b=q)} + {one.format(n=n, a=q, b=p)}) / 2))"

    pooled = lambda bins, n: "[" + ", ".join(f"sum({bins}[{i + 1}])" for i in range(n)) + f"] AS r_{bins}"
    return f"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text, row_number() OVER () AS k FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{ws}'), lambda x: x <> '') AS words FROM t),
l AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
  list_filter(list_transform(words, lambda x: rtrim(lower(x), ',.;:!?')), lambda x: x IN ({listed})) AS c FROM w),
tri AS (SELECT k, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM tri) WHERE n >= 2),
cov AS (SELECT k, count(DISTINCT p) AS n_repeat_words FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY k),
f AS (SELECT l.k, doc_id, lang, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
  length(text)::BIGINT AS n_chars, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
  [{classes}] AS classes, [{common}, len(words) - len(c)] AS word_bins FROM l LEFT JOIN cov USING (k)),
g AS (SELECT *, classes[{len(CLASSES)}]::BIGINT AS n_symbols, list_concat(classes, [n_chars - word_chars, word_chars - list_sum(classes)]) AS char_bins FROM f),
r AS (SELECT lang, {pooled("char_bins", n_char)}, {pooled("word_bins", n_word)} FROM g GROUP BY lang),
s AS (SELECT g.*, {share("char_bins", n_char)} AS p_char_bins, {share("r_char_bins", n_char)} AS q_char_bins,
  {share("word_bins", n_word)} AS p_word_bins, {share("r_word_bins", n_word)} AS q_word_bins FROM g JOIN r USING (lang)),
v AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  (n_chars >= {CHAR_GUARD} AND {distance("char_bins", n_char)} > {CHAR_LIMIT}) OR
  (n_words >= {WORD_GUARD} AND {distance("word_bins", n_word)} > {WORD_LIMIT} + {WORD_NOISE} / sqrt(n_words)) AS far FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT far AS kept FROM v
"""


@query("op2_quality_rules", _sql())
def op2_quality_rules(t: Tables) -> DataFrame:
    """Verdict on every document."""
    return quality_rules(t.documents).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
