"""Token search over text columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: everything that is not a letter or digit separates tokens.
TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def tokens(col: Column) -> Column:
    """Lower-cased tokens of a text."""
    return F.filter(F.split(F.lower(col), TOKEN_BREAK), lambda w: w != "")


def token_text(col: Column) -> Column:
    """Lower-cased text in which a run of bytes of ASCII letters, ASCII digits and other characters than ASCII is a token."""
    return F.regexp_replace(F.lower(col), r"[^\x00-\x7F\p{L}\p{N}]+", " ")


def _terms(term: str) -> list[str]:
    import regex

    return [w for w in regex.split(TOKEN_BREAK, term.lower()) if w]


def phrase_words(term: str) -> tuple[list[str], bool]:
    """Tokens of a search term, and whether it stands in backticks."""
    return _terms(term.strip("`")), term.startswith("`") and term.endswith("`") and len(term) > 1


def _run(words: list[str]) -> str:
    """Pattern of tokens one after the other, in lower-cased text."""
    return r"(?<![\p{L}\p{N}])" + TOKEN_BREAK.join(words) + r"(?![\p{L}\p{N}])"


def matches(col: Column, term: str, analyzer: str = "log") -> Column:
    """Whether a text holds ``term``.

    ``no_op`` compares the whole value. ``log`` asks for every token of the term, in any place;
    a term in backticks must appear as that exact run of tokens.
    """
    if analyzer == "no_op":
        return col == F.lit(term)
    words, phrase = phrase_words(term)
    if not words:
        return F.lit(False)
    # a plain substring test first; then the text is searched for whole tokens, up to the first, without cutting it up
    low = F.lower(col)
    likely = reduce(lambda a, b: a & b, (F.contains(low, F.lit(w)) for w in words))
    return likely & reduce(lambda a, b: a & b, (low.rlike(p) for p in ([_run(words)] if phrase else [_run([w]) for w in words])))


def search_columns(df: DataFrame, cols: list[str] | None, term: str, analyzer: str = "log") -> Column:
    """Predicate for one column, several columns, or (``None``) every string column of the row."""
    names = cols or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return reduce(lambda a, b: a | b, (F.coalesce(matches(F.col(c), term, analyzer), F.lit(False)) for c in names))
