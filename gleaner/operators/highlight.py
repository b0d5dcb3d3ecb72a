"""Highlights and snippets of ranked hits; applied after the page is cut."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import break_pattern, tokens

START, END = "<mark>", "</mark>"
AFFIX_TOKENS = 4
SNIPPET_THRESHOLD = 30


def matched_tokens(page: DataFrame, candidates: DataFrame) -> DataFrame:
    """Attach the tokens that may be marked, one list per query."""
    lists = candidates.groupBy("query_id").agg(F.array_sort(F.collect_set("token")).alias("marks"))
    return page.join(lists, "query_id", "left")


def query_marks(queries: DataFrame) -> DataFrame:
    return queries.select("query_id", F.array_distinct(tokens(F.col("q"))).alias("marks"))


def _words(text: Column) -> Column:
    """The text cut at white space; punctuation stays with its word."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def _core(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), break_pattern(), " ")


def _hit(word: Column, marks: Column) -> Column:
    return F.arrays_overlap(F.split(F.trim(_core(word)), " "), marks)


def highlight(text: Column, marks: Column, start: str = START, end: str = END, separators=(), symbols=()) -> Column:
    """Whole text with the matching tokens in tags; white space and punctuation stay as they are."""
    gap = break_pattern(separators, symbols)
    pieces = F.regexp_extract_all(text, F.lit(f"{gap}|(?s:(?!{gap}).)+"), F.lit(0))
    return F.array_join(
        F.transform(
            pieces,
            lambda p: F.when(F.array_contains(marks, F.lower(p)), F.concat(F.lit(start), p, F.lit(end))).otherwise(p),
        ),
        "",
    )


def snippet(
    text: Column,
    marks: Column,
    affix: int = AFFIX_TOKENS,
    threshold: int = SNIPPET_THRESHOLD,
    start: str = START,
    end: str = END,
) -> Column:
    """The words around the first match; texts below ``threshold`` words are returned whole."""
    words = _words(text)
    flags = F.transform(words, lambda w: _hit(w, marks))
    first = F.coalesce(F.array_position(flags, True), F.lit(0)).cast("int")
    begin = F.greatest(F.lit(1), first - affix)
    around = F.slice(words, begin, F.greatest(first, F.lit(1)) + affix - begin + 1)
    window = F.when(F.size(words) < threshold, words).otherwise(around)
    return highlight(F.array_join(window, " "), marks, start, end)
