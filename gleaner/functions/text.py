"""Text expressions: tokens, vocabulary keys for inexact matching, shingles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Longest prefix kept as a join key; longer prefixes are verified after the join.
PREFIX_KEY_LENGTH = 12
GRAM = 3


def _class_chars(chars) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in chars)


def break_pattern(separators=(), symbols=()) -> str:
    """Regular expression of the gaps between tokens.

    Letters and digits make up tokens. ``symbols`` are kept in tokens as well,
    ``separators`` always split, even if they would otherwise be kept.
    """
    gap = r"[^\p{L}\p{N}" + _class_chars(symbols) + "]"
    if separators:
        gap = f"(?:{gap}|[{_class_chars(separators)}])"
    return gap + "+"


def tokens(text: Column, separators=(), symbols=()) -> Column:
    return F.filter(F.split(F.lower(text), break_pattern(separators, symbols)), lambda t: t != "")


def prefix_keys(token: Column) -> Column:
    """Every leading piece of a token, up to the longest key length."""
    longest = F.least(F.length(token), F.lit(PREFIX_KEY_LENGTH))
    return F.transform(F.sequence(F.lit(1), longest), lambda n: F.substring(token, F.lit(1), n))


def prefix_key(token: Column) -> Column:
    return F.substring(token, 1, PREFIX_KEY_LENGTH)


def gram_keys(token: Column) -> Column:
    """All distinct pieces of 1 to 3 characters of a token."""
    starts = F.sequence(F.lit(1), F.length(token))
    grams = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.least(F.length(token), F.lit(GRAM))),
            lambda n: F.transform(starts, lambda s: F.substring(token, s, n)),
        )
    )
    return F.array_distinct(grams)


def gram_key(token: Column) -> Column:
    """The one piece looked up for an infix: any token holding it has this piece."""
    return F.substring(token, 1, GRAM)


def _segment_start(length: Column, segment: Column, pieces: int) -> Column:
    """0-based start of segment 0..pieces-1; the longer segments come last."""
    base = F.floor(length / pieces).cast("int")
    short = pieces - (length - base * pieces)
    return segment * base + F.greatest(F.lit(0), segment - short)


def _segment_length(length: Column, segment: Column, pieces: int) -> Column:
    base = F.floor(length / pieces).cast("int")
    short = pieces - (length - base * pieces)
    return base + (segment >= short).cast("int")


def _segment_key(bound: int, length: Column, segment: Column, piece: Column) -> Column:
    return F.concat_ws(":", F.lit(str(bound)), length.cast("string"), segment.cast("string"), piece)


def segment_keys(token: Column, bound: int) -> Column:
    """Keys of a vocabulary token: its bound+1 even segments.

    With at most ``bound`` edits one segment stays whole, moved by at most
    ``bound`` places (the partition scheme of PassJoin, VLDB 2011). A token
    has three keys at bound 2, where deletion neighbourhoods need hundreds.
    """
    length = F.length(token)
    pieces = bound + 1

    def key(segment):
        start = _segment_start(length, segment, pieces)
        piece = F.substring(token, start + 1, _segment_length(length, segment, pieces))
        return _segment_key(bound, length, segment, piece)

    return F.transform(F.sequence(F.lit(0), F.lit(bound)), key)


def segment_probes(token: Column, bound: int) -> Column:
    """Keys a misspelt token looks up among ``segment_keys(..., bound)``."""
    length = F.length(token)
    pieces = bound + 1
    shifts = F.sequence(F.lit(-bound), F.lit(bound))

    def per_length(other):
        def per_segment(segment):
            size = _segment_length(other, segment, pieces)

            def per_shift(shift):
                start = _segment_start(other, segment, pieces) + shift
                fits = (start >= 0) & (start + size <= length)
                return F.when(
                    fits, _segment_key(bound, other, segment, F.substring(token, start + 1, size))
                )

            return F.transform(shifts, per_shift)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(bound)), per_segment))

    lengths = F.sequence(F.greatest(F.lit(1), length - bound), length + bound)
    keys = F.flatten(F.transform(lengths, per_length))
    return F.array_distinct(F.filter(keys, lambda k: k.isNotNull()))


def word_shingles(toks: Column, size: int = 3) -> Column:
    """Distinct hashes of ``size`` consecutive words; a shorter text is one shingle.

    ``toks`` should be a column, not an expression: it is read once per shingle.
    """
    count = F.greatest(F.lit(1), F.size(toks) - (size - 1))
    return F.array_distinct(
        F.transform(F.sequence(F.lit(1), count), lambda s: F.xxhash64(F.slice(toks, s, size)))
    )
