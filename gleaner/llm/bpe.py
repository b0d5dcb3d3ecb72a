"""Token counts by byte-pair merging with a heap over a linked list of symbols.

A chunk of text starts as its UTF-8 bytes, one symbol each, the last marked as
the end of a word. The adjacent pair of lowest rank (the leftmost of equals) is
merged until no pair has a rank. Each merge makes two symbols one, so the count
is the number of bytes less the number of merges; no identifier is looked up.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from types import ModuleType

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the vocabulary file's format: white space, the split pattern's
# classes and the strings that stand for special tokens.
SPACE = "\t-\r \x85\xa0  -     　"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Words and chunks whose counts one worker process remembers, and the longest worth it.
REMEMBERED, LONGEST = 400_000, 48


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Merger:
    """Counts the tokens of texts with the merges of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        end = spec["model"]["end_of_word_suffix"] or ""
        ids: dict[str, int] = {}
        number = lambda symbol: ids.setdefault(symbol, len(ids))
        self.inner = [number(s) for s in byte_symbols()]
        self.last = [number(s + end) for s in byte_symbols()]
        self.ranks: dict[int, int] = {}  # of pairs, as one number each
        self.parts: list[tuple[int, int, int]] = []  # by rank: left, right, merged
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.parts.append((number(left), number(right), number(left + right)))
            self.ranks[self.parts[-1][0] << 24 | self.parts[-1][1]] = rank
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.starts = tuple({s[:2] for s in special})
        self.chunks = re.compile(f"[^{SPACE}]+")
        self.words = regex.compile(WORDS.replace(r"\s", SPACE))
        self.known: dict[str, int] = {}
        self.known_words: dict[str, int] = {}

    def word(self, data: bytes) -> int:
        """Symbols left of one word. The heap holds rank and place of a pair as one number."""
        n = left = len(data)
        inner, rank_of, parts = self.inner, self.ranks.get, self.parts
        symbols = [inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        heap, at = [], 0
        for pair in zip(symbols, symbols[1:]):
            rank = rank_of(pair[0] << 24 | pair[1])
            if rank is not None:
                heap.append(rank << 40 | at)
            at += 1
        if not heap:
            return n
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        while heap:
            entry = pop(heap)
            at = entry & 0xFFFFFFFFFF
            first, second, merged = parts[entry >> 40]
            right = after[at]
            if symbols[at] != first or right < 0 or symbols[right] != second:
                continue  # one of the two has been merged since
            left -= 1
            symbols[at] = merged
            symbols[right] = -1
            follow = after[at] = after[right]
            if follow >= 0:
                before[follow] = at
                rank = rank_of(merged << 24 | symbols[follow])
                if rank is not None:
                    push(heap, rank << 40 | at)
            lead = before[at]
            if lead >= 0:
                rank = rank_of(symbols[lead] << 24 | merged)
                if rank is not None:
                    push(heap, rank << 40 | lead)
        return left

    def chunk(self, chunk: str) -> int:
        """Tokens of a piece of text without white space."""
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        total, known = 0, self.known_words
        for word in self.words.findall(chunk.lower()):
            found = known.get(word)
            if found is None:
                found = self.word(word.encode("utf-8", "surrogatepass"))
                if len(word) <= LONGEST and len(known) < REMEMBERED:
                    known[word] = found
            total += found
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        total, parts = 0, [text]
        if self.special and any(s in text for s in self.starts):
            parts = self.special.split(text)
            total = len(parts) - 1
        known = self.known
        for part in parts:
            for piece in self.chunks.findall(part):
                found = known.get(piece)
                if found is None:
                    found = self.chunk(piece)
                    if len(piece) <= LONGEST and len(known) < REMEMBERED:
                        known[piece] = found
                total += found
        return total


def tokens_of(path: str):
    """A column function giving the tokens of a text; a worker process reads the vocabulary once."""

    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # Task functions are sent by value; what is to outlive a task needs a module of its own.
        kept = sys.modules.setdefault("_kept_by_worker", ModuleType("_kept_by_worker")).__dict__
        merger = kept.get(path) or kept.setdefault(path, Merger(path))
        for texts in batches:
            yield pd.Series([merger.count(t) for t in texts], dtype="int64")

    # Given as classes: the names of this module's annotations are not resolved in a task.
    tokens.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(tokens, "long")


def count_tokens(docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes and tokens of every text: key, n_bytes, n_tokens, over_limit.

    A null text counts as an empty one: 0 bytes, 0 tokens. Rows that repeat
    give repeated rows; null keys stay null. Other columns are not read. A text
    of any length is counted whole, in time n log n of its longest word.
    """
    return (
        docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
        .withColumn("n_tokens", tokens_of(path)(F.col("text")))
        .select(
            F.col("doc_id").alias(key),
            F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
            "n_tokens",
            (F.col("n_tokens") > limit).alias("over_limit"),
        )
    )
