"""Groups of spelling variants: words one edit apart, found over a reduced alphabet.

The letters are dealt to a few symbols, so a word becomes a reduced word. Two
words one edit apart have reduced words at most one edit apart. Every word
generates the full one-edit neighbourhood of its reduced word, as 64-bit hashes
taken from prefix sums, and meets the words whose reduced word is in it; what
meets is verified on the words as they are written.

The neighbourhood is symmetric, so of two reduced words the one with the smaller
hash looks for the other, and a pair of words is verified once. The number of
symbols grows with the eighth root of the vocabulary: more symbols make
neighbourhoods larger by a factor and chance meetings rarer by a power.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.native import ascii_lower, stored, text_or_empty
from gleaner.llm.words import mixed

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
# One in so many occurrences loses a letter.
DAMAGED = 97
FEWEST_SYMBOLS = 4
# Longer words are joined by their hash instead of being sent with every key.
LONG = 48
# Letters whose keys are made at a time.
SLICE = 1 << 15

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = _U(pow(_BASE, -1, 1 << 64))


def words_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word and n over all texts, each occurrence possibly without one letter.

    Words are runs of letters, A-Z folded. Where 97 divides the CRC-32 of
    ``<key>:<word>`` the letter at that number modulo the length is left out.
    A null key is written as nothing; null texts have no words.
    """
    runs = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
        F.explode(F.regexp_extract_all(ascii_lower(text_or_empty(F.col(text).cast("string"))), F.lit(RUN), F.lit(0))).alias("run"),
    )
    named = runs.withColumn("h", F.crc32(F.concat("key", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DAMAGED == 0, cut).otherwise(F.col("run"))
    return named.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def symbols_for(words: int) -> int:
    return max(FEWEST_SYMBOLS, int(np.ceil(max(words, 1) ** 0.125)))


def alphabet(words: DataFrame, symbols: int) -> np.ndarray:
    """Symbol by code point: letters dealt to the emptiest symbol, the most frequent first.

    The letters are those that a word can have, some 90, so the counts that
    come to the driver are bounded by the alphabet.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count().collect()
    symbol, load = np.zeros(256, dtype=np.uint8), [0] * symbols
    for row in sorted(letters, key=lambda r: (-r["count"], r["letter"])):
        if row["letter"]:
            least = load.index(min(load))
            symbol[ord(row["letter"]) & 255] = least
            load[least] += row["count"]
    return symbol


class Reducer:
    """Reduced words of a batch as digits with their prefix sums; hashes of them and their neighbours."""

    def __init__(self, words: list[str], symbol: np.ndarray, symbols: int):
        self.symbols = symbols
        self.lengths = np.array([len(w) for w in words], dtype=np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        self.digits = symbol[points & 255].astype(_U)
        self.ends = np.cumsum(self.lengths)
        self.word = np.repeat(np.arange(len(words)), self.lengths)
        self.place = np.arange(len(points)) - (self.ends - self.lengths)[self.word]
        longest = int(self.lengths.max(initial=0)) + 2
        self.powers = np.ones(longest, dtype=_U)
        self.powers[1:] = np.cumprod(np.full(longest - 1, _BASE, dtype=_U))
        self.values = (self.digits + _U(1)) * self.powers[self.place]
        sums = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(self.values, dtype=_U)])
        starts = sums[self.ends - self.lengths]
        self.totals = sums[self.ends] - starts
        self.before = sums[:-1] - starts[self.word]
        self.own = self._key(self.totals, self.lengths)

    @staticmethod
    def _key(h: np.ndarray, length: np.ndarray) -> np.ndarray:
        return mixed(h + length.astype(_U) * _U(0xD6E8FEB86659FD93))

    def neighbours(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word number, key) of every reduced word one edit away, each once.

        Of equal neighbours one is made: a letter is removed at the start of a
        run only, and not inserted before its equal.
        """
        every = np.arange(len(self.lengths))
        for c in range(self.symbols):
            yield every, self._key(self.totals + _U(c + 1) * self.powers[self.lengths], self.lengths + 1)
        for at in range(0, len(self.word), SLICE):
            part = slice(at, at + SLICE)
            word, digit, place = self.word[part], self.digits[part], self.place[part]
            total, before, value = self.totals[word], self.before[part], self.values[part]
            power, length = self.powers[place], self.lengths[word]
            previous = self.digits[np.maximum(np.arange(at, at + len(word)) - 1, 0)]
            first = (place == 0) | (digit != previous)
            yield word[first], self._key(before + (total - before - value) * _INVERSE, length - 1)[first]
            for c in range(self.symbols):
                other = digit != c
                swapped = total + (_U(c) - digit) * power
                inserted = before + _U(c + 1) * power + (total - before) * _U(_BASE)
                yield word[other], self._key(swapped, length)[other]
                yield word[other], self._key(inserted, length + 1)[other]


def reduced(words: DataFrame, symbol: np.ndarray, symbols: int) -> DataFrame:
    """Words with ``cell``, the hash of the reduced word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = Reducer(batch.column("word").to_pylist(), symbol, symbols).own
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.view(np.int64))], ["word", "n", "cell"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, cell long")


def probes(words: DataFrame, symbol: np.ndarray, symbols: int, name: str = "word") -> DataFrame:
    """probe, cell and same: the cells of a word's neighbourhood that it looks into, under the word or another name.

    Its own cell (same) and those of its neighbours with a larger hash.
    """
    kind = words.schema[name].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(probe, cell, same):
            return pa.RecordBatch.from_arrays([probe, pa.array(cell), pa.array(np.full(len(cell), same))], ["probe", "cell", "same"])

        for batch in batches:
            names = batch.column("probe")
            known = Reducer(batch.column("written").to_pylist(), symbol, symbols)
            own = known.own.view(np.int64)
            yield rows(names, own, True)
            for word, key in known.neighbours():
                key = key.view(np.int64)
                up = key > own[word]
                yield rows(names.take(pa.array(word[up])), key[up], False)

    given = words.select(F.col(name).alias("probe"), F.col("word").alias("written"))
    return given.mapInArrow(run, f"probe {kind}, cell long, same boolean")


def near_pairs(words: DataFrame, symbols: int | None = None, long: int = LONG) -> DataFrame:
    """Pairs a, b of words exactly one edit apart, each pair once; ``words`` has distinct word and n.

    Words of more than ``long`` letters meet each other under a hash of the
    word and are written out only where they meet, so what is sent with the
    keys of a very long word does not grow with its square.
    """
    symbols = symbols or symbols_for(words.count())
    symbol = alphabet(words, symbols)
    cells = stored(reduced(words, symbol, symbols), "cells").select("word", "cell", F.length("word").alias("size"))
    apart = F.levenshtein(F.col("a"), F.col("b"), 1) == 1
    once = ~F.col("same") | (F.col("a") < F.col("b"))

    brief = cells.filter(F.col("size") <= long + 1).select(F.col("word").alias("b"), "cell", "size")
    looked = probes(brief.withColumnRenamed("b", "word"), symbol, symbols).withColumnRenamed("probe", "a")
    near = looked.join(brief, "cell").filter(once & apart & (F.least(F.length("a"), "size") <= long))

    lengthy = cells.filter(F.col("size") > long).withColumn("name", F.xxhash64("word"))
    other = lengthy.select(F.col("name").alias("other"), "cell")
    met = probes(lengthy, symbol, symbols, "name").withColumnRenamed("probe", "name").join(other, "cell")
    written = lengthy.select("name", "word")
    far = (
        met.filter(F.col("name") != F.col("other")).select("name", "other", "same").distinct()
        .join(written.withColumnRenamed("word", "a"), "name")
        .join(written.withColumnsRenamed({"name": "other", "word": "b"}), "other")
        .filter(once & apart)
    )
    return near.select("a", "b").unionByName(far.select("a", "b"))


def _followed(forms: DataFrame) -> DataFrame:
    """word and root: the end of the chain word, form, form of the form, and so on.

    Every form is at least twice as frequent as its word, so chains end, after
    some 60 steps at most; each round doubles the steps taken.
    """
    root = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = root.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = stored(root.join(onward, "root", "left"), "ahead")
        if ahead.filter("next IS NOT NULL").isEmpty():
            return root
        root = stored(ahead.select("word", F.coalesce("next", "root").alias("root")), "roots")


def variants(words: DataFrame, symbols: int | None = None, long: int = LONG) -> DataFrame:
    """Every word with its number of near words, its form and the root of its group.

    ``words`` has distinct word and n. The form is the near word with the
    largest n, of equal ones the first in code-point order, if it is at least
    twice as frequent as the word; else form and form_n are null. The root is
    what the forms lead to, the word itself without a form. ``symbols`` and
    ``long`` change the work, not the result.
    """
    vocabulary = stored(words.select("word", "n"), "vocabulary")
    pairs = stored(near_pairs(vocabulary, symbols, long), "pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    best = F.min(F.struct((-F.col("n")).alias("m"), "b"))
    near = (
        both.join(vocabulary.withColumnRenamed("word", "b"), "b")
        .groupBy(F.col("a").alias("word"))
        .agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    )
    often = -F.col("best.m") >= 2 * F.col("n")
    known = stored(
        vocabulary.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(often, F.col("best.b")).alias("form"), F.when(often, -F.col("best.m")).alias("form_n"),
        ),
        "known",
    )
    roots = _followed(known.filter("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The variants among all words of the documents of 5 letters or more that occur 3 times or more.

    Null and empty texts add no words, repeated rows and ties count as they
    stand, an empty table has no words. Other columns are ignored.
    """
    counted = words_of(docs)
    return variants(counted.filter((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT)))


def variants_sql(crc_table: str, crc32: str) -> str:
    """SQL of ``spelling_variants``; ``crc32`` is the checksum of a column ``said``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE {crc_table},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
said AS (SELECT doc_id, run, coalesce(doc_id::VARCHAR, '') || ':' || run AS said, count(*) AS times FROM runs GROUP BY ALL),
hashed AS (SELECT run, times, {crc32} AS h FROM said, crc_table),
written AS (
  SELECT CASE WHEN h % {DAMAGED} = 0 THEN substring(run, 1, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2) ELSE run END AS word, times
  FROM hashed),
vocabulary AS MATERIALIZED (
  SELECT word, sum(times)::BIGINT AS n FROM written WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(times) >= {LEAST_COUNT}),
cuts AS MATERIALIZED (
  SELECT word, i, substring(word, 1, i - 1) || substring(word, i + 1) AS cut FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
close AS (
  SELECT DISTINCT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT c.word, v.word FROM cuts c JOIN vocabulary v ON c.cut = v.word
  UNION
  SELECT v.word, c.word FROM cuts c JOIN vocabulary v ON c.cut = v.word),
near AS (
  SELECT c.word, count(*) AS n_near, arg_min(other, (-v.n, other)) AS best, max(v.n) AS best_n FROM close c JOIN vocabulary v ON v.word = c.other GROUP BY c.word),
known AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * v.n THEN best END AS form, CASE WHEN best_n >= 2 * v.n THEN best_n END AS form_n
  FROM vocabulary v LEFT JOIN near USING (word)),
chain AS (
  SELECT word, word AS at FROM known
  UNION ALL
  SELECT c.word, k.form FROM chain c JOIN known k ON k.word = c.at WHERE k.form IS NOT NULL)
SELECT k.word, k.form, c.at AS root, k.n, k.n_near, k.form_n
FROM known k JOIN chain c ON c.word = k.word JOIN known e ON e.word = c.at WHERE e.form IS NULL
"""
