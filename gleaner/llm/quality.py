"""Quality rules: fixed counts of a text, and the divergence of its histograms from its language.

Two histograms of a document, of character classes and of common words, are
compared with the mean histograms of its language by Jensen-Shannon distance.
Short documents are not compared: their histograms say little. How far common
words may be off follows from the reference, by the distance that a text
without any of them has, and from the length, by its sampling noise.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.native import BLANKS, WORD, let, removed, stored, text_or_empty, word_list

SYMBOLS = "[#*$%&|<>]"
# The most common words of four languages, as written inside a sentence.
COMMON_WORDS = {
    "de": ["der", "die", "und", "den", "von", "das", "nicht", "ist"],
    "en": ["the", "of", "and", "to", "in", "that", "is", "it"],
    "es": ["de", "la", "que", "el", "los", "se", "las", "por"],
    "fr": ["la", "le", "et", "les", "des", "un", "une", "que"],
}
WORDS = sorted({w for words in COMMON_WORDS.values() for w in words})
# Up to so many repeated windows of a text are looked up one by one.
LOOKED_UP = 64
CLASSES = ["ascii_letters", "other_letters", "digits", "blanks", "symbols", "punctuation"]


@dataclass(frozen=True)
class Rules:
    """Bounds of the rules; distances lie between 0 and 1.

    The word histogram of a text may be off by ``most_word_share`` of the
    distance that a text without common words has, and by chance: the squared
    distance of n words drawn from the reference is about ``word_noise`` / n,
    which is classes / (8 ln 2). A language in which common words make up less
    than ``least_common`` of the mean text says nothing by them.
    """

    least_words: int = 50
    most_repeated: int = 50  # percent of words in repeated 3-word windows
    least_chars_compared: int = 400
    least_words_compared: int = 100
    most_class_distance: float = 0.30
    most_word_share: float = 0.75
    word_noise: float = len(COMMON_WORDS["en"]) / (8 * math.log(2))
    least_common: float = 0.05


def _no_hashes() -> Column:
    return F.array().cast("array<bigint>")


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash of every 3-word window; ``words`` is an array column."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    return F.when(F.size(words) < 3, _no_hashes()).otherwise(windows)


def _covered(hashes: Column, twice: Column) -> Column:
    """Words that lie in a window whose hash is among ``twice``, the hashes found more than once.

    Few repeated hashes are looked up for each window; many are found by
    sorting the windows. Either way a word counts once.
    """

    def sorted_starts(found: Column) -> Column:
        last = F.size(found) - 1
        same = lambda x, k: found[F.least(F.greatest(k, F.lit(0)), last)]["h"] == x["h"]
        repeated = F.filter(found, lambda x, k: ((k > 0) & same(x, k - 1)) | ((k < last) & same(x, k + 1)))
        return F.sort_array(F.transform(repeated, lambda x: x["i"]))

    def width(at: Column) -> Column:
        last = F.size(at) - 1
        return F.aggregate(
            F.transform(at, lambda x, k: F.when(k < last, F.least(F.lit(3), at[F.least(k + 1, last)] - x)).otherwise(3)),
            F.lit(0), lambda a, b: a + b,
        )

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    looked_up = F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), lambda i: F.array_contains(twice, hashes[i]))
    starts = F.when(F.size(twice) <= LOOKED_UP, looked_up).otherwise(let(pairs, sorted_starts))
    return F.when(F.size(twice) == 0, F.lit(0)).otherwise(let(starts, width)).cast("long")


def features(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The counts of every whole text: key, lang, the base counts, ``classes`` and ``common`` as arrays."""
    body = text_or_empty(F.col("text"))
    given = docs.select(F.col(key).alias("doc_id"), F.col(lang).alias("lang"), body.alias("text"))
    # Each pattern runs on what the one before has left, which soon is short; texts and
    # arrays are given up as soon as their counts are taken.
    cut = (
        given.withColumn("_rest", removed(F.col("text"), "[A-Za-z]+"))
        .withColumn("_dark", removed(F.col("_rest"), BLANKS))
        .withColumn("_unnumbered", removed(F.col("_dark"), "[0-9]+"))
        .withColumn("_signs", removed(F.col("_unnumbered"), r"\p{L}+"))
        .withColumn("_unsymboled", removed(F.col("_signs"), SYMBOLS + "+"))
    )
    size = lambda c: F.length(c).cast("long")
    letters, rest = size("text") - size("_rest"), size("_rest")
    counts = [
        letters,
        size("_unnumbered") - size("_signs"),
        size("_dark") - size("_unnumbered"),
        rest - size("_dark"),
        size("_signs") - size("_unsymboled"),
        size("_unsymboled"),
    ]
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    counted = cut.select(
        "doc_id",
        "lang",
        "text",
        (size("text") - rest + size("_dark")).alias("word_chars"),
        (size("_signs") - size("_unsymboled")).alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.array(*counts).alias("classes"),
    )
    scalars = ["doc_id", "lang", "word_chars", "n_symbols", "n_dup_lines", "classes"]
    spaced = lambda w: F.lit(f" {w} ")
    common = [
        ((F.length("_common") - F.length(F.replace(F.col("_common"), spaced(w), F.lit("")))) / (len(w) + 2)).cast("long") for w in WORDS
    ]
    listed = F.concat(F.lit(" "), F.array_join(F.filter("words", lambda w: w.isin(WORDS)), "  "), F.lit(" "))
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    return (
        counted.select(*scalars, word_list(F.col("text")).alias("words"))
        .select(*scalars, F.size("words").cast("long").alias("n_words"), listed.alias("_common"), _window_hashes(F.col("words")).alias("_hashes"))
        .select(*scalars, "n_words", "_common", "_hashes", F.when(repeats, F.sort_array("_hashes")).otherwise(_no_hashes()).alias("_sorted"))
        .withColumn("_twice", F.array_distinct(F.filter("_sorted", lambda x, k: (k > 0) & (F.col("_sorted")[F.greatest(k - 1, F.lit(0))] == x))))
        .select(*scalars, "n_words", _covered(F.col("_hashes"), F.col("_twice")).alias("n_repeat_words"), F.array(*common).alias("common"))
    )


def _base_failed(rules: Rules) -> Column:
    return (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.most_repeated * F.col("n_words"))


def _chars() -> Column:
    return F.aggregate("classes", F.lit(0).cast("long"), lambda a, b: a + b)


def _shares(counts: Column, whole: Column) -> Column:
    return F.transform(counts, lambda c: c / whole)


def _word_counts() -> Column:
    """Common words, and all other words as one more class."""
    listed = F.aggregate("common", F.lit(0).cast("long"), lambda a, b: a + b)
    return F.concat(F.col("common"), F.array(F.col("n_words") - listed))


def language_references(counted: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Mean histograms per language over all documents that pass the base rules and are long enough.

    Every such document counts alike, whatever its length. One row per
    language that has any: lang, ref_classes, ref_words.
    """
    fit = counted.filter(
        ~_base_failed(rules) & (_chars() >= rules.least_chars_compared) & (F.col("n_words") >= rules.least_words_compared)
    ).select("lang", _shares(F.col("classes"), _chars()).alias("c"), _shares(_word_counts(), F.col("n_words")).alias("w"))
    means = lambda name, n: F.array(*[F.avg(F.col(name)[i]) for i in range(n)])
    return fit.groupBy("lang").agg(means("c", len(CLASSES)).alias("ref_classes"), means("w", len(WORDS) + 1).alias("ref_words"))


def distance(shares: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two distributions given as arrays."""
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    parts = F.zip_with(shares, reference, lambda p, q: part(p, (p + q) / 2) / 2 + part(q, (p + q) / 2) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)))


def _word_bound(rules: Rules) -> Column:
    """The largest distance of a word histogram from ``ref_words`` that a text of ``n_words`` may have."""
    wordless = F.array(*[F.lit(0.0)] * len(WORDS), F.lit(1.0))
    systematic = rules.most_word_share * distance(wordless, F.col("ref_words"))
    return F.sqrt(systematic * systematic + F.lit(rules.word_noise) / F.col("n_words"))


def judge(docs: DataFrame, rules: Rules = Rules(), references: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """The verdict on every row: key, base counts, base_failed, kept, class_distance, word_distance, word_bound.

    A document is rejected if it fails the base rules or lies too far from its
    language in either histogram. A distance is null, and not held against the
    document, below the minimum lengths and for a language (null is one)
    without a reference; that of words also for a language whose documents
    hardly have common words. Null texts are empty and fail; repeated rows are judged
    alike; rows of an empty table are none. References are learnt from all given
    documents unless given. The counts are written to the shared folder once,
    as they are used twice.
    """
    counted = stored(features(docs, key), "quality")
    known = language_references(counted, rules) if references is None else references
    compared = counted.join(known.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    far = lambda test, shares, ref: F.when(test & F.col(ref).isNotNull(), distance(shares, F.col(ref)))
    judged = compared.withColumn(
        "class_distance", far(_chars() >= rules.least_chars_compared, _shares(F.col("classes"), _chars()), "ref_classes")
    ).withColumn(
        "word_distance",
        far(
            (F.col("n_words") >= rules.least_words_compared) & (F.col("ref_words")[len(WORDS)] <= 1 - rules.least_common),
            _shares(_word_counts(), F.col("n_words")), "ref_words",
        ),
    ).withColumn("word_bound", F.when(F.col("word_distance").isNotNull(), _word_bound(rules)))
    near = (F.coalesce("class_distance", F.lit(0.0)) <= rules.most_class_distance) & (
        F.col("word_distance").isNull() | (F.col("word_distance") <= F.col("word_bound"))
    )
    return judged.withColumn("base_failed", _base_failed(rules)).select(
        F.col("doc_id").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & near).alias("kept"), "class_distance", "word_distance", "word_bound",
    )


def judge_sql(rules: Rules = Rules()) -> str:
    """SQL of the same verdicts with references learnt from all documents."""
    count = lambda pattern, of: f"length({of}) - length(regexp_replace({of}, '{pattern}', '', 'g'))"
    classes = [
        count("[A-Za-z]", "body"), "length(regexp_replace(d, '[^\\p{L}]', '', 'g'))", count("[0-9]", "d"), count(BLANKS, "body"),
        count(SYMBOLS, "d"), "length(regexp_replace(d, '[\\p{L}0-9]', '', 'g')) - (" + count(SYMBOLS, "d") + ")",
    ]
    common = [f"len(list_filter(w, lambda x: x = '{word}'))" for word in WORDS]
    js = lambda p, q: (
        f"sqrt(greatest(0.0, list_sum(list_transform(list_zip({p}, {q}), lambda z: "
        "(CASE WHEN z[1] > 0 THEN z[1] * log2(z[1] / ((z[1] + z[2]) / 2)) ELSE 0.0 END) / 2 + "
        "(CASE WHEN z[2] > 0 THEN z[2] * log2(z[2] / ((z[1] + z[2]) / 2)) ELSE 0.0 END) / 2))))"
    )
    means = lambda name, n: "[" + ", ".join(f"avg({name}[{i + 1}])" for i in range(n)) + "]"
    return f"""
WITH g AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS body,
         regexp_replace(regexp_replace(coalesce(text, ''), '[A-Za-z]', '', 'g'), '{BLANKS}', '', 'g') AS d,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w
  FROM documents),
win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM g)),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM win WHERE n > 1) GROUP BY rid),
f AS (
  SELECT rid, doc_id, lang, len(w) AS n_words, length(body) - ({count(BLANKS, "body")}) AS word_chars,
         {count(SYMBOLS, "body")} AS n_symbols,
         len(list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '{WORD}')))
           - len(list_distinct(list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '{WORD}')))) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, length(body) AS chars,
         [{", ".join(classes)}] AS classes, [{", ".join(common)}] AS listed
  FROM g LEFT JOIN rep USING (rid)),
s AS (
  SELECT *, n_words < {rules.least_words} OR 100 * n_repeat_words > {rules.most_repeated} * n_words AS base_failed,
         list_transform(classes, lambda x: x / chars) AS c,
         list_transform(list_append(listed, n_words - list_sum(listed)), lambda x: x / n_words) AS v
  FROM f),
r AS (
  SELECT lang, {means("c", len(CLASSES))} AS rc, {means("v", len(WORDS) + 1)} AS rw FROM s
  WHERE NOT base_failed AND chars >= {rules.least_chars_compared} AND n_words >= {rules.least_words_compared} GROUP BY lang),
j AS (
  SELECT s.*, sqrt(({rules.most_word_share} * {js("[" + "0.0, " * len(WORDS) + "1.0]", "rw")}) ** 2 + {rules.word_noise!r} / n_words) AS word_bound,
         CASE WHEN chars >= {rules.least_chars_compared} AND rc IS NOT NULL THEN {js("c", "rc")} END AS class_distance,
         CASE WHEN n_words >= {rules.least_words_compared} AND rw[{len(WORDS) + 1}] <= {1 - rules.least_common} THEN {js("v", "rw")} END AS word_distance
  FROM s LEFT JOIN r ON s.lang IS NOT DISTINCT FROM r.lang)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND coalesce(class_distance, 0) <= {rules.most_class_distance}
         AND (word_distance IS NULL OR word_distance <= word_bound) AS kept
FROM j
"""
