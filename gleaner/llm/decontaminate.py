"""Benchmark passages in training texts, found with a stored positional inverted index.

The index holds, for every term of the benchmark, its postings in the training
texts: document and position. A phrase is looked up by its rarest term first;
its postings, moved back by the term's offset, are the places where the phrase
can begin. They are intersected with the moved postings of the second rarest
term and then with those of all others. What is left are the phrase's places;
with a slop, terms may lie some positions off, and places are marked as near.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleaner.functions.skew import broadcast_checked
from gleaner.llm.native import UPPER, ascii_lower, stored, text_or_empty
from gleaner.session import work_path

# A word before A-Z are folded: digits, letters and all code points above ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
FOLDED_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
# Folders that the postings are dealt to by term, so that a lookup reads few of them.
BUCKETS = 8

_KEY = ["doc_id", "digest"]
_PLACE = [*_KEY, "start", "phrase", "length"]


def benchmark_words(text: Column) -> Column:
    return F.regexp_extract_all(text_or_empty(text), F.lit(WORD), F.lit(0))


@dataclass(frozen=True)
class Phrases:
    """Distinct phrases: ``terms`` (phrase, offset, term, length) and their ``items`` (phrase, item_id)."""

    terms: DataFrame
    items: DataFrame


def phrases(items: DataFrame, window: int = WINDOW, key: str = "item_id", text: str = "text") -> Phrases:
    """All runs of ``window`` words of each item; an item of fewer words, but not none, is one phrase.

    Equal phrases of several items are one phrase with several items. Null
    texts have no words; items with a null key have phrases, but no name.
    """
    words = F.transform(benchmark_words(F.col(text)), lambda w: F.translate(w, UPPER, UPPER.lower()))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - window + 1))
    runs = (
        items.select(F.col(key).cast("string").alias("item_id"), words.alias("words"))
        .filter(F.size("words") > 0)
        .withColumn("run", F.explode(F.transform(starts, lambda s: F.slice(F.col("words"), s, window))))
        .withColumn("phrase", F.md5(F.array_join("run", " ")))
    )
    named = stored(runs.select("phrase", "item_id", "run"), "phrases")
    terms = named.dropDuplicates(["phrase"]).select("phrase", F.size("run").alias("length"), F.posexplode("run").alias("offset", "term"))
    return Phrases(terms, named.select("phrase", "item_id").filter("item_id IS NOT NULL").distinct())


@dataclass(frozen=True)
class Index:
    """``vocabulary`` (term, term_id, bucket) and the folder of postings (bucket, term_id, doc_id, digest, pos)."""

    vocabulary: DataFrame
    folder: str
    schema: StructType

    def postings(self) -> DataFrame:
        return self.vocabulary.sparkSession.read.schema(self.schema).parquet(self.folder)


def build_index(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text") -> Index:
    """Postings of the given terms in every whole text, written once by the tasks that read the texts.

    ``terms`` has the column ``term``. The vocabulary goes to the texts by
    broadcast if its counted rows allow it, else words are shuffled by term. A
    document is its key together with a hash of its text, so rows that share a
    key, or have none, are not mixed up.
    """
    spark = docs.sparkSession
    vocabulary = stored(
        terms.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id()), "vocabulary"
    ).withColumn("bucket", F.pmod(F.xxhash64("term_id"), F.lit(BUCKETS)).cast("int"))
    small, _ = broadcast_checked(vocabulary)
    folder = work_path(spark, "postings")
    postings = (
        docs.select(
            F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("digest"), F.posexplode(benchmark_words(F.col(text))).alias("pos", "word")
        )
        .select("doc_id", "digest", "pos", ascii_lower(F.col("word")).alias("term"))
        .join(small, "term")
        .select("bucket", "term_id", "doc_id", "digest", "pos")
    )
    postings.write.partitionBy("bucket").parquet(folder)
    small.unpersist()
    return Index(vocabulary, folder, postings.schema)


def _confirmed(places: DataFrame, wanted: DataFrame, postings: DataFrame, slop: int) -> DataFrame:
    """Places where all ``wanted`` terms (phrase, offset, term_id, needed) are found, with the largest shift so far.

    ``places`` come with their phrase's length and the shift ``off`` of the terms found before. Each wanted term is one row to be met by a posting of the same document;
    with a slop, postings are met in the cells of slop + 1 positions around.
    """
    cell = lambda c: F.floor(c / F.lit(slop + 1)).cast("int")
    expected = F.col("start") + F.col("offset")
    sought = (
        places.withColumnRenamed("off", "before")
        .join(wanted, "phrase")
        .withColumn("expected", expected)
        .withColumn("cell", F.explode(F.sequence(cell(F.col("expected") - slop), cell(F.col("expected") + slop))))
    )
    there = postings.select("term_id", F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest"), "pos", cell(F.col("pos")).alias("cell"))
    met = sought.join(
        there,
        (sought["term_id"] == there["term_id"])
        & (sought["cell"] == there["cell"])
        & (sought["digest"] == there["_digest"])
        & sought["doc_id"].eqNullSafe(there["_doc"])
        & (F.abs(there["pos"] - sought["expected"]) <= slop),
    )
    return (
        met.groupBy(*_PLACE, "before", "offset", "needed")
        .agg(F.min(F.abs(F.col("pos") - F.col("expected"))).alias("off"))
        .groupBy(*_PLACE, "before", "needed")
        .agg(F.count(F.lit(1)).alias("found"), F.max("off").alias("off"))
        .filter(F.col("found") == F.col("needed"))
        .select(*_PLACE, F.greatest("before", "off").alias("off"))
    )


def find(index: Index, sought: Phrases, slop: int = 0) -> DataFrame:
    """Every place of every phrase: doc_id, digest, start, phrase, length, exact.

    With ``slop`` 0 all places are exact. With more, a place also counts if
    each term lies within ``slop`` positions of where it should be, measured
    from the rarest term, which lies exactly. A repeated row is one document.
    """
    postings = index.postings()
    frequencies = postings.groupBy("term_id").agg(F.count(F.lit(1)).alias("frequency"))
    by_rarity = Window.partitionBy("phrase").orderBy("frequency", "offset")
    ranked = (
        sought.terms.join(index.vocabulary, "term")
        .join(frequencies, "term_id")
        .withColumn("rank", F.row_number().over(by_rarity))
        .withColumn("_known", F.count(F.lit(1)).over(Window.partitionBy("phrase")))
        .filter(F.col("_known") == F.col("length"))
        .select("phrase", "length", "offset", "term_id", "bucket", "rank")
    )
    ranked = stored(ranked, "ranked")
    anchors, _ = broadcast_checked(ranked.filter("rank = 1").select("phrase", "length", "offset", "term_id", "bucket"))
    places = stored(
        postings.join(anchors, ["bucket", "term_id"])
        .select(*_KEY, (F.col("pos") - F.col("offset")).alias("start"), "phrase", "length", F.lit(0).alias("off"))
        .filter("start >= 0")
        .distinct(),
        "places",
    )
    anchors.unpersist()

    # The second rarest term takes away most places; its postings are few as well.
    second = ranked.filter("rank = 2").select("phrase", "offset", "term_id", "bucket", F.lit(1).alias("needed"))
    rare, _ = broadcast_checked(second.select("bucket", "term_id").distinct())
    narrowed = _confirmed(places, second.drop("bucket"), postings.join(rare, ["bucket", "term_id"], "left_semi"), slop)
    narrowed = stored(narrowed, "narrowed")
    rare.unpersist()

    rest = ranked.filter("rank > 2").select("phrase", "offset", "term_id", (F.col("length") - 2).alias("needed"))
    documents, _ = broadcast_checked(narrowed.select(*_KEY).distinct())
    own = postings.alias("p").join(
        documents.alias("d"),
        (F.col("p.digest") == F.col("d.digest")) & F.col("p.doc_id").eqNullSafe(F.col("d.doc_id")),
        "left_semi",
    )
    more = _confirmed(narrowed, rest, own, slop)
    found = places.filter("length = 1").unionByName(narrowed.filter("length = 2")).unionByName(more)
    return found.select(*_PLACE, (F.col("off") == 0).alias("exact"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: key, n_words, n_hit, n_items, items_sha256, contaminated.

    ``n_hit`` are the words inside any place of any phrase of ``items``,
    ``n_items`` the items with a phrase in the text. Null and empty texts have
    no words and no hits. Rows that repeat, or have the same or no key, each
    get what their text holds. With an empty table of items nothing is hit.
    Other columns are not read.
    """
    sought = phrases(items, window)
    index = build_index(docs, sought.terms, key, text)
    places = stored(find(index, sought), "found")
    in_order = Window.partitionBy(*_KEY).orderBy("start", "end")
    before = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    hits = (
        places.select(*_KEY, "start", (F.col("start") + F.col("length")).alias("end"))
        .distinct()
        .withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0)))))
        .groupBy(*_KEY)
        .agg(F.sum("new").alias("n_hit"))
    )
    named = (
        places.select(*_KEY, "phrase")
        .distinct()
        .join(sought.items, "phrase")
        .groupBy(*_KEY)
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )


    def attached(rows: DataFrame, more: DataFrame) -> DataFrame:
        more = more.withColumnsRenamed({"doc_id": "_doc", "digest": "_digest"})
        same = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
        return rows.join(more, same, "left").drop("_doc", "_digest")

    each = docs.select(
        F.col(key).alias("doc_id"),
        F.xxhash64(F.col(text)).alias("digest"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"),
    )
    result = attached(attached(each, hits), named)
    listed = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return result.select(
        F.col("doc_id").alias(key),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def hits_sql(table: str = "documents", window: int = WINDOW) -> str:
    """SQL of the words hit: ``hit`` with ``row_id``, n_words, n_hit, n_items and items_sha256 of the rows of ``table``."""
    words = lambda c: f"regexp_extract_all(translate(coalesce({c}, ''), '{UPPER}', '{UPPER.lower()}'), '{FOLDED_WORD}')"
    return f"""
bw AS (SELECT item_id::VARCHAR AS item_id, {words("text")} AS w FROM benchmark),
ph AS (
  SELECT DISTINCT item_id, least(len(w), {window}) AS n, array_to_string(w[s:s + least(len(w), {window}) - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - {window - 1}) + 1)) AS s FROM bw WHERE len(w) > 0)),
dw AS (SELECT row_number() OVER () AS row_id, *, {words("text")} AS w FROM {table}),
pl AS (
  SELECT row_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS phrase
  FROM (SELECT row_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM dw, (SELECT DISTINCT n FROM ph))),
pf AS (SELECT row_id, s, pl.n, pl.phrase FROM pl WHERE EXISTS (SELECT 1 FROM ph WHERE ph.n = pl.n AND ph.phrase = pl.phrase)),
nh AS (SELECT row_id, count(DISTINCT p) AS n_hit FROM (SELECT row_id, unnest(range(s, s + n)) AS p FROM pf) GROUP BY row_id),
ni AS (
  SELECT row_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT row_id, item_id FROM pf JOIN ph USING (n, phrase) WHERE item_id IS NOT NULL) GROUP BY row_id),
hit AS (
  SELECT dw.*, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
         sha256(coalesce(items, '')) AS items_sha256
  FROM dw LEFT JOIN nh USING (row_id) LEFT JOIN ni USING (row_id))"""
