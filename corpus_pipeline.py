"""From documents to token shards: quality, near copies, benchmark passages, mixture, shards.

Each stage works on all documents that the one before has kept, and all but the
last return the columns of documents. A stage's verdicts are rows of their own
and are joined to the documents by doc_id and a hash of the text, so rows that
share a doc_id are told apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import decontaminate, jaccard, mixing, quality
from gleaner.llm.queries import token_records
from gleaner.session import table, work_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_key", F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("digest")))


def _chosen(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The rows whose ``_key`` is among the verdicts'; repeated rows stay or go together."""
    keyed = _keyed(docs)
    return keyed.join(verdicts.select("_key").distinct(), "_key", "left_semi").select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, judged against the languages of all given documents."""
    verdicts = quality.judge(_keyed(docs).select(F.col("_key").alias("doc_id"), "text", "lang"))
    return _chosen(docs, verdicts.filter("kept").select(F.col("doc_id").alias("_key")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that with the smallest doc_id, null last.

    Documents without shingles are no copies and stay. Rows are told apart by
    all their columns; rows that repeat a document in every column are its copies.
    """
    others = F.to_json(F.struct(*[c for c in docs.columns if c not in ("doc_id", "text")]))
    key = F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"),
        F.xxhash64("text").alias("digest"), F.xxhash64(others).alias("others"),
    )
    keyed = docs.withColumn("_key", key)
    linked = jaccard.link(keyed.select("_key", "text"), "_key")
    firsts = linked.filter(F.col("_key").eqNullSafe(F.col("component_id"))).select("_key").distinct()
    return keyed.join(firsts, "_key", "left_semi").dropDuplicates(["_key"]).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a phrase of the benchmark."""
    items = table(spark, sf_dir, "benchmark")
    hits = decontaminate.contamination(_keyed(docs).select(F.col("_key").alias("doc_id"), "text"), items)
    return _chosen(docs, hits.filter("NOT contaminated").select(F.col("doc_id").alias("_key")))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes their words, rounded to whole documents: 0, 1 or 2 times."""
    keyed = _keyed(docs)
    taken = mixing.taken_words(mixing.mix(keyed.select(F.col("_key").alias("doc_id"), "text", "source")))
    times = (
        taken.filter("size > 0")
        .groupBy(F.col("doc_id").alias("_key"))
        .agg(F.floor(F.avg(F.col("taken") / F.col("size")) + 0.5).cast("int").alias("_times"))
        .filter("_times > 0")
    )
    repeated = keyed.join(times, "_key").withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return repeated.select(*docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The records of the token shards, written in training order and read back."""
    return token_records(spark, docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("source_mixture", source_mixture),
    ("token_output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table documents; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        folder = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)


# Token identifiers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None
