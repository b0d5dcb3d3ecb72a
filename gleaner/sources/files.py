"""Files: JSON lines out, dictionaries in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators.normalize import project

DICTIONARY = "dictionary string, word string, root string"


def json_lines(docs: DataFrame, where: Column | None = None, include: list[str] | None = None) -> DataFrame:
    """(line): one JSON document per row, filtered and projected."""
    kept = docs if where is None else docs.filter(where)
    kept = project(kept, include)
    return kept.select(F.to_json(F.struct(*kept.columns)).alias("line"))


def export_json_lines(docs: DataFrame, path: str, where: Column | None = None, include: list[str] | None = None) -> None:
    """Write the collection as JSON lines, one file per task."""
    json_lines(docs, where, include).write.mode("overwrite").text(path)


def read_dictionary(spark: SparkSession, name: str, path: str) -> DataFrame:
    """(dictionary, word, root) from a .json list, .jsonl lines, a .csv of word,root, or one word per line.

    A word without a root is its own root. An unreadable path raises.
    """
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind in ("json", "jsonl"):
        reader = spark.read.schema("word string, root string").option("mode", "FAILFAST")
        entries = reader.option("multiLine", kind == "json").json(path)
        words = entries.select(F.trim("word").alias("word"), F.trim("root").alias("root"))
    elif kind == "csv":
        columns = spark.read.schema("word string, root string").option("mode", "PERMISSIVE").csv(path)
        words = columns.filter(F.col("root").isNotNull()).select(
            F.trim("word").alias("word"), F.trim("root").alias("root")
        )
    else:
        lines = spark.read.text(path).select(F.trim("value").alias("word")).filter("word <> ''")
        words = lines.withColumn("root", F.col("word"))
    return words.filter("word is not null").select(
        F.lit(name).alias("dictionary"), "word", F.coalesce("root", "word").alias("root")
    )
