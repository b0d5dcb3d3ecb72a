"""Full re-index: scan, normalise, check, write a version, report, publish."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.normalize import normalize
from gleaner.operators.schema import Collection, split_valid
from gleaner.sources.store import Store


def tally(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """(succeeded, failed, first_error); the first error is that of the smallest id."""
    good = accepted.select(F.col("id"), F.lit(None).cast("string").alias("error"))
    return good.unionByName(rejected.select("id", "error")).agg(
        F.count_if(F.col("error").isNull()).alias("succeeded"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.min_by("error", F.when(F.col("error").isNotNull(), F.coalesce("id", F.lit("")))).alias("first_error"),
    )


def reindex(
    store: Store, source: DataFrame, collection: Collection, version: str, id_column: str | Column = "id"
) -> DataFrame:
    """Build a new version of a collection and move its name to it; returns the tally.

    Nothing is published when no document comes out, so a failed source
    never empties a collection. Rejected rows are written beside the version.
    """
    docs = normalize(source, collection, id_column)
    accepted, rejected = split_valid(docs, collection)
    accepted.write.mode("overwrite").parquet(store.path(version))
    rejected.write.mode("overwrite").parquet(store.path(version) + "_rejects")
    spark = store.spark
    report = tally(
        spark.read.parquet(store.path(version)), spark.read.parquet(store.path(version) + "_rejects")
    )
    if not spark.read.parquet(store.path(version)).isEmpty():
        store.swap(collection.name, version)
    return report
