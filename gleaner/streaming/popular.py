"""Running query counts from a stream of searches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleaner.functions.skew import best_per_key


def count_queries(searches: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep counts per q; every batch writes the counts that changed."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    counts = searches.groupBy("q").agg(F.count(F.lit(1)).alias("count"))
    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest count per q."""
    written = spark.read.parquet(path)
    return best_per_key(written, ["q"], [F.col("epoch").desc()]).select("q", "count")
