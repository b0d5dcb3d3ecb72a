"""A stored index: postings and vocabulary written once, searched many times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators.postings import index, vocabulary
from gleaner.operators.schema import Collection
from gleaner.sources.store import Store


def build_index(store: Store, collection: Collection, docs: DataFrame, version: str) -> str | None:
    """Write postings and vocabulary of a version, then point the index names at them.

    The vocabulary is counted from the written postings, so texts are cut
    into tokens once. Readers of the old names are not disturbed.
    """
    written = store.path(f"{version}_postings")
    index(docs, collection).write.mode("overwrite").partitionBy("field").parquet(written)
    words = vocabulary(store.spark.read.parquet(written))
    words.write.mode("overwrite").partitionBy("field").parquet(store.path(f"{version}_words"))
    store.swap(f"{collection.name}.words", f"{version}_words")
    return store.swap(f"{collection.name}.postings", f"{version}_postings")


def read_index(store: Store, collection: Collection) -> tuple[DataFrame, DataFrame]:
    """(postings, words); partitioned by field, so only the fields of a search are read."""
    parts = (store.read(f"{collection.name}.{part}") for part in ("postings", "words"))
    postings, words = (p.withColumn("field", F.col("field").cast("string")) for p in parts)
    return postings, words
