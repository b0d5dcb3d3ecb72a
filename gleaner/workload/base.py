"""Registry of the checked queries and the collections they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.skew import spread
from gleaner.session import local_table, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a query and, where SQL can express it, the SQL with the same result."""

    def register(run):
        if key in QUERIES:
            raise KeyError(f"query {key} is registered twice")
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register


def requests(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    return local_table(spark, rows, "query_id string, q string")


def keyed(spark: SparkSession, sf: str, name: str, key: str) -> DataFrame:
    """A table as a collection: its key as a string ``id``, other columns as they are."""
    return table(spark, sf, name).withColumn("id", F.col(key).cast("string"))


def products(spark, sf):
    return keyed(spark, sf, "part", "p_partkey")


def documents(spark, sf):
    return spread(keyed(spark, sf, "documents", "doc_id"))


def benchmark(spark, sf):
    return keyed(spark, sf, "benchmark", "item_id")


def stores(spark, sf):
    """Customers with coordinates derived from their key; there is no geo column."""
    key = F.col("c_custkey")
    return keyed(spark, sf, "customer", "c_custkey").select(
        "id",
        "c_name",
        "c_acctbal",
        "c_mktsegment",
        ((key * 37 % 18000) / 100 - 90).alias("lat"),
        ((key * 91 % 36000) / 100 - 180).alias("lon"),
    )


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("vector"), "label"
    )


# SQL of the same collections.
STORES = (
    "(SELECT CAST(c_custkey AS VARCHAR) AS id, c_name, c_acctbal, c_mktsegment, "
    "(c_custkey * 37 % 18000) / 100.0 - 90 AS lat, (c_custkey * 91 % 36000) / 100.0 - 180 AS lon FROM customer)"
)
PRODUCTS = "(SELECT CAST(p_partkey AS VARCHAR) AS id, * FROM part)"
DOCUMENTS = "(SELECT CAST(doc_id AS VARCHAR) AS id, * FROM documents)"
BENCHMARK = "(SELECT CAST(item_id AS VARCHAR) AS id, * FROM benchmark)"

PRODUCT_QUERIES = [("q1", "red widget"), ("q2", "Small RING"), ("q3", "economy bolt"), ("q4", "plate"), ("q5", "no such thing")]
DOCUMENT_QUERIES = [("d1", "the of"), ("d2", "der und"), ("d3", "that is it"), ("d4", "la de"), ("d5", "absent zzzz")]


def rounded(column, digits: int = 6):
    scale = 10.0**digits
    return F.floor(column * scale + 0.5) / scale


def sql_rounded(expression: str, digits: int = 6) -> str:
    return f"floor(({expression}) * 1e{digits} + 0.5) / 1e{digits}"
