"""The flagship query: several searches over two collections in one result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.predicates import gt
from gleaner.operators.highlight import query_marks, snippet
from gleaner.operators.match import Match
from gleaner.operators.rank import asc, desc
from gleaner.plans.search import Page, run
from gleaner.workload.base import documents, products, requests

ON_PRODUCTS = [("p1", "red widget"), ("p2", "smal ring"), ("p3", "economy bol")]
ON_DOCUMENTS = [("t1", "the of"), ("t2", "der die"), ("t3", "la que")]


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Top 10 per search with score, snippet and the size of the hit's facet value."""
    parts = [
        (
            "products", products(spark, sf).withColumnsRenamed({"p_name": "title"}), requests(spark, ON_PRODUCTS),
            Match(("title", "p_type")), "p_brand", gt("p_size", 10),
            (desc("score"), asc("p_retailprice")), "p_retailprice", "title",
        ),
        (
            "documents", documents(spark, sf), requests(spark, ON_DOCUMENTS),
            Match(("text",), num_typos=0), "lang", None, (desc("score"), desc("n_chars")), "n_chars", "text",
        ),
    ]
    out = None
    for name, docs, queries, how, facet, where, order, sort_by, shown in parts:
        page = Page(order=order, sort_by=(sort_by,), facet_by=(facet,), max_facet_values=1000)
        found = run(docs, queries, how, page, where)
        marked = found.hits.join(query_marks(queries), "query_id")
        counts = found.facets.select("query_id", F.col("value").alias("facet"), F.col("n").alias("facet_count"))
        rows = marked.withColumn("facet", F.col(facet).cast("string")).join(counts, ["query_id", "facet"], "left").select(
            F.lit(name).alias("collection"), "query_id", "rank", "id", "score",
            snippet(F.col(shown), F.col("marks")).alias("snippet"), "facet", "facet_count",
        )
        out = rows if out is None else out.unionByName(rows)
    return out
