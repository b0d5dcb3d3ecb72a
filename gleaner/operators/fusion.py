"""Hybrid pages that are exact over whole lists, read only as deep as the page needs.

A fused score depends on ranks alone, so the depth at which the threshold
algorithm stops is known before reading: behind depth m of both lists a document
has at most (a + b) / (c + m + 1), while the last of a page of p has at least
max(a, b) / (c + p). Both lists are cut where the first falls below the second.
What stands in one cut list only may stand anywhere in the other; its rank there
is found by counting who is better, without listing them.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.skew import broadcast_checked, top_n
from gleaner.functions.vectors import distance
from gleaner.operators.knn import DIGITS, SCANNED, distances, fuse, in_blocks, knn, matrix, sized
from gleaner.session import stored

# Scores closer than this may be shown in either order.
SLACK = 2e-9


def safe_depth(per_page: int, text_weight: float, vector_weight: float, constant: int = 60) -> int:
    """Places of both lists behind which no document reaches a page of ``per_page``."""
    if min(text_weight, vector_weight) < 0 or max(text_weight, vector_weight) <= 0:
        raise ValueError("weights must not be negative, and one must be positive")
    last = max(text_weight, vector_weight) / (constant + max(per_page, 1)) - SLACK
    return max(per_page, math.ceil((text_weight + vector_weight) / last) - constant)


def text_key() -> list[Column]:
    """Better hits have smaller keys."""
    return [(-F.col("score")).alias("s"), (-F.col("weight")).alias("w"), F.col("id")]


def _text_ranks(hits: DataFrame, wanted: DataFrame) -> DataFrame:
    """(query_id, id, text_rank) of the wanted (query_id, id) that are hits, by counting better hits.

    Every hit is compared with the wanted ones of its query, which are at most
    a page's depth; counts are summed before the shuffle.
    """
    keyed = hits.select("query_id", F.struct(*text_key()).alias("k"))
    mine = wanted.join(hits, ["query_id", "id"]).select("query_id", F.struct(*text_key()).alias("k"))
    lists = mine.groupBy("query_id").agg(F.array_sort(F.collect_list("k")).alias("ks"))
    lists, _ = broadcast_checked(lists, size=40 * F.size("ks"))
    worse = keyed.join(lists, "query_id").select("query_id", F.size(_after("ks", "k")).alias("worse"))
    counts = worse.groupBy("query_id", "worse").agg(F.count(F.lit(1)).alias("n"))
    at_least = Window.partitionBy("query_id").orderBy(F.desc("worse"))
    below = counts.withColumn("better", F.sum("n").over(at_least))
    placed = lists.select("query_id", F.size("ks").alias("of"), F.posexplode("ks").alias("at", "k"))
    met = placed.join(below, "query_id", "left").filter("worse >= of - at")
    best = met.groupBy("query_id", F.col("k.id").alias("id")).agg(F.max("better").alias("better"))
    all_of = placed.select("query_id", F.col("k.id").alias("id"))
    return all_of.join(best, ["query_id", "id"], "left").select(
        "query_id", "id", (F.coalesce("better", F.lit(0)) + 1).alias("text_rank")
    )


def _after(keys: str, key: str) -> Column:
    return F.filter(F.col(keys), lambda k: k > F.col(key))


def _vector_ranks(docs: DataFrame, queries: DataFrame, wanted: DataFrame, metric: str) -> DataFrame:
    """(query_id, id, vector_rank) of the wanted (query_id, id) that have vectors, by counting nearer documents."""
    vectors = docs.filter(F.col("vector").isNotNull()).select(F.col("id").cast("string").alias("id"), "vector")
    asked = queries.select("query_id", F.col("vector").cast("array<double>").alias("vector"))
    few, _ = broadcast_checked(wanted)
    mine = vectors.join(few, "id").join(asked.withColumnRenamed("vector", "query_vector"), "query_id")
    far = mine.select("query_id", "id", F.round(distance(F.col("query_vector"), F.col("vector"), metric), DIGITS).alias("d"))
    lists = far.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("d", "id"))).alias("l"))
    given = asked.join(lists, "query_id").select("query_id", "vector", F.col("l.d").alias("limits"), F.col("l.id").alias("ids"))

    def run(near: pa.Table, asking: pa.Table) -> pa.Table:
        out: list[pd.DataFrame] = []
        if near.num_rows and asking.num_rows:
            points = matrix(asking)
            limits, ids = asking.column("limits").to_pylist(), asking.column("ids").to_pylist()
            sums = [np.zeros(len(i), dtype=np.int64) for i in ids]
            for start in range(0, near.num_rows, SCANNED):
                rows = near.slice(start, SCANNED)
                names = pd.Index(rows.column("id").to_pandas())
                measured = np.round(distances(points, matrix(rows), metric), DIGITS) + 0.0
                for q, (edges, held) in enumerate(zip(limits, ids)):
                    d, edges = measured[q], np.asarray(edges)
                    sums[q] += np.searchsorted(np.sort(d), edges, side="left")
                    itself = names.get_indexer(held)
                    found = itself >= 0
                    sums[q][found] -= d[itself[found]] < edges[found]
                    for at in np.flatnonzero(np.isin(edges, d)):
                        sums[q][at] += sum(1 for name in names[d == edges[at]] if name < held[at])
            out = [pd.DataFrame({"query_id": n, "id": i, "n": s}) for n, i, s in zip(asking.column("query_id").to_pylist(), ids, sums)]
        whole = pd.concat(out) if out else pd.DataFrame({"query_id": [], "id": [], "n": []})
        columns = [pa.array(whole["query_id"], pa.string()), pa.array(whole["id"], pa.string()), pa.array(whole["n"].astype(np.int64))]
        return pa.table(columns, names=["query_id", "id", "n"])

    left, right = sized(vectors, stored(given, "limits"))
    counted = in_blocks(left, right, run, "query_id string, id string, n long", ["limits", "ids"])
    return counted.groupBy("query_id", "id").agg((F.sum("n") + 1).alias("vector_rank"))


def fused_page(
    hits: DataFrame, docs: DataFrame, queries: DataFrame, per_page: int, text_weight: float = 0.5,
    vector_weight: float = 0.5, constant: int = 60, metric: str = "cosine", digits: int = 9,
) -> DataFrame:
    """The first ``per_page`` of all hits and all vectors fused: (query_id, id, fused, rank).

    ``hits`` are all text hits (query_id, id, score, weight), ``docs`` have id
    and vector, ``queries`` query_id and vector. Scores are rounded to
    ``digits`` places; equal ones go by id.
    """
    depth = safe_depth(per_page, text_weight, vector_weight, constant)
    hits = stored(hits.select("query_id", "id", "score", "weight"), "hits")
    asked = stored(queries.select("query_id", "vector"), "asked")
    order = [F.desc("score"), F.desc("weight"), F.col("id").asc()]
    text = stored(top_n(hits, ["query_id"], order, depth).select("query_id", "id", F.col("rank").cast("long").alias("text_rank")), "text")
    near = stored(knn(docs, asked, depth, metric).select("query_id", "id", F.col("rank").cast("long").alias("vector_rank")), "near")
    both = ["query_id", "id"]
    late_text = _text_ranks(hits, near.join(text, both, "left_anti").select(*both))
    late_near = _vector_ranks(docs, asked, text.join(near, both, "left_anti").select(*both), metric)
    ranked = fuse(
        text.unionByName(late_text).withColumnRenamed("text_rank", "rank"),
        near.unionByName(late_near).withColumnRenamed("vector_rank", "rank"),
        text_weight, vector_weight, constant,
    )
    shown = ranked.select(*both, (F.floor(F.col("fused") * 10.0**digits + 0.5) / 10.0**digits).alias("fused"))
    return top_n(shown, ["query_id"], [F.desc("fused"), F.col("id").asc()], per_page)
