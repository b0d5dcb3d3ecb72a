"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.session import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of an edge.

    Alternates two steps until nothing changes (large and small stars, Kiveris
    et al. 2014): each node links its larger, then its smaller neighbours to
    the smallest it knows. The number of edges never grows, and the rounds
    grow with the logarithm of the graph. A hub's minimum is summed before the
    shuffle; its join is split by adaptive execution. Each round is written to
    the shared folder, so a lost executor repeats one round at most. The loop
    ends because every change replaces a neighbour by a smaller one.
    """
    links = stored(_larger_first(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "links")
    state = _state(links)
    while True:
        links = stored(_small_star(_large_star(links)), "links")
        now = _state(links)
        if now == state:
            break
        state = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _larger_first(links: DataFrame) -> DataFrame:
    return links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _larger_first(larger)


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    linked = links.join(least, "u")
    return _larger_first(
        linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    )
