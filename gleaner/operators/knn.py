"""Nearest neighbours by blocks of matrices, exact or within cells; hybrid ranking; diversification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.skew import broadcast_checked, top_n
from gleaner.functions.vectors import METRICS, dot, norm
from gleaner.session import stored

# Query vectors and vectors of a cell that meet in one task, and vectors measured at a time.
QUERIES_PER_BLOCK = 2048
VECTORS_PER_PART = 16384
SCANNED = 2048
# Candidates of a query that a diversifying round looks at.
WORKING = 1024
# Distances are ranked at this precision, so that the order of summation does not matter.
DIGITS = 9


def distances(queries: np.ndarray, docs: np.ndarray, metric: str) -> np.ndarray:
    if metric == "l2sq":
        # Row by row: the expanded form loses digits for close vectors.
        return np.stack([((docs - q) ** 2).sum(axis=1) for q in queries])
    dots = queries @ docs.T
    if metric == "ip":
        return 1.0 - dots
    lengths = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(docs, axis=1)[None, :]
    return 1.0 - np.divide(dots, lengths, out=np.zeros_like(dots), where=lengths > 0)


def _pairs(measured: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, document) positions up to the k-th distance; ties are settled by id later."""
    if measured.shape[1] <= k:
        return np.nonzero(np.ones_like(measured, dtype=bool))
    kth = np.partition(measured, k - 1, axis=1)[:, k - 1 : k]
    return np.nonzero(measured <= kth)


def matrix(rows: pa.Table) -> np.ndarray:
    listed = rows.column("vector").combine_chunks()
    return listed.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(listed), -1)


def in_blocks(docs: DataFrame, queries: DataFrame, run, shape: str, carried: list[str] = ()) -> DataFrame:
    """What ``run`` makes of the documents and queries that share a cell, block by block.

    Both sides have id or query_id, vector, cell, and two numbers that are the
    same for all rows of a cell: ``parts`` and ``blocks``. The documents of a
    cell are dealt to its parts, its queries to its blocks, and every part meets
    every block as two tables in one task. So neither a large cell nor a large
    batch ends in one task, no vector passes the driver, and the way is the
    same for one query and for many.
    """
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    dealt = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    left = docs.select("id", "vector", "cell", dealt("id", "parts").alias("part"), every("blocks").alias("block"))
    right = queries.select("query_id", "vector", *carried, "cell", dealt("query_id", "blocks").alias("block"), every("parts").alias("part"))
    return left.groupBy("cell", "part", "block").cogroup(right.groupBy("cell", "part", "block")).applyInArrow(run, shape)


def sized(docs: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides as one cell: twice as many parts as the documents are read in, and blocks by the count of the queries."""
    parts = max(2 * docs.rdd.getNumPartitions(), docs.sparkSession.sparkContext.defaultParallelism)
    blocks = max(1, -(-queries.count() // QUERIES_PER_BLOCK))
    one = {"cell": F.lit(0), "parts": F.lit(parts), "blocks": F.lit(blocks)}
    return docs.withColumns(one), queries.withColumns(one)


def _nearest_in_blocks(docs: DataFrame, queries: DataFrame, k: int, metric: str, threshold: float | None = None) -> DataFrame:
    """The ``k`` best per query of documents and queries that share a cell: (query_id, id, distance, rank).

    Every part keeps k rows per query.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, got {metric!r}")

    def run(near: pa.Table, asking: pa.Table) -> pa.Table:
        best = pd.DataFrame({"q": np.zeros(0, np.int64), "id": np.zeros(0, object), "distance": np.zeros(0)})
        if near.num_rows and asking.num_rows:
            wanted = matrix(asking)
            for start in range(0, near.num_rows, SCANNED):
                rows = near.slice(start, SCANNED)
                measured = np.round(distances(wanted, matrix(rows), metric), DIGITS) + 0.0
                q, d = _pairs(measured, k)
                found = pd.DataFrame({"q": q, "id": rows.column("id").to_pandas().to_numpy()[d], "distance": measured[q, d]})
                if threshold is not None:
                    found = found[found["distance"] <= threshold]
                best = pd.concat([best, found]).sort_values(["q", "distance", "id"]).groupby("q").head(k)
        names = asking.column("query_id").to_pandas().to_numpy()
        columns = [pa.array(names[best["q"].to_numpy()], pa.string()), pa.array(best["id"], pa.string()), pa.array(best["distance"], pa.float64())]
        return pa.table(columns, names=["query_id", "id", "distance"])

    local = in_blocks(docs, queries, run, "query_id string, id string, distance double")
    return top_n(local, ["query_id"], [F.col("distance").asc(), F.col("id").asc()], k)


def knn(
    docs: DataFrame, queries: DataFrame, k: int, metric: str = "cosine", threshold: float | None = None
) -> DataFrame:
    """The ``k`` nearest (id, vector) for every (query_id, vector): (query_id, id, distance, rank).

    The documents are read, or embedded, once and dealt to twice as many parts
    as they are read in. The queries are written and counted first; beyond
    QUERIES_PER_BLOCK of them every part meets several blocks.
    """
    asked = stored(queries.filter(F.col("vector").isNotNull()).select("query_id", "vector"), "queries")
    source = docs.filter(F.col("vector").isNotNull()).select(F.col("id").cast("string").alias("id"), "vector")
    return _nearest_in_blocks(*sized(source, asked), k, metric, threshold)


def knn_by_id(docs: DataFrame, wanted: DataFrame, k: int, metric: str = "cosine") -> DataFrame:
    """Neighbours of documents given as (query_id, id); the document itself is left out."""
    vectors = docs.join(wanted.select("query_id", "id"), "id").select("query_id", "vector")
    near = knn(docs, vectors, k + 1, metric).drop("rank")
    others = near.join(wanted.select("query_id", "id"), ["query_id", "id"], "left_anti")
    return top_n(others, ["query_id"], [F.col("distance").asc(), F.col("id").asc()], k)


def unit(vector: Column) -> Column:
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.when(length > 0, F.transform(vector, lambda x: x.cast("double") / length)).otherwise(
        F.transform(vector, lambda x: x.cast("double"))
    )


def fit_cells(docs: DataFrame, cells: int, seed: int = 7, metric: str = "cosine"):
    """Coarse partition of the vectors; the model holds ``cells`` centres."""
    value = unit(F.col("vector")) if metric == "cosine" else F.col("vector").cast("array<double>")
    points = docs.select(array_to_vector(value).alias("features"))
    return KMeans(k=cells, seed=seed, maxIter=10, initSteps=2).fit(points)


def assign_cells(docs: DataFrame, model, metric: str = "cosine") -> DataFrame:
    """(id, vector, cell), to be written partitioned by cell."""
    value = unit(F.col("vector")) if metric == "cosine" else F.col("vector").cast("array<double>")
    placed = model.transform(docs.withColumn("features", array_to_vector(value)))
    return placed.withColumnRenamed("prediction", "cell").drop("features")


def probe_cells(queries: DataFrame, model, probes: int, metric: str = "cosine") -> DataFrame:
    """(query_id, query_vector, cell) for the cells whose centres are nearest to each query."""
    return probe_centres(queries, np.asarray(model.clusterCenters()), probes, metric)


def probe_centres(queries: DataFrame, centres: np.ndarray, probes: int, metric: str = "cosine") -> DataFrame:
    probes = min(probes, len(centres))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            points = np.stack(batch["point"].to_numpy())
            far = (centres**2).sum(axis=1)[None, :] - 2.0 * points @ centres.T
            cells = np.argsort(far, axis=1, kind="stable")[:, :probes]
            yield pd.DataFrame(
                {
                    "query_id": np.repeat(batch["query_id"].to_numpy(), probes),
                    "query_vector": [v for v in batch["vector"] for _ in range(probes)],
                    "cell": cells.ravel().astype(np.int32),
                }
            )

    value = unit(F.col("vector")) if metric == "cosine" else F.col("vector").cast("array<double>")
    points = queries.select("query_id", F.col("vector").cast("array<double>").alias("vector"), value.alias("point"))
    return points.mapInPandas(run, "query_id string, query_vector array<double>, cell int")


def knn_cells(
    placed: DataFrame, queries: DataFrame, model, k: int, probes: int, metric: str = "cosine"
) -> DataFrame:
    """Approximate neighbours: only the ``probes`` cells nearest to a query are compared.

    The documents (id, vector, cell) and the queries of each cell are counted,
    a row per cell, so a cell with a large share of all vectors has more parts.
    """
    probed = stored(probe_cells(queries, model, probes, metric), "probed")
    asked = probed.select("query_id", F.col("query_vector").alias("vector"), "cell")
    held = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / VECTORS_PER_PART).alias("parts"))
    asking = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES_PER_BLOCK).alias("blocks"))
    sizes = F.broadcast(stored(held.join(asking, "cell"), "cells"))  # a row per centre of the model
    return _nearest_in_blocks(placed.join(sizes, "cell"), asked.join(sizes, "cell"), k, metric)


def fuse(text: DataFrame, near: DataFrame, text_weight: float = 0.5, vector_weight: float = 0.5, constant: int = 60) -> DataFrame:
    """Weighted reciprocal-rank fusion of two ranked lists (query_id, id, rank)."""
    a = text.select("query_id", "id", F.col("rank").alias("text_rank"))
    b = near.select("query_id", "id", F.col("rank").alias("vector_rank"))
    part = lambda weight, rank: F.coalesce(F.lit(float(weight)) / (F.lit(constant) + F.col(rank)), F.lit(0.0))
    return a.join(b, ["query_id", "id"], "full_outer").withColumn(
        "fused", part(text_weight, "text_rank") + part(vector_weight, "vector_rank")
    )


def _cosine(a: Column, b: Column) -> Column:
    length = norm(a) * norm(b)
    return F.when(length == 0, F.lit(0.0)).otherwise(dot(a, b) / F.nullif(length, F.lit(0.0)))


def _choose(rows: pd.DataFrame, k: int, balance: float, working: int) -> pd.DataFrame:
    """Picks among the best rows of a query, as long as none that was left out can come before."""
    rows = rows.sort_values("place").reset_index(drop=True)
    done, beyond = int(rows["done"].iloc[0]), None
    if len(rows) > working:
        beyond = rows.iloc[working]
        rows = rows.iloc[:working]
    points = np.stack(rows["vector"].to_numpy()).astype(np.float64)
    lengths = np.linalg.norm(points, axis=1, keepdims=True)
    points = np.divide(points, lengths, out=np.zeros_like(points), where=lengths > 0)
    relevance = 1.0 - rows["distance"].to_numpy()
    closest, any_pick = rows["closest"].fillna(0.0).to_numpy().copy(), done > 0
    by_name = np.lexsort([rows["id"].to_numpy().astype(str), rows["distance"].to_numpy()])
    left = np.ones(len(rows), dtype=bool)
    order: list[int] = []
    while done + len(order) < k and left.any():
        gain = np.round(np.where(left, balance * relevance - (1.0 - balance) * closest, -np.inf), DIGITS)
        pick = int(by_name[np.argmax(gain[by_name])])
        if beyond is not None and order:
            # Before the first pick nothing is known of what stands beyond; later its gain can only fall.
            mine = (-gain[pick], rows["distance"].iloc[pick], rows["id"].iloc[pick])
            if not any_pick or mine > (-beyond["gain"], beyond["distance"], beyond["id"]):
                break
        order.append(pick)
        left[pick] = False
        similar = points @ points[pick]
        closest = similar if done == 0 and len(order) == 1 else np.maximum(closest, similar)
    out = rows.loc[order, ["query_id", "id", "distance", "vector"]].copy()
    out["rank"] = range(done + 1, done + len(out) + 1)
    return out


def diversify(
    candidates: DataFrame, k: int, balance: float = 0.5, depth: int | None = None, working: int = WORKING
) -> DataFrame:
    """Greedy choice of relevant but different hits (maximal marginal relevance).

    ``candidates`` is a ranked list (query_id, id, distance, vector, rank); all
    of it is chosen from, or its first ``depth`` places. A round takes the
    ``working`` candidates with the largest gains of each query to one task,
    which picks as long as its best comes before the best of those left behind:
    gains only fall with every pick, so that is the greedy choice among all.
    Then the others learn how close they are to the new picks, where they lie.
    """
    near = candidates if depth is None else candidates.filter(F.col("rank") <= depth)
    state = stored(
        near.select("query_id", "id", "distance", "vector", F.lit(None).cast("double").alias("closest"), F.lit(0).alias("done")), "candidates"
    )
    gain = F.lit(balance) * (1 - F.col("distance")) - F.lit(1.0 - balance) * F.coalesce("closest", F.lit(0.0))
    vector = state.schema["vector"].dataType.simpleString()
    shape = f"query_id string, id string, distance double, vector {vector}, rank int"
    picked = None
    while True:
        order = [F.desc("gain"), F.col("distance").asc(), F.col("id").asc()]
        best = top_n(state.withColumn("gain", F.round(gain, DIGITS)), ["query_id"], order, working + 1, "place")
        new = stored(best.groupBy("query_id").applyInPandas(lambda rows: _choose(rows, k, balance, working), shape), "picks")
        picked = new if picked is None else picked.unionByName(new)
        made = new.groupBy("query_id").agg(F.max("rank").alias("made"), F.collect_list("vector").alias("picks")).filter(F.col("made") < k)
        made, _ = broadcast_checked(made, size=F.lit(8 * k) * F.size(F.col("picks")[0]))
        rest = state.join(new.select("query_id", "id"), ["query_id", "id"], "left_anti").join(made, "query_id")
        nearest = F.array_max(F.transform("picks", lambda p: _cosine(p, F.col("vector"))))
        state = stored(
            rest.select("query_id", "id", "distance", "vector", F.greatest("closest", nearest).alias("closest"), F.col("made").alias("done")), "candidates"
        )
        if state.isEmpty():
            return picked.drop("vector")
