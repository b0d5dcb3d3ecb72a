"""Stored cells: vectors written by cell once, searched through rounded residuals."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.skew import broadcast_checked, top_n
from gleaner.functions.vectors import distance
from gleaner.operators.knn import (
    DIGITS, QUERIES_PER_BLOCK, VECTORS_PER_PART, _nearest_in_blocks, assign_cells, fit_cells, probe_centres, unit,
)
from gleaner.session import stored
from gleaner.sources.store import Store

# Vectors, about, from which the centres are learnt; every vector is indexed.
LEARNT_FROM = 100_000


def build_cells(
    store: Store, name: str, docs: DataFrame, version: str, cells: int, metric: str = "cosine", learnt_from: int = LEARNT_FROM
) -> None:
    """Write the vectors (id, vector) partitioned by cell, and a table of the cells; then point the names at them.

    A row holds the vector and its residual, the difference to the centre of
    its cell, as numbers from -127 to 127 and a scale. A cell with many
    vectors is written in several files. The centres are learnt from a sample
    of about ``learnt_from`` vectors chosen by a hash of the id. Rows without
    a vector are left out.
    """
    points = stored(docs.filter(F.col("vector").isNotNull()).select(F.col("id").cast("string").alias("id"), "vector"), "points")
    total = points.count()
    sample = points.filter(F.pmod(F.xxhash64("id"), F.lit(max(total, 1))) < learnt_from)
    model = fit_cells(sample, cells, metric=metric)
    # One row per centre: as many as the caller asked for.
    centres = store.spark.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cell int, centre array<double>"
    )
    placed = stored(assign_cells(points, model, metric), "placed")
    held = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("vectors"))
    about = stored(
        centres.join(held, "cell", "left").na.fill(0, ["vectors"]).withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("vectors") / VECTORS_PER_PART))), "cells"
    )
    value = unit(F.col("vector")) if metric == "cosine" else F.col("vector")
    residual = F.zip_with(value, "centre", lambda x, c: x.cast("double") - c)
    largest = F.array_max(F.transform("residual", lambda x: F.abs(x)))
    code = F.transform("residual", lambda x: F.when(F.col("scale") > 0, F.round(x / F.col("scale"))).otherwise(0).cast("tinyint"))
    coded = (
        placed.join(F.broadcast(about.select("cell", "centre", "parts")), "cell")
        .withColumn("residual", residual)
        .withColumn("scale", largest / 127)
        .select("cell", "id", "scale", code.alias("code"), "vector", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"))
    )
    files = f"{version}_vectors"
    coded.repartition("cell", "part").drop("part").write.mode("overwrite").partitionBy("cell").parquet(store.path(files))
    store.publish(f"{name}.cells", f"{version}_cells", about)
    store.swap(f"{name}.vectors", files)


def search_cells(
    store: Store, name: str, queries: DataFrame, k: int, probes: int, metric: str = "cosine", refine: int = 4
) -> DataFrame:
    """Approximate neighbours from stored cells: (query_id, id, distance, rank), with exact distances.

    Only the folders of probed cells are read. The first scan reads the
    residuals and keeps ``refine * k`` candidates per query; the second reads
    the vectors of the candidates alone for their exact distances. ``metric``
    is that of the stored cells.
    """
    cells = store.read(f"{name}.cells")
    vectors = store.read(f"{name}.vectors")
    centres = np.array([r["centre"] for r in cells.orderBy("cell").select("centre").collect()])  # a row per cell
    asking = queries.filter(F.col("vector").isNotNull()).select("query_id", "vector")
    probed = stored(probe_centres(asking, centres, probes, metric), "probed")
    asked = probed.select("query_id", F.col("query_vector").alias("vector"), "cell")
    blocks = probed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES_PER_BLOCK).alias("blocks"))
    # At most a row per cell. The condition always holds; with one Spark prunes the folders by the probed cells.
    sizes = F.broadcast(stored(cells.join(blocks, "cell").select("cell", "centre", "parts", "blocks"), "sizes").filter("blocks > 0"))
    rebuilt = F.zip_with("code", "centre", lambda x, c: x * F.col("scale") + c)
    coded = vectors.select("cell", "id", "scale", "code").join(sizes, "cell").select("cell", "id", rebuilt.alias("vector"), "parts", "blocks")
    near = _nearest_in_blocks(coded, asked.join(sizes.drop("centre"), "cell"), refine * k, metric)
    candidates, _ = broadcast_checked(
        near.select("query_id", "id").join(asking.withColumnRenamed("vector", "wanted"), "query_id"), size=8 * F.size("wanted") + 64
    )
    known = vectors.join(sizes.select("cell"), "cell").select("id", "vector").join(candidates, "id")
    measured = known.select("query_id", "id", (F.round(distance(F.col("wanted"), F.col("vector"), metric), DIGITS) + 0.0).alias("distance"))
    return top_n(measured, ["query_id"], [F.col("distance").asc(), F.col("id").asc()], k)
