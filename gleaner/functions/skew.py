"""Building blocks that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.session import work_root

# Spark cuts rows before the shuffle only for windows limited to this many rows
# (spark.sql.optimizer.windowGroupLimitThreshold, default 1000).
GROUP_LIMIT = 1000
# Rows (some 100 bytes each) that may be sent to every task.
BROADCAST_ROWS = 200_000
# Bytes of rows of any length that may be sent to every task.
BROADCAST_BYTES = 64 << 20


def spread(scan: DataFrame) -> DataFrame:
    """A table read in fewer pieces than there are cores, dealt out to all of them.

    Meant for plain scans before costly work per row, such as cutting texts
    into tokens. A table of many files is left as it is read.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows per key, numbered from 1.

    Up to GROUP_LIMIT rows, Spark keeps at most ``n`` rows per key and task
    before shuffling. For larger ``n`` the same cut is made per key and input
    task first.
    """
    if n > GROUP_LIMIT:
        slices = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", F.spark_partition_id())
            .withColumn("_slice_rank", F.row_number().over(slices))
            .filter(F.col("_slice_rank") <= n)
            .drop("_salt", "_slice_rank")
        )
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= n)


def top_by(df: DataFrame, keys: list[str], order: list[Column], limit: str, rank: str = "rank") -> DataFrame:
    """Like ``top_n`` with the limit taken from a column; each input task cuts first."""
    slices = Window.partitionBy(*keys, "_salt").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_salt", F.spark_partition_id())
        .withColumn("_slice_rank", F.row_number().over(slices))
        .filter(F.col("_slice_rank") <= F.col(limit))
        .withColumn(rank, F.row_number().over(whole))
        .filter(F.col(rank) <= F.col(limit))
        .drop("_salt", "_slice_rank")
    )


def best_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_n(df, keys, order, 1, "_first").drop("_first")


def ordinals(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """Number *all* rows per key without sending a key to one task.

    The rows are spread by range, numbered inside their range, and moved on by
    the row count of the earlier ranges. The ranges are written to the shared
    checkpoint folder first, so a lost executor cannot redraw their limits.
    """
    work_root(df.sparkSession)
    by = [F.col(k).asc() for k in keys] + list(order)
    ranged = df.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()).checkpoint()
    counts = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    return (
        ranged.withColumn("_inside", F.row_number().over(inside))
        .join(starts, [*keys, "_range"])
        .withColumn(name, F.col("_inside") + F.col("_start"))
        .drop("_inside", "_start", "_range")
    )


def broadcast_checked(df: DataFrame, most: int = BROADCAST_ROWS, size: Column | None = None) -> tuple[DataFrame, int | None]:
    """The rows with a broadcast hint if their counted number allows it; and that number.

    ``size`` gives the bytes of a row where rows can be long; then their sum is
    checked too, and the number is None for rows that are not sent. The counted
    rows are kept, so they are not computed a second time.
    """
    df = df.persist()
    if size is None:
        rows = df.count()
        return (F.broadcast(df) if rows <= most else df), rows
    rows, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    fits = rows <= most and total <= BROADCAST_BYTES
    return (F.broadcast(df) if fits else df), (rows if fits else None)
