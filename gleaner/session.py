"""Session helpers: the shared work folder and table loading."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def work_root(spark: SparkSession) -> str:
    """Folder shared by all executors for versions, change logs and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. A folder of our own is
    only used in local mode, where driver and tasks share one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    own = tempfile.mkdtemp(prefix="gleaner-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared work folder."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def local_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Rows given by the caller as a table whose size the planner knows.

    Through Arrow the rows become a local relation. From a plain list Spark
    makes an RDD of unknown size, which it would never broadcast by itself.
    """
    schema = T.StructType.fromDDL(ddl)
    data = pa.Table.from_pylist([dict(zip(schema.names, row)) for row in rows], schema=to_arrow_schema(schema))
    return spark.createDataFrame(data, schema=schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read from there: later plans start at the written table."""
    folder = work_path(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)
