"""Stored collections: written versions, aliases, and an append-only change log.

Everything is plain Parquet below one folder that all executors share.
A version is written completely before any name points to it, and a name is
moved by one appended row, so readers never see half a version. Changes of a
version are written beside it and merged when it is read; one appended row
lists the change folders that count.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.skew import best_per_key, broadcast_checked
from gleaner.session import local_table

POINTER = "alias string, target string, seq long, at timestamp"
CHANGES = "version string, seq long, folders array<string>"


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- names -------------------------------------------------------------

    def _pointers(self) -> DataFrame:
        try:
            return self.spark.read.schema(POINTER).parquet(f"{self.root}/aliases")
        except AnalysisException:
            return local_table(self.spark, [], POINTER)

    def _point(self, alias: str, target: str | None) -> None:
        seq = (self._pointers().agg(F.max("seq")).first()[0] or 0) + 1
        row = local_table(self.spark, [(alias, target, seq)], "alias string, target string, seq long")
        row.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{self.root}/aliases")

    def aliases(self) -> DataFrame:
        """Current (alias, target); deleted names are gone."""
        current = best_per_key(self._pointers(), ["alias"], [F.col("seq").desc(), F.col("at").desc()])
        return current.filter("target is not null").select("alias", "target")

    def target(self, alias: str) -> str | None:
        row = self.aliases().filter(F.col("alias") == alias).first()
        return None if row is None else row["target"]

    def swap(self, alias: str, target: str) -> str | None:
        """Point a name at a version; returns the previous one, None for a new name."""
        previous = self.target(alias)
        self._point(alias, target)
        return previous

    def drop_alias(self, alias: str) -> None:
        self._point(alias, None)

    # --- versions ----------------------------------------------------------

    def path(self, version: str) -> str:
        return f"{self.root}/versions/{version}"

    def exists(self, alias: str) -> bool:
        return self.target(alias) is not None

    def publish(self, alias: str, version: str, docs: DataFrame) -> str | None:
        docs.write.mode("overwrite").parquet(self.path(version))
        return self.swap(alias, version)

    def create(self, alias: str, schema: T.StructType, version: str | None = None) -> bool:
        """New empty collection; False, and nothing done, when it exists."""
        if self.exists(alias):
            return False
        self.publish(alias, version or f"{alias}_v1", self.spark.createDataFrame([], schema))
        return True

    def drop(self, alias: str) -> bool:
        """Remove the name; a missing collection is fine."""
        known = self.exists(alias)
        if known:
            self.drop_alias(alias)
        return known

    def recreate(self, alias: str, schema: T.StructType, version: str) -> None:
        self.drop(alias)
        self.create(alias, schema, version)

    def read(self, alias: str) -> DataFrame:
        target = self.target(alias)
        if target is None:
            raise LookupError(f"collection '{alias}' does not exist")
        base = self.spark.read.parquet(self.path(target))
        _, folders = self._changes(target)
        return merge_changes(base, self._changed(folders)) if folders else base

    # --- changes beside a version -------------------------------------------

    def _changes(self, version: str) -> tuple[int, list[str]]:
        """Number of the newest list of change folders of a version, and the list."""
        try:
            lists = self.spark.read.schema(CHANGES).parquet(f"{self.root}/changes")
        except AnalysisException:
            return 0, []
        row = lists.filter(F.col("version") == version).orderBy(F.desc("seq")).first()
        return (0, []) if row is None else (row["seq"], list(row["folders"]))

    def _list(self, version: str, seq: int, folders: list[str]) -> None:
        row = local_table(self.spark, [(version, seq, folders)], CHANGES)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/changes")

    def _changed(self, folders: list[str]) -> DataFrame:
        batches = [self.spark.read.parquet(folder) for folder in folders]
        whole = batches[0]
        for batch in batches[1:]:
            whole = whole.unionByName(batch, allowMissingColumns=True)
        return whole

    def append(self, alias: str, changes: DataFrame) -> int:
        """Add change rows (id, op, seq, columns of an upsert); returns the number of folders a read merges.

        What is written is the newest change per id of the batch. The version
        itself is neither read nor written. One writer at a time per collection.
        """
        version = self.target(alias)
        if version is None:
            raise LookupError(f"collection '{alias}' does not exist")
        seq, folders = self._changes(version)
        folder = f"{self.path(version)}_changes/{uuid.uuid4().hex}"
        newest_per_id(changes).write.parquet(folder)
        self._list(version, seq + 1, [*folders, folder])
        return len(folders) + 1

    def fold(self, alias: str) -> int:
        """Rewrite the change folders as one; the cost is that of the changes, the version is left alone.

        Deletions stay, as the version may hold their documents. Returns the
        number of folders that were folded.
        """
        version = self.target(alias)
        seq, folders = self._changes(version)
        if len(folders) > 1:
            folder = f"{self.path(version)}_changes/{uuid.uuid4().hex}"
            newest_per_id(self._changed(folders)).write.parquet(folder)
            self._list(version, seq + 1, [folder])
        return len(folders)


# --- change log -------------------------------------------------------------


def upserts(docs: DataFrame, seq) -> DataFrame:
    """Change rows that add or replace whole documents."""
    return docs.withColumn("op", F.lit("upsert")).withColumn("seq", seq)


def tombstones(ids: DataFrame, seq) -> DataFrame:
    return ids.select("id", F.lit("delete").alias("op"), seq.alias("seq"))


def newest_per_id(log: DataFrame) -> DataFrame:
    """The latest change of each id; of changes with equal ``seq`` a deletion.

    Each task keeps one row per id before the shuffle, so an id with very many
    changes costs no more than others.
    """
    return best_per_key(log, ["id"], [F.col("seq").desc(), F.col("op").asc()])


def latest(log: DataFrame) -> DataFrame:
    """Live documents of a change log: the latest change per id, unless it deletes."""
    return newest_per_id(log).filter("op = 'upsert'").drop("op", "seq")


def merge_changes(live: DataFrame, changes: DataFrame) -> DataFrame:
    """Documents after changes by id: what is not touched by any, and the newest upserts.

    Only the changes are shuffled. Their ids are counted and sent to the live
    documents, which stay where they lie; beyond that count both are joined by
    shuffle. Live ids are distinct; columns that one side lacks become null.
    """
    ids, _ = broadcast_checked(changes.select("id").distinct())
    untouched = live.join(ids, "id", "left_anti")
    return untouched.unionByName(latest(changes), allowMissingColumns=True)


def merge_upserts(live: DataFrame, incoming: DataFrame) -> DataFrame:
    """Current documents after replacing by id; of equal ids the later ``seq`` wins."""
    return merge_changes(live, incoming)


def delete_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(ids.select("id").distinct(), "id", "left_anti")


def lookup(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The asked ids with an ``exists`` flag and the document where there is one."""
    found = docs.withColumn("_found", F.lit(True))
    joined = ids.select("id").distinct().join(found, "id", "left")
    return joined.withColumn("exists", F.coalesce("_found", F.lit(False))).drop("_found")


def compact(store: Store, alias: str, version: str, log: DataFrame) -> str | None:
    """Write the live documents as a new version and move the name to it."""
    return store.publish(alias, version, latest(log))
