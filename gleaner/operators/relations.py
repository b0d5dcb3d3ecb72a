"""References between collections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_reference(children: DataFrame, parents: DataFrame, on: str, parent_key: str, required: bool = False) -> DataFrame:
    """Follow a reference; children without a parent stay unless ``required``."""
    how = "inner" if required else "left"
    return children.join(parents, children[on] == parents[parent_key], how)


def unresolved(children: DataFrame, parents: DataFrame, on: str, parent_key: str) -> DataFrame:
    """Children whose reference is set but whose parent has not arrived."""
    pointing = children.filter(F.col(on).isNotNull())
    return pointing.join(parents, pointing[on] == parents[parent_key], "left_anti")


def check_references(children: DataFrame, parents: DataFrame, on: str, parent_key: str) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected children of a reference that must resolve at once."""
    resolved = children.join(parents, children[on] == parents[parent_key], "left_semi")
    accepted = children.filter(F.col(on).isNull()).unionByName(resolved)
    return accepted, unresolved(children, parents, on, parent_key)


def cascade(tombstones: dict[str, DataFrame], levels: list[tuple[str, str, DataFrame, str, str, bool | None]]) -> dict[str, DataFrame]:
    """Tombstones of children of deleted parents.

    ``levels`` lists (parent, child, child rows, reference column, child id,
    cascade flag) from the top down; the loop runs over levels of the schema.
    An explicit false keeps the children.
    """
    out = dict(tombstones)
    for parent, child, rows, on, child_id, flag in levels:
        if flag is False or parent not in out:
            continue
        dead = out[parent].select(F.col("id").alias("_dead"))
        gone = rows.join(dead, rows[on].cast("string") == F.col("_dead"), "left_semi")
        ids = gone.select(F.col(child_id).cast("string").alias("id")).distinct()
        out[child] = out[child].unionByName(ids).distinct() if child in out else ids
    return out
