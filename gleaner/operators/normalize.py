"""Source rows to documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.coerce import coerce
from gleaner.functions.skew import ordinals
from gleaner.operators.schema import Collection

# Children in one part of a nested list.
NEST_LIMIT = 10_000


def normalize(
    source: DataFrame,
    collection: Collection,
    id_column: str | Column = "id",
    indexable: Column | None = None,
) -> DataFrame:
    """Documents with a string ``id`` and the declared fields, coerced to their types.

    Rows without an id, and rows that are not ``indexable``, give no document.
    Fields with ``embed`` are left out: their vector is made later.
    """
    if indexable is not None:
        source = source.filter(indexable)
    key = F.col(id_column) if isinstance(id_column, str) else id_column
    wanted = [f for f in collection.fields if f.embed is None and f.name != "id"]
    raw = source.select(key.alias("id"), *[f.column().alias(f.name) for f in wanted])
    out = [F.col("id").cast("string").alias("id")]
    for f in wanted:
        kind = "string" if f.reference and not f.type.endswith("[]") else f.type
        value = coerce(F.col(f.name), raw.schema[f.name].dataType, kind)
        if f.truncate is not None:
            value = F.substring(value, 1, f.truncate)
        out.append(value.alias(f.name))
    return raw.filter(F.col("id").isNotNull()).select(*out)


def normalize_with(source: DataFrame, make: Callable[[DataFrame], DataFrame], id_column: str) -> DataFrame:
    """A user function builds the documents; the id stays forced to a string."""
    made = make(source)
    return made.withColumn("id", F.col(id_column).cast("string")).filter(F.col("id").isNotNull())


def nested(id_value: Column, **fields: Column) -> Column:
    """Nested document of a to-one relation; null where there is no related row."""
    body = F.struct(id_value.cast("string").alias("id"), *[c.alias(n) for n, c in fields.items()])
    return F.when(id_value.isNotNull(), body)


def nest_many(
    parents: DataFrame,
    children: DataFrame,
    parent_key: str,
    child_key: str,
    item: Column,
    name: str,
    spread_by: list[str],
    limit: int = NEST_LIMIT,
) -> DataFrame:
    """To-many relation as a sorted list of nested items.

    The n-th child in sorted order lies in ``part`` floor((n - 1) / ``limit``),
    a row of its own, so that no task builds one unbounded list and the parts
    in order are the sorted list. ``spread_by`` has no effect on the result.
    """
    given = children.select(F.col(child_key), item.alias("_item")).filter(F.col(child_key).isNotNull() & F.col("_item").isNotNull())
    numbered = ordinals(given, [child_key], [F.col("_item").asc()], "_n")
    parted = numbered.withColumn("part", F.floor((F.col("_n") - 1) / limit).cast("int"))
    lists = parted.groupBy(child_key, "part").agg(F.sort_array(F.collect_list("_item")).alias(name))
    kept = lists.withColumnRenamed(child_key, "_child_key")
    joined = parents.join(kept, parents[parent_key] == F.col("_child_key"), "left").drop("_child_key")
    empty = F.array().cast(joined.schema[name].dataType)
    return joined.withColumn(name, F.coalesce(name, empty)).withColumn("part", F.coalesce("part", F.lit(0)))


def project(docs: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Keep the included fields, then remove the excluded ones; ``id`` stays unless excluded."""
    if include:
        docs = docs.select(*[c for c in docs.columns if c in include or c == "id"])
    return docs.drop(*(exclude or []))
