"""Collections: declared fields, inference, validation and schema changes."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.coerce import SPARK_TYPES
from pyspark.sql import types as T

from gleaner.session import local_table

# Type names and the rules that refer to them.
FIELD_TYPES = (
    "string", "int32", "int64", "float", "bool",
    "string[]", "int32[]", "int64[]", "float[]", "bool[]",
    "geopoint", "geopoint[]", "object", "object[]", "image", "auto",
)
TEXT_TYPES = ("string", "string[]", "auto")
SORTABLE_TYPES = ("string", "int32", "int64", "float", "auto")
DEFAULT_SORT_TYPES = ("int32", "int64", "float")
DISTANCES = ("cosine", "ip", "l2sq")
METADATA_KEYS = ("default_sorting_field", "enable_nested_fields")

FIELD_TABLE = (
    "collection string, name string, type string, facet boolean, optional boolean, sort boolean, "
    "`index` boolean, reference string, cascade_delete boolean, num_dim int, options map<string,string>"
)


@dataclass(frozen=True)
class Field:
    """One declared field. ``source`` is the column, path or expression it is read from."""

    name: str
    type: str = "auto"
    source: str | Column | None = None
    facet: bool = False
    optional: bool = False
    sort: bool = False
    index: bool = True
    reference: str | None = None
    async_reference: bool | None = None
    cascade_delete: bool | None = None
    truncate: int | None = None
    token_separators: tuple[str, ...] = ()
    symbols_to_index: tuple[str, ...] = ()
    embed: tuple[str, ...] | None = None
    num_dim: int | None = None
    vec_dist: str | None = None
    ann_params: dict | None = None

    def column(self) -> Column:
        if self.source is None:
            return F.col(self.name)
        return F.col(self.source) if isinstance(self.source, str) else self.source

    def options(self) -> dict[str, str]:
        """Flags that are set, and only those; an explicit false is kept."""
        given = {
            "index": None if self.index else "false",
            "reference": self.reference,
            "async_reference": _text(self.async_reference),
            "cascade_delete": _text(self.cascade_delete),
            "truncate": _text(self.truncate),
            "token_separators": " ".join(self.token_separators) or None,
            "symbols_to_index": " ".join(self.symbols_to_index) or None,
            "embed": ",".join(self.embed) if self.embed else None,
            "num_dim": _text(self.num_dim),
            "vec_dist": self.vec_dist,
            "ann_params": _text(self.ann_params),
        }
        return {k: v for k, v in given.items() if v is not None}


@dataclass(frozen=True)
class Collection:
    name: str
    fields: tuple[Field, ...]
    default_sorting_field: str | None = None
    enable_nested_fields: bool = False
    metadata: dict[str, str] = field(default_factory=dict)
    options: dict = field(default_factory=dict)

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)


def _text(value) -> str | None:
    if value is None:
        return None
    return str(value).lower() if isinstance(value, bool) else str(value)


def infer_type(spark_type: T.DataType) -> str:
    if isinstance(spark_type, T.BooleanType):
        return "bool"
    if isinstance(spark_type, (T.LongType, T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "int64"
    if isinstance(spark_type, T.IntegralType):
        return "int32"
    if isinstance(spark_type, T.FractionalType):
        return "float"
    if isinstance(spark_type, T.ArrayType):
        element = infer_type(spark_type.elementType)
        return element if element.endswith("[]") else element + "[]"
    if isinstance(spark_type, (T.StructType, T.MapType)):
        return "object"
    if isinstance(spark_type, T.BinaryType):
        return "image"
    return "string"


def resolve(collection: Collection, source: DataFrame | None = None) -> Collection:
    """Replace ``auto`` types; an embedded field is always a vector, ``id`` is never a field."""
    resolved = []
    for f in collection.fields:
        if f.name == "id":
            continue
        if f.type == "auto" and f.embed is not None:
            f = replace(f, type="float[]")
        elif f.type == "auto" and source is not None:
            f = replace(f, type=infer_type(source.select(f.column().alias("v")).schema["v"].dataType))
        elif f.type == "auto":
            f = replace(f, type="string")
        resolved.append(f)
    return replace(collection, fields=tuple(resolved))


def declared(name: str, source: DataFrame, id_column: str, **flags: dict) -> Collection:
    """A collection with one field per source column; ``flags`` adds flags by field name."""
    fields = tuple(
        Field(c, infer_type(source.schema[c].dataType), **flags.get(c, {}))
        for c in source.columns
        if c != id_column
    )
    return Collection(name, fields)


def problems(collection: Collection) -> list[tuple[str, str]]:
    """Broken declaration rules as (field, rule)."""
    found = []
    for f in resolve(collection).fields:
        vector = f.num_dim is not None or f.embed is not None
        rules = {
            "unknown type": f.type not in FIELD_TYPES,
            "cascade_delete needs a reference": f.cascade_delete is not None and f.reference is None,
            "async_reference needs a reference": f.async_reference is not None and f.reference is None,
            "reference must be collection.field": f.reference is not None and "." not in f.reference,
            "truncate is for text": f.truncate is not None and f.type not in TEXT_TYPES,
            "token_separators is for text": bool(f.token_separators) and f.type not in TEXT_TYPES,
            "symbols_to_index is for text": bool(f.symbols_to_index) and f.type not in TEXT_TYPES,
            "vec_dist needs num_dim or embed": f.vec_dist is not None and not vector,
            "vec_dist is unknown": f.vec_dist is not None and f.vec_dist not in DISTANCES,
            "sort needs a sortable type": f.sort and f.type not in SORTABLE_TYPES,
            "ann_params needs num_dim or embed": f.ann_params is not None and not vector,
        }
        found += [(f.name, rule) for rule, broken in rules.items() if broken]
    by = collection.default_sorting_field
    if by is not None:
        match = [f for f in resolve(collection).fields if f.name == by]
        if not match:
            found.append((by, "default sorting field is missing"))
        elif match[0].optional:
            found.append((by, "default sorting field is optional"))
        elif match[0].type not in DEFAULT_SORT_TYPES:
            found.append((by, "default sorting field is not numeric"))
    return found


def check(collection: Collection) -> Collection:
    found = problems(collection)
    if found:
        raise ValueError("; ".join(f"field '{name}': {rule}" for name, rule in found))
    return collection


def field_table(spark: SparkSession, collections: list[Collection]) -> DataFrame:
    rows = [
        (c.name, f.name, f.type, f.facet, f.optional, f.sort, f.index, f.reference, f.cascade_delete,
         f.num_dim, f.options())
        for c in collections
        for f in c.fields
    ]
    return local_table(spark, rows, FIELD_TABLE)


def spark_schema(collection: Collection, source: DataFrame) -> T.StructType:
    """Document schema with the flags in each field's metadata."""
    out = [T.StructField("id", T.StringType(), False)]
    for f in collection.fields:
        out.append(
            T.StructField(f.name, source.schema[f.name].dataType, True, {"type": f.type} | f.options())
        )
    return T.StructType(out)


def data_violations(docs: DataFrame, collection: Collection) -> DataFrame:
    """Rows that break the declared fields, counted in one pass: (collection, field, rule, n)."""
    counts = [("id", "missing id", F.count_if(F.col("id").isNull()))]
    for f in collection.fields:
        column = F.col(f.name)
        if not f.optional and f.embed is None:
            counts.append((f.name, "null in required field", F.count_if(column.isNull())))
        if f.num_dim is not None:
            wrong = column.isNotNull() & (F.size(column) != f.num_dim)
            counts.append((f.name, "wrong vector size", F.count_if(wrong)))
    if collection.default_sorting_field:
        by = collection.default_sorting_field
        counts.append((by, "null in default sorting field", F.count_if(F.col(by).isNull())))
    one_row = docs.agg(*[n.alias(f"n{i}") for i, (_, _, n) in enumerate(counts)])
    entries = [
        F.struct(
            F.lit(collection.name).alias("collection"), F.lit(name).alias("field"),
            F.lit(rule).alias("rule"), F.col(f"n{i}").alias("n"),
        )
        for i, (name, rule, _) in enumerate(counts)
    ]
    return one_row.select(F.inline(F.array(*entries)))


def split_valid(docs: DataFrame, collection: Collection) -> tuple[DataFrame, DataFrame]:
    """Accepted documents, and rejected ones with a reason."""
    reasons = [F.when(F.col("id").isNull(), F.lit("missing id"))]
    for f in collection.fields:
        if not f.optional and f.embed is None and f.name in docs.columns:
            reasons.append(F.when(F.col(f.name).isNull(), F.lit(f"field '{f.name}' is required")))
        if f.num_dim is not None and f.name in docs.columns:
            wrong = F.size(F.col(f.name)) != f.num_dim
            reasons.append(F.when(wrong, F.lit(f"field '{f.name}' needs {f.num_dim} dimensions")))
    marked = docs.withColumn("error", F.coalesce(*reasons))
    return marked.filter("error is null").drop("error"), marked.filter("error is not null")


def diff(new: DataFrame, live: DataFrame | None) -> DataFrame:
    """Changes from a live field table to a new one: (name, change, live_type, new_type).

    Only the type decides about a conflict; ``id`` is never dropped; without a
    live collection every field is an addition.
    """
    n = new.select("name", F.col("type").alias("new_type"))
    if live is None:
        return n.select("name", F.lit("add").alias("change"), F.lit(None).cast("string").alias("live_type"), "new_type")
    old = live.filter(F.col("name") != "id").select("name", F.col("type").alias("live_type"))
    change = (
        F.when(F.col("live_type").isNull(), "add")
        .when(F.col("new_type").isNull(), "drop")
        .when(F.col("live_type") != F.col("new_type"), "conflict")
    )
    joined = n.join(old, "name", "full_outer").withColumn("change", change)
    return joined.filter(F.col("change").isNotNull()).select("name", "change", "live_type", "new_type")


def metadata_changed(new: dict, live: dict) -> bool:
    return any(
        type(new.get(k)) is not type(live.get(k)) or new.get(k) != live.get(k) for k in METADATA_KEYS
    )


def apply_diff(docs: DataFrame, changes: list[tuple[str, str, str | None]], metadata: bool = False) -> DataFrame:
    """Add and drop columns; refuses when the collection must be built anew.

    ``changes`` holds (name, change, spark type of an added field) — one entry
    per field of a schema, never per row.
    """
    if not changes and not metadata:
        return docs
    if metadata or any(change == "conflict" for _, change, _ in changes):
        raise ValueError("a type conflict or changed metadata needs a new collection")
    added = {name: F.lit(None).cast(kind or "string") for name, change, kind in changes if change == "add"}
    dropped = [name for name, change, _ in changes if change == "drop"]
    return docs.withColumns(added).drop(*dropped) if added else docs.drop(*dropped)


def apply_changes(docs: DataFrame, changes: DataFrame, metadata: bool = False) -> DataFrame:
    """Documents after the changes that ``diff`` has found: (name, change, live_type, new_type).

    The rows are fields of one schema, so they come to the driver, which adds
    and drops columns; added ones have the Spark type of their declared type.
    """
    kinds = {name: kind.simpleString() for name, kind in SPARK_TYPES.items()}

    def kind_of(declared: str | None) -> str | None:
        if declared and declared.endswith("[]"):
            return f"array<{kinds.get(declared[:-2], 'string')}>"
        return kinds.get(declared, "string") if declared else None

    rows = changes.select("name", "change", "new_type").orderBy("name").collect()
    return apply_diff(docs, [(r["name"], r["change"], kind_of(r["new_type"])) for r in rows], metadata)


def profile(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    """Document count per collection, in one job over all collections."""
    counted = [
        docs.agg(F.count(F.lit(1)).alias("documents")).select(
            F.lit(name).alias("collection"), "documents", F.lit(len(docs.columns) - 1).alias("fields")
        )
        for name, docs in parts
    ]
    return reduce(DataFrame.unionByName, counted)
