"""Checked queries: collections, their storage, and source rows to documents."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from gleaner.operators import schema as s
from gleaner.operators.normalize import nest_many, nested, normalize, normalize_with, project
from gleaner.operators.postings import occurrences, postings
from gleaner.operators.schema import Collection, Field
from gleaner.plans.reindex import reindex
from gleaner.session import local_table, table, work_path
from gleaner.sources import files
from gleaner.sources.store import (
    Store, compact, delete_ids, latest, lookup, merge_upserts, tombstones, upserts,
)
from gleaner.workload import oracle
from gleaner.workload.base import DOCUMENTS, PRODUCTS, documents, products, query

# --- declared collections ------------------------------------------------------

KEYS = {"part": "p_partkey", "orders": "o_orderkey", "documents": "doc_id", "embeddings": "vec_id", "customer": "c_custkey"}
_TYPES = (
    "CASE WHEN column_type LIKE '%[]' THEN 'float[]' WHEN column_type IN ('BIGINT', 'TIMESTAMP') THEN 'int64' "
    "WHEN column_type = 'INTEGER' THEN 'int32' WHEN column_type IN ('DOUBLE', 'FLOAT') THEN 'float' ELSE 'string' END"
)


def declared(spark, sf):
    return [s.declared(name, table(spark, sf, name), key) for name, key in KEYS.items()]


@query(
    "collection_fields",
    " UNION ALL ".join(
        f"SELECT '{n}' AS collection, column_name AS name, {_TYPES} AS type, (SELECT count(*) FROM {n}) AS documents "
        f"FROM (DESCRIBE {n}) WHERE column_name <> '{k}'"
        for n, k in KEYS.items()
    ),
)
def collection_fields(spark, sf):
    """Field tables of the collections beside their document counts."""
    fields = s.field_table(spark, declared(spark, sf)).select("collection", "name", "type")
    counts = s.profile([(n, table(spark, sf, n)) for n in KEYS]).select("collection", "documents")
    return fields.join(counts, "collection")


LABELLED = Collection(
    "labelled",
    (
        Field("text", "string"), Field("lang", "string", facet=True), Field("quality", "int32", sort=True),
        Field("embedding", "float[]", num_dim=64, optional=True), Field("n_chars", "int64"),
    ),
    default_sorting_field="quality",
)


def labelled(spark, sf):
    """Documents with labels and vectors; many have neither, and every seventh vector is cut short."""
    docs = documents(spark, sf)
    vector = F.when(F.col("doc_id") % 7 == 3, F.slice("embedding", 1, 32)).otherwise(F.col("embedding"))
    return (
        docs.join(table(spark, sf, "labels"), "doc_id", "left")
        .join(table(spark, sf, "embeddings"), F.col("doc_id") == F.col("vec_id"), "left")
        .select("id", "text", "lang", "quality", vector.alias("embedding"), "n_chars")
    )


_LABELLED = (
    f"(SELECT d.id, d.text, d.lang, l.quality, CASE WHEN d.doc_id % 7 = 3 THEN e.embedding[1:32] ELSE e.embedding END AS embedding, d.n_chars FROM {DOCUMENTS} d LEFT JOIN labels l USING (doc_id) "
    "LEFT JOIN embeddings e ON d.doc_id = e.vec_id)"
)


@query(
    "schema_violations",
    "SELECT 'labelled' AS collection, field, rule, CAST(n AS BIGINT) AS n FROM (SELECT unnest(["
    "{'field': 'id', 'rule': 'missing id', 'n': count(*) FILTER (id IS NULL)},"
    "{'field': 'text', 'rule': 'null in required field', 'n': count(*) FILTER (text IS NULL)},"
    "{'field': 'lang', 'rule': 'null in required field', 'n': count(*) FILTER (lang IS NULL)},"
    "{'field': 'quality', 'rule': 'null in required field', 'n': count(*) FILTER (quality IS NULL)},"
    "{'field': 'n_chars', 'rule': 'null in required field', 'n': count(*) FILTER (n_chars IS NULL)},"
    "{'field': 'embedding', 'rule': 'wrong vector size', 'n': count(*) FILTER (len(embedding) <> 64)},"
    "{'field': 'quality', 'rule': 'null in default sorting field', 'n': count(*) FILTER (quality IS NULL)}], recursive := true) "
    f"FROM {_LABELLED})",
)
def schema_violations(spark, sf):
    return s.data_violations(labelled(spark, sf), LABELLED)


@query(
    "collection_create",
    """SELECT * FROM (VALUES ('create', true, 0), ('create again', false, 0), ('fill', true, (SELECT count(*) FROM part)),
    ('recreate', true, 0), ('drop', true, 0), ('drop missing', false, 0)) v(step, done, documents)""",
)
def collection_create(spark, sf):
    """Create, create again, fill, recreate and drop: what each step reports."""
    store = Store(spark, work_path(spark, "create"))
    docs = products(spark, sf).drop("p_partkey")
    schema = s.spark_schema(s.declared("products", docs, "id", p_brand={"facet": True}), docs)
    steps = [("create", store.create("products", schema), store.read("products").count())]
    steps.append(("create again", store.create("products", schema), store.read("products").count()))
    store.publish("products", "products_v2", docs)
    steps.append(("fill", True, store.read("products").count()))
    store.recreate("products", schema, "products_v3")
    steps.append(("recreate", True, store.read("products").count()))
    steps.append(("drop", store.drop("products"), 0))
    steps.append(("drop missing", store.drop("products"), 0))
    return local_table(spark, steps, "step string, done boolean, documents long")


@query(
    "collection_profile",
    " UNION ALL ".join(
        f"SELECT '{n}' AS collection, count(*) AS documents, (SELECT CAST(count(*) - 1 AS INTEGER) FROM (DESCRIBE {n})) AS fields FROM {n}"
        for n in KEYS
    ),
)
def collection_profile(spark, sf):
    return s.profile([(n, table(spark, sf, n)) for n in KEYS])


def _changed(spark, sf):
    """Orders as live, and a new declaration: a field less, one more, one of another type."""
    live = s.declared("orders", table(spark, sf, "orders"), "o_orderkey")
    kept = tuple(
        replace(f, type="string") if f.name == "o_totalprice" else f for f in live.fields if f.name != "o_orderpriority"
    )
    return live, Collection("orders", (*kept, Field("o_comment", "string", optional=True)))


@query(
    "schema_diff",
    f"""WITH live AS (SELECT column_name AS name, {_TYPES} AS type FROM (DESCRIBE orders) WHERE column_name <> 'o_orderkey'),
    new AS (SELECT name, CASE WHEN name = 'o_totalprice' THEN 'string' ELSE type END AS type FROM live WHERE name <> 'o_orderpriority'
            UNION ALL SELECT 'o_comment', 'string')
    SELECT name, CASE WHEN l.type IS NULL THEN 'add' WHEN n.type IS NULL THEN 'drop' ELSE 'conflict' END AS change,
           l.type AS live_type, n.type AS new_type, (SELECT count(*) FROM orders) AS documents
    FROM new n FULL OUTER JOIN live l USING (name) WHERE l.type IS DISTINCT FROM n.type""",
)
def schema_diff(spark, sf):
    """Differences of two declarations, with the number of documents concerned."""
    live, new = _changed(spark, sf)
    changes = s.diff(s.field_table(spark, [new]), s.field_table(spark, [live]))
    counts = s.profile([("orders", table(spark, sf, "orders"))]).select("collection", "documents")
    return changes.withColumn("collection", F.lit("orders")).join(counts, "collection").drop("collection")


@query("schema_apply", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CAST(NULL AS VARCHAR) AS o_comment FROM orders")
def schema_apply(spark, sf):
    """The differences of two declarations, applied as they were found."""
    live, new = _changed(spark, sf)
    kept = Collection("orders", tuple(f for f in live.fields if f.name == "o_totalprice") + tuple(f for f in new.fields if f.name != "o_totalprice"))
    changes = s.diff(s.field_table(spark, [kept]), s.field_table(spark, [live]))
    return s.apply_changes(table(spark, sf, "orders"), changes)


_MORE = {"string": "o_note", "int64": "o_rank", "float": "o_share", "bool": "o_done", "string[]": "o_tags"}


@query(
    "schema_apply_types",
    """SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS o_note, CAST(NULL AS BIGINT) AS o_rank, CAST(NULL AS DOUBLE) AS o_share,
    CAST(NULL AS BOOLEAN) AS o_done, CAST(NULL AS VARCHAR[]) AS o_tags FROM orders""",
)
def schema_apply_types(spark, sf):
    """A declaration with a field of every kind more and most fields less."""
    live = s.declared("orders", table(spark, sf, "orders"), "o_orderkey")
    kept = tuple(f for f in live.fields if f.name == "o_custkey")
    more = tuple(Field(name, kind, optional=True) for kind, name in _MORE.items())
    changes = s.diff(s.field_table(spark, [Collection("orders", kept + more)]), s.field_table(spark, [live]))
    return s.apply_changes(table(spark, sf, "orders"), changes)


# --- import, delete, look up ----------------------------------------------------

# Incoming products: every product again through its line items, at the latest price sold.
_PRICED = (
    "SELECT CAST(l_partkey AS VARCHAR) AS id, max(l_extendedprice) AS price, max(epoch(l_shipdate)) AS seq FROM lineitem GROUP BY 1"
)


def priced(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.groupBy(F.col("l_partkey").cast("string").alias("id")).agg(
        F.max("l_extendedprice").alias("price"), F.max(F.unix_timestamp(F.col("l_shipdate").cast("timestamp"))).alias("seq")
    )


@query(
    "import_upsert",
    f"""WITH incoming AS ({_PRICED}), live AS (SELECT id, p_name, p_retailprice AS price FROM {PRODUCTS})
    SELECT coalesce(i.id, l.id) AS id, CASE WHEN i.id IS NOT NULL THEN 'sold' ELSE l.p_name END AS p_name, coalesce(i.price, l.price) AS price
    FROM live l FULL OUTER JOIN incoming i USING (id)""",
)
def import_upsert(spark, sf):
    """Documents after an import that replaces by id."""
    live = products(spark, sf).select("id", "p_name", F.col("p_retailprice").alias("price"))
    incoming = priced(spark, sf).select("id", F.lit("sold").alias("p_name"), "price", F.lit("upsert").alias("op"), F.col("seq").cast("long").alias("seq"))
    return merge_upserts(live, incoming)


@query(
    "merge_on_read",
    f"""WITH incoming AS ({_PRICED}), live AS (SELECT id, p_name, p_retailprice AS price FROM {PRODUCTS})
    SELECT l.id, CASE WHEN i.id IS NOT NULL THEN 'sold' ELSE l.p_name END AS p_name, coalesce(i.price, l.price) AS price
    FROM live l LEFT JOIN incoming i USING (id) WHERE l.id NOT IN (SELECT id FROM incoming WHERE price < 60000)""",
)
def merge_on_read(spark, sf):
    """A collection read with three batches of changes beside its version: stale prices, prices, deletions; folded once."""
    store = Store(spark, work_path(spark, "merged"))
    store.publish("products", "products_v1", products(spark, sf).select("id", "p_name", F.col("p_retailprice").alias("price")))
    new = priced(spark, sf).select("id", F.lit("sold").alias("p_name"), "price", F.col("seq").cast("long").alias("seq"))
    store.append("products", upserts(new.withColumn("price", F.col("price") - 1), F.col("seq")))
    store.append("products", upserts(new, F.col("seq") + 1))
    store.fold("products")
    store.append("products", tombstones(new.filter("price < 60000"), F.col("seq") + 2))
    return store.read("products")


@query(
    "import_report",
    f"""SELECT id, CASE WHEN text IS NULL THEN 'field ''text'' is required' WHEN lang IS NULL THEN 'field ''lang'' is required'
    WHEN quality IS NULL THEN 'field ''quality'' is required' WHEN len(embedding) <> 64 THEN 'field ''embedding'' needs 64 dimensions' END AS error
    FROM {_LABELLED}""",
)
def import_report(spark, sf):
    """Outcome per imported document: null, or the reason it was rejected."""
    accepted, rejected = s.split_valid(labelled(spark, sf), LABELLED)
    return accepted.select("id", F.lit(None).cast("string").alias("error")).unionByName(rejected.select("id", "error"))


PLAIN = Collection("labelled", tuple(f for f in LABELLED.fields if f.name != "embedding"), "quality")


@query(
    "reindex_summary",
    f"""SELECT count(*) FILTER (quality IS NOT NULL) AS succeeded, count(*) FILTER (quality IS NULL) AS failed,
    CASE WHEN count(*) FILTER (quality IS NULL) > 0 THEN 'field ''quality'' is required' END AS first_error,
    CAST(count(*) FILTER (quality IS NOT NULL) AS BIGINT) AS live FROM {_LABELLED}""",
)
def reindex_summary(spark, sf):
    """Full re-index into a store; the tally beside the documents then live."""
    store = Store(spark, work_path(spark, "reindex"))
    report = reindex(store, labelled(spark, sf), PLAIN, "labelled_v1")
    return report.withColumn("live", F.lit(store.read("labelled").count()).cast("long"))


@query(
    "delete_by_id",
    f"SELECT id, lang, n_chars FROM {DOCUMENTS} WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)",
)
def delete_by_id(spark, sf):
    dead = table(spark, sf, "labels").filter("toxic = 1").select(F.col("doc_id").cast("string").alias("id"))
    return delete_ids(documents(spark, sf).select("id", "lang", "n_chars"), dead)


@query(
    "lookup_ids",
    f"""WITH asked AS (SELECT CAST(page_id AS VARCHAR) AS id FROM pages UNION SELECT CAST(user_id AS VARCHAR) || 'x' FROM events)
    SELECT id, d.id IS NOT NULL AS "exists", d.lang FROM asked LEFT JOIN {DOCUMENTS} d USING (id)""",
)
def lookup_ids(spark, sf):
    pages = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("id"))
    unknown = table(spark, sf, "events").select(F.concat(F.col("user_id").cast("string"), F.lit("x")).alias("id"))
    return lookup(documents(spark, sf).select("id", "lang"), pages.union(unknown))


@query("export_jsonl", f"SELECT id, lang, n_chars FROM {DOCUMENTS} WHERE n_chars > 200")
def export_jsonl(spark, sf):
    """Written as JSON lines and read back."""
    path = work_path(spark, "export")
    files.export_json_lines(documents(spark, sf), path, F.col("n_chars") > 200, ["id", "lang", "n_chars"])
    return spark.read.schema("id string, lang string, n_chars long").json(path)


@query(
    "alias_swap",
    """SELECT 'documents_v1' AS version, NULL AS previous, count(*) AS documents FROM documents UNION ALL
    SELECT 'documents_v2', 'documents_v1', count(*) FROM documents WHERE n_chars > 200""",
)
def alias_swap(spark, sf):
    """Two versions published under one name; what a swap returns and what readers see."""
    store = Store(spark, work_path(spark, "alias"))
    docs = documents(spark, sf)
    first = store.publish("documents", "documents_v1", docs)
    seen_first = store.read("documents").count()
    second = store.publish("documents", "documents_v2", docs.filter("n_chars > 200"))
    seen_second = store.read("documents").count()
    rows = [("documents_v1", first, seen_first), ("documents_v2", second, seen_second)]
    return local_table(spark, rows, "version string, previous string, documents long")


_VOCABULARY = f"(SELECT DISTINCT unnest({oracle.tokens('text')}) AS word FROM benchmark)"


@query(
    "dictionary_import",
    f"""SELECT 'csv' AS dictionary, word, left(word, 3) AS root FROM {_VOCABULARY} UNION ALL
    SELECT 'jsonl', word, left(word, 3) FROM {_VOCABULARY} UNION ALL SELECT 'txt', word, word FROM {_VOCABULARY}""",
)
def dictionary_import(spark, sf):
    """Words of the reference texts, written in the three formats and imported again."""
    texts = table(spark, sf, "benchmark").withColumn("id", F.col("item_id").cast("string"))
    words = occurrences(texts, ["text"]).select(F.col("token").alias("word")).distinct()
    rooted = words.withColumn("root", F.substring("word", 1, 3))
    base = work_path(spark, "dictionary")
    rooted.write.csv(f"{base}.csv")
    rooted.write.json(f"{base}.jsonl")
    words.write.text(f"{base}.txt")
    parts = [files.read_dictionary(spark, kind, f"{base}.{kind}") for kind in ("csv", "jsonl", "txt")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "latest_state",
    """SELECT id, value FROM (SELECT CAST(user_id AS VARCHAR) AS id, value, event_type,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'""",
)
def latest_state(spark, sf):
    """Live documents of a change log kept as events: errors delete, all others replace."""
    return latest(change_log(spark, sf))


def change_log(spark, sf):
    events = table(spark, sf, "events").withColumn("id", F.col("user_id").cast("string"))
    replaced = upserts(events.filter("event_type <> 'error'").select("id", "value", "event_id"), F.col("event_id"))
    deleted = tombstones(events.filter("event_type = 'error'"), F.col("event_id"))
    return replaced.drop("event_id").unionByName(deleted, allowMissingColumns=True)


@query(
    "compacted",
    """SELECT id, value FROM (SELECT CAST(user_id AS VARCHAR) AS id, value, event_type,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'""",
)
def compacted(spark, sf):
    """The change log compacted into a version and read through its name."""
    store = Store(spark, work_path(spark, "compact"))
    compact(store, "users", "users_v1", change_log(spark, sf))
    return store.read("users")


# --- normalisation ---------------------------------------------------------------

ORDERS = Collection(
    "orders",
    (
        Field("customer", "string", source="o_custkey", reference="customers.id"),
        Field("status", "string", source="o_orderstatus", facet=True),
        Field("price", "float", source="o_totalprice"),
        Field("ordered_at", "int64", source="o_orderdate", sort=True),
        Field("priority", "int32", source="o_orderpriority"),
        Field("summary", "float[]", embed=("status",)),
    ),
    default_sorting_field="ordered_at",
)


@query(
    "normalize_orders",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS customer, o_orderstatus AS status, o_totalprice AS price,
    CAST(floor(epoch(o_orderdate)) AS BIGINT) AS ordered_at, CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority FROM orders""",
)
def normalize_orders(spark, sf):
    return normalize(table(spark, sf, "orders"), ORDERS, "o_orderkey")


@query(
    "normalize_getter",
    "SELECT CAST(p_partkey AS VARCHAR) AS id, upper(p_name) || ' (' || p_brand || ')' AS label, p_size * 2 AS double_size FROM part",
)
def normalize_getter(spark, sf):
    labelled_parts = Collection(
        "products",
        (
            Field("label", "string", source=F.concat(F.upper("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")"))),
            Field("double_size", "int32", source=F.col("p_size") * 2),
        ),
    )
    return normalize(table(spark, sf, "part"), labelled_parts, "p_partkey")


@query("normalize_custom", "SELECT CAST(c_custkey AS VARCHAR) AS id, lower(c_name) AS name, c_acctbal < 0 AS in_debt FROM customer")
def normalize_custom(spark, sf):
    make = lambda df: df.select("c_custkey", F.lower("c_name").alias("name"), (F.col("c_acctbal") < 0).alias("in_debt"))
    return normalize_with(table(spark, sf, "customer"), make, "c_custkey").drop("c_custkey")


@query(
    "normalize_indexable",
    "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P'",
)
def normalize_indexable(spark, sf):
    only_status = Collection("orders", (Field("status", "string", source="o_orderstatus"),))
    return normalize(table(spark, sf, "orders"), only_status, "o_orderkey", F.col("o_orderstatus") != "P")


_SQL_TEXT = "CASE WHEN {0} = floor({0}) THEN CAST(CAST({0} AS BIGINT) AS VARCHAR) ELSE CAST({0} AS VARCHAR) END"


@query(
    "coerce_scalars",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS text_int, 0 AS word_int,
    CAST(trunc(o_totalprice) AS BIGINT) AS float_int, {_SQL_TEXT.format('o_totalprice')} AS float_text, true AS text_bool,
    o_custkey <> 0 AS int_bool, CAST(o_custkey AS DOUBLE) AS int_float, CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '' END AS bool_text,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS bool_int FROM orders""",
)
def coerce_scalars(spark, sf):
    fields = (
        Field("text_int", "int32", source="o_orderpriority"), Field("word_int", "int32", source="o_orderstatus"),
        Field("float_int", "int64", source="o_totalprice"), Field("float_text", "string", source="o_totalprice"),
        Field("text_bool", "bool", source="o_orderstatus"), Field("int_bool", "bool", source="o_custkey"),
        Field("int_float", "float", source="o_custkey"),
        Field("bool_text", "string", source=F.col("o_orderstatus") == "F"),
        Field("bool_int", "int32", source=F.col("o_orderstatus") == "F"),
    )
    return normalize(table(spark, sf, "orders"), Collection("orders", fields), "o_orderkey")


@query(
    "coerce_arrays",
    """SELECT CAST(vec_id AS VARCHAR) AS id, list_transform(embedding, lambda x: CAST(trunc(x * 1000) AS INTEGER)) AS ints,
    list_transform(embedding, lambda x: x <> 0) AS bools, list_transform(embedding, lambda x: CAST(x AS FLOAT)) AS floats FROM embeddings""",
)
def coerce_arrays(spark, sf):
    scaled = F.transform("embedding", lambda x: x * F.lit(1000).cast("float"))
    fields = (
        Field("ints", "int32[]", source=scaled),
        Field("bools", "bool[]", source="embedding"),
        Field("floats", "float[]", source=F.transform("embedding", lambda x: x.cast("string"))),
    )
    return normalize(table(spark, sf, "embeddings"), Collection("vectors", fields), "vec_id")


@query(
    "normalize_refs",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, any_value(CAST(o_custkey AS VARCHAR)) AS customer, 0 AS part,
    list(CAST(l_partkey AS VARCHAR) ORDER BY CAST(l_partkey AS VARCHAR)) FILTER (l_partkey IS NOT NULL) AS parts
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def normalize_refs(spark, sf):
    """A to-one reference as its id, a to-many as the sorted list of ids (null when there are none)."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey"), F.col("o_custkey").cast("string").alias("customer"))
    listed = nest_many(
        orders, table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey", F.col("l_partkey").cast("string"), "parts",
        ["l_partkey", "l_suppkey", "l_shipdate"],
    )
    return listed.select(
        F.col("o_orderkey").cast("string").alias("id"), "customer", "part", F.when(F.size("parts") > 0, F.col("parts")).alias("parts")
    )


@query(
    "nest_one",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(to_json({'id': CAST(n_nationkey AS VARCHAR), 'name': n_name,
    'region': {'id': CAST(r_regionkey AS VARCHAR), 'name': r_name}}) AS VARCHAR) AS nation
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def nest_one(spark, sf):
    joined = customers_with_nation(spark, sf)
    region = nested(F.col("r_regionkey"), name=F.col("r_name"))
    nation = nested(F.col("n_nationkey"), name=F.col("n_name"), region=region)
    return joined.select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.to_json(nation).alias("nation")
    )


def customers_with_nation(spark, sf):
    customer, nation, region = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
        region, F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )


@query(
    "nest_path",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(c_custkey AS VARCHAR) AS customer_id, n_name AS customer_nation, r_name AS customer_region
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal >= 0 LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def nest_path(spark, sf):
    """Fields read through a path of relations; null anywhere on the way gives null."""
    customer = customers_with_nation(spark, sf).filter("c_acctbal >= 0").select(
        "c_custkey",
        F.struct(
            F.col("c_custkey").alias("id"),
            F.struct(F.col("n_name").alias("name"), F.struct(F.col("r_name").alias("name")).alias("region")).alias("nation"),
        ).alias("customer"),
    )
    orders = table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    paths = Collection(
        "orders",
        (
            Field("customer_id", "string", source="customer.id"),
            Field("customer_nation", "string", source="customer.nation.name"),
            Field("customer_region", "string", source="customer.nation.region.name"),
        ),
    )
    return normalize(orders, paths, "o_orderkey")


@query(
    "nest_fallback",
    """SELECT CAST(s_suppkey AS VARCHAR) AS id, CAST(to_json({'id': CAST(n_nationkey AS VARCHAR), 'name': n_name}) AS VARCHAR) AS nation,
    CAST(NULL AS VARCHAR) AS details FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def nest_fallback(spark, sf):
    """Nothing configured: id and name of the related row; an ``object`` field stays null."""
    joined = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    nation = nested(F.col("n_nationkey"), name=F.col("n_name"))
    return joined.select(
        F.col("s_suppkey").cast("string").alias("id"), F.to_json(nation).alias("nation"), F.lit(None).cast("string").alias("details")
    )


@query(
    "nest_many",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, 0 AS part, coalesce(list(CAST(to_json({'line': l_linenumber, 'product': CAST(l_partkey AS VARCHAR),
    'supplier': l_suppkey, 'quantity': CAST(l_quantity AS BIGINT)}) AS VARCHAR) ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR), l_suppkey, CAST(l_quantity AS BIGINT)) FILTER (l_orderkey IS NOT NULL), []) AS lines
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def nest_many_lines(spark, sf):
    item = F.struct(
        F.col("l_linenumber").alias("line"), F.col("l_partkey").cast("string").alias("product"),
        F.col("l_suppkey").alias("supplier"), F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    orders = table(spark, sf, "orders").select("o_orderkey")
    listed = nest_many(
        orders, table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey", item, "lines", ["l_linenumber", "l_partkey", "l_suppkey"]
    )
    return listed.select(
        F.col("o_orderkey").cast("string").alias("id"), "part", F.transform("lines", lambda x: F.to_json(x)).alias("lines")
    )


@query("truncate_text", f"SELECT id, left(text, 120) AS text FROM {DOCUMENTS}")
def truncate_text(spark, sf):
    cut = Collection("documents", (Field("text", "string", truncate=120),))
    return normalize(documents(spark, sf), cut)


@query("project_fields", f"SELECT id, lang FROM {DOCUMENTS}")
def project_fields(spark, sf):
    return project(documents(spark, sf), include=["lang", "source"], exclude=["source"])


@query(
    "index_false",
    f"""WITH {oracle.search_ctes(PRODUCTS, ['p_name'], [('q1', 'standard'), ('q2', 'red'), ('q3', 'ring')])}
    SELECT query_id, id, p_name, p_type FROM hits JOIN {PRODUCTS} USING (id)""",
)
def index_false(spark, sf):
    """A field with ``index=False`` is returned with the hits but finds nothing."""
    from gleaner.operators.match import EXACT_ONLY, Match, search
    from gleaner.workload.base import requests

    fields = [Field("p_name", "string"), Field("p_type", "string", index=False)]
    docs = products(spark, sf)
    queries = requests(spark, [("q1", "standard"), ("q2", "red"), ("q3", "ring")])
    hits = search(postings(docs, fields), queries, Match(("p_name", "p_type"), **EXACT_ONLY))
    return hits.select("query_id", "id").join(docs.select("id", "p_name", "p_type"), "id")
