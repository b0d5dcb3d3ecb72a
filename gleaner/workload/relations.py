"""Checked queries: references, several collections at once, curation."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions.predicates import gt
from gleaner.functions.skew import ordinals, top_by
from gleaner.operators import curation, rank, union
from gleaner.operators.match import EXACT_ONLY, Match, search
from gleaner.operators.postings import postings
from gleaner.operators.relations import cascade, check_references, join_reference, unresolved
from gleaner.plans import requests as each
from gleaner.session import local_table, table
from gleaner.sources import resources
from gleaner.workload import oracle
from gleaner.workload.base import (
    BENCHMARK, DOCUMENT_QUERIES, DOCUMENTS, PRODUCT_QUERIES, PRODUCTS, benchmark, documents, products, query, requests,
)
from gleaner.workload.text import NAME_TYPE, document_hits, product_hits

# --- references ------------------------------------------------------------------


@query(
    "reference_join",
    f"""WITH {oracle.search_ctes(DOCUMENTS, ['text'], DOCUMENT_QUERIES)} SELECT query_id, id, score, quality FROM hits
    JOIN labels ON id = CAST(doc_id AS VARCHAR) WHERE quality > 0""",
)
def reference_join(spark, sf):
    """Hits filtered by a numeric field of the referencing labels collection."""
    labels = table(spark, sf, "labels").withColumn("document", F.col("doc_id").cast("string"))
    hits = document_hits(spark, sf, DOCUMENT_QUERIES)
    joined = join_reference(hits, labels, "id", "document", required=True).filter(gt("quality", 0))
    return joined.select("query_id", "id", "score", "quality")


@query("reference_left", "SELECT CAST(doc_id AS VARCHAR) AS id, d.lang, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)")
def reference_left(spark, sf):
    labels = table(spark, sf, "labels").withColumnRenamed("doc_id", "labelled")
    return join_reference(documents(spark, sf), labels, "doc_id", "labelled").select("id", "lang", "quality", "toxic")


# Parents that have arrived: customers not in debt.
@query(
    "unresolved_refs",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)",
)
def unresolved_refs(spark, sf):
    arrived = table(spark, sf, "customer").filter("c_acctbal >= 0")
    return unresolved(table(spark, sf, "orders"), arrived, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query(
    "strict_refs",
    "SELECT o_orderkey, c_custkey IS NOT NULL AS accepted FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal >= 0",
)
def strict_refs(spark, sf):
    arrived = table(spark, sf, "customer").filter("c_acctbal >= 0")
    accepted, rejected = check_references(table(spark, sf, "orders"), arrived, "o_custkey", "c_custkey")
    return accepted.select("o_orderkey", F.lit(True).alias("accepted")).unionByName(
        rejected.select("o_orderkey", F.lit(False).alias("accepted"))
    )


_DEAD = "SELECT c_custkey FROM customer WHERE c_acctbal < 0"


@query(
    "cascade_delete",
    f"""SELECT 'customers' AS collection, CAST(c_custkey AS VARCHAR) AS id FROM ({_DEAD}) UNION ALL
    SELECT 'orders', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_custkey IN ({_DEAD}) UNION ALL
    SELECT DISTINCT 'lines', CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN ({_DEAD}))""",
)
def cascade_delete(spark, sf):
    """Customers in debt are deleted; their orders and order lines follow, other logs do not."""
    dead = table(spark, sf, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("id"))
    lines = table(spark, sf, "lineitem").withColumn(
        "line_id", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    )
    levels = [
        ("customers", "orders", table(spark, sf, "orders"), "o_custkey", "o_orderkey", True),
        ("customers", "visits", table(spark, sf, "events"), "user_id", "event_id", False),
        ("orders", "lines", lines, "l_orderkey", "line_id", None),
    ]
    gone = cascade({"customers": dead}, levels)
    parts = [rows.select(F.lit(name).alias("collection"), "id") for name, rows in gone.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- several searches ----------------------------------------------------------------

@query(
    "multi_search",
    f"""WITH {oracle.search_ctes(PRODUCTS, NAME_TYPE, PRODUCT_QUERIES, name='p')}, {oracle.search_ctes(DOCUMENTS, ['text'], DOCUMENT_QUERIES, name='t')},
    a AS (SELECT 'products' AS collection, * FROM p UNION ALL SELECT 'documents', * FROM t)
    SELECT collection, query_id, id, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, weight DESC, id) AS INTEGER) AS rank FROM a) WHERE rank <= 10""",
)
def multi_search(spark, sf):
    """Ten searches over two collections; each search keeps its own page."""
    parts = {"products": product_hits(spark, sf, PRODUCT_QUERIES), "documents": document_hits(spark, sf, DOCUMENT_QUERIES)}
    every = union.merge(parts).withColumnRenamed("_collection", "collection")
    return rank.page(every, rank.default_order()).select("collection", "query_id", "id", "rank")


UNION_QUERIES = [("u1", "the of"), ("u2", "that it"), ("u3", "is"), ("u4", "absent zzzz")]


def _union(extra):
    return f"""WITH {oracle.search_ctes(DOCUMENTS, ['text'], UNION_QUERIES, name='d')}, {oracle.search_ctes(BENCHMARK, ['text'], UNION_QUERIES, name='b')},
    a AS (SELECT 'documents' AS _collection, d.*, x.text FROM d JOIN {DOCUMENTS} x USING (id) UNION ALL SELECT 'benchmark', b.*, x.text FROM b JOIN {BENCHMARK} x USING (id)) {extra}"""


def union_hits(spark, sf, column="text"):
    """Hits of both collections with one column of their documents, or none."""
    queries = requests(spark, UNION_QUERIES)
    how = Match(("text",), **EXACT_ONLY)
    parts = {}
    for name, docs in (("documents", documents(spark, sf)), ("benchmark", benchmark(spark, sf))):
        hits = search(postings(docs, ["text"]), queries, how)
        parts[name] = hits if column is None else hits.join(docs.select("id", column), "id")
    return union.merge(parts)


@query(
    "union_search",
    _union(
        "SELECT query_id, _collection, id, score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, _collection DESC, id) AS INTEGER) AS rank FROM a) WHERE rank <= 40"
    ),
)
def union_search(spark, sf):
    merged = rank.page(union_hits(spark, sf), [rank.desc("score"), rank.desc("_collection")], per_page=40)
    return merged.select("query_id", "_collection", "id", "score", "rank")


@query(
    "union_dedup",
    _union(
        f"""SELECT query_id, _collection, id FROM (SELECT *, row_number() OVER (PARTITION BY query_id, md5(array_to_string({oracle.tokens('text')}, ' ')) ORDER BY score DESC, _collection DESC, id) AS n FROM a) WHERE n = 1"""
    ),
)
def union_dedup(spark, sf):
    order = [rank.desc("score"), rank.desc("_collection"), F.col("id").asc()]
    marked = union_hits(spark, sf, union.fingerprint(F.col("text")).alias("fingerprint"))
    return union.drop_copies(marked, order).select("query_id", "_collection", "id")


@query("union_neardup")
def union_neardup(spark, sf):
    order = [rank.desc("score"), rank.desc("_collection"), F.col("id").asc()]
    texts = union.merge({"documents": documents(spark, sf).select("id", "text"), "benchmark": benchmark(spark, sf).select("id", "text")})
    return union.drop_near_copies(union_hits(spark, sf, None), "text", order, texts=texts).select("query_id", "_collection", "id")


_REQUESTS = [("r1", "wide", None, None), ("r2", "wide", "red", 3), ("r3", None, "small ring", None), ("r4", "narrow", None, 7), ("r5", "gone", "plate", None)]
_PRESETS = [("wide", "hot plate", "20"), ("narrow", "old rod", "2")]


@query(
    "preset_search",
    f"""WITH r AS (SELECT * FROM {oracle.values(_REQUESTS)} v(query_id, preset, q, per_page)),
    s AS (SELECT * FROM {oracle.values(_PRESETS)} v(name, q, per_page)),
    w AS (SELECT query_id, coalesce(r.q, s.q) AS q, coalesce(r.per_page, CAST(s.per_page AS INTEGER), 5) AS per_page FROM r LEFT JOIN s ON preset = name),
    {oracle.search_ctes(PRODUCTS, NAME_TYPE, 'SELECT query_id, q FROM w')},
    x AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, weight DESC, id) AS INTEGER) AS rank FROM hits)
    SELECT query_id, id, score, rank FROM x JOIN w USING (query_id) WHERE rank <= per_page""",
)
def preset_search(spark, sf):
    """Stored parameters by name; the request's own values win, then the preset, then the shared ones."""
    stored = resources.presets(spark, {n: {"q": q, "per_page": p} for n, q, p in _PRESETS})
    wide = stored.groupBy("name").pivot("param", ["q", "per_page"]).agg(F.first("value"))
    asked = local_table(spark, _REQUESTS, "query_id string, preset string, q string, per_page int")
    resolved = union.with_presets(
        asked, wide.withColumn("per_page", F.col("per_page").cast("int")), ["q", "per_page"], common={"per_page": 5}
    )
    how = Match(tuple(NAME_TYPE), **EXACT_ONLY)
    hits = search(postings(products(spark, sf), NAME_TYPE), resolved.select("query_id", "q"), how)
    limited = hits.join(resolved.select("query_id", "per_page"), "query_id")
    order = [*rank.default_order(), F.col("id").asc()]
    return top_by(limited, ["query_id"], order, "per_page").select("query_id", "id", "score", "rank")


# --- curation --------------------------------------------------------------------------

# Pins are the dearest product of every type; the place is the rank of the type's name.
_PINS = """SELECT q.query_id, CAST(p.id AS VARCHAR) AS id, CAST(p.position * 2 AS INTEGER) AS position FROM
    (SELECT arg_max(p_partkey, (p_retailprice, p_partkey)) AS id, row_number() OVER (ORDER BY p_type) AS position FROM part GROUP BY p_type) p, hits_queries q"""


def _placed(pins, rows=PRODUCT_QUERIES, end=12, hidden="SELECT NULL AS query_id, NULL AS id WHERE false"):
    return f"""WITH {oracle.search_ctes(PRODUCTS, NAME_TYPE, rows)}, pins AS ({pins}), hid AS ({hidden}),
    pi AS (SELECT *, position - row_number() OVER (PARTITION BY query_id ORDER BY position, id) AS gap FROM pins),
    o AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, weight DESC, id) AS r FROM hits h
          WHERE NOT EXISTS (SELECT 1 FROM pins p WHERE p.query_id = h.query_id AND p.id = h.id)
          AND NOT EXISTS (SELECT 1 FROM hid p WHERE p.query_id = h.query_id AND p.id = h.id)),
    a AS (SELECT query_id, id, r + (SELECT count(*) FROM pi WHERE pi.query_id = o.query_id AND gap < r) AS place, false AS pinned FROM o
          UNION ALL SELECT query_id, id, position, true FROM pins)
    SELECT query_id, id, pinned, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY place, id) AS INTEGER) AS rank FROM a) WHERE rank <= {end}"""


@query("pinned_hits", _placed(_PINS))
def pinned_hits(spark, sf):
    dearest = products(spark, sf).groupBy("p_type").agg(F.max_by("id", F.struct("p_retailprice", "p_partkey")).alias("id"))
    pins = ordinals(dearest, [], [F.col("p_type").asc()], "place").select("id", (F.col("place") * 2).cast("int").alias("position"))
    pins = pins.withColumn("query_id", F.explode(F.array(*[F.lit(q) for q, _ in PRODUCT_QUERIES])))
    hits = product_hits(spark, sf, PRODUCT_QUERIES)
    return curation.pin(hits, pins, rank.default_order(), 12).select("query_id", "id", "pinned", "rank")


CURATIONS = {
    "products": {
        "items": {
            "promote": {
                "rule": {"query": "Red  Widget!", "tags": ["summer"]},
                "includes": [{"id": 7, "position": 1}, {"id": "100", "position": 3}, {"id": "42", "position": 4}],
                "excludes": [{"id": 1}],
            },
            5: {
                "rule": {"query": "small ring", "tags": ["winter"]},
                "includes": [{"id": "0", "position": 2}],
                "excludes": [{"id": "12"}, {"id": "64"}],
            },
        }
    },
    "plates": {"items": [{"id": "p", "rule": {"query": "plate"}, "includes": [{"id": "3", "position": 5}]}]},
}
_RULES = [
    ("products", "promote", "red widget", "include", "7", 1, ["summer"]), ("products", "promote", "red widget", "include", "100", 3, ["summer"]),
    ("products", "promote", "red widget", "include", "42", 4, ["summer"]), ("products", "promote", "red widget", "exclude", "1", None, ["summer"]),
    ("products", "5", "small ring", "include", "0", 2, ["winter"]), ("products", "5", "small ring", "exclude", "12", None, ["winter"]),
    ("products", "5", "small ring", "exclude", "64", None, ["winter"]), ("plates", "p", "plate", "include", "3", 5, ["-"]),
]
_RULE_SQL = f"""(SELECT * FROM {oracle.values(_RULES)} v("set", rule_id, query, action, doc_id, position, tags))"""


def _active(action, where="true"):
    return (
        f"SELECT query_id, doc_id AS id, CAST(position AS INTEGER) AS position FROM {_RULE_SQL} "
        f"JOIN hits_queries ON query = array_to_string({oracle.tokens('q')}, ' ') WHERE action = '{action}' AND {where}"
    )


@query(
    "curation_table",
    f"""SELECT "set", rule_id, action, doc_id, CAST(position AS INTEGER) AS position, p_name FROM {_RULE_SQL} LEFT JOIN {PRODUCTS} ON id = doc_id""",
)
def curation_table(spark, sf):
    """Curation rules as rows, beside the product each one moves."""
    rules = resources.curations(spark, CURATIONS)
    named = products(spark, sf).select(F.col("id").alias("doc_id"), "p_name")
    return rules.join(named, "doc_id", "left").select("set", "rule_id", "action", "doc_id", "position", "p_name")


def _curated(spark, sf, **options):
    queries = requests(spark, PRODUCT_QUERIES)
    hits = product_hits(spark, sf, PRODUCT_QUERIES)
    rules = resources.curations(spark, CURATIONS)
    out = curation.curate(hits, queries, rules, rank.default_order(), 12, **options)
    return out.select("query_id", "id", "pinned", "rank")


@query("curated_search", _placed(_active("include"), hidden=_active("exclude")))
def curated_search(spark, sf):
    return _curated(spark, sf)


@query(
    "curation_excludes",
    f"""WITH {oracle.search_ctes(PRODUCTS, NAME_TYPE, PRODUCT_QUERIES)}, x AS ({_active('exclude')})
    SELECT query_id, id FROM hits h WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.query_id = h.query_id AND x.id = h.id)""",
)
def curation_excludes(spark, sf):
    active = curation.applicable_rules(requests(spark, PRODUCT_QUERIES), resources.curations(spark, CURATIONS))
    hits = product_hits(spark, sf, PRODUCT_QUERIES)
    return curation.hide(hits, active.filter("action = 'exclude'")).select("query_id", "id")


_TAGGED = "list_has_any(tags, ['winter'])"


@query("curation_tags", _placed(_active("include", _TAGGED), hidden=_active("exclude", _TAGGED)))
def curation_tags(spark, sf):
    return _curated(spark, sf, tags=["winter"])


@query("curation_off", _placed(_active("include", "false"), hidden=_active("exclude", "false")))
def curation_off(spark, sf):
    return _curated(spark, sf, enabled=False)


_ALLOWED = f"doc_id IN (SELECT id FROM {PRODUCTS} WHERE p_size > 25)"


@query("curation_filtered", _placed(_active("include", _ALLOWED), hidden=_active("exclude")))
def curation_filtered(spark, sf):
    return _curated(spark, sf, allowed=products(spark, sf).filter(gt("p_size", 25)))


# --- every request with its own filter, order and page -----------------------------

EACH = [("r1", "red ring", 1, 5), ("r2", "small", 2, 10), ("r3", "*", 1, 7), ("r4", "*", 3, 4), ("r5", "large plate", None, None), ("r6", "*", 1, 3), ("r7", "*", 2, 6)]
EACH_CONDITIONS = [
    ("r1", "p_size", None, 10.0, 40.0), ("r2", "p_type", "SMALL", None, None), ("r2", "p_retailprice", None, None, 950.0),
    ("r3", "p_type", "PROMO", None, None), ("r3", "p_size", None, 45.0, None), ("r4", "p_retailprice", None, 905.0, 915.5), ("r7", "p_size", None, None, 3.0),
]
EACH_ORDERS = [("r1", 0, "p_retailprice", True), ("r2", 0, "p_size", False), ("r2", 1, "p_retailprice", True), ("r3", 0, "p_size", True), ("r4", 0, "p_retailprice", False), ("r5", 0, "score", True)]


@query(
    "multi_search_each",
    f"""WITH {oracle.search_ctes(PRODUCTS, ["p_name", "p_type"], [(q, t) for q, t, *_ in EACH if t != "*"])},
    found AS (SELECT query_id, id, score, weight FROM hits UNION ALL
      SELECT query_id, id, 0, 0 FROM (VALUES ('r3'), ('r4'), ('r6'), ('r7')) v(query_id), {PRODUCTS} d),
    kept AS (SELECT f.*, p_size, p_retailprice FROM found f JOIN {PRODUCTS} d USING (id) WHERE CASE query_id WHEN 'r1' THEN p_size BETWEEN 10 AND 40
      WHEN 'r2' THEN p_type = 'SMALL' AND p_retailprice <= 950 WHEN 'r3' THEN p_type = 'PROMO' AND p_size >= 45
      WHEN 'r4' THEN p_retailprice BETWEEN 905 AND 915.5 WHEN 'r7' THEN p_size <= 3 ELSE true END),
    keyed AS (SELECT *, CASE query_id WHEN 'r1' THEN -p_retailprice WHEN 'r2' THEN p_size WHEN 'r3' THEN -p_size WHEN 'r4' THEN p_retailprice WHEN 'r5' THEN -score ELSE 0 END AS k1,
      CASE query_id WHEN 'r2' THEN -p_retailprice ELSE 0 END AS k2 FROM kept),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY k1, k2, score DESC, weight DESC, id) AS INTEGER) AS rank FROM keyed)
    SELECT query_id, id, CAST(score AS BIGINT) AS score, CAST(weight AS INTEGER) AS weight, rank FROM ranked JOIN
    (VALUES ('r1', 0, 5), ('r2', 10, 20), ('r3', 0, 7), ('r4', 8, 12), ('r5', 0, 10), ('r6', 0, 3), ('r7', 6, 12)) p(query_id, first, last) USING (query_id) WHERE rank > first AND rank <= last""",
)
def multi_search_each(spark, sf):
    """A batch in which every search has a filter, an order and a page of its own."""
    return each.run_each(
        products(spark, sf), local_table(spark, EACH, each.REQUEST), Match(("p_name", "p_type"), **EXACT_ONLY),
        each.Columns(("p_type",), ("p_size", "p_retailprice")),
        local_table(spark, EACH_CONDITIONS, each.CONDITION), local_table(spark, EACH_ORDERS, each.ORDER),
    )


RULE_CONDITIONS = [("Red ring!", "p_type", "PROMO", None, None), ("large PLATE", "p_retailprice", None, None, 960.0), ("other", "p_size", None, 50.0, None)]
RULE_ORDERS = [("red RING", 0, "p_size", True), ("large plate", 0, "p_retailprice", False), ("other", 0, "p_size", True)]
RULED = [("r1", "red ring", 1, 10), ("r2", "small", 1, 10), ("r5", "large plate", 2, 5)]


@query(
    "curated_each",
    f"""WITH {oracle.search_ctes(PRODUCTS, ["p_name", "p_type"], [(q, t) for q, t, *_ in RULED])},
    kept AS (SELECT f.*, p_size, p_retailprice FROM hits f JOIN {PRODUCTS} d USING (id) WHERE CASE query_id WHEN 'r1' THEN p_size BETWEEN 10 AND 40 AND p_type = 'PROMO'
      WHEN 'r2' THEN p_type = 'SMALL' AND p_retailprice <= 950 ELSE p_retailprice <= 960 END),
    keyed AS (SELECT *, CASE query_id WHEN 'r1' THEN -p_size WHEN 'r2' THEN p_size ELSE p_retailprice END AS k1, CASE query_id WHEN 'r2' THEN -p_retailprice ELSE 0 END AS k2 FROM kept),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY k1, k2, score DESC, weight DESC, id) AS INTEGER) AS rank FROM keyed)
    SELECT query_id, id, CAST(score AS BIGINT) AS score, CAST(weight AS INTEGER) AS weight, rank FROM ranked
    WHERE CASE query_id WHEN 'r5' THEN rank BETWEEN 6 AND 10 ELSE rank <= 10 END""",
)
def curated_each(spark, sf):
    """Curation rules that add a filter and set the order of the searches they apply to."""
    asked = local_table(spark, RULED, each.REQUEST)
    conditions, orders = each.with_rules(
        asked, local_table(spark, [c for c in EACH_CONDITIONS if c[0] in ("r1", "r2")], each.CONDITION),
        local_table(spark, [o for o in EACH_ORDERS if o[0] in ("r1", "r2", "r5")], each.ORDER),
        local_table(spark, RULE_CONDITIONS, each.RULE_CONDITION), local_table(spark, RULE_ORDERS, each.RULE_ORDER),
    )
    columns = each.Columns(("p_type",), ("p_size", "p_retailprice"))
    return each.run_each(products(spark, sf), asked, Match(("p_name", "p_type"), **EXACT_ONLY), columns, conditions, orders)
