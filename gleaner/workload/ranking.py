"""Checked queries: filters, sorting, paging, facets and groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import decay, geo
from gleaner.functions.predicates import all_of, eq, gt, has, lt
from gleaner.operators import curation, facets, rank
from gleaner.operators.fanout import fan_out, match_all
from gleaner.plans.search import Page, as_json, assemble, run
from gleaner.operators.match import EXACT_ONLY, Match
from gleaner.workload import oracle
from gleaner.workload.base import (
    PRODUCT_QUERIES, PRODUCTS, STORES, documents, products, query, requests, rounded, sql_rounded, stores,
)
from gleaner.workload.text import NAME_TYPE, product_hits
from gleaner.session import table

PRODUCT_COLUMNS = ["id", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


def _hits(spark, sf, rows=PRODUCT_QUERIES, **options):
    """Product hits with the columns of the product."""
    return product_hits(spark, sf, rows, **options).join(products(spark, sf).select(*PRODUCT_COLUMNS), "id")


def _sql(select, rows=PRODUCT_QUERIES, docs=PRODUCTS, extra="", **options):
    ctes = oracle.search_ctes(docs, NAME_TYPE, rows, **options)
    return f"WITH {ctes}, h AS (SELECT h.*, d.* EXCLUDE (id) FROM hits h JOIN {docs} d USING (id)){extra} {select}"


# --- filters -------------------------------------------------------------------


@query("match_all", f"SELECT q.query_id, id, CAST(0 AS BIGINT) AS score FROM {PRODUCTS}, (VALUES ('a'), ('b')) q(query_id)")
def match_everything(spark, sf):
    return match_all(products(spark, sf), ["a", "b"]).select("query_id", "id", "score")


@query("filter_numeric", f"SELECT id, p_size FROM {PRODUCTS} WHERE p_size > 10 AND p_retailprice < 1000")
def filter_numeric(spark, sf):
    return products(spark, sf).filter(gt("p_size", 10) & lt("p_retailprice", 1000)).select("id", "p_size")


@query(
    "filter_value",
    f"""SELECT 'field' AS kind, id FROM {PRODUCTS} WHERE p_type = 'PROMO' UNION ALL
    SELECT 'list', id FROM {PRODUCTS} WHERE list_contains({oracle.tokens('p_name')}, 'red')""",
)
def filter_value(spark, sf):
    from gleaner.functions.text import tokens

    field = products(spark, sf).filter(eq("p_type", "PROMO")).select(F.lit("field").alias("kind"), "id")
    words = products(spark, sf).withColumn("words", tokens(F.col("p_name"))).filter(has("words", "red"))
    return field.unionByName(words.select(F.lit("list").alias("kind"), "id"))


@query(
    "filter_and",
    f"WITH {oracle.search_ctes('(SELECT CAST(p_partkey AS VARCHAR) AS id, * FROM part WHERE p_size > 10 AND p_type = ' + chr(39) + 'PROMO' + chr(39) + ')', NAME_TYPE, PRODUCT_QUERIES)} SELECT query_id, id, score FROM hits",
)
def filter_and(spark, sf):
    where = all_of(gt("p_size", 10), eq("p_type", "PROMO"))
    return product_hits(spark, sf, PRODUCT_QUERIES, where=where).select("query_id", "id", "score")


@query(
    "filter_requests",
    f"""SELECT 'cheap' AS query_id, id FROM {PRODUCTS} WHERE p_retailprice < 1000 UNION ALL
    SELECT 'big', id FROM {PRODUCTS} WHERE p_size > 40 UNION ALL SELECT 'both', id FROM {PRODUCTS} WHERE p_retailprice < 1000 AND p_size > 40""",
)
def filter_requests(spark, sf):
    """Several filter-only requests over one scan."""
    wanted = {"cheap": lt("p_retailprice", 1000), "big": gt("p_size", 40), "both": lt("p_retailprice", 1000) & gt("p_size", 40)}
    return fan_out(products(spark, sf), wanted).select("query_id", "id")


CENTRE = (48.8566, 2.3522)
POLYGON = [(-60.0, -120.0), (40.5, -100.0), (70.0, 30.25), (10.0, 10.0), (-20.0, 140.0)]


def _sql_km(lat, lon, at=CENTRE):
    return (
        f"2 * 6371.0 * asin(sqrt(least(1.0, power(sin(radians({lat} - {at[0]}) / 2), 2) + "
        f"cos(radians({lat})) * cos(radians({at[0]})) * power(sin(radians({lon} - {at[1]}) / 2), 2))))"
    )


def _sql_inside(lat, lon):
    parts = []
    for (la, lo), (lb, lob) in zip(POLYGON, POLYGON[-1:] + POLYGON[:-1]):
        parts.append(
            f"CASE WHEN ({la} > {lat}) <> ({lb} > {lat}) AND {lon} < ({lob} - ({lo})) * ({lat} - ({la})) / ({lb} - ({la})) + ({lo}) THEN 1 ELSE 0 END"
        )
    return f"({' + '.join(parts)}) % 2 = 1"


@query("filter_geo_radius", f"SELECT id, {sql_rounded(_sql_km('lat', 'lon'))} AS km FROM {STORES} WHERE {_sql_km('lat', 'lon')} <= 2500")
def filter_geo_radius(spark, sf):
    near = stores(spark, sf).filter(geo.within_km(F.col("lat"), F.col("lon"), *CENTRE, 2500))
    return near.select("id", rounded(geo.distance_km(F.col("lat"), F.col("lon"), *CENTRE)).alias("km"))


@query("filter_geo_polygon", f"SELECT id FROM {STORES} WHERE {_sql_inside('lat', 'lon')}")
def filter_geo_polygon(spark, sf):
    return stores(spark, sf).filter(geo.in_polygon(F.col("lat"), F.col("lon"), POLYGON)).select("id")


_SNAPPED = f"(SELECT id, floor(lat * 10 + 0.5) / 10 AS lat, floor(lon * 10 + 0.5) / 10 AS lon FROM {STORES})"


@query("geo_precision", f"SELECT id, lat, lon FROM {_SNAPPED} WHERE {_sql_km('lat', 'lon')} <= 2500")
def geo_precision(spark, sf):
    coarse = stores(spark, sf).withColumns({"lat": geo.snap(F.col("lat"), 1), "lon": geo.snap(F.col("lon"), 1)})
    return coarse.filter(geo.within_km(F.col("lat"), F.col("lon"), *CENTRE, 2500)).select("id", "lat", "lon")


@query(
    "hidden_hits",
    _sql("SELECT query_id, id, score FROM h WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE CAST(l_partkey AS VARCHAR) = id AND l_quantity >= 50)"),
)
def hidden_hits(spark, sf):
    """Products sold in large numbers are hidden from every query."""
    sold = table(spark, sf, "lineitem").filter("l_quantity >= 50").select(F.col("l_partkey").cast("string").alias("id")).distinct()
    hidden = fan_out(sold, {q: F.lit(True) for q, _ in PRODUCT_QUERIES})
    return curation.hide(product_hits(spark, sf, PRODUCT_QUERIES), hidden).select("query_id", "id", "score")


# --- sorting ---------------------------------------------------------------------


@query("sort_multi", _sql(oracle.top("score DESC, p_retailprice, p_size DESC", 25, "score, p_retailprice", "h")))
def sort_multi(spark, sf):
    order = [rank.desc("score"), rank.asc("p_retailprice"), rank.desc("p_size")]
    return rank.page(_hits(spark, sf), order, per_page=25).select("query_id", "id", "score", "p_retailprice", "rank")


@query("sort_default", _sql(oracle.top("score DESC, weight DESC, p_retailprice DESC", 25, "score", "h")))
def sort_default(spark, sf):
    return rank.page(_hits(spark, sf), rank.default_order("p_retailprice"), per_page=25).select("query_id", "id", "score", "rank")


@query("sort_rand_seeded", _sql(oracle.top("md5('42:' || id)", 25, "", "h")))
def sort_rand_seeded(spark, sf):
    return rank.page(_hits(spark, sf), [rank.seeded_order(42)], per_page=25).select("query_id", "id", "rank")


@query("sort_rand")
def sort_rand(spark, sf):
    return rank.page(_hits(spark, sf), [rank.random_order()], per_page=25).select("query_id", "id", "rank")


@query(
    "sort_geo",
    f"WITH s AS (SELECT 'near' AS query_id, id, {sql_rounded(_sql_km('lat', 'lon'))} AS km FROM {STORES}) {oracle.top('km', 100, 'km', 's')}",
)
def sort_geo(spark, sf):
    km = rounded(geo.distance_km(F.col("lat"), F.col("lon"), *CENTRE))
    everyone = match_all(stores(spark, sf), ["near"]).withColumn("km", km)
    return rank.page(everyone, [rank.asc("km")], per_page=100).select("query_id", "id", "km", "rank")


for _key, _curve, _formula in (
    ("decay_gauss", decay.gauss, "exp(ln(0.5) * z * z / power(8.0, 2))"),
    ("decay_linear", decay.linear, "greatest(0.0, 1 - (1 - 0.5) * z / 8.0)"),
    ("decay_exp", decay.exponential, "exp(ln(0.5) * z / 8.0)"),
):

    @query(
        _key,
        _sql(
            oracle.top("decay DESC", 50, "decay", "w"),
            extra=f", z AS (SELECT *, greatest(0.0, abs(p_size - 25.0) - 3.0) AS z FROM h), w AS (SELECT *, {sql_rounded(_formula)} AS decay FROM z)",
        ),
    )
    def decayed(spark, sf, curve=_curve):
        value = rounded(curve(F.col("p_size"), 25.0, 8.0, 3.0, 0.5))
        hits = _hits(spark, sf).withColumn("decay", value)
        return rank.page(hits, [rank.desc("decay")], per_page=50).select("query_id", "id", "decay", "rank")


@query(
    "bucketed_sort",
    _sql(
        oracle.top("bucket, p_retailprice", 50, "bucket, p_retailprice", "b"),
        extra=", b AS (SELECT *, CAST(ntile(7) OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS bucket FROM h)",
    ),
)
def bucketed_sort(spark, sf):
    bucketed = rank.score_buckets(_hits(spark, sf), 7)
    order = [rank.asc("bucket"), rank.asc("p_retailprice")]
    return rank.page(bucketed, order, per_page=50).select("query_id", "id", "bucket", "p_retailprice", "rank")


@query(
    "bucketed_documents",
    """SELECT lang AS query_id, CAST(doc_id AS VARCHAR) AS id, CAST(ntile(13) OVER (PARTITION BY lang ORDER BY n_chars DESC, CAST(doc_id AS VARCHAR)) AS INTEGER) AS bucket FROM documents""",
)
def bucketed_documents(spark, sf):
    """All rows of a hot group put in buckets, without a page to cut them."""
    docs = documents(spark, sf).select(F.col("lang").alias("query_id"), "id", "n_chars")
    return rank.score_buckets(docs, 13, [rank.desc("n_chars")]).select("query_id", "id", "bucket")


# --- paging ---------------------------------------------------------------------


@query("paginate", _sql(oracle.top("score DESC, weight DESC", 30, "score", "h", 20)))
def paginate(spark, sf):
    return rank.page(_hits(spark, sf), rank.default_order(), page=3, per_page=10).select("query_id", "id", "score", "rank")


@query("offset_limit", _sql(oracle.top("score DESC, weight DESC", 35, "score", "h", 15)))
def offset_limit(spark, sf):
    return rank.page(_hits(spark, sf), rank.default_order(), offset=15, per_page=20).select("query_id", "id", "score", "rank")


@query("limit_hits", _sql(oracle.top("score DESC, weight DESC", 25, "score", "h", 20)))
def limit_hits(spark, sf):
    return rank.page(_hits(spark, sf), rank.default_order(), page=2, per_page=20, limit_hits=25).select("query_id", "id", "score", "rank")


@query(
    "deep_page",
    f"WITH h AS (SELECT 'all' AS query_id, id, p_retailprice FROM {PRODUCTS}) {oracle.top('p_retailprice DESC', 1750, 'p_retailprice', 'h', 1500)}",
)
def deep_page(spark, sf):
    """A page beyond the rows Spark cuts early for a window."""
    everything = match_all(products(spark, sf), ["all"])
    return rank.page(everything, [rank.desc("p_retailprice")], page=7, per_page=250).select("query_id", "id", "p_retailprice", "rank")


_FOUND = "SELECT q.query_id, count(h.id) AS found FROM hits_queries q LEFT JOIN hits h USING (query_id) GROUP BY 1"


@query("found_counts", _sql(_FOUND))
def found_counts(spark, sf):
    return rank.found(product_hits(spark, sf, PRODUCT_QUERIES), requests(spark, PRODUCT_QUERIES))


@query(
    "page_facts",
    _sql(
        f"""SELECT query_id, found, 2 AS page, 30 AS per_page, CAST(greatest(1, ceil(found / 30)) AS INTEGER) AS last_page, true AS has_previous,
        2 < greatest(1, ceil(found / 30)) AS has_next, 1 AS previous_page, CASE WHEN 2 < greatest(1, ceil(found / 30)) THEN 3 END AS next_page FROM ({_FOUND})"""
    ),
)
def page_facts(spark, sf):
    totals = rank.found(product_hits(spark, sf, PRODUCT_QUERIES), requests(spark, PRODUCT_QUERIES))
    return rank.page_facts(totals, 2, 30)


_STAR = [("s1", "*"), ("s2", "red widget")]


@query(
    "star_search",
    f"""WITH {oracle.search_ctes('(SELECT CAST(p_partkey AS VARCHAR) AS id, * FROM part WHERE p_size > 10)', ['p_name'], _STAR)},
    a AS (SELECT query_id, id, p_retailprice FROM hits JOIN {PRODUCTS} USING (id) UNION ALL SELECT 's1', id, p_retailprice FROM {PRODUCTS} WHERE p_size > 10)
    {oracle.top('p_retailprice DESC', 25, 'p_retailprice', 'a')}""",
)
def star_search(spark, sf):
    """A query for everything beside an ordinary one, in the same batch."""
    page = Page(order=(rank.desc("p_retailprice"),), sort_by=("p_retailprice",), per_page=25)
    found = run(products(spark, sf), requests(spark, _STAR), Match(("p_name",), **EXACT_ONLY), page, gt("p_size", 10))
    return found.hits.select("query_id", "id", "p_retailprice", "rank")


_BIG = "(SELECT CAST(p_partkey AS VARCHAR) AS id, * FROM part WHERE p_size > 10)"


@query(
    "result_json",
    _sql(
        """SELECT query_id, CAST(to_json(CASE WHEN l.hits IS NULL THEN NULL ELSE {'found': t.found, 'page': 1, 'hits': l.hits, 'facet_counts': v.facets} END) AS VARCHAR) AS result
        FROM t JOIN l USING (query_id) JOIN v USING (query_id) UNION ALL
        SELECT query_id, '{"found":0,"page":1,"hits":[]}' FROM t WHERE found = 0""",
        docs=_BIG,
        extra=f""", t AS ({_FOUND}), p AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, p_retailprice, id) AS INTEGER) AS rank FROM h),
        l AS (SELECT query_id, list({{'rank': rank, 'id': id, 'score': score, 'p_name': p_name, 'p_retailprice': p_retailprice}} ORDER BY rank) AS hits FROM p WHERE rank <= 10 GROUP BY 1),
        c AS (SELECT query_id, p_brand AS value, count(*) AS n FROM h GROUP BY ALL),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY n DESC, value) AS INTEGER) AS rank FROM c),
        v AS (SELECT query_id, list({{'field': 'p_brand', 'rank': rank, 'value': value, 'n': n}} ORDER BY rank) AS facets FROM r WHERE rank <= 10 GROUP BY 1)""",
    ),
)
def result_json(spark, sf):
    queries = requests(spark, PRODUCT_QUERIES)
    found = run(
        products(spark, sf).select(*PRODUCT_COLUMNS), queries, Match(("p_name", "p_type"), **EXACT_ONLY),
        Page(order=(rank.desc("score"), rank.asc("p_retailprice")), sort_by=("p_retailprice",), facet_by=("p_brand",)), gt("p_size", 10),
    )
    return as_json(found, ["p_name", "p_retailprice"])


# --- facets and groups ------------------------------------------------------------

_FACETS = "SELECT query_id, unnest(['p_brand', 'p_type', 'p_size']) AS field, unnest([p_brand, p_type, CAST(p_size AS VARCHAR)]) AS value FROM h"
_COUNTS = f", f AS ({_FACETS}), c AS (SELECT query_id, field, value, count(*) AS n FROM f GROUP BY ALL)"
FACETS = ["p_brand", "p_type", "p_size"]


@query("facet_counts", _sql("SELECT * FROM c", extra=_COUNTS))
def facet_counts(spark, sf):
    return facets.facet_counts(_hits(spark, sf), FACETS)


@query(
    "facet_topk",
    _sql(
        "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id, field ORDER BY n DESC, value) AS INTEGER) AS rank FROM c) WHERE rank <= 5",
        extra=_COUNTS,
    ),
)
def facet_topk(spark, sf):
    return facets.top_values(facets.facet_counts(_hits(spark, sf), FACETS), 5)


@query("facet_query", _sql("SELECT * FROM c WHERE starts_with(lower(value), 'brand#1')", extra=_COUNTS))
def facet_query(spark, sf):
    return facets.facet_counts(_hits(spark, sf), ["p_brand", "p_type"], "Brand#1")


@query(
    "facet_array",
    f"""SELECT 'all' AS query_id, 'words' AS field, word AS value, count(*) AS n FROM
    (SELECT unnest(list_distinct({oracle.tokens('text')})) AS word FROM documents) GROUP BY ALL""",
)
def facet_array(spark, sf):
    """Every word of the documents as a facet value, counted per document."""
    from gleaner.functions.text import tokens

    worded = documents(spark, sf).select(F.lit("all").alias("query_id"), F.array_distinct(tokens(F.col("text"))).alias("words"))
    return facets.facet_counts(worded, ["words"])


# Products without a brand: those never sold with a discount of 0.1.
_BRANDED = f"""(SELECT d.* EXCLUDE (p_brand), CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = d.p_partkey AND l_discount = 0.1) THEN p_brand END AS p_brand FROM {PRODUCTS} d)"""


def _branded_hits(spark, sf):
    sold = table(spark, sf, "lineitem").filter("l_discount = 0.1").select(F.col("l_partkey").cast("string").alias("id")).distinct()
    marked = _hits(spark, sf).join(sold.withColumn("sold", F.lit(True)), "id", "left")
    return marked.withColumn("p_brand", F.when(F.col("sold"), F.col("p_brand")))


def _grouped(limit, groups, missing=True, candidates=None):
    kept = "" if missing else " WHERE p_brand IS NOT NULL"
    pool = "k" if candidates is None else f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, p_retailprice, id) AS n FROM k) WHERE n <= {candidates})"
    return _sql(
        f"""SELECT query_id, p_brand, id, group_rank, rank, coalesce(group_found, 0) AS group_found FROM r JOIN g USING (query_id, grp) LEFT JOIN s USING (query_id, grp)
        WHERE rank <= {limit} AND group_rank <= {groups}""",
        docs=_BRANDED,
        extra=f""", k AS (SELECT *, coalesce(p_brand, '-') AS grp FROM h{kept}),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id, grp ORDER BY score DESC, p_retailprice, id) AS INTEGER) AS rank FROM k),
        g AS (SELECT query_id, grp, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, p_retailprice, id) AS INTEGER) AS group_rank FROM r WHERE rank = 1),
        s AS (SELECT query_id, grp, count(*) AS group_found FROM {pool} GROUP BY ALL)""",
    )


def _group(spark, sf, **options):
    order = [rank.desc("score"), rank.asc("p_retailprice")]
    grouped = rank.group_hits(_branded_hits(spark, sf), "p_brand", order, **options)
    return grouped.select("query_id", "p_brand", "id", "group_rank", "rank", "group_found")


@query("group_by", _grouped(2, 8))
def group_by(spark, sf):
    return _group(spark, sf, group_limit=2, groups=8)


@query("group_missing", _grouped(2, 8, missing=False))
def group_missing(spark, sf):
    return _group(spark, sf, group_limit=2, groups=8, include_missing=False)


@query("group_candidates", _grouped(2, 8, candidates=40))
def group_candidates(spark, sf):
    return _group(spark, sf, group_limit=2, groups=8, max_candidates=40)


@query(
    "assembled_page",
    _sql(oracle.top("score DESC, p_retailprice", 10, "score, p_brand", "h"), docs="(SELECT CAST(p_partkey AS VARCHAR) AS id, * FROM part WHERE p_size > 10)"),
)
def assembled_page(spark, sf):
    """The whole plan of a search: filter, match, rank, page."""
    docs = products(spark, sf).select(*PRODUCT_COLUMNS).filter(gt("p_size", 10))
    hits = product_hits(spark, sf, PRODUCT_QUERIES, where=gt("p_size", 10))
    order = (rank.desc("score"), rank.asc("p_retailprice"))
    found = assemble(hits, docs, requests(spark, PRODUCT_QUERIES), Page(order=order, sort_by=("p_retailprice",)))
    return found.hits.select("query_id", "id", "score", "p_brand", "rank")
