"""Checked queries: search log, events, rules and resource tables.

The events table plays the log: a view is a search with hits, an error a
search without, a click a click, a purchase a conversion, a signup custom.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.operators import analytics
from gleaner.session import table, work_path
from gleaner.sources import files, resources
from gleaner.workload import oracle
from gleaner.workload.base import DOCUMENTS, documents, query, rounded, sql_rounded
from gleaner.workload.text import STEMS
from gleaner.workload.relations import CURATIONS

_Q = "'k' || json_extract_string(props, '$.k')"
_LOG = f"""(SELECT ts, CAST(user_id AS VARCHAR) AS user_id, CASE WHEN value > 50 THEN 'shop' ELSE 'help' END AS tag,
    CASE WHEN value > 20 THEN 'products' ELSE 'documents' END AS collection, {_Q} AS q, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS found
    FROM events WHERE event_type IN ('view', 'error'))"""


def asked():
    return F.concat(F.lit("k"), F.get_json_object(F.col("props"), "$.k"))


def searches(spark, sf):
    events = table(spark, sf, "events").filter(F.col("event_type").isin("view", "error"))
    return events.select(
        "ts",
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("value") > 50, "shop").otherwise("help").alias("tag"),
        F.when(F.col("value") > 20, "products").otherwise("documents").alias("collection"),
        asked().alias("q"),
        F.when(F.col("event_type") == "view", 1).otherwise(0).alias("found"),
        (F.col("value") >= 5).alias("enabled"),
    )


def log(spark, sf):
    return analytics.search_log(searches(spark, sf))


@query(
    "search_log",
    f"SELECT CAST(floor(epoch(ts)) AS BIGINT) AS second, user_id, tag, collection, q, found FROM {_LOG.replace('WHERE event_type', 'WHERE value >= 5 AND event_type')}",
)
def search_log(spark, sf):
    """Searches that allow it are logged."""
    kept = analytics.search_log(searches(spark, sf), F.col("enabled"))
    return kept.withColumn("second", F.unix_timestamp(F.col("ts").cast("timestamp"))).drop("ts")


_KIND = "CASE event_type WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'conversion' WHEN 'signup' THEN 'custom' ELSE event_type END"


def raw_events(spark, sf):
    """Events as the JSON an application would send."""
    kind = (
        F.when(F.col("event_type") == "purchase", "conversion")
        .when(F.col("event_type") == "signup", "custom")
        .otherwise(F.col("event_type"))
    )
    body = F.struct(
        kind.alias("type"),
        F.concat(F.lit("shop_"), kind).alias("name"),
        F.struct(
            asked().alias("q"),
            F.col("event_id").cast("string").alias("doc_id"),
            F.col("user_id").cast("string").alias("user_id"),
            (F.col("event_id") % 10 + 1).cast("int").alias("position"),
        ).alias("data"),
    )
    return table(spark, sf, "events").select("event_id", F.to_json(body).alias("body"))


@query(
    "analytics_events",
    f"""SELECT event_id, {_KIND} AS type, 'shop_' || {_KIND} AS name, {_Q} AS q, CAST(event_id AS VARCHAR) AS doc_id, CAST(user_id AS VARCHAR) AS user_id,
    CAST(event_id % 10 + 1 AS INTEGER) AS position, CAST(NULL AS VARCHAR) AS error FROM events WHERE event_type NOT IN ('view', 'error') UNION ALL
    SELECT event_id, NULL, NULL, NULL, NULL, NULL, NULL, 'unknown type ' || event_type FROM events WHERE event_type IN ('view', 'error')""",
)
def analytics_events(spark, sf):
    """Accepted events with their fields; events of an unknown type with the reason."""
    good, rejected = analytics.parse_events(raw_events(spark, sf))
    return good.withColumn("error", F.lit(None).cast("string")).unionByName(rejected.drop("body"), allowMissingColumns=True)


@query("popular_queries", f"SELECT q, count(*) AS count FROM {_LOG} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def popular_queries(spark, sf):
    return analytics.popular_queries(log(spark, sf), 20)


@query("nohits_queries", f"SELECT q, count(*) AS count FROM {_LOG} WHERE found = 0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def nohits_queries(spark, sf):
    return analytics.nohits_queries(log(spark, sf), 20)


@query(
    "popular_by_tag",
    f"SELECT tag, q, count FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY count DESC, q) AS n FROM (SELECT tag, q, count(*) AS count FROM {_LOG} GROUP BY tag, q)) WHERE n <= 5",
)
def popular_by_tag(spark, sf):
    return analytics.popular_queries(log(spark, sf), 5, ["tag"])


RULES = {
    "popular_products": {
        "type": "popular_queries",
        "params": {"source": {"collections": ["products"]}, "destination": {"collection": "popular"}, "limit": 30},
    },
    "everywhere": {
        "type": "popular_queries",
        "name": "popular_everywhere",
        "params": {"source": {"collections": ["products", "documents"]}, "destination": {"collection": "popular"}, "limit": 12},
    },
    "no_results": {
        "type": "nohits_queries",
        "params": {"source": {"collections": ["documents", "products"]}, "destination": {"collection": "misses"}, "limit": 15},
    },
}
_RULES = "(SELECT * FROM " + oracle.values(
    [("popular_products", "popular_queries", ["products"], "popular", 30), ("popular_everywhere", "popular_queries", ["products", "documents"], "popular", 12),
     ("no_results", "nohits_queries", ["documents", "products"], "misses", 15)]
) + " v(name, type, source_collections, destination, lim))"


@query(
    "rules_table",
    f"""SELECT name, type, destination, CAST(lim AS INTEGER) AS "limit", collection, count(*) AS searches FROM
    (SELECT *, unnest(source_collections) AS collection FROM {_RULES}) JOIN {_LOG} USING (collection) GROUP BY ALL""",
)
def rules_table(spark, sf):
    """Rules by source collection, with the searches each would see."""
    rules = resources.rules(spark, RULES).withColumn("collection", F.explode("source_collections"))
    seen = log(spark, sf).groupBy("collection").agg(F.count(F.lit(1)).alias("searches"))
    return rules.join(seen, "collection").select("name", "type", "destination", "limit", "collection", "searches")


@query(
    "run_rules",
    f"""SELECT name AS rule, destination, q, count FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY count DESC, q) AS n FROM
    (SELECT name, destination, q, lim, count(*) AS count FROM (SELECT *, unnest(source_collections) AS collection FROM {_RULES})
    JOIN {_LOG} USING (collection) WHERE type = 'popular_queries' OR found = 0 GROUP BY ALL)) WHERE n <= lim""",
)
def run_rules(spark, sf):
    return analytics.run_rules(log(spark, sf), resources.rules(spark, RULES))


@query("export_popular", f"SELECT q, count(*) AS count FROM {_LOG} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50")
def export_popular(spark, sf):
    """An aggregate exported as JSON lines and read back."""
    path = work_path(spark, "popular")
    files.export_json_lines(analytics.popular_queries(log(spark, sf), 50), path)
    return spark.read.schema("q string, count long").json(path)


_SUMS = f"""(SELECT {_Q} AS q, count(*) FILTER (event_type IN ('view', 'error')) AS searches, count(*) FILTER (event_type = 'click') AS clicks,
    count(*) FILTER (event_type = 'purchase') AS conversions FROM events GROUP BY 1)"""


@query(
    "query_conversion",
    f"""SELECT q, searches, clicks, conversions, {sql_rounded('CASE WHEN searches > 0 THEN clicks / searches END')} AS click_ratio,
    {sql_rounded('CASE WHEN searches > 0 THEN conversions / searches END')} AS conversion_ratio FROM {_SUMS}""",
)
def query_conversion(spark, sf):
    kind = (
        F.when(F.col("event_type").isin("view", "error"), "search")
        .when(F.col("event_type") == "purchase", "conversion")
        .otherwise(F.col("event_type"))
    )
    rows = analytics.query_conversion(table(spark, sf, "events").select(asked().alias("q"), kind.alias("kind")))
    return rows.withColumns({c: rounded(F.col(c)) for c in ("click_ratio", "conversion_ratio")})


@query(
    "click_positions",
    f"""SELECT {_Q} AS q, CAST(user_id AS VARCHAR) AS doc_id, count(*) AS clicks, {sql_rounded('avg(event_id % 10 + 1)')} AS avg_position,
    CAST(min(event_id % 10 + 1) AS INTEGER) AS best_position FROM events WHERE event_type = 'click' GROUP BY ALL""",
)
def click_positions(spark, sf):
    clicks = table(spark, sf, "events").filter("event_type = 'click'").select(
        asked().alias("q"), F.col("user_id").cast("string").alias("doc_id"), (F.col("event_id") % 10 + 1).cast("int").alias("position")
    )
    return analytics.click_positions(clicks).withColumn("avg_position", rounded(F.col("avg_position")))


@query("tag_breakdown", f"SELECT tag, q, count(*) AS searches, count(*) FILTER (found = 0) AS misses FROM {_LOG} GROUP BY ALL")
def tag_breakdown(spark, sf):
    return analytics.tag_breakdown(log(spark, sf))


# Every distinct word of the reference texts as a query against the documents.
_ASKED = f"SELECT 'w' || word AS query_id, word AS q FROM (SELECT DISTINCT unnest({oracle.tokens('text')}) AS word FROM benchmark)"


@query(
    "nohits_words",
    f"""WITH {oracle.search_ctes(DOCUMENTS, ['text'], _ASKED)} SELECT q, CAST(1 AS BIGINT) AS count FROM hits_queries WHERE query_id NOT IN (SELECT query_id FROM hits)""",
)
def nohits_words(spark, sf):
    """Words of the reference texts that find no document: a search feeding the analytics."""
    from gleaner.operators.match import EXACT_ONLY, Match, search
    from gleaner.operators.postings import occurrences, postings
    from gleaner.operators.rank import found

    words = occurrences(table(spark, sf, "benchmark").withColumn("id", F.col("item_id").cast("string")), ["text"])
    batch = words.select(F.concat(F.lit("w"), "token").alias("query_id"), F.col("token").alias("q")).distinct()
    hits = search(postings(documents(spark, sf), ["text"]), batch, Match(("text",), **EXACT_ONLY))
    searched = batch.join(found(hits, batch), "query_id")
    return analytics.nohits_queries(searched)


CONFIG = {
    "synonym_sets": {"products": {"items": {"size": {"synonyms": ["small", "tiny"]}, 3: {"synonyms": ["hot"]}}}},
    "curation_sets": CURATIONS,
    "stemming_dictionaries": STEMS,
    "analytics_rules": RULES,
    "presets": {"wide": {"q": "hot plate", "per_page": 20}},
    "nl_search_models": {},
}


@query(
    "resource_counts",
    """SELECT * FROM (VALUES ('synonym_sets', 2), ('curation_sets', 3), ('presets', 1), ('stemming_dictionaries', 5), ('analytics_rules', 3)) v(kind, n)
    UNION ALL SELECT 'logged_queries', count(DISTINCT json_extract_string(props, '$.k')) FROM events UNION ALL SELECT 'collections', 14""",
)
def resource_counts(spark, sf):
    """Items per declared kind, beside the distinct queries in the log."""
    names = {"synonym_sets": "id", "curation_sets": "rule_id", "presets": "name", "stemming_dictionaries": "word", "analytics_rules": "name"}
    tables = {kind: (rows, names[kind]) for kind, rows in resources.load(spark, CONFIG).items()}
    tables["logged_queries"] = (log_all(spark, sf), "q")
    tables["collections"] = (_table_names(spark, sf), "name")
    return resources.resource_counts(tables)


def log_all(spark, sf):
    return table(spark, sf, "events").select(asked().alias("q"))


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _table_names(spark, sf):
    from gleaner.operators.schema import profile

    return profile([(t, table(spark, sf, t)) for t in TABLES]).filter("documents > 0").select(F.col("collection").alias("name"))
