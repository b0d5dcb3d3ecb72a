"""Checked queries: tokens, keyword matching, synonyms, stemming, highlighting."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions.text import tokens
from gleaner.operators import highlight as marks
from gleaner.operators import rank
from gleaner.operators.levels import match_documents
from gleaner.operators.lexical import synonym_pairs
from gleaner.operators.match import EXACT_ONLY, Match, search
from gleaner.operators.postings import occurrences, postings
from gleaner.operators.schema import Collection, Field
from gleaner.plans.indexing import build_index, read_index
from gleaner.session import table, work_path
from gleaner.sources import resources
from gleaner.sources.store import Store
from gleaner.workload import oracle
from gleaner.workload.base import (
    DOCUMENT_QUERIES, DOCUMENTS, PRODUCT_QUERIES, PRODUCTS, documents, products, query, requests,
)

NAME_TYPE = ["p_name", "p_type"]


def product_hits(spark, sf, rows, fields=NAME_TYPE, where=None, **options):
    docs = products(spark, sf) if where is None else products(spark, sf).filter(where)
    how = Match(tuple(fields), **(EXACT_ONLY | options))
    return match_documents(docs, list(fields), requests(spark, rows), how)


def document_hits(spark, sf, rows, **options):
    how = Match(("text",), **(EXACT_ONLY | options))
    return match_documents(documents(spark, sf), ["text"], requests(spark, rows), how)


def on_products(key, rows, fields=NAME_TYPE, spark_options=None, **sql_options):
    """Register a keyword search over products returning all hits."""

    @query(key, oracle.search(PRODUCTS, list(fields), rows, **sql_options))
    def run(spark, sf):
        return product_hits(spark, sf, rows, fields, **(spark_options or {}))

    return run


# --- tokens and exact matching ------------------------------------------------


@query(
    "token_postings",
    f"""SELECT id, field, unnest(toks) AS token, CAST(unnest(range(len(toks))) AS INTEGER) AS pos FROM (
        SELECT CAST(doc_id AS VARCHAR) AS id, 'text' AS field, {oracle.tokens('text')} AS toks FROM documents
        UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'p_brand',
        {oracle.tokens('p_brand', '[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}#]+')} FROM part)""",
)
def token_postings(spark, sf):
    texts = occurrences(documents(spark, sf), ["text"])
    brands = occurrences(products(spark, sf), [Field("p_brand", "string", symbols_to_index=("#",))])
    return texts.unionByName(brands).select("id", "field", "token", "pos")


on_products("search_exact", PRODUCT_QUERIES)


@query("search_documents", oracle.search(DOCUMENTS, ["text"], DOCUMENT_QUERIES))
def search_documents(spark, sf):
    return document_hits(spark, sf, DOCUMENT_QUERIES)


_long = (
    "SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS query_id, text AS q "
    "FROM conversations WHERE role = 'user'"
)


@query("search_turns", oracle.search(DOCUMENTS, ["text"], _long, drop_threshold=1))
def search_turns(spark, sf):
    """Every user turn is a query of any length; tokens are dropped where nothing holds them all."""
    turns = table(spark, sf, "conversations").filter("role = 'user'")
    batch = turns.select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query_id"), F.col("text").alias("q"))
    how = Match(("text",), **(EXACT_ONLY | {"drop_tokens_threshold": 1}))
    return match_documents(documents(spark, sf), ["text"], batch, how)


WEIGHTS = {"p_name": 2, "p_type": 5}
MIXED = [("w1", "large plate"), ("w2", "small small"), ("w3", "medium"), ("w4", "small ring")]


@query(
    "search_weighted",
    oracle.search(PRODUCTS, NAME_TYPE, MIXED, oracle.top("score DESC, weight DESC", 20, "score, weight"), weights=WEIGHTS),
)
def search_weighted(spark, sf):
    hits = product_hits(spark, sf, MIXED, weights=WEIGHTS)
    return rank.page(hits, rank.default_order(), per_page=20).select("query_id", "id", "score", "weight", "rank")


PREFIXES = [("p1", "red wid"), ("p2", "sma"), ("p3", "eco"), ("p4", "old r"), ("p5", "small widgetwidgetwidget")]
on_products("search_prefix", PREFIXES, spark_options={"prefix": True}, prefix=NAME_TYPE)
on_products(
    "search_prefix_per_field", PREFIXES, spark_options={"prefix": {"p_name": True, "p_type": False}}, prefix=["p_name"]
)

INFIXES = [("i1", "idge"), ("i2", "red late"), ("i3", "in"), ("i4", "ring"), ("i5", "tandar")]
on_products(
    "search_infix", INFIXES,
    spark_options={"infix": {"p_name": "always", "p_type": "fallback"}},
    infix={"p_name": "always", "p_type": "fallback"},
)
on_products("search_infix_fallback", INFIXES, ["p_name"], spark_options={"infix": "fallback"}, infix={"p_name": "fallback"})

MISSPELT = [("t1", "red wigdet"), ("t2", "smal ring"), ("t3", "widgetts"), ("t4", "ecnoomy"), ("t5", "rde"), ("t6", "lage plat")]
on_products("search_typos", MISSPELT, spark_options={"num_typos": 2}, num_typos=2)

CODES = [("c1", "brand1"), ("c2", "brnd 17"), ("c3", "brand 17x1"), ("c4", "1234 brand")]
on_products(
    "typos_alnum", CODES, ["p_brand"], spark_options={"num_typos": 2, "typos_on_digits": True, "drop_tokens_threshold": 1},
    num_typos=2, typos_on_digits=True, drop_threshold=1,
)
on_products(
    "typo_threshold", [("h1", "bolt"), ("h2", "gear"), ("h3", "hot rod")], ["p_name"],
    spark_options={"num_typos": 1, "typo_tokens_threshold": 2000}, num_typos=1, typo_threshold=2000,
)
on_products(
    "drop_tokens", [("r1", "red widget unknown"), ("r2", "small ring economy"), ("r3", "nothing red")],
    spark_options={"drop_tokens_threshold": 40}, drop_threshold=40,
)



@query("indexed_search", oracle.search(PRODUCTS, NAME_TYPE, MISSPELT, num_typos=2, prefix=NAME_TYPE))
def indexed_search(spark, sf):
    """The same kind of search on an index written beforehand."""
    store = Store(spark, work_path(spark, "index"))
    shop = Collection("products", tuple(Field(f, "string") for f in NAME_TYPE))
    build_index(store, shop, products(spark, sf), "products_v1")
    found, words = read_index(store, shop)
    how = Match(tuple(NAME_TYPE), num_typos=2, drop_tokens_threshold=0)
    return search(found, requests(spark, MISSPELT), how, words)


# --- scores ------------------------------------------------------------------

for _type, _key in (("max_score", "score_max"), ("max_weight", "score_max_weight"), ("sum_score", "score_sum")):
    on_products(
        _key, MIXED, spark_options={"text_match_type": _type, "weights": WEIGHTS}, match_type=_type, weights=WEIGHTS
    )
on_products("ranking_tokens", MIXED, spark_options={"ranking_tokens": 1}, ranking_tokens=1)
on_products("exact_boost", MIXED, spark_options={"prioritize_exact_match": False}, exact=False)


@query("position_boost", oracle.search(DOCUMENTS, ["text"], DOCUMENT_QUERIES, position=True))
def position_boost(spark, sf):
    return document_hits(spark, sf, DOCUMENT_QUERIES, prioritize_token_position=True)


on_products("fields_boost", MIXED, spark_options={"prioritize_num_matching_fields": True}, num_fields=True)

# --- synonyms and stemming ------------------------------------------------------

SETS = {
    "products": {
        "items": {
            "size": {"synonyms": ["small", "tiny", "mini"]},
            "cog": {"root": "cog", "synonyms": ["gear", "old rod"]},
            3: {"synonyms": ["hot", "red"]},
        }
    },
}
SCOPED = {"products": [{"id": "finger", "root": "finger jewel", "synonyms": ["ring"]}], "other": [{"id": "x", "synonyms": ["plate", "bolt"]}]}
FLAT = [{"id": "w", "synonyms": ["widget", "gadget"]}]
ITEMS = oracle.values(
    [("any", "products", "size", None, ["small", "tiny", "mini"]), ("any", "products", "cog", "cog", ["gear", "old rod"]),
     ("any", "products", "3", None, ["hot", "red"]), ("products", "products", "finger", "finger jewel", ["ring"]),
     ("other", "other", "x", None, ["plate", "bolt"]), ("any", "global", "w", None, ["widget", "gadget"])]
)
PAIRS = f"""SELECT t.collection, t."set", t.id, t.term, unnest(list_filter(t.synonyms, lambda e: t.root IS NOT NULL OR e <> t.term)) AS expansion
 FROM (SELECT *, unnest(CASE WHEN root IS NULL THEN synonyms ELSE [root] END) AS term FROM {ITEMS} i(collection, "set", id, root, synonyms)) t"""
PAIRS_FOR_PRODUCTS = f"SELECT term, expansion FROM ({PAIRS}) WHERE collection IN ('any', 'products')"
ONE_WAY = f"SELECT term, expansion FROM ({PAIRS}) WHERE collection IN ('any', 'products') AND id IN ('cog', 'finger')"
SYNONYM_QUERIES = [("s1", "tiny gadget"), ("s2", "cog"), ("s3", "gear"), ("s4", "finger jewel"), ("s5", "mini red ring"), ("s6", "plate")]


def pairs(spark):
    return synonym_pairs(resources.synonyms(spark, SETS, SCOPED, FLAT))


@query(
    "synonym_table",
    f"""WITH docs AS {PRODUCTS}, words AS (SELECT token, count(DISTINCT id) AS n FROM (SELECT id, unnest({oracle.tokens('p_name')}) AS token FROM docs) GROUP BY token)
    SELECT "set", p.id, term, expansion, coalesce(w.n, 0) AS products FROM ({PAIRS}) p LEFT JOIN words w ON p.expansion = w.token""",
)
def synonym_table(spark, sf):
    """Synonym pairs with the number of products that hold the expansion."""
    words = occurrences(products(spark, sf), ["p_name"]).groupBy("token").agg(F.count_distinct("id").alias("n"))
    joined = pairs(spark).join(words, F.col("expansion") == F.col("token"), "left")
    return joined.select("set", "id", "term", "expansion", F.coalesce("n", F.lit(0)).alias("products"))


def on_synonyms(key, rows, chosen=None, sql=PAIRS_FOR_PRODUCTS, sql_options=None, **options):
    @query(key, oracle.search(PRODUCTS, ["p_name"], rows, synonyms=sql, **(sql_options or {})))
    def run(spark, sf):
        table = pairs(spark) if chosen is None else pairs(spark).filter(F.col("id").isin(*chosen))
        return product_hits(spark, sf, rows, ["p_name"], synonyms=table, collection="products", **options)


on_synonyms("search_synonyms", SYNONYM_QUERIES)
on_synonyms("search_synonyms_oneway", SYNONYM_QUERIES, ["cog", "finger"], ONE_WAY)
PARTS = "SELECT * FROM (VALUES ('thing', 'wid'), ('thing', 'bo'), ('coin', 'sm ri')) v(term, expansion)"


@query(
    "synonym_prefix",
    oracle.search(PRODUCTS, ["p_name"], [("x1", "thing"), ("x2", "red thing"), ("x3", "coin")], synonyms=PARTS, synonym_prefix=True),
)
def synonym_prefix(spark, sf):
    rows = [("x1", "thing"), ("x2", "red thing"), ("x3", "coin")]
    items = resources.synonyms(
        spark, {"s": {"items": {"a": {"root": "thing", "synonyms": ["wid", "bo"]}, "b": {"root": "coin", "synonyms": ["sm ri"]}}}}
    )
    return product_hits(spark, sf, rows, ["p_name"], synonyms=synonym_pairs(items), synonym_prefix=True)


on_synonyms(
    "synonym_typos", [("y1", "tinny ring"), ("y2", "gadgt"), ("y3", "cogg")], synonym_num_typos=1,
    sql_options={"synonym_typos": 1},
)

STEMS = {"en": [{"word": "widgets", "root": "widget"}, {"word": "gears", "root": "gear"}, {"word": "bolted", "root": "bolt"},
                {"word": "ring", "root": "rod"}, {"word": "rods", "root": "rod"}]}
STEM_SQL = "SELECT * FROM " + oracle.values([(w["word"], w["root"]) for w in STEMS["en"]]) + " v(word, root)"
STEM_QUERIES = [("m1", "red widgets"), ("m2", "gears"), ("m3", "ring"), ("m4", "old rods"), ("m5", "rod")]


@query("search_stemmed", oracle.search(PRODUCTS, ["p_name"], STEM_QUERIES, stemming=STEM_SQL))
def search_stemmed(spark, sf):
    dictionary = resources.stemming(spark, STEMS)
    return product_hits(spark, sf, STEM_QUERIES, ["p_name"], stemming=dictionary)


# --- highlighting -----------------------------------------------------------------


def _sql_words(text):
    return f"list_filter(string_split_regex({text}, '\\s+'), lambda w: w <> '')"


_HIT = "list_has_any(string_split(trim(regexp_replace(lower(w), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' '), marks)"


def _sql_marked(text):
    pieces = f"regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+')"
    return f"array_to_string(list_transform({pieces}, lambda p: CASE WHEN list_contains(marks, lower(p)) THEN '<mark>' || p || '</mark>' ELSE p END), '')"


def _shown(select):
    return (
        f"WITH {oracle.search_ctes(DOCUMENTS, ['text'], DOCUMENT_QUERIES)}, best AS ({oracle.top('score DESC, weight DESC', 10, 'score')}), "
        f"shown AS (SELECT b.query_id, b.id, b.rank, d.text, list_distinct({oracle.tokens('q.q')}) AS marks, {_sql_words('d.text')} AS ws "
        f"FROM best b JOIN {DOCUMENTS} d USING (id) JOIN hits_queries q USING (query_id)) {select}"
    )


def _page_with_marks(spark, sf):
    queries = requests(spark, DOCUMENT_QUERIES)
    shown = rank.page(document_hits(spark, sf, DOCUMENT_QUERIES), rank.default_order())
    texts = documents(spark, sf).select("id", "text")
    return rank.attach(shown, texts).join(marks.query_marks(queries), "query_id")


@query(
    "highlight",
    f"WITH {oracle.search_ctes(PRODUCTS, ['p_name'], PRODUCT_QUERIES, prefix=['p_name'])}, "
    f"words AS (SELECT query_id, list(DISTINCT token) AS marks FROM hits_cand GROUP BY query_id) "
    f"SELECT h.query_id, h.id, {_sql_marked('d.p_name')} AS highlight FROM hits h JOIN {PRODUCTS} d USING (id) JOIN words USING (query_id)",
)
def highlight(spark, sf):
    """All matched vocabulary tokens are marked, also those found by prefix."""
    from gleaner.operators.match import candidates, tokenize_queries
    from gleaner.operators.postings import vocabulary

    queries = requests(spark, PRODUCT_QUERIES)
    how = Match(("p_name",), **(EXACT_ONLY | {"prefix": True}))
    found = postings(products(spark, sf), ["p_name"])
    words = candidates(tokenize_queries(queries), vocabulary(found), how)
    hits = search(found, queries, how).join(products(spark, sf).select("id", "p_name"), "id")
    marked = marks.matched_tokens(hits, words)
    return marked.select("query_id", "id", marks.highlight(F.col("p_name"), F.col("marks")).alias("highlight"))


_INEXACT = dict(prefix=True, num_typos=2)


@query(
    "highlight_inexact",
    f"WITH {oracle.search_ctes(PRODUCTS, ['p_name'], MISSPELT, prefix=['p_name'], num_typos=2)}, "
    f"best AS ({oracle.top('score DESC, weight DESC', 10, 'score')}), "
    f"words AS (SELECT query_id, list(DISTINCT token) AS marks FROM hits_cand WHERE field = 'p_name' GROUP BY query_id) "
    f"SELECT b.query_id, b.id, b.rank, {_sql_marked('d.p_name')} AS highlight FROM best b JOIN {PRODUCTS} d USING (id) JOIN words USING (query_id)",
)
def highlight_inexact(spark, sf):
    """Whole fields of a page with every hit marked: as typed, as a prefix, or misspelt."""
    from gleaner.operators.match import candidates, tokenize_queries
    from gleaner.operators.postings import vocabulary

    queries = requests(spark, MISSPELT)
    how = Match(("p_name",), **(EXACT_ONLY | _INEXACT))
    listed = postings(products(spark, sf), ["p_name"])
    words = vocabulary(listed)
    page = rank.page(search(listed, queries, how, words), rank.default_order())
    texts = rank.attach(page, products(spark, sf).select("id", "p_name"))
    marked = marks.matched_tokens(texts, candidates(tokenize_queries(queries), words, how).filter("field = 'p_name'"))
    return marked.select("query_id", "id", "rank", marks.highlight(F.col("p_name"), F.col("marks")).alias("highlight"))


@query("highlight_full", _shown(f"SELECT query_id, id, rank, {_sql_marked('text')} AS highlight FROM shown"))
def highlight_full(spark, sf):
    page = _page_with_marks(spark, sf)
    return page.select("query_id", "id", "rank", marks.highlight(F.col("text"), F.col("marks")).alias("highlight"))


_FIRST = f"coalesce(list_position(list_transform(ws, lambda w: {_HIT}), true), 0)"


@query(
    "snippet",
    _shown(
        f", cut AS (SELECT *, {_FIRST} AS f FROM shown) SELECT query_id, id, rank, "
        + _sql_marked("array_to_string(CASE WHEN len(ws) < 30 THEN ws ELSE list_slice(ws, greatest(1, f - 4), greatest(f, 1) + 4) END, ' ')")
        + " AS snippet FROM cut"
    ),
)
def snippet(spark, sf):
    page = _page_with_marks(spark, sf)
    return page.select("query_id", "id", "rank", marks.snippet(F.col("text"), F.col("marks")).alias("snippet"))
