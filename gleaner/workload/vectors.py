"""Checked queries: nearest neighbours, hybrid ranking, diversification, embedding."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions.vectors import distance
from gleaner.operators import knn as nn
from gleaner.operators.cells import build_cells, search_cells
from gleaner.operators.embed import auto_embed
from gleaner.operators.fusion import fused_page
from gleaner.session import local_table, table, work_path
from gleaner.sources.store import Store
from gleaner.workload import oracle
from gleaner.workload.base import DOCUMENTS, documents, query, rounded, sql_rounded, vectors
from gleaner.workload.text import document_hits

_COS = "1 - list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v))"
_IP = "1 - list_dot_product(a.v, b.v)"
_L2 = "list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
_DOCS = "(SELECT CAST(vec_id AS VARCHAR) AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"
_CENTRES = """(SELECT 'label' || CAST(label AS VARCHAR) AS query_id, list(m ORDER BY i) AS v FROM (SELECT label, i, avg(x) AS m FROM
    (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY ALL) GROUP BY 1)"""


def centres(spark, sf):
    """One query vector per label: the mean of its vectors."""
    parts = vectors(spark, sf).select("label", F.posexplode("vector").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    # A list of as many entries as the vectors have dimensions.
    joined = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("l"))
    return joined.select(F.concat(F.lit("label"), F.col("label").cast("string")).alias("query_id"), F.col("l.m").alias("vector"))


def _nearest(k, formula=_COS, queries=_CENTRES, where="true"):
    return f"""SELECT query_id, id, {sql_rounded('round(d, 9)')} + 0.0 AS distance, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), id) AS INTEGER) AS rank
    FROM (SELECT query_id, b.id, {formula} AS d FROM {queries} a, {_DOCS} b) WHERE {where}) WHERE rank <= {k}"""


def _shown(found):
    return found.select("query_id", "id", (rounded(F.col("distance")) + 0.0).alias("distance"), "rank")


@query("knn_exact", _nearest(10))
def knn_exact(spark, sf):
    return _shown(nn.knn(vectors(spark, sf), centres(spark, sf), 10))


for _key, _metric, _formula in (("knn_cosine", "cosine", _COS), ("knn_ip", "ip", _IP), ("knn_l2sq", "l2sq", _L2)):

    @query(_key, _nearest(25, _formula))
    def by_metric(spark, sf, metric=_metric):
        return _shown(nn.knn(vectors(spark, sf), centres(spark, sf), 25, metric))


IDS = [("n1", "0"), ("n2", "17"), ("n3", "321"), ("n4", "499"), ("n5", "missing")]
_BY_ID = f"(SELECT query_id, w.id AS self, v FROM {oracle.values(IDS)} w(query_id, id) JOIN {_DOCS} d ON d.id = w.id)"


@query(
    "knn_by_id",
    f"""SELECT query_id, id, {sql_rounded('round(d, 9)')} + 0.0 AS distance, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), id) AS INTEGER) AS rank
    FROM (SELECT query_id, b.id, {_COS} AS d FROM {_BY_ID} a, {_DOCS} b WHERE b.id <> a.self)) WHERE rank <= 15""",
)
def knn_by_id(spark, sf):
    wanted = local_table(spark, IDS, "query_id string, id string")
    return _shown(nn.knn_by_id(vectors(spark, sf), wanted, 15))


@query("vector_threshold", _nearest(50, where="round(d, 9) <= 0.8"))
def vector_threshold(spark, sf):
    return _shown(nn.knn(vectors(spark, sf), centres(spark, sf), 50, threshold=0.8))


@query(
    "label_distances",
    f"""SELECT label, count(*) AS n, {sql_rounded('avg(d)', 5)} AS mean_distance FROM (SELECT b.label, {_COS} AS d FROM {_CENTRES} a JOIN {_DOCS} b
    ON a.query_id = 'label' || CAST(b.label AS VARCHAR)) GROUP BY 1""",
)
def label_distances(spark, sf):
    """Distances as column expressions: every vector to the centre of its label."""
    joined = vectors(spark, sf).withColumn("query_id", F.concat(F.lit("label"), F.col("label").cast("string"))).join(
        centres(spark, sf).withColumnRenamed("vector", "centre"), "query_id"
    )
    measured = joined.withColumn("d", distance(F.col("centre"), F.col("vector")))
    return measured.groupBy("label").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("d"), 5).alias("mean_distance"))


@query("knn_ann")
def knn_ann(spark, sf):
    docs = vectors(spark, sf)
    model = nn.fit_cells(docs, 16)
    found = nn.knn_cells(nn.assign_cells(docs, model), centres(spark, sf), model, 10, probes=12)
    return _shown(found)


# Cells, and cells probed: vectors without structure need most of them.
CELLS, PROBED = 16, 14


@query("stored_cells", "SELECT 'label' || CAST(label AS VARCHAR) AS query_id, 20 AS hits, true AS found FROM embeddings GROUP BY label")
def stored_cells(spark, sf):
    """Neighbours from stored cells against exact ones: whether each query has at least 0.9 of them."""
    store = Store(spark, work_path(spark, "cells"))
    wanted = centres(spark, sf)
    build_cells(store, "documents", vectors(spark, sf), "v1", CELLS)
    near = search_cells(store, "documents", wanted, 20, PROBED).select("query_id", "id", F.lit(1).alias("hit"))
    exact = nn.knn(vectors(spark, sf), wanted, 20).select("query_id", "id")
    both = exact.join(near, ["query_id", "id"], "left").groupBy("query_id")
    return both.agg(F.count(F.lit(1)).cast("int").alias("hits"), (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("found"))


_TEXTS = [("label0", "the of"), ("label3", "der und"), ("label7", "is that")]


@query(
    "hybrid",
    f"""WITH {oracle.search_ctes(DOCUMENTS, ['text'], _TEXTS)}, t AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, weight DESC, id) AS rank FROM hits),
    n AS (SELECT query_id, id, rank FROM ({_nearest(10**9)}) WHERE query_id IN ('label0', 'label3', 'label7')),
    f AS (SELECT query_id, id, coalesce(0.7 / (60 + t.rank), 0) + coalesce(0.3 / (60 + n.rank), 0) AS fused FROM t FULL OUTER JOIN n USING (query_id, id)),
    r AS (SELECT *, {sql_rounded('fused', 9)} AS shown FROM f) {oracle.top('shown DESC', 20, 'shown AS fused', 'r')}""",
)
def hybrid(spark, sf):
    """All text matches and all vectors of the same documents in one ranking."""
    wanted = centres(spark, sf).filter(F.col("query_id").isin(*[q for q, _ in _TEXTS]))
    return fused_page(document_hits(spark, sf, _TEXTS), vectors(spark, sf), wanted, 20, 0.7, 0.3)


# Neighbours among which mmr chooses: the candidates of the operator are the top k, and this is its k.
MMR_CANDIDATES = 50


def _candidates(spark, sf):
    docs = vectors(spark, sf)
    near = nn.knn(docs, centres(spark, sf), MMR_CANDIDATES)
    return near.join(docs.select("id", "vector"), "id")


def _diverse(k, balance):
    """Greedy choice step by step: each step joins what is left with the similarities to what was picked."""
    sim = "list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v))"
    return f"""WITH RECURSIVE near AS ({_nearest(MMR_CANDIDATES)}),
    c AS MATERIALIZED (SELECT n.query_id, n.id, round({_COS}, 9) AS d, b.v FROM near n JOIN {_CENTRES} a USING (query_id) JOIN {_DOCS} b ON b.id = n.id),
    s AS MATERIALIZED (SELECT a.query_id, a.id, b.id AS other, {sim} AS sim FROM c a JOIN c b ON a.query_id = b.query_id AND a.id <> b.id),
    g AS (
      SELECT DISTINCT query_id, 0 AS n, []::VARCHAR[] AS picks FROM c
      UNION ALL
      SELECT query_id, n + 1, list_append(picks, arg_min(id, (-gain, d, id))) FROM (
        SELECT query_id, n, picks, id, d, round({balance} * (1 - d) - {1 - balance} * coalesce(closest, 0), 9) AS gain FROM (
        SELECT g.query_id, g.n, g.picks, c.id, c.d, max(s.sim) AS closest FROM g JOIN c ON c.query_id = g.query_id AND NOT list_contains(g.picks, c.id)
        LEFT JOIN s ON s.query_id = g.query_id AND s.id = c.id AND list_contains(g.picks, s.other)
        WHERE g.n < {k} GROUP BY g.query_id, g.n, g.picks, c.id, c.d)) GROUP BY query_id, n, picks)
    SELECT query_id, id, {sql_rounded('d')} + 0.0 AS distance, CAST(list_position(picks, id) AS INTEGER) AS rank
    FROM g JOIN c USING (query_id) WHERE n = {k} AND list_contains(picks, id)"""


@query("mmr", _diverse(10, 0.5))
def mmr(spark, sf):
    return _shown(nn.diversify(_candidates(spark, sf), 10))


@query("mmr_relevance", _nearest(10))
def mmr_relevance(spark, sf):
    """Pure relevance is the plain order of neighbours."""
    return _shown(nn.diversify(_candidates(spark, sf), 10, 1.0))


@query("auto_embed")
def embed_documents(spark, sf):
    embedded = auto_embed(documents(spark, sf), ["lang", "text"])
    return embedded.select("id", F.size("embedding").alias("dimensions"), "embedding")


@query("search_by_text_vector")
def search_by_text_vector(spark, sf):
    """Reference texts look up the documents nearest to them, embedded by the same model."""
    texts = table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), "text")
    queries = auto_embed(texts, ["text"], out="vector")
    docs = auto_embed(documents(spark, sf), ["text"], out="vector")
    return _shown(nn.knn(docs, queries, 3))
