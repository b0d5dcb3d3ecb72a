"""Hybrid pages against the fusion of whole lists."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.operators import fusion, knn


def tables(spark, seed, docs=300, hit_share=0.4):
    rnd = np.random.default_rng(seed)
    points = rnd.normal(size=(docs, 4)).round(1)  # many equal distances
    asked = rnd.normal(size=(3, 4)).round(1)
    hits = [
        (f"q{q}", f"d{i:03d}", int(rnd.integers(0, 6)), int(rnd.integers(0, 2)))
        for q in range(3) for i in range(docs + 40) if rnd.random() < (hit_share if q else 0.01)
    ]
    vector = "array<double>"
    return (
        spark.createDataFrame(hits, "query_id string, id string, score long, weight int"),
        spark.createDataFrame([(f"d{i:03d}", p.tolist()) for i, p in enumerate(points)], f"id string, vector {vector}"),
        spark.createDataFrame([(f"q{q}", a.tolist()) for q, a in enumerate(asked)], f"query_id string, vector {vector}"),
        hits, points, asked,
    )


def expected(hits, points, asked, page, a, b, c):
    out = []
    for q, v in enumerate(asked):
        text = sorted((h for h in hits if h[0] == f"q{q}"), key=lambda h: (-h[2], -h[3], h[1]))
        d = 1 - points @ v / (np.linalg.norm(points, axis=1) * np.linalg.norm(v))
        near = sorted((round(x, 9), f"d{i:03d}") for i, x in enumerate(d))
        t = {h[1]: n for n, h in enumerate(text, 1)}
        n = {i: r for r, (_, i) in enumerate(near, 1)}
        fused = {i: (a / (c + t[i]) if i in t else 0) + (b / (c + n[i]) if i in n else 0) for i in t.keys() | n.keys()}
        best = sorted((-round(f, 9), i) for i, f in fused.items())[:page]
        out += [(f"q{q}", i, place) for place, (_, i) in enumerate(best, 1)]
    return out


@pytest.mark.parametrize("page,a,b,c", [(5, 0.5, 0.5, 60), (10, 0.7, 0.3, 60), (7, 0.1, 0.9, 3), (4, 1.0, 0.0, 60), (4, 0.0, 1.0, 5), (1, 0.5, 0.5, 0)])
def test_page_equals_that_of_whole_lists(spark, page, a, b, c):
    hits, docs, queries, *plain = tables(spark, page)
    found = fusion.fused_page(hits, docs, queries, page, a, b, c).collect()
    assert sorted((r["query_id"], r["id"], r["rank"]) for r in found) == sorted(expected(*plain, page, a, b, c))


def test_ranks_beyond_the_cut_are_counted(spark, monkeypatch):
    monkeypatch.setattr(fusion, "SCANNED", 13)
    monkeypatch.setattr(knn, "QUERIES_PER_BLOCK", 2)
    hits, docs, queries, *_ = tables(spark, 2, docs=120)
    whole = knn.knn(docs, queries, 1000).select("query_id", "id", F.col("rank").cast("long").alias("vector_rank"))
    wanted = whole.filter("vector_rank % 3 = 1")
    found = fusion._vector_ranks(docs, queries, wanted.select("query_id", "id"), "cosine")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    order = F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score DESC, weight DESC, id)").cast("long")
    listed = hits.withColumn("text_rank", order).filter("text_rank % 4 = 3").select("query_id", "id", "text_rank")
    missed = listed.select("query_id", "id").unionByName(spark.createDataFrame([("q1", "unknown")], "query_id string, id string"))
    assert sorted(map(tuple, fusion._text_ranks(hits, missed).collect())) == sorted(map(tuple, listed.collect()))


def test_empty_lists(spark):
    hits, docs, queries, *plain = tables(spark, 4, docs=50)
    assert fusion.fused_page(hits.filter("false"), docs, queries, 5).count() == 15
    assert fusion.fused_page(hits, docs.filter("false"), queries, 5).filter("query_id = 'q1'").count() == 5
    with pytest.raises(ValueError):
        fusion.safe_depth(10, 0.0, 0.0)
