"""Stored cells against brute force."""

import numpy as np
import pytest

from gleaner.operators import knn
from gleaner.operators.cells import build_cells, search_cells
from gleaner.session import local_table, work_path
from gleaner.sources.store import Store


def vector_table(spark, points, name="id"):
    rows = [(f"v{i:03d}", [float(x) for x in p]) for i, p in enumerate(points)]
    return local_table(spark, [*rows, ("none", None)], f"{name} string, vector array<float>")


def triples(found):
    return {(r["query_id"], r["id"], round(r["distance"], 6)) for r in found.collect()}


@pytest.mark.parametrize("metric", ["cosine", "ip", "l2sq"])
def test_all_cells_give_exact_neighbours(spark, metric):
    rnd = np.random.default_rng(3)
    points = rnd.normal(size=(300, 8))
    points[:20] = points[0]  # ties
    points[20] = 0
    docs, asked = vector_table(spark, points), vector_table(spark, rnd.normal(size=(6, 8)), "query_id")
    store = Store(spark, work_path(spark, "cells"))
    build_cells(store, "docs", docs, "v1", 6, metric, learnt_from=100)
    assert store.read("docs.vectors").count() == 300
    found = search_cells(store, "docs", asked, 10, 6, metric, refine=8)
    assert triples(found) == triples(knn.knn(docs, asked, 10, metric))


def test_few_cells_are_read(spark):
    rnd = np.random.default_rng(4)
    around = rnd.normal(size=(8, 8)) * 10
    points = np.concatenate([c + rnd.normal(size=(60, 8)) for c in around])
    store = Store(spark, work_path(spark, "cells"))
    docs, asked = vector_table(spark, points), vector_table(spark, around[:2], "query_id")
    build_cells(store, "docs", docs, "v1", 8)
    found = search_cells(store, "docs", asked, 10, 2)
    exact = triples(knn.knn(docs, asked, 10))
    assert len(triples(found) & exact) >= 0.9 * len(exact)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    first = next(line for line in plan.splitlines() if "FileScan" in line and "code" in line)
    assert "vector:" not in first.split("ReadSchema")[1]
