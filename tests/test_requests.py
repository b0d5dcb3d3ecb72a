"""Batches with a filter, an order and a page per request, against brute force."""

import random

from pyspark.sql import functions as F

from gleaner.operators.match import EXACT_ONLY, Match
from gleaner.plans import requests as each
from gleaner.session import local_table

INF = float("inf")


def meets(row, condition):
    _, field, value, low, high = condition
    if value is not None:
        return field == "kind" and row["kind"] == value
    x = row.get(field) if field in ("size", "price") else None
    return x is not None and (low is None or x >= low) and (high is None or x <= high)


def expected(rows, asked, conditions, orders):
    out = []
    for query_id, q, page, per_page in asked:
        size, start = per_page or 10, ((page or 1) - 1) * (per_page or 10)
        mine = []
        for row in rows:
            words = (row["name"] or "").split()
            if q != "*" and not all(w in words for w in q.split()):
                continue
            if all(meets(row, c) for c in conditions if c[0] == query_id):
                keys = []
                for _, _, field, down in sorted((o for o in orders if o[0] == query_id), key=lambda o: o[1]):
                    x = row.get(field) if field in ("size", "price") else None
                    keys.append(INF if x is None else -x if down else x)
                same = q != "*" and words == q.split()
                mine.append((keys, not same, row["id"]))
        out += [(query_id, i, n) for n, (_, _, i) in enumerate(sorted(mine), 1) if start < n <= start + size]
    return sorted(out)


def test_requests_of_their_own(spark):
    rng = random.Random(1)
    maybe = lambda x: None if rng.random() < 0.1 else x
    rows = [
        {"id": f"{i:04d}", "name": maybe(" ".join(rng.sample(["red", "blue", "ring", "bolt"], rng.randrange(1, 4)))),
         "kind": maybe(rng.choice("ab")), "size": maybe(rng.randrange(12)), "price": maybe(rng.choice([1.5, 2.5, 9.0]))}
        for i in range(500)
    ]
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], "id string, name string, kind string, size int, price double").withColumn("key", F.lit(1))
    asked, conditions, orders = [], [], []
    for n in range(40):
        q = f"q{n}"
        asked.append((q, rng.choice(["*", "*", "red", "ring bolt", "unheard"]), maybe(rng.randrange(1, 4)), maybe(rng.choice([3, 20, 250]))))
        for _ in range(rng.randrange(3)):
            low, high = maybe(float(rng.randrange(12))), maybe(float(rng.randrange(12)))
            conditions.append(rng.choice([(q, "kind", rng.choice("abz"), None, None), (q, "size", None, low, high), (q, "price", None, low, None)]))
        for place in range(rng.randrange(3)):
            orders.append((q, place, rng.choice(["size", "price"]), rng.random() < 0.5))
    conditions.append(("q0", "unknown", None, 1.0, None))
    tables = (local_table(spark, asked, each.REQUEST), Match(("name",), **EXACT_ONLY), each.Columns(("kind",), ("size", "price")),
              local_table(spark, conditions, each.CONDITION), local_table(spark, orders, each.ORDER))
    found = each.run_each(docs, *tables)
    assert sorted((r["query_id"], r["id"], r["rank"]) for r in found.collect()) == expected(rows, asked, conditions, orders)
    assert each.run_each(docs.filter("false"), *tables).count() == 0


def test_requests_without_conditions_or_columns(spark):
    docs = spark.createDataFrame([("1", "red"), ("2", "blue")], "id string, name string")
    asked = local_table(spark, [("a", "*", None, None), ("b", "red", 1, 1)], each.REQUEST)
    none = lambda ddl: spark.createDataFrame([], ddl)
    found = each.run_each(docs, asked, Match(("name",), **EXACT_ONLY), each.Columns(), none(each.CONDITION), none(each.ORDER))
    assert sorted((r["query_id"], r["id"], r["rank"]) for r in found.collect()) == [("a", "1", 1), ("a", "2", 2), ("b", "1", 1)]
