"""Order, pages, groups, pins, facets and the balanced building blocks."""

import random

import pytest
from pyspark.sql import functions as F

from gleaner.functions import decay, geo
from gleaner.functions.skew import broadcast_checked, ordinals, spread, top_by, top_n
from gleaner.operators import curation, facets, highlight, rank
from gleaner.operators.fanout import REQUESTS_PER_SCAN, fan_out
from gleaner.session import local_table


def rows_of(spark, seed=5, n=600):
    rnd = random.Random(seed)
    rows = [("hot" if rnd.random() < 0.6 else f"q{rnd.randint(1, 4)}", f"d{i:04d}", rnd.randint(0, 6)) for i in range(n)]
    return rows, local_table(spark, rows, "query_id string, id string, score int").repartition(7)


def ranked(rows):
    out = {}
    for q, i, s in sorted(rows, key=lambda r: (r[0], -r[2], r[1])):
        out.setdefault(q, []).append(i)
    return {(q, i): n for q, ids in out.items() for n, i in enumerate(ids, 1)}


def as_ranks(df, name="rank"):
    return {(r["query_id"], r["id"]): r[name] for r in df.collect()}


def order():
    return [F.col("score").desc(), F.col("id").asc()]


def test_ordinals_number_all_rows_of_hot_groups(spark):
    rows, df = rows_of(spark)
    assert as_ranks(ordinals(df, ["query_id"], order())) == ranked(rows)


def test_ordinals_without_keys(spark):
    rows, df = rows_of(spark)
    flat = [("all", i, s) for _, i, s in rows]
    found = ordinals(df.withColumn("query_id", F.lit("all")), [], order())
    assert as_ranks(found) == ranked(flat)


@pytest.mark.parametrize("n", [1, 10, 1001])
def test_top_n(spark, n):
    rows, df = rows_of(spark, n=3000)
    assert as_ranks(top_n(df, ["query_id"], order(), n)) == {k: v for k, v in ranked(rows).items() if v <= n}


def test_top_by_takes_the_limit_from_the_row(spark):
    rows, df = rows_of(spark)
    limited = df.withColumn("n", F.when(F.col("query_id") == "hot", 40).otherwise(3))
    expected = {k: v for k, v in ranked(rows).items() if v <= (40 if k[0] == "hot" else 3)}
    assert as_ranks(top_by(limited, ["query_id"], order(), "n")) == expected


def test_broadcast_is_checked_by_rows_and_bytes(spark, monkeypatch):
    from gleaner.functions import skew

    df = spark.range(100).withColumn("n", F.lit(10))
    assert broadcast_checked(df)[1] == 100 and broadcast_checked(df, most=99)[1] == 100
    assert broadcast_checked(df, size=F.col("n"))[1] == 100
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 999)
    assert broadcast_checked(df, size=F.col("n"))[1] is None


def test_spread_leaves_enough_partitions_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == cores
    many = spark.range(10, numPartitions=cores + 3)
    assert spread(many) is many


def test_pages(spark):
    rows, df = rows_of(spark)
    df = df.withColumn("weight", F.lit(1))
    everything = ranked(rows)
    pick = lambda lo, hi: {k: v for k, v in everything.items() if lo < v <= hi}
    assert as_ranks(rank.page(df, rank.default_order(), page=3, per_page=10)) == pick(20, 30)
    assert as_ranks(rank.page(df, rank.default_order(), offset=5, per_page=10)) == pick(5, 15)
    assert as_ranks(rank.page(df, rank.default_order(), page=2, per_page=10, limit_hits=12)) == pick(10, 12)
    with pytest.raises(ValueError):
        rank.page(df, [], per_page=251)
    with pytest.raises(ValueError):
        rank.page(df, [], page=0)


def test_page_facts(spark):
    totals = local_table(spark, [("a", 100), ("b", 95), ("c", 0), ("d", 3), ("e", 25)], "query_id string, found long")
    facts = {r["query_id"]: r for r in rank.page_facts(totals, 2, 10).collect()}
    assert [facts[q]["last_page"] for q in "abcde"] == [10, 10, 1, 1, 3]
    assert facts["e"]["has_next"] and facts["e"]["next_page"] == 3 and facts["e"]["previous_page"] == 1
    assert not facts["d"]["has_next"] and facts["d"]["next_page"] is None


def test_found_counts_queries_without_hits(spark):
    queries = local_table(spark, [("hot", ""), ("nothing", "")], "query_id string, q string")
    rows, df = rows_of(spark)
    found = {r["query_id"]: r["found"] for r in rank.found(df, queries).collect()}
    assert found == {"hot": sum(q == "hot" for q, _, _ in rows), "nothing": 0}


@pytest.mark.parametrize("buckets", [1, 4, 7, 1000])
def test_score_buckets_are_those_of_ntile(spark, buckets):
    from pyspark.sql import Window

    _, df = rows_of(spark)
    tile = F.ntile(buckets).over(Window.partitionBy("query_id").orderBy(*order()))
    assert as_ranks(rank.score_buckets(df, buckets), "bucket") == as_ranks(df.withColumn("bucket", tile), "bucket")


def test_groups_rank_as_their_best_hit(spark):
    rows = [("q", "1", 5, "a"), ("q", "2", 9, "b"), ("q", "3", 7, "a"), ("q", "4", 1, None), ("q", "5", 8, "b"), ("q", "6", 2, "a")]
    df = local_table(spark, rows, "query_id string, id string, score int, brand string")
    grouped = rank.group_hits(df, "brand", [F.col("score").desc()], group_limit=2)
    got = {r["id"]: (r["brand"], r["group_rank"], r["rank"], r["group_found"]) for r in grouped.collect()}
    assert got == {"2": ("b", 1, 1, 2), "5": ("b", 1, 2, 2), "3": ("a", 2, 1, 3), "1": ("a", 2, 2, 3), "4": (None, 3, 1, 1)}
    without = rank.group_hits(df, "brand", [F.col("score").desc()], include_missing=False, groups=1)
    assert {r["id"] for r in without.collect()} == {"2", "5"}


def place(organic, pins, end):
    """Insert the pins one by one, in order of their places."""
    out = [d for d in organic if d not in {p for p, _ in pins}]
    for doc, position in sorted(pins, key=lambda p: (p[1], p[0])):
        out.insert(position - 1, doc)
    return out[:end]


def test_pins_against_one_by_one_insertion(spark):
    rnd = random.Random(11)
    rows, pins, expected = [], [], {}
    for case in range(60):
        q = f"c{case}"
        organic = [f"d{i:02d}" for i in range(rnd.randint(0, 15))]
        rows += [(q, d, 100 - n) for n, d in enumerate(organic)]
        chosen = rnd.sample(range(25), rnd.randint(0, 5))
        places = rnd.sample(range(1, 12), len(chosen))
        mine = [(f"d{c:02d}", p) for c, p in zip(chosen, places)]
        pins += [(q, d, p) for d, p in mine]
        expected[q] = place(organic, mine, 10)
    hits = local_table(spark, rows, "query_id string, id string, score int")
    table = local_table(spark, pins, "query_id string, id string, position int")
    got = {}
    for r in curation.pin(hits, table, [F.col("score").desc()], 10).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["id"])
    assert got == {q: ids for q, ids in expected.items() if ids}


def test_two_pins_on_one_place_take_the_next(spark):
    hits = local_table(spark, [("q", x, 10 - n) for n, x in enumerate("abcd")], "query_id string, id string, score int")
    pins = local_table(spark, [("q", "x", 2), ("q", "y", 2)], "query_id string, id string, position int")
    got = curation.pin(hits, pins, [F.col("score").desc()], 10).orderBy("rank").collect()
    assert [r["id"] for r in got] == ["a", "x", "y", "b", "c", "d"]


def test_rules_match_on_normalised_text_and_tags(spark):
    from gleaner.sources import resources

    config = {"s": {"items": {"r": {"rule": {"query": "I-Phone", "tags": ["t"]}, "includes": [{"id": 15, "position": 1}], "excludes": [{"id": "x"}]}}}}
    rules = resources.curations(spark, config)
    queries = local_table(spark, [("a", "i phone!"), ("b", "phone")], "query_id string, q string")
    got = {(r["query_id"], r["action"], r["id"], r["position"]) for r in curation.applicable_rules(queries, rules).collect()}
    assert got == {("a", "include", "15", 1), ("a", "exclude", "x", None)}
    assert curation.applicable_rules(queries, rules, tags=["other"]).count() == 0
    assert curation.applicable_rules(queries, rules, enabled=False).count() == 0


def test_facets_of_lists_and_prefix(spark):
    rows = [("q", ["red", "blue"], "Big"), ("q", ["red"], None), ("q", None, "big")]
    df = local_table(spark, rows, "query_id string, tags array<string>, size string")
    counts = {(r["field"], r["value"]): r["n"] for r in facets.facet_counts(df, ["tags", "size"]).collect()}
    assert counts == {("tags", "red"): 2, ("tags", "blue"): 1, ("size", "Big"): 1, ("size", "big"): 1}
    few = facets.facet_counts(df, ["tags", "size"], "B").collect()
    assert {r["value"] for r in few} == {"blue", "Big", "big"}
    top = facets.top_values(facets.facet_counts(df, ["tags"]), 1).collect()
    assert [(r["value"], r["rank"]) for r in top] == [("red", 1)]


def test_highlight_and_snippet(spark):
    text = " ".join(f"w{i}" for i in range(40)).replace("w20", "Ring,")
    df = local_table(spark, [(text, ["ring"]), ("a Ring-master b", ["ring"]), ("none here", ["ring"])], "t string, marks array<string>")
    got = df.select(highlight.highlight(F.col("t"), F.col("marks")).alias("h"), highlight.snippet(F.col("t"), F.col("marks")).alias("s")).collect()
    assert "<mark>Ring</mark>," in got[0]["h"] and got[0]["h"].startswith("w0 ")
    assert got[0]["s"] == "w16 w17 w18 w19 <mark>Ring</mark>, w21 w22 w23 w24"
    assert got[1]["h"] == "a <mark>Ring</mark>-master b" == got[1]["s"]
    assert got[2]["s"] == "none here"
    kept = local_table(spark, [("a  b\nc, B!", ["b"]), ("", ["b"]), (None, ["b"])], "t string, marks array<string>")
    got = [r["h"] for r in kept.select(highlight.highlight(F.col("t"), F.col("marks")).alias("h")).collect()]
    assert got == ["a  <mark>b</mark>\nc, <mark>B</mark>!", "", None]


def test_fan_out_over_more_requests_than_one_scan(spark):
    df = spark.range(5).withColumn("id", F.col("id").cast("string"))
    wanted = {f"r{i}": F.col("id") == str(i % 7) for i in range(REQUESTS_PER_SCAN + 20)}
    got = {(r["query_id"], r["id"]) for r in fan_out(df, wanted).collect()}
    assert got == {(f"r{i}", str(i % 7)) for i in range(REQUESTS_PER_SCAN + 20) if i % 7 < 5}


def test_geo(spark):
    places = [("paris", 48.8566, 2.3522), ("london", 51.5074, -0.1278), ("sydney", -33.8688, 151.2093)]
    df = local_table(spark, places, "id string, lat double, lon double")
    km = {r["id"]: r["km"] for r in df.select("id", geo.distance_km(F.col("lat"), F.col("lon"), 48.8566, 2.3522).alias("km")).collect()}
    assert km["paris"] == pytest.approx(0, abs=1e-6) and km["london"] == pytest.approx(343.5, abs=1)
    assert [r["id"] for r in df.filter(geo.within_km(F.col("lat"), F.col("lon"), 48.8566, 2.3522, 400)).collect()] == ["paris", "london"]
    box = [(45.0, 0.0), (45.0, 5.0), (50.0, 5.0), (50.0, 0.0)]
    assert [r["id"] for r in df.filter(geo.in_polygon(F.col("lat"), F.col("lon"), box)).collect()] == ["paris"]


def test_decay_is_one_at_the_origin_and_the_factor_at_scale(spark):
    df = local_table(spark, [(50.0,), (53.0,), (63.0,), (500.0,)], "x double")
    for curve in (decay.gauss, decay.exponential, decay.linear):
        values = [r["v"] for r in df.select(curve(F.col("x"), 50, 10, 3, 0.5).alias("v")).collect()]
        assert values[:3] == pytest.approx([1, 1, 0.5]) and 0 <= values[3] < 0.01


def test_seeded_order_is_stable(spark):
    _, df = rows_of(spark)
    first = as_ranks(rank.page(df, [rank.seeded_order(42)]))
    assert first == as_ranks(rank.page(df.repartition(3), [rank.seeded_order(42)]))
    assert first != as_ranks(rank.page(df, [rank.seeded_order(43)]))
