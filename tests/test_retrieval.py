"""Vectors, unions, conversations, requests in plain words, analytics and streams."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.functions.vectors import distance
from gleaner.operators import analytics, conversation, knn, translate, union
from gleaner.operators.embed import EMBEDDERS, auto_embed, from_column
from gleaner.operators.fanout import fan_out
from gleaner.operators.match import EXACT_ONLY, Match
from gleaner.operators.rank import desc
from gleaner.plans.search import Page, as_json, run
from gleaner.session import local_table, work_path
from gleaner.sources import resources
from gleaner.sources.store import latest
from gleaner.streaming import changes, popular

DIM = 8


def cloud(n, seed=0, copies=0):
    rnd = np.random.default_rng(seed)
    points = rnd.normal(size=(n, DIM))
    if copies:
        points[:copies] = points[0]
    return points.astype(np.float32)


def vector_table(spark, points, name="id"):
    return local_table(spark, [(f"v{i:03d}", [float(x) for x in p]) for i, p in enumerate(points)], f"{name} string, vector array<float>")


def brute(points, queries, k, metric):
    out = set()
    for j, q in enumerate(queries.astype(float)):
        p = points.astype(float)
        if metric == "l2sq":
            d = ((p - q) ** 2).sum(axis=1)
        elif metric == "ip":
            d = 1 - p @ q
        else:
            d = 1 - p @ q / (np.linalg.norm(p, axis=1) * np.linalg.norm(q))
        best = sorted(zip(np.round(d, 9), [f"v{i:03d}" for i in range(len(p))]))[:k]
        out |= {(f"v{j:03d}", doc, n) for n, (_, doc) in enumerate(best, 1)}
    return out


def triples(df):
    return {(r["query_id"], r["id"], r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("metric", ["cosine", "ip", "l2sq"])
def test_exact_neighbours_with_many_equal_vectors(spark, metric):
    points, queries = cloud(400, 1, copies=130), cloud(6, 2)
    docs = vector_table(spark, points).repartition(5)
    assert triples(knn.knn(docs, vector_table(spark, queries, "query_id"), 7, metric)) == brute(points, queries, 7, metric)


def test_more_queries_than_one_block(spark, monkeypatch):
    points, queries = cloud(60, 1), cloud(9, 2)
    monkeypatch.setattr(knn, "QUERIES_PER_BLOCK", 4)
    monkeypatch.setattr(knn, "SCANNED", 7)
    assert triples(knn.knn(vector_table(spark, points), vector_table(spark, queries, "query_id"), 3)) == brute(points, queries, 3, "cosine")


def test_neighbours_of_a_document_leave_it_out(spark):
    docs = vector_table(spark, cloud(50, 3, copies=5))
    wanted = local_table(spark, [("q", "v000"), ("none", "v999")], "query_id string, id string")
    got = knn.knn_by_id(docs, wanted, 6).collect()
    assert len(got) == 6 and "v000" not in {r["id"] for r in got}


def test_threshold_and_no_queries(spark):
    docs = vector_table(spark, cloud(50, 3))
    queries = vector_table(spark, cloud(2, 4), "query_id")
    near = knn.knn(docs, queries, 50, threshold=0.6).collect()
    assert near and max(r["distance"] for r in near) <= 0.6
    assert knn.knn(docs, queries.limit(0), 5).count() == 0


def test_distance_columns_agree_with_the_scan(spark):
    docs = vector_table(spark, cloud(20, 5))
    one = cloud(1, 6)
    for metric in ("cosine", "ip", "l2sq"):
        scanned = {r["id"]: r["distance"] for r in knn.knn(docs, vector_table(spark, one, "query_id"), 20, metric).collect()}
        target = F.array(*[F.lit(float(x)) for x in one[0]])
        columns = {r["id"]: r["d"] for r in docs.select("id", distance(F.col("vector"), target, metric).alias("d")).collect()}
        assert scanned == pytest.approx(columns, abs=1e-8)


def test_cells_in_one_part_and_in_many_agree_and_recall_is_high(spark, monkeypatch):
    rnd = np.random.default_rng(9)
    centres = rnd.normal(size=(12, DIM)) * 4
    points = (centres[rnd.integers(0, 12, 600)] + rnd.normal(size=(600, DIM))).astype(np.float32)
    queries = points[::60]
    docs, asked = vector_table(spark, points), vector_table(spark, queries, "query_id")
    model = knn.fit_cells(docs, 8)
    placed = knn.assign_cells(docs, model)
    scanned = triples(knn.knn_cells(placed, asked, model, 10, probes=3))
    monkeypatch.setattr(knn, "VECTORS_PER_PART", 20)
    monkeypatch.setattr(knn, "QUERIES_PER_BLOCK", 3)
    assert scanned == triples(knn.knn_cells(placed, asked, model, 10, probes=3))
    exact = brute(points, queries, 10, "cosine")
    found = {(q, d) for q, d, _ in scanned}
    assert len(found & {(q, d) for q, d, _ in exact}) >= 0.9 * len(exact)
    assert triples(knn.knn_cells(placed, asked, model, 10, probes=8)) == exact


def test_fused_ranks(spark):
    text = local_table(spark, [("q", "a", 1), ("q", "b", 2)], "query_id string, id string, rank int")
    near = local_table(spark, [("q", "b", 1), ("q", "c", 2)], "query_id string, id string, rank int")
    got = {r["id"]: r["fused"] for r in knn.fuse(text, near, 0.7, 0.3).collect()}
    assert got == pytest.approx({"a": 0.7 / 61, "b": 0.7 / 62 + 0.3 / 61, "c": 0.3 / 62})


def greedy(points, distances, k, balance):
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    chosen = []
    while len(chosen) < min(k, len(points)):
        gains = []
        for i in range(len(points)):
            if i in chosen:
                continue
            near = max((float(unit[i] @ unit[j]) for j in chosen), default=0.0)
            gains.append((-round(balance * (1 - distances[i]) - (1 - balance) * near, 9), distances[i], i))
        chosen.append(min(gains)[2])
    return chosen


@pytest.mark.parametrize("balance", [0.0, 0.3, 0.5, 1.0])
def test_diversified_order_against_brute_force(spark, balance):
    points = cloud(40, 7).astype(float)
    near = knn.knn(vector_table(spark, points), vector_table(spark, cloud(1, 8), "query_id"), 40)
    rows = near.join(vector_table(spark, points), "id")
    listed = sorted(near.collect(), key=lambda r: (r["distance"], r["id"]))
    order = [int(r["id"][1:]) for r in listed]
    expected = greedy(points.astype(np.float32).astype(float)[order], [r["distance"] for r in listed], 10, balance)
    for working in (1024, 6, 1):
        got = [r["id"] for r in knn.diversify(rows, 10, balance, working=working).orderBy("rank").collect()]
        assert got == [listed[i]["id"] for i in expected]


def test_diversified_lists_are_as_long_as_asked_for(spark):
    near = knn.knn(vector_table(spark, cloud(400, 7)), vector_table(spark, cloud(1, 8), "query_id"), 400)
    rows = near.join(vector_table(spark, cloud(400, 7)), "id").cache()
    assert knn.diversify(rows, 300).count() == 300
    assert knn.diversify(rows, 300, depth=20).count() == 20


def test_embedding_models_by_name(spark):
    docs = local_table(spark, [("1", "red", "ring"), ("2", "red", "ring"), ("3", "", "")], "id string, a string, b string")
    rows = {r["id"]: r["embedding"] for r in auto_embed(docs, ["a", "b"]).collect()}
    assert rows["1"] == rows["2"] and len(rows["1"]) == 256
    assert np.linalg.norm(rows["1"]) == pytest.approx(1) and not any(rows["3"])
    EMBEDDERS["length"] = from_column(lambda text: F.array(F.length(text).cast("float")))
    assert auto_embed(docs, ["a", "b"], "length").first()["embedding"] == [8.0]


# --- several collections ---------------------------------------------------------------


def test_presets_fill_what_a_request_leaves_open(spark):
    requests = local_table(spark, [("a", "p", None, 3), ("b", "p", "own", None), ("c", None, None, None)], "query_id string, preset string, q string, per_page int")
    presets = local_table(spark, [("p", "stored", None)], "name string, q string, per_page int")
    got = union.with_presets(requests, presets, ["q", "per_page"], common={"per_page": 7}, defaults={"q": "*", "per_page": 10})
    assert {tuple(r) for r in got.collect()} == {("a", "stored", 3), ("b", "own", 7), ("c", "*", 7)}


def copies(spark):
    base = [f"w{i}" for i in range(60)]
    near = base[:57] + ["x", "y", "z"]
    far = base[:20] + [f"z{i}" for i in range(40)]
    texts = {"a": base, "b": base, "c": near, "d": far, "e": ["solo"]}
    rows = [("q", "docs" if k < "c" else "refs", k, 100 - n, " ".join(t)) for n, (k, t) in enumerate(texts.items())]
    return local_table(spark, rows, "query_id string, _collection string, id string, score int, text string")


def test_copies_and_near_copies(spark):
    order = [desc("score"), F.col("id").asc()]
    hits = copies(spark)
    marked = hits.withColumn("fingerprint", union.fingerprint(F.col("text")))
    assert {r["id"] for r in union.drop_copies(marked, order).collect()} == {"a", "c", "d", "e"}
    assert {r["id"] for r in union.drop_near_copies(hits, "text", order).collect()} == {"a", "d", "e"}
    assert {r["id"] for r in union.drop_near_copies(hits, "text", order, similarity=0.99).collect()} == {"a", "c", "d", "e"}


@pytest.mark.parametrize("wanted, window", [(250, 250), (60, 5), (7, 3), (1, 1)])
def test_near_copies_against_brute_force(spark, wanted, window):
    rnd = random.Random(4)
    base = [rnd.choice("abcdefgh") * rnd.randint(1, 2) for _ in range(40)]
    texts = []
    for _ in range(60):
        words = list(base) if rnd.random() < 0.7 else [rnd.choice("ijklmn") for _ in range(30)]
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(len(words))] = "zz"
        texts.append(words)
    shingles = lambda w: {tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))}
    kept = []
    for n, words in enumerate(texts):
        mine = shingles(words)
        if all(len(mine & o) < 0.8 * len(mine | o) for _, o in kept):
            kept.append((f"d{n:02d}", mine))
    rows = [("q", "c", f"d{n:02d}", 100 - n, " ".join(t)) for n, t in enumerate(texts)]
    hits = local_table(spark, rows, "query_id string, _collection string, id string, score int, text string")
    got = union.drop_near_copies(hits, "text", [desc("score"), F.col("id").asc()], wanted, window=window)
    assert {r["id"] for r in got.collect()} == {d for d, _ in kept[:wanted]}


def test_near_copies_keep_all_different_hits(spark):
    rows = [(q, "c", f"d{n}", 1000 - n, " ".join(f"w{n % 400}x{i}" for i in range(6)) + (" end" if n >= 400 else "")) for q in "ab" for n in range(500)]
    hits = local_table(spark, rows, "query_id string, _collection string, id string, score int, text string")
    got = union.drop_near_copies(hits, "text", [desc("score"), F.col("id").asc()], similarity=0.75)
    assert {(r["query_id"], r["id"]) for r in got.collect()} == {(q, f"d{n}") for q in "ab" for n in range(400)}
    assert got.count() == 800 and got.columns == hits.columns


def test_whole_search_and_json(spark):
    docs = local_table(spark, [("1", "red ring", "a", 5), ("2", "red rod", "b", 9), ("3", "blue ring", "a", 1)], "id string, name string, brand string, price int")
    queries = local_table(spark, [("x", "red"), ("y", "nothing"), ("z", "ring")], "query_id string, q string")
    found = run(docs, queries, Match(("name",), **EXACT_ONLY), Page(order=(desc("price"),), sort_by=("price",), facet_by=("brand",)), F.col("price") > 2)
    assert [(r["query_id"], r["id"], r["rank"]) for r in found.hits.orderBy("query_id", "rank").collect()] == [("x", "2", 1), ("x", "1", 2), ("z", "1", 1)]
    assert {r["query_id"]: r["found"] for r in found.summary.collect()} == {"x": 2, "y": 0, "z": 1}
    assert {(r["query_id"], r["value"], r["n"]) for r in found.facets.collect()} == {("x", "a", 1), ("x", "b", 1), ("z", "a", 1)}
    text = {r["query_id"]: r["result"] for r in as_json(found, ["name"]).collect()}
    assert '"found":2' in text["x"] and '"hits":[]' in text["y"] and '"name":"red rod"' in text["x"]


def test_star_queries_and_hidden_hits(spark):
    docs = local_table(spark, [(str(i), f"ring {i}", i) for i in range(30)], "id string, name string, price int")
    queries = local_table(spark, [("all", " * "), ("one", "7"), ("also", "*")], "query_id string, q string")
    hidden = local_table(spark, [("all", "29"), ("one", "8")], "query_id string, id string")
    page = Page(order=(desc("price"),), sort_by=("price",), per_page=2)
    found = run(docs, queries, Match(("name",), **EXACT_ONLY), page, F.col("price") > 3, hidden=hidden)
    assert {r["query_id"]: r["found"] for r in found.summary.collect()} == {"all": 25, "one": 1, "also": 26}
    got = {(r["query_id"], r["rank"]): r["id"] for r in found.hits.collect()}
    assert got == {("all", 1): "28", ("all", 2): "27", ("also", 1): "29", ("also", 2): "28", ("one", 1): "7"}


# --- conversations and plain words --------------------------------------------------------


def long_talk(spark, n=1300):
    rows = [(1, t, "user" if t % 2 else "assistant", " ".join(["w"] * (t % 5 + 1))) for t in range(n)]
    return rows, local_table(spark, rows + [(2, 0, "user", "hi there")], "conv_id long, turn long, role string, text string")


def test_history_and_budget_of_a_very_long_conversation(spark):
    rows, turns = long_talk(spark)
    got = {r["turn"]: r["history"] for r in conversation.history(turns).filter("conv_id = 1").collect()}
    texts = [r[3] for r in rows]
    assert got == {t: texts[max(0, t - 6):t] for t in range(len(rows))}
    used, total = {}, 0
    for t, text in enumerate(texts):
        total += len(text.split())
        used[t] = total
    kept = {r["turn"]: r["used"] for r in conversation.context_budget(turns, 2500).filter("conv_id = 1").collect()}
    assert kept == {t: u for t, u in used.items() if u <= 2500} and len(kept) > 700


def test_history_counts_turns_not_turn_numbers(spark):
    rows = [(1, 10 * t, "user", f"t{t}") for t in range(9)]
    turns = local_table(spark, rows, "conv_id long, turn long, role string, text string")
    got = {r["turn"]: r["history"] for r in conversation.history(turns, 3).collect()}
    assert got == {10 * t: [f"t{k}" for k in range(max(0, t - 3), t)] for t in range(9)}


def test_answers_and_transcript(spark):
    turns = local_table(spark, [(1, 0, "user", "hi")], "conv_id long, turn long, role string, text string")
    page = local_table(spark, [("q", "d2", 2, "second"), ("q", "d1", 1, "first")], "query_id string, id string, rank int, text string")
    found = conversation.contexts(page, "text")
    assert tuple(found.first()) == ("q", ["d1", "d2"], ["first", "second"])
    asked = local_table(spark, [("q", 1, "what?"), ("r", 9, "new?")], "query_id string, conversation_id long, q string")
    answered = conversation.answer(asked, found)
    rows = [tuple(r) for r in conversation.transcript(turns, answered).orderBy("conv_id", "turn").collect()]
    assert rows == [(1, 0, "user", "hi"), (1, 1, "user", "what?"), (1, 2, "assistant", "first"), (9, 0, "user", "new?"), (9, 1, "assistant", "")]


def test_answers_know_the_history(spark):
    asked = local_table(
        spark, [("q", 1, "and?", ["a", "b"]), ("r", 2, "new?", []), ("s", 3, "odd?", None)],
        "query_id string, conversation_id long, q string, history array<string>",
    )
    found = local_table(spark, [("q", ["d1"], ["first"]), ("r", ["d1"], ["first"])], "query_id string, source_ids array<string>, context array<string>")
    got = {r["query_id"]: r["answer"] for r in conversation.answer(asked, found, "follow-up").collect()}
    assert got == {"q": "b | first", "r": "first", "s": ""}


def test_requests_in_plain_words(spark):
    translate.TRANSLATORS["t"] = translate.rule_translator({"price": "price"}, {"red": "color"})
    docs = local_table(spark, [("1", 5.0, "red"), ("2", 50.0, "red"), ("3", 1.0, "blue")], "id string, price double, color string")
    asked = local_table(spark, [("a", "Red with price under 10"), ("b", "price over 3"), ("c", "any")], "query_id string, natural_language_query string")
    params = translate.translate(asked, "t")
    assert {r["q"] for r in params.collect()} == {"*"}
    hits = fan_out(docs, translate.conditions(params, docs, extra=F.col("price") < 40))
    assert {(r["query_id"], r["id"]) for r in hits.collect()} == {("a", "1"), ("b", "1"), ("c", "1"), ("c", "3")}
    with pytest.raises(ValueError):
        translate.conditions(params, docs, most=2)


# --- analytics and streams --------------------------------------------------------------


def test_events_are_typed_or_rejected(spark):
    bodies = [
        '{"type":"click","name":"n","data":{"q":"x","doc_id":"1","user_id":"u","position":2}}',
        '{"type":"purchase","name":"n","data":{}}', "not json", '{"type":"custom","data":{"q":"y"}}',
    ]
    good, bad = analytics.parse_events(local_table(spark, [(i, b) for i, b in enumerate(bodies)], "n int, body string"))
    assert [(r["n"], r["type"], r["q"], r["position"]) for r in good.collect()] == [(0, "click", "x", 2)]
    assert {r["n"]: r["error"] for r in bad.collect()} == {1: "unknown type purchase", 2: "not an event", 3: "missing name"}


def test_rules_cut_to_their_own_limits(spark):
    log = local_table(spark, [("p", "a", 1)] * 3 + [("p", "b", 0)] * 2 + [("d", "a", 0)] * 2 + [("d", "c", 5)], "collection string, q string, found int")
    config = {
        "top": {"type": "popular_queries", "params": {"source": {"collections": ["p", "d"]}, "destination": {"collection": "t"}, "limit": 2}},
        "miss": {"type": "nohits_queries", "params": {"source": {"collections": ["d"]}, "destination": {"collection": "m"}}},
    }
    got = {tuple(r) for r in analytics.run_rules(log, resources.rules(spark, config)).collect()}
    assert got == {("top", "t", "a", 5), ("top", "t", "b", 2), ("miss", "m", "a", 2)}


CHANGES = "op string, collection string, id string, seq long, ts timestamp"


def test_stream_of_changes_in_several_batches(spark):
    source, log, checkpoint = (work_path(spark, n) for n in ("source", "log", "checkpoint"))
    rows = lambda *r: local_table(spark, [(op, c, i, n, None) for op, c, i, n in r], CHANGES)
    present = {"docs": local_table(spark, [("1", "a"), ("2", "b")], "id string, name string")}

    def apply():
        stream = changes.listed(spark.readStream.schema(CHANGES).parquet(source), ["products"])
        changes.maintain(stream, lambda: present["docs"], log, checkpoint).awaitTermination()
        return {tuple(r) for r in latest(spark.read.parquet(log).drop("epoch")).collect()}

    rows(("upsert", "products", "1", 1), ("upsert", "products", "2", 2), ("upsert", "products", "9", 3), ("upsert", "other", "1", 9)).write.mode("append").parquet(source)
    assert apply() == {("1", "a"), ("2", "b")}
    present["docs"] = local_table(spark, [("1", "new")], "id string, name string")
    rows(("upsert", "products", "1", 4), ("delete", "products", "2", 5)).write.mode("append").parquet(source)
    assert apply() == {("1", "new")}
    assert apply() == {("1", "new")}


def test_stream_mode_is_checked(spark):
    with pytest.raises(ValueError):
        changes.maintain(spark.readStream.format("rate").load(), lambda: None, "x", "y", mode="later")


def test_switched_off_maintenance_sees_no_change(spark):
    rows = local_table(spark, [("upsert", "products", "1", 1, None)], CHANGES)
    assert changes.listed(rows, ["products"], enabled=False).count() == 0


def test_streamed_counts_equal_the_batch(spark):
    source, path, checkpoint = (work_path(spark, n) for n in ("searches", "counts", "counts-checkpoint"))
    rows = local_table(spark, [("a",), ("b",), ("a",)], "q string")
    for expected in ({("a", 2), ("b", 1)}, {("a", 4), ("b", 2)}):
        rows.write.mode("append").parquet(source)
        popular.count_queries(spark.readStream.schema("q string").parquet(source), path, checkpoint).awaitTermination()
        assert {tuple(r) for r in popular.current_counts(spark, path).collect()} == expected
