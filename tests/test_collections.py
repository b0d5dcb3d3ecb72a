"""Declared collections, documents, stored versions, files and resources."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gleaner.operators import schema as s
from gleaner.operators.normalize import nest_many, nested, normalize, normalize_with, project
from gleaner.operators.relations import cascade, check_references, join_reference, unresolved
from gleaner.operators.schema import Collection, Field
from gleaner.plans.indexing import build_index, read_index
from gleaner.plans.reindex import reindex
from gleaner.session import local_table, work_path
from gleaner.sources import files, resources
from gleaner.sources.store import Store, compact, delete_ids, latest, lookup, merge_upserts, tombstones, upserts


def books(**more):
    fields = (Field("title"), Field("genre", facet=True), Field("summary", optional=True), Field("pages"))
    return Collection("books", fields, "pages", True, **more)


def book_rows(spark):
    return local_table(spark, [(1, "T", "g", None, 3)], "id long, title string, genre string, summary string, pages int")


def test_types_are_inferred_and_id_is_no_field(spark):
    rows = local_table(
        spark, [(1, 2, 1.5, True, ["x"], [0.5], datetime(2024, 1, 1), "t")],
        "id long, n int, x double, b boolean, tags array<string>, v array<float>, at timestamp, name string",
    )
    fields = tuple(Field(c) for c in rows.columns) + (Field("vector", embed=("name",)),)
    got = {f.name: f.type for f in s.resolve(Collection("c", fields), rows).fields}
    assert got == {
        "n": "int32", "x": "float", "b": "bool", "tags": "string[]", "v": "float[]", "at": "int64", "name": "string",
        "vector": "float[]",
    }


def test_valid_collection_and_sparse_options(spark):
    collection = s.resolve(books(), book_rows(spark))
    assert s.problems(collection) == []
    assert all(f.options() == {} for f in collection.fields)
    review = Field("productId", "string", reference="products.id", async_reference=True, cascade_delete=False)
    assert review.options() == {"reference": "products.id", "async_reference": "true", "cascade_delete": "false"}
    assert Field("internalCode", "string", index=False).options() == {"index": "false"}
    body = Field("body", "string", truncate=120, token_separators=("-", "/"), symbols_to_index=("+",))
    assert body.options() == {"truncate": "120", "token_separators": "- /", "symbols_to_index": "+"}


@pytest.mark.parametrize(
    "field",
    [
        Field("x", "string", cascade_delete=True), Field("x", "string", async_reference=True),
        Field("x", "string", reference="products"), Field("x", "int32", truncate=5),
        Field("x", "int32", token_separators=("-",)), Field("x", "bool", symbols_to_index=("+",)),
        Field("x", "float[]", vec_dist="cosine"), Field("x", "float[]", num_dim=3, vec_dist="euclidean"),
        Field("x", "bool", sort=True), Field("x", "float[]", ann_params={"m": 16}), Field("x", "decimal"),
    ],
)
def test_broken_field_rules(field):
    assert len(s.problems(Collection("c", (field,)))) == 1
    with pytest.raises(ValueError):
        s.check(Collection("c", (field,)))


@pytest.mark.parametrize("by, rule", [("summary", "optional"), ("title", "numeric"), ("nonexistent", "missing")])
def test_broken_default_sorting_field(spark, by, rule):
    broken = s.resolve(books(), book_rows(spark))
    broken = Collection("books", broken.fields, by)
    assert rule in s.problems(broken)[0][1]


def test_schema_diff_cases(spark):
    table = lambda *f: s.field_table(spark, [Collection("c", tuple(Field(n, t) for n, t in f))])
    got = lambda new, live: {(r["name"], r["change"]) for r in s.diff(new, live).collect()}
    title = ("title", "string")
    assert got(table(title), None) == {("title", "add")}
    assert got(table(title), table(title, ("id", "string"))) == set()
    assert got(table(title, ("author", "string")), table(title, ("id", "string"))) == {("author", "add")}
    assert got(table(title), table(title, ("old", "string"))) == {("old", "drop")}
    assert got(table(("rating", "float")), table(("rating", "int32"))) == {("rating", "conflict")}
    assert s.metadata_changed({"enable_nested_fields": True}, {})
    assert not s.metadata_changed({}, {})


def test_apply_diff(spark):
    docs = local_table(spark, [("1", "a", 2)], "id string, title string, old int")
    out = s.apply_diff(docs, [("author", "add", "string"), ("old", "drop", None)])
    assert out.columns == ["id", "title", "author"] and out.first()["author"] is None
    assert s.apply_diff(docs, []) is docs
    with pytest.raises(ValueError):
        s.apply_diff(docs, [("title", "conflict", None)])
    with pytest.raises(ValueError):
        s.apply_diff(docs, [], metadata=True)


# --- documents -----------------------------------------------------------------

PRODUCT = Collection(
    "products",
    (
        Field("name", "string"), Field("stock", "int32"), Field("price", "float"), Field("available", "bool"),
        Field("description", "string", optional=True), Field("embedding", "float[]", embed=("name",)),
    ),
)
PRODUCT_ROWS = "id long, name string, stock int, price double, available boolean, description string"


def test_product_document(spark):
    rows = local_table(spark, [(1, "Laptop", 100, 9.99, True, None), (None, "x", 1, 1.0, True, None)], PRODUCT_ROWS)
    docs = normalize(rows, PRODUCT).collect()
    assert [d.asDict() for d in docs] == [
        {"id": "1", "name": "Laptop", "stock": 100, "price": 9.99, "available": True, "description": None}
    ]


def test_rows_that_are_not_indexable_give_no_document(spark):
    rows = local_table(spark, [(1, "a", 0, 1.0, True, None), (2, "b", 5, 1.0, True, None)], PRODUCT_ROWS)
    assert [d["id"] for d in normalize(rows, PRODUCT, indexable=F.col("stock") > 0).collect()] == ["2"]


def test_custom_normaliser_keeps_the_id(spark):
    rows = local_table(spark, [(42, "n")], "id long, name string")
    made = normalize_with(rows, lambda df: df.select("id", F.lit("from-method").alias("name"), F.lit(True).alias("extra")), "id")
    assert made.first().asDict() == {"id": "42", "name": "from-method", "extra": True}


@pytest.mark.parametrize(
    "kind, values",
    [
        ("int32", {"12abc": 12, "abc": 0, "": 0, " 7": 7, "-3.9": -3, "1e3": 1000, ".5": 0, None: None}),
        ("int64", {"9007199254740993": 9007199254740993, "5-LOW": 5, "+4": 4}),
        ("float", {"1.5kg": 1.5, "x": 0.0, "-.5": -0.5, None: None}),
        ("bool", {"": False, "0": False, "0.0": True, "false": True, "x": True, None: None}),
        ("string", {"a": "a", None: None}),
    ],
)
def test_strings_to_declared_types(spark, kind, values):
    rows = local_table(spark, [(i, v) for i, v in enumerate(values)], "id long, v string")
    got = normalize(rows, Collection("c", (Field("v", kind),))).collect()
    assert {r["id"]: r["v"] for r in got} == {str(i): want for i, want in enumerate(values.values())}


def test_other_scalars_to_declared_types(spark):
    rows = local_table(
        spark, [(1, 19.0, True, -2.7, 0), (2, 19.25, False, 2.7, 3)], "id long, f double, b boolean, g double, n int"
    )
    fields = (
        Field("f", "string"), Field("b", "string"), Field("g", "int32"), Field("n", "bool"),
        Field("bi", "int64", source="b"), Field("nf", "float", source="n"),
    )
    got = [tuple(r) for r in normalize(rows, Collection("c", fields)).orderBy("id").collect()]
    assert got == [("1", "19", "1", -2, False, 1, 0.0), ("2", "19.25", "", 2, True, 0, 3.0)]


def test_dates_vectors_and_lists(spark):
    rows = local_table(
        spark, [(3, datetime(2024, 1, 15, 12), ["1", "2", "3"], [1.9, -1.9])],
        "id long, created timestamp, vector array<string>, n array<double>",
    )
    fields = (Field("created", "int64"), Field("vector", "float[]", num_dim=3), Field("n", "int32[]"))
    got = normalize(rows, Collection("c", fields)).first()
    assert (got["created"], got["vector"], got["n"]) == (1705320000, [1.0, 2.0, 3.0], [1, -1])


def test_references_and_nested_objects(spark):
    orders = local_table(spark, [(1, 99, "x"), (2, None, None)], "id long, product_id long, product_name string")
    by_id = normalize(orders, Collection("o", (Field("product", "string", source="product_id", reference="products.id"),)))
    assert {r["id"]: r["product"] for r in by_id.collect()} == {"1": "99", "2": None}
    inside = orders.select("id", nested(F.col("product_id"), name=F.col("product_name")).alias("product")).orderBy("id").collect()
    assert inside[0]["product"].asDict() == {"id": "99", "name": "x"} and inside[1]["product"] is None


def test_to_many_lists_stay_whole_and_hot_parents_are_split(spark):
    parents = local_table(spark, [(7,), (8,), (9,)], "id long")
    lines = [(7, n, "item") for n in range(50)] + [(8, 1, "item")]
    children = local_table(spark, lines, "invoice long, line long, label string")
    item = F.struct(F.col("line"), F.col("label"))
    whole = nest_many(parents, children, "id", "invoice", item, "lines", ["line"]).collect()
    assert {r["id"]: len(r["lines"]) for r in whole} == {7: 50, 8: 1, 9: 0}
    split = nest_many(parents, children, "id", "invoice", item, "lines", ["line"], limit=10).collect()
    hot = [r for r in split if r["id"] == 7]
    assert len(hot) > 1 and sorted(x["line"] for r in hot for x in r["lines"]) == list(range(50))
    assert len([r for r in split if r["id"] == 9]) == 1


def test_parts_of_a_hot_parent_are_its_sorted_list(spark):
    parents = local_table(spark, [(7,), (8,), (9,)], "id long")
    children = local_table(spark, [(7, n * 17 % 50) for n in range(50)] + [(8, 1)], "invoice long, line long")
    rows = nest_many(parents, children, "id", "invoice", F.col("line"), "lines", ["line"], limit=10).collect()
    got = {(r["id"], r["part"]): r["lines"] for r in rows}
    assert got == {(7, p): list(range(10 * p, 10 * p + 10)) for p in range(5)} | {(8, 0): [1], (9, 0): []}


def test_truncate_and_project(spark):
    rows = local_table(spark, [(1, "abcdef", "z")], "id long, t string, u string")
    docs = normalize(rows, Collection("c", (Field("t", "string", truncate=3), Field("u", "string"))))
    assert docs.first()["t"] == "abc"
    assert project(docs, include=["u"]).columns == ["id", "u"]
    assert project(docs, exclude=["u"]).columns == ["id", "t"]


def test_relations(spark):
    children = local_table(spark, [("a", "1"), ("b", "2"), ("c", None)], "id string, parent string")
    parents = local_table(spark, [("1", "p")], "pid string, name string")
    assert join_reference(children, parents, "parent", "pid").count() == 3
    assert join_reference(children, parents, "parent", "pid", required=True).count() == 1
    assert [r["id"] for r in unresolved(children, parents, "parent", "pid").collect()] == ["b"]
    good, bad = check_references(children, parents, "parent", "pid")
    assert sorted(r["id"] for r in good.collect()) == ["a", "c"] and [r["id"] for r in bad.collect()] == ["b"]


def test_cascade_goes_down_the_levels_and_stops_at_false(spark):
    dead = local_table(spark, [("1",)], "id string")
    mid = local_table(spark, [("m1", "1"), ("m2", "2")], "id string, parent string")
    low = local_table(spark, [("l1", "m1"), ("l2", "m2"), ("l3", "m1")], "id string, parent string")
    out = cascade(
        {"top": dead},
        [("top", "mid", mid, "parent", "id", None), ("mid", "low", low, "parent", "id", True), ("mid", "kept", low, "parent", "id", False)],
    )
    assert set(out) == {"top", "mid", "low"}
    assert sorted(r["id"] for r in out["low"].collect()) == ["l1", "l3"]


# --- storage ---------------------------------------------------------------------


@pytest.fixture
def store(spark):
    return Store(spark, work_path(spark, "test-store"))


def test_aliases(spark, store):
    docs = local_table(spark, [("1",)], "id string")
    assert store.target("products") is None
    assert store.publish("products", "products_v1", docs) is None
    assert store.publish("products", "products_v2", docs.union(docs)) == "products_v1"
    store.swap("other", "products_v1")
    assert {tuple(r) for r in store.aliases().collect()} == {("products", "products_v2"), ("other", "products_v1")}
    assert store.read("products").count() == 2 and store.read("other").count() == 1
    store.drop_alias("other")
    assert not store.exists("other")
    with pytest.raises(LookupError):
        store.read("other")


def test_create_drop_recreate(spark, store):
    docs = local_table(spark, [("1",)], "id string")
    assert store.create("c", docs.schema)
    assert not store.create("c", docs.schema)
    store.publish("c", "c_v2", docs)
    store.recreate("c", docs.schema, "c_v3")
    assert store.read("c").count() == 0
    assert store.drop("c") and not store.drop("c")


def test_latest_of_a_change_log(spark):
    docs = local_table(spark, [("1", "a", 1), ("1", "b", 3), ("2", "c", 1), ("3", "d", 2)], "id string, v string, n long")
    log = upserts(docs.select("id", "v", "n"), F.col("n")).drop("n").unionByName(
        tombstones(local_table(spark, [("2", 5), ("3", 1)], "id string, n long"), F.col("n")), allowMissingColumns=True
    )
    assert {tuple(r) for r in latest(log).select("id", "v").collect()} == {("1", "b"), ("3", "d")}


def test_upsert_delete_lookup_compact(spark, store):
    live = local_table(spark, [("1", "a"), ("2", "b")], "id string, v string")
    new = local_table(spark, [("2", "x", "upsert", 1), ("2", "y", "upsert", 2), ("3", "z", "upsert", 1)], "id string, v string, op string, seq long")
    merged = merge_upserts(live, new)
    assert {tuple(r) for r in merged.collect()} == {("1", "a"), ("2", "y"), ("3", "z")}
    assert [r["id"] for r in delete_ids(live, local_table(spark, [("1",), ("9",)], "id string")).collect()] == ["2"]
    seen = lookup(live, local_table(spark, [("1",), ("9",)], "id string"))
    assert {r["id"]: (r["exists"], r["v"]) for r in seen.collect()} == {"1": (True, "a"), "9": (False, None)}
    compact(store, "c", "c_v1", new)
    assert {tuple(r) for r in store.read("c").collect()} == {("2", "y"), ("3", "z")}


def test_changes_are_merged_when_read_and_the_version_is_not_shuffled(spark, store):
    shape = "id string, v string, op string, seq long"
    store.publish("c", "c_v1", local_table(spark, [(str(i), "old") for i in range(6)], "id string, v string"))
    assert store.append("c", local_table(spark, [("1", "x", "upsert", 5), ("1", "y", "upsert", 6), ("2", None, "delete", 1), ("7", "new", "upsert", 1)], shape)) == 1
    assert store.append("c", local_table(spark, [("2", "back", "upsert", 2), ("7", None, "delete", 9), ("1", "late", "upsert", 4), ("3", "z", "upsert", 3)], shape)) == 2
    expected = {("0", "old"), ("1", "y"), ("2", "back"), ("3", "z"), ("4", "old"), ("5", "old")}
    read = lambda: sorted(tuple(r) for r in store.read("c").select("id", "v").collect())
    assert read() == sorted(expected)
    assert store.fold("c") == 2 and read() == sorted(expected)
    assert store.append("c", local_table(spark, [("7", None, "delete", 1), ("4", None, "delete", 9)], shape)) == 2
    assert read() == sorted(expected - {("4", "old")})
    plan = store.read("c")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "SortMergeJoin" not in plan
    store.publish("c", "c_v2", store.read("c"))
    assert read() == sorted(expected - {("4", "old")}) and store._changes("c_v2") == (0, [])
    with pytest.raises(LookupError):
        store.append("none", local_table(spark, [], shape))


def test_reindex_counts_and_never_empties_a_collection(spark, store):
    shop = Collection("products", (Field("name", "string"), Field("vector", "float[]", num_dim=2, optional=True)))
    ddl = "id long, name string, vector array<float>"
    rows = local_table(spark, [(1, "a", [0.0, 1.0]), (2, None, None), (3, "c", [1.0])], ddl)
    assert tuple(reindex(store, rows, shop, "v1").first()) == (1, 2, "field 'name' is required")
    assert [r["id"] for r in store.read("products").collect()] == ["1"]
    assert tuple(reindex(store, local_table(spark, [], ddl), shop, "v2").first()) == (0, 0, None)
    assert store.target("products") == "v1"


def test_index_is_read_by_field(spark, store):
    shop = Collection("shop", (Field("name", "string"), Field("kind", "string"), Field("n", "int32")))
    docs = local_table(spark, [("1", "red ring ring", "small", 1), ("2", "red rod", "big", 2)], "id string, name string, kind string, n int")
    build_index(store, shop, docs, "v1")
    found, words = read_index(store, shop)
    got = {tuple(r) for r in found.filter("field = 'name'").select("token", "id", "pos").collect()}
    assert got == {("red", "1", 0), ("ring", "1", 1), ("red", "2", 0), ("rod", "2", 1)}
    assert {r["token"] for r in words.filter("field = 'kind'").collect()} == {"small", "big"}


# --- files and resources -------------------------------------------------------------


def test_dictionary_files(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps([{"word": "running", "root": "run"}, {"word": "walking", "root": "walk"}]))
    (tmp_path / "d.csv").write_text("running, run\nalone\n\"walking\",walk\n")
    (tmp_path / "d.txt").write_text("  one \n\n two\n")
    rows = lambda kind: {tuple(r)[1:] for r in files.read_dictionary(spark, "d", str(tmp_path / f"d.{kind}")).collect()}
    assert rows("json") == rows("csv") == {("running", "run"), ("walking", "walk")}
    assert rows("txt") == {("one", "one"), ("two", "two")}
    with pytest.raises(Exception):
        files.read_dictionary(spark, "d", str(tmp_path / "missing.csv")).collect()


def test_json_lines(spark):
    docs = local_table(spark, [("1", 5, "x"), ("2", 9, "y")], "id string, n int, t string")
    lines = files.json_lines(docs, F.col("n") > 6, ["t"]).collect()
    assert [json.loads(r["line"]) for r in lines] == [{"id": "2", "t": "y"}]


def test_resources_are_loaded_in_order_and_empty_kinds_skipped(spark):
    config = {
        "analytics_rules": {"popular": {"type": "popular_queries", "params": {"source": {"collections": ["p"]}, "destination": {"collection": "d"}}}},
        "synonym_sets": {"p": {"items": {5: {"synonyms": ["a"]}, "empty": {"synonyms": []}}}},
        "presets": {}, "conversation_models": {"bot": {"model_name": "m"}}, "nl_search_models": {"k": {"id": "own", "model_name": "m"}},
    }
    tables = resources.load(spark, config)
    assert list(tables) == ["synonym_sets", "analytics_rules", "nl_search_models", "conversation_models"]
    assert {r["id"] for r in tables["synonym_sets"].collect()} == {"5", "empty"}
    assert [r["id"] for r in resources.synonym_problems(tables["synonym_sets"]).collect()] == ["empty"]
    rule = tables["analytics_rules"].first()
    assert (rule["name"], rule["limit"]) == ("popular", 1000)
    assert tables["nl_search_models"].first()["id"] == "own" and tables["conversation_models"].first()["id"] == "bot"


def test_changes_of_a_diff_are_applied_or_refused(spark):
    from gleaner.operators import schema as fields

    docs = spark.createDataFrame([("1", 5, "x")], "id string, n long, old string")
    table = lambda rows: spark.createDataFrame(rows, "name string, type string")
    live = table([("id", "string"), ("n", "int64"), ("old", "string")])
    changed = fields.apply_changes(docs, fields.diff(table([("n", "int64"), ("tags", "string[]"), ("ok", "bool")]), live))
    assert dict(changed.dtypes) == {"id": "string", "n": "bigint", "tags": "array<string>", "ok": "boolean"}
    assert tuple(changed.select("id", "n", "ok", "tags").first()) == ("1", 5, None, None)
    assert fields.apply_changes(docs, fields.diff(live, live)).columns == docs.columns
    with pytest.raises(ValueError):
        fields.apply_changes(docs, fields.diff(table([("n", "float")]), live))
