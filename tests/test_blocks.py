"""Blocks of documents against blocks of queries, compared with the postings of every token."""

import pytest
from test_levels import rows

from gleaner.operators import blocks, levels
from gleaner.operators.match import EXACT_ONLY, Match, search
from gleaner.operators.postings import postings
from gleaner.operators.rank import default_order, page


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(levels, "FEW_QUERIES", 0)
    monkeypatch.setattr(blocks, "BLOCK_TOKENS", 100)
    monkeypatch.setattr(blocks, "ADDED", 7)
    monkeypatch.setattr(blocks, "QUERY_TOKENS", 40)
    monkeypatch.setattr(blocks, "GIVEN", 50)


@pytest.mark.parametrize(
    "options",
    [
        {}, {"drop_tokens_threshold": 1}, {"drop_tokens_threshold": 7}, {"drop_tokens_threshold": 5000},
        {"drop_tokens_threshold": 3, "ranking_tokens": 2, "weights": {"a": 2, "b": 5}, "text_match_type": "max_weight"},
        {"prioritize_token_position": True, "text_match_type": "sum_score", "drop_tokens_threshold": 2},
        {"prioritize_exact_match": False, "prioritize_num_matching_fields": True},
    ],
)
@pytest.mark.parametrize("fields", [("a", "b"), ("a",)])
def test_blocks_give_the_hits_of_the_postings(spark, small, options, fields):
    docs, queries = rows(spark)
    how = Match(fields, **(EXACT_ONLY | options))
    found, counts = levels.counted_documents(docs, list(fields), queries, how)
    found = found.select(*levels.HIT).collect()
    wanted = search(postings(docs, list(fields)), queries, how).select(*levels.HIT).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, wanted)) and found
    number = {}
    for hit in wanted:
        number[hit["query_id"]] = number.get(hit["query_id"], 0) + 1
    assert dict(map(tuple, counts.collect())) == number


@pytest.mark.parametrize("options", [{}, {"drop_tokens_threshold": 1}, {"drop_tokens_threshold": 40}, {"ranking_tokens": 1, "drop_tokens_threshold": 3}])
@pytest.mark.parametrize("best", [1, 3, 20])
def test_the_best_of_blocks_make_the_same_page(spark, small, options, best):
    docs, queries = rows(spark)
    how = Match(("a",), **(EXACT_ONLY | options))
    every = levels.match_documents(docs, ["a"], queries, how)
    cut = levels.match_documents(docs, ["a"], queries, how, best=best)
    shown = [page(hits, default_order(), per_page=best).select("query_id", "rank", "id", "score").collect() for hits in (every, cut)]
    assert sorted(map(tuple, shown[0])) == sorted(map(tuple, shown[1])) and shown[0]


def test_blocks_of_nothing(spark, small, monkeypatch):
    docs, queries = rows(spark)
    how = Match(("a", "b"), **(EXACT_ONLY | {"drop_tokens_threshold": 1}))
    assert levels.match_documents(docs.filter("false"), ["a", "b"], queries, how).count() == 0
    monkeypatch.setattr(levels, "FEW_QUERIES", -1)
    assert levels.match_documents(docs, ["a", "b"], queries.filter("false"), how).count() == 0


def test_many_queries_write_no_pairs(spark, monkeypatch):
    """Beyond a number of queries only blocks, queries and last levels are written, and nothing is kept."""
    written = []
    for module in (levels, blocks):
        monkeypatch.setattr(module, "stored", lambda df, name, put=module.stored: written.append(name) or put(df, name))
    monkeypatch.setattr(levels, "FEW_QUERIES", 10)
    docs, queries = rows(spark)
    how = Match(("a",), **(EXACT_ONLY | {"drop_tokens_threshold": 1}))
    assert levels.match_documents(docs, ["a"], queries, how).count()
    assert written == ["asked", "blocks", "queries", "last", "queries"]


def many(spark):
    """Queries whose tokens many documents hold, in documents read in several pieces."""
    words = [f"w{i}" for i in range(12)]
    docs = [(str(i), " ".join(words[(i * k + k) % 12] for k in range(1 + i % 9))) for i in range(300)]
    asked = [(f"q{i}", " ".join(words[(i + k * k) % 12] for k in range(1 + i % 5))) for i in range(40)]
    return spark.createDataFrame(docs, "id string, a string").repartition(3), spark.createDataFrame(asked, "query_id string, q string")


def test_levels_are_given_once_for_a_task(spark, small, monkeypatch):
    """However many blocks there are, a task gives a query no levels that its own hits have closed."""
    monkeypatch.setattr(blocks, "TASKS", 1)
    monkeypatch.setattr(blocks, "TASK_TOKENS", 1 << 16)
    monkeypatch.setattr(blocks, "QUERY_TOKENS", 1 << 16)
    docs, queries = many(spark)
    given = []
    met = blocks._met
    monkeypatch.setattr(blocks, "_met", lambda *args: given.append(met(*args)) or given[-1])
    how = Match(("a",), **(EXACT_ONLY | {"drop_tokens_threshold": 1}))
    found = levels.match_documents(docs, ["a"], queries, how, best=2)
    shown = page(found, default_order(), per_page=2).select("query_id", "rank", "id", "score").collect()
    every = page(search(postings(docs, ["a"]), queries, how), default_order(), per_page=2).select("query_id", "rank", "id", "score").collect()
    assert sorted(map(tuple, shown)) == sorted(map(tuple, every))
    tasks = spark.sparkContext.defaultParallelism
    assert given[0].groupBy("query_id").count().agg({"count": "max"}).first()[0] <= tasks


def test_bits_of_many_tokens_are_made_for_fewer_queries(spark, small, monkeypatch):
    monkeypatch.setattr(blocks, "BITS_BYTES", 200)
    monkeypatch.setattr(blocks, "STATE_BYTES", 64)
    monkeypatch.setattr(blocks, "ENTRIES", 9)
    docs, queries = rows(spark)
    how = Match(("a", "b"), **(EXACT_ONLY | {"drop_tokens_threshold": 3}))
    found = levels.match_documents(docs, ["a", "b"], queries, how).select(*levels.HIT).collect()
    wanted = search(postings(docs, ["a", "b"]), queries, how).select(*levels.HIT).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, wanted)) and found
