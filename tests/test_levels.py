"""Exact matching level by level against the postings of every token."""

import random

import pytest
from pyspark.sql import functions as F

from gleaner.functions.text import tokens
from gleaner.operators import levels
from gleaner.operators.match import EXACT_ONLY, Match, search
from gleaner.operators.postings import postings

SEED = 4


def rows(spark):
    rng = random.Random(SEED)
    words = [f"w{i}" for i in range(40)]
    said = lambda n: " ".join(words[min(int(rng.expovariate(0.15)), 39)] for _ in range(n))
    docs = [(i, said(rng.randrange(12)), said(rng.randrange(4))) for i in range(400)]
    docs += [(400, None, "w1 w2"), (401, None, None), (402, "", "w0"), (403, "W1, w2! w3", "w1")]
    asked = [(f"q{i}", said(rng.randrange(1, 7))) for i in range(60)]
    asked += [("none", ""), ("null", None), ("gap", "w1 unheard w2"), ("first", "unheard w1"), ("twice", "w3 w3 w0"), ("one", "w0")]
    return spark.createDataFrame(docs, "id long, a string, b string"), spark.createDataFrame(asked, "query_id string, q string")


@pytest.mark.parametrize(
    "options",
    [
        {}, {"drop_tokens_threshold": 1}, {"drop_tokens_threshold": 7}, {"drop_tokens_threshold": 5000},
        {"drop_tokens_threshold": 3, "ranking_tokens": 2, "weights": {"a": 2, "b": 5}, "text_match_type": "max_weight"},
        {"prioritize_token_position": True, "text_match_type": "sum_score", "drop_tokens_threshold": 2},
        {"prioritize_exact_match": False, "prioritize_num_matching_fields": True},
    ],
)
@pytest.mark.parametrize("first,group", [(1024, 1 << 20), (2, 64)])
def test_levels_give_the_hits_of_the_postings(spark, monkeypatch, options, first, group):
    monkeypatch.setattr(levels, "FIRST_FREQUENCY", first)
    monkeypatch.setattr(levels, "ALL_AT_ONCE", 0 if first == 2 else 1 << 20)
    monkeypatch.setattr(levels, "STEP", 3 if first == 2 else 32)
    monkeypatch.setattr(levels, "GROUP_TOKENS", group)
    monkeypatch.setattr(levels, "GROUP_PAIRS", 1 << 18 if group > 64 else 50)
    docs, queries = rows(spark)
    how = Match(("a", "b"), **(EXACT_ONLY | options))
    assert levels.takes_tokens_as_they_are(how)
    found = levels.match_documents(docs, ["a", "b"], queries, how).select(*levels.HIT).collect()
    wanted = search(postings(docs, ["a", "b"]), queries, how).select(*levels.HIT).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, wanted)) and found


def test_pairs_come_from_the_rarest_token_only(spark):
    docs = spark.range(3000).select(F.col("id"), F.concat_ws(" ", F.lit("often common"), F.concat(F.lit("r"), F.expr("id % 1000"))).alias("a"))
    asked = spark.range(50).select(F.col("id").cast("string").alias("query_id"), F.concat_ws(" ", F.lit("often common"), F.concat(F.lit("r"), F.col("id"))).alias("q"))
    texts, _ = levels._texts(docs, ("a",))
    words = asked.select("query_id", tokens(F.col("q")).alias("words"))
    words = words.select("query_id", levels._hashed(F.col("words")).alias("hashes"), F.size("words").alias("n"))
    records = levels._records(words, texts)
    whole = records.filter("high = n")
    assert levels.pairs(texts, whole).count() == whole.agg(F.sum("df")).first()[0] == 150
    hits = levels.match_documents(docs, ["a"], asked, Match(("a",), **EXACT_ONLY))
    assert hits.count() == 150


def test_levels_of_nothing(spark):
    docs, queries = rows(spark)
    how = Match(("a", "b"), **(EXACT_ONLY | {"drop_tokens_threshold": 1}))
    assert levels.match_documents(docs.filter("false"), ["a", "b"], queries, how).count() == 0
    assert levels.match_documents(docs, ["a", "b"], queries.filter("false"), how).count() == 0
