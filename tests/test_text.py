"""Tokens, vocabulary keys, matching and scoring on small literal data."""

import random
import string

import pytest
from pyspark.sql import functions as F

from gleaner.functions.text import (
    gram_key, gram_keys, prefix_key, prefix_keys, segment_keys, segment_probes, tokens, word_shingles,
)
from gleaner.operators.lexical import stem_alternatives, synonym_pairs
from gleaner.operators.match import EXACT_ONLY, Match, search, tokenize_queries
from gleaner.operators.postings import occurrences, postings
from gleaner.operators.schema import Field
from gleaner.session import local_table
from gleaner.sources import resources


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def docs(spark, rows, ddl="id string, title string, body string"):
    return local_table(spark, rows, ddl)


def hits(spark, rows, queries, **how):
    fields = how.pop("fields", ("title",))
    found = search(
        postings(docs(spark, rows), list(fields)), local_table(spark, queries, "query_id string, q string"),
        Match(tuple(fields), **(EXACT_ONLY | how)),
    )
    return {(r["query_id"], r["id"]): r for r in found.collect()}


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_tokens_lower_and_split_on_anything_but_letters_and_digits(spark):
    assert one(spark, tokens(F.lit("Hé-llo, WORLD's 2nd\n item_3!"))) == ["hé", "llo", "world", "s", "2nd", "item", "3"]


def test_symbols_are_kept_and_separators_split(spark):
    assert one(spark, tokens(F.lit("Brand#12 c++"), symbols=("#", "+"))) == ["brand#12", "c++"]
    assert one(spark, tokens(F.lit("aXbXc x"), separators=("x",))) == ["a", "b", "c"]


def test_postings_hold_the_first_place_of_every_word(spark):
    rows = [("1", "b a b a c", ""), ("2", "", "x"), ("3", None, "x")]
    first = postings(docs(spark, rows), ["title"]).select("id", "token", "pos", "field_length").collect()
    assert sorted(map(tuple, first)) == [("1", "a", 1, 5), ("1", "b", 0, 5), ("1", "c", 4, 5)]
    every = occurrences(docs(spark, rows), ["title"]).select("token", "pos").collect()
    assert sorted(map(tuple, every)) == [("a", 1), ("a", 3), ("b", 0), ("b", 2), ("c", 4)]


def test_fields_without_index_have_no_postings(spark):
    rows = [("1", "x", "y")]
    kept = postings(docs(spark, rows), [Field("title", "string"), Field("body", "string", index=False)])
    assert [r["token"] for r in kept.collect()] == ["x"]


def words(seed, n, alphabet, longest=9):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, longest))) for _ in range(n)]


@pytest.mark.parametrize("bound", [1, 2])
def test_segment_keys_find_every_word_within_the_bound(spark, bound):
    vocabulary = sorted(set(words(1, 250, "abc") + words(2, 150, string.ascii_lowercase, 12)))
    asked = sorted(set(words(3, 120, "abc") + vocabulary[::9]))
    left = local_table(spark, [(w,) for w in asked], "q string").select("q", F.explode(segment_probes(F.col("q"), bound)).alias("k"))
    right = local_table(spark, [(w,) for w in vocabulary], "w string").select("w", F.explode(segment_keys(F.col("w"), bound)).alias("k"))
    near = left.join(right, "k").filter(F.levenshtein("q", "w", bound) >= 0).select("q", "w").distinct()
    expected = {(q, w) for q in asked for w in vocabulary if edits(q, w) <= bound}
    assert {tuple(r) for r in near.collect()} == expected


def test_prefix_and_gram_keys_cover_long_and_short_words(spark):
    vocabulary = ["a", "ab", "widget", "internationalisation", "internationalise", "xyz"]
    table = local_table(spark, [(w,) for w in vocabulary], "w string")
    for q in ("a", "int", "internationali", "internationalisa", "dge", "z", "tionalis"):
        ask = local_table(spark, [(q,)], "q string")
        by_prefix = ask.join(table.select("w", F.explode(prefix_keys(F.col("w"))).alias("k")), prefix_key(F.col("q")) == F.col("k"))
        found = by_prefix.filter(F.startswith("w", "q")).select("w").distinct().collect()
        assert sorted(r["w"] for r in found) == sorted(w for w in vocabulary if w.startswith(q))
        by_gram = ask.join(table.select("w", F.explode(gram_keys(F.col("w"))).alias("k")), gram_key(F.col("q")) == F.col("k"))
        found = by_gram.filter(F.contains("w", "q")).select("w").collect()
        assert sorted(r["w"] for r in found) == sorted(w for w in vocabulary if q in w)


def test_every_query_token_must_match_some_field(spark):
    rows = [("1", "red widget", "cheap"), ("2", "red", "widget"), ("3", "blue widget", "red car"), ("4", "red", "car")]
    assert {i for _, i in hits(spark, rows, [("q", "red widget")], fields=("title", "body"))} == {"1", "2", "3"}
    assert {i for _, i in hits(spark, rows, [("q", "red widget")])} == {"1"}


def test_exact_text_scores_above_a_longer_one(spark):
    rows = [("1", "red widget", ""), ("2", "red widget set", ""), ("3", "widget red", "")]
    found = hits(spark, rows, [("q", "Red widget")])
    assert found["q", "1"]["score"] == 209100000
    assert found["q", "2"]["score"] == found["q", "3"]["score"] == 209000000


def test_score_types(spark):
    rows = [("1", "ring", "ring small"), ("2", "small", "ring")]
    weights = {"title": 1, "body": 3}
    best = hits(spark, rows, [("q", "small ring")], fields=("title", "body"), weights=weights)
    assert best["q", "1"]["score"] == 209000000 and best["q", "1"]["weight"] == 3
    total = hits(spark, rows, [("q", "small ring")], fields=("title", "body"), weights=weights, text_match_type="sum_score")
    assert total["q", "1"]["score"] == 109000000 + 3 * 209000000
    heavy = hits(spark, rows, [("q", "small ring")], fields=("title", "body"), weights=weights, text_match_type="max_weight")
    assert heavy["q", "2"]["score"] == 109000000


def test_position_and_number_of_fields(spark):
    rows = [("1", "ring a", "ring"), ("2", "a b ring", "")]
    found = hits(spark, rows, [("q", "ring")], fields=("title", "body"), prioritize_token_position=True, prioritize_exact_match=False)
    assert found["q", "1"]["score"] - found["q", "2"]["score"] == 200
    more = hits(spark, rows, [("q", "ring")], fields=("title", "body"), prioritize_num_matching_fields=True, prioritize_exact_match=False)
    assert more["q", "1"]["score"] - more["q", "2"]["score"] == 1


def test_typos_only_where_exact_hits_are_too_few(spark):
    rows = [("1", "widget", ""), ("2", "wodget", ""), ("3", "wodgat", "")]
    strict = hits(spark, rows, [("q", "widget")], num_typos=2)
    assert {i for _, i in strict} == {"1"}
    wide = hits(spark, rows, [("q", "widget")], num_typos=2, typo_tokens_threshold=5, min_len_2typo=6)
    assert {i: r["typo_cost"] for (_, i), r in wide.items()} == {"1": 0, "2": 1, "3": 2}
    assert wide["q", "2"]["score"] == 100000000 + 8 * 1000000


def test_typo_length_gates_and_digits(spark):
    rows = [("1", "cat", ""), ("2", "iphone12", "")]
    assert not hits(spark, rows, [("q", "cut")], num_typos=2)
    assert not hits(spark, rows, [("q", "iphone13")], num_typos=2)
    assert hits(spark, rows, [("q", "iphone13")], num_typos=2, typos_on_digits=True)


def test_tokens_are_dropped_from_the_right(spark):
    rows = [("1", "red", ""), ("2", "widget", ""), ("3", "red ring", "")]
    found = hits(spark, rows, [("q", "red ring gone")], drop_tokens_threshold=1)
    assert {i: r["dropped"] for (_, i), r in found.items()} == {"3": 1}
    more = hits(spark, rows, [("q", "red ring gone")], drop_tokens_threshold=2)
    assert {i: r["dropped"] for (_, i), r in more.items()} == {"3": 1, "1": 2}


def test_infix_fallback_only_without_other_hits(spark):
    rows = [("1", "widget", ""), ("2", "idget", ""), ("3", "gadget", "")]
    assert {i for _, i in hits(spark, rows, [("q", "idget")], infix="fallback")} == {"2"}
    assert {i for _, i in hits(spark, rows, [("q", "dget")], infix="fallback")} == {"1", "2", "3"}
    assert {i for _, i in hits(spark, rows, [("q", "idget")], infix="always")} == {"1", "2"}


def test_a_typo_match_is_not_improved_by_an_infix_match_of_the_same_word(spark):
    rows = [("1", "widgets", "")]
    found = hits(spark, rows, [("q", "widget")], num_typos=1, infix="fallback")
    assert found["q", "1"]["typo_cost"] == 1


def test_prefix_only_for_the_last_token_and_per_field(spark):
    rows = [("1", "red widget", ""), ("2", "redder widget", ""), ("3", "", "red wide")]
    found = hits(spark, rows, [("q", "red wid")], prefix=True, fields=("title", "body"))
    assert {i for _, i in found} == {"1", "3"}
    title = hits(spark, rows, [("q", "red wid")], prefix={"title": True, "body": False}, fields=("title", "body"))
    assert {i for _, i in title} == {"1"}


@pytest.mark.parametrize("masks", [8, 1])
def test_queries_longer_than_one_mask(spark, monkeypatch, masks):
    monkeypatch.setattr("gleaner.operators.match.MASKS", masks)
    many = [f"w{i}" for i in range(150)]
    rows = [("all", " ".join(many), ""), ("gap", " ".join(w for w in many if w != "w100"), ""), ("none", "x", "")]
    found = hits(spark, rows, [("q", " ".join(many)), ("short", "x")])
    assert set(found) == {("q", "all"), ("short", "none")}
    assert found["q", "all"]["score"] == 150 * 100000000 + 9100000
    dropped = hits(spark, rows, [("q", " ".join(many))], drop_tokens_threshold=10)
    assert {i: r["dropped"] for (_, i), r in dropped.items()} == {"all": 0, "gap": 50}
    assert dropped["q", "gap"]["score"] == 149 * 100000000 + 9000000


@pytest.mark.parametrize("masks", [8, 1])
def test_long_queries_over_two_fields_with_typos(spark, monkeypatch, masks):
    monkeypatch.setattr("gleaner.operators.match.MASKS", masks)
    many = [f"{'abcdefgh'[i % 8] * 2}{'abcdefgh'[i // 8 % 8] * 2}{'xyzuv'[i // 64] * 2}long" for i in range(130)]
    near = " ".join(many[:100] + [many[100] + "q"] + many[101:])
    rows = [("split", " ".join(many[:70]), " ".join(many[70:])), ("typo", near, ""), ("half", "", " ".join(many[:63]))]
    found = hits(
        spark, rows, [("q", " ".join(many))], fields=("title", "body"), num_typos=1, typo_tokens_threshold=9,
        drop_tokens_threshold=9, text_match_type="sum_score", prioritize_token_position=True,
    )
    assert {i: r["dropped"] for (_, i), r in found.items()} == {"split": 0, "typo": 0, "half": 67}
    assert found["q", "split"]["typo_cost"] == 0 and found["q", "typo"]["typo_cost"] == 1
    # Both fields count for the split text; its words are all there.
    assert found["q", "split"]["score"] == 130 * 100000000 + 2 * 9000000 + 2 * 99900


def test_a_hot_token_and_many_queries_without_broadcast(spark, monkeypatch):
    rows = [(str(i), "the " + ("ring" if i % 3 else "rod"), "") for i in range(300)]
    queries = [(f"q{i}", "the rod") for i in range(5)]
    before = hits(spark, rows, queries)
    monkeypatch.setattr("gleaner.operators.match.BROADCAST_ROWS", 0)
    assert set(hits(spark, rows, queries)) == set(before) and len(before) == 500


# --- synonyms and stemming ---------------------------------------------------


def items(spark, sets, **more):
    return synonym_pairs(resources.synonyms(spark, sets, **more))


def test_synonym_pairs(spark):
    sets = {"products": {"items": {"size": {"synonyms": ["large", "big"]}, 7: {"root": "color", "synonyms": ["red", "blue"]}}}}
    rows = {(r["id"], r["term"], r["expansion"]) for r in items(spark, sets).collect()}
    assert rows == {("size", "large", "big"), ("size", "big", "large"), ("7", "color", "red"), ("7", "color", "blue")}


def test_synonyms_of_several_words_need_all_of_them(spark):
    rows = [("1", "smart phone", ""), ("2", "phone", ""), ("3", "smartphone case", ""), ("4", "mobile smart", "")]
    table = items(spark, {"s": {"items": {"m": {"synonyms": ["mobile", "smart phone", "smartphone"]}}}})
    assert {i for _, i in hits(spark, rows, [("q", "mobile")], synonyms=table)} == {"1", "3", "4"}
    assert {i for _, i in hits(spark, rows, [("q", "smart phone")], synonyms=table)} == {"1", "3", "4"}
    assert {i for _, i in hits(spark, rows, [("q", "smart phone case")], synonyms=table)} == {"3"}
    assert {i for _, i in hits(spark, rows, [("q", "mobile")], synonyms=table, enable_synonyms=False)} == {"4"}


def test_one_way_and_scoped_synonyms(spark):
    rows = [("1", "cog", ""), ("2", "gear", "")]
    table = items(spark, {}, collections={"shop": [{"id": "c", "root": "cog", "synonyms": ["gear"]}]})
    both = [("a", "cog"), ("b", "gear")]
    assert set(hits(spark, rows, both, synonyms=table, collection="shop")) == {("a", "1"), ("a", "2"), ("b", "2")}
    assert set(hits(spark, rows, both, synonyms=table, collection="other")) == {("a", "1"), ("b", "2")}


def test_stemming_equals_replacing_words_on_both_sides(spark):
    dictionary = {"running": "run", "runs": "run", "run": "run", "mice": "mouse", "ring": "rod"}
    vocabulary = ["running", "runs", "run", "runner", "mice", "mouse", "ring", "rod", "x"]
    stem = lambda w: dictionary.get(w, w)
    table = local_table(spark, list(dictionary.items()), "word string, root string")
    asked = tokenize_queries(local_table(spark, [(w, w) for w in vocabulary], "query_id string, q string"))
    found = {(r["query_id"], r["token"]) for r in stem_alternatives(asked, table).collect() if r["token"] in vocabulary}
    assert found == {(q, w) for q in vocabulary for w in vocabulary if stem(q) == stem(w)}


def test_word_shingles_of_short_texts(spark):
    size = lambda text: len(one(spark, word_shingles(F.split(F.lit(text), " "))))
    assert [size("a"), size("a b"), size("a b c"), size("a b c d"), size("a b a b a b")] == [1, 1, 1, 2, 2]
