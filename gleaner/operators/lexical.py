"""Synonyms and stemming dictionaries as alternatives of query tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import segment_keys, segment_probes, tokens


def synonym_pairs(items: DataFrame) -> DataFrame:
    """(collection, set, id, term, expansion) from items (collection, set, id, root, synonyms).

    With a root, the root stands for each listed term and not the other way
    round. Without one every term stands for every other; each term is paired
    with the item's own list, so an item is never joined with itself.
    """
    terms = F.col("synonyms")
    one_way = F.transform(terms, lambda e: F.struct(F.col("root").alias("term"), e.alias("expansion")))
    multi_way = F.flatten(
        F.transform(
            terms,
            lambda t: F.transform(
                F.filter(terms, lambda e: e != t), lambda e: F.struct(t.alias("term"), e.alias("expansion"))
            ),
        )
    )
    pairs = F.when(F.col("root").isNotNull(), one_way).otherwise(multi_way)
    return items.select("collection", "set", "id", F.inline(pairs))


def synonym_alternatives(
    query_tokens: DataFrame, pairs: DataFrame, collection: str | None = None, typos: int = 0
) -> DataFrame:
    """Expansions of the query tokens: (query_id, slot, alt, word_no, n_words, token, n_tokens, query_hash).

    A term of several words must stand in the query word by word. An expansion
    of several words is one alternative that needs all of them. With ``typos``
    a one-word term may be misspelt in the query by that many edits.
    """
    scoped = pairs
    if collection is not None:
        scoped = pairs.filter(F.col("collection").isNull() | (F.col("collection") == collection))
    scoped = scoped.select(
        tokens(F.col("term")).alias("term_words"), tokens(F.col("expansion")).alias("words")
    ).filter((F.size("term_words") > 0) & (F.size("words") > 0))
    firsts = scoped.withColumn("first", F.element_at("term_words", 1))
    found = query_tokens.join(firsts, query_tokens["token"] == firsts["first"]).filter(
        F.slice("query_words", F.col("slot") + 1, F.size("term_words")) == F.col("term_words")
    )
    columns = ["query_id", "slot", "n_tokens", "query_hash", "term_words", "words"]
    found = found.select(*columns)
    if typos:
        singles = firsts.filter(F.size("term_words") == 1)
        keyed = singles.select("term_words", "words", "first", F.explode(segment_keys(F.col("first"), typos)).alias("key"))
        probes = query_tokens.select("query_id", "slot", "token", "n_tokens", "query_hash", F.explode(segment_probes(F.col("token"), typos)).alias("key"))
        close = probes.join(keyed, "key").filter(F.levenshtein("token", "first", typos) >= 0)
        found = found.unionByName(close.select(*columns)).distinct()
    alternatives = found.select(
        "query_id",
        "n_tokens",
        "query_hash",
        F.explode(F.sequence(F.col("slot"), F.col("slot") + F.size("term_words") - 1)).alias("slot"),
        F.xxhash64(F.col("slot"), F.col("term_words"), F.col("words")).alias("alt"),
        "words",
    )
    return alternatives.select(
        "query_id", "slot", "alt", "n_tokens", "query_hash",
        F.size("words").alias("n_words"), F.posexplode("words").alias("word_no", "token"),
    )


def stem_alternatives(query_tokens: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Words sharing the root of a query token: (query_id, slot, n_tokens, query_hash, token).

    Equal to replacing words by roots in documents *and* queries, but only the
    query side is rewritten; the postings stay as they are.
    """
    words = dictionary.select("word", "root").distinct()
    root_of = words.withColumnsRenamed({"word": "token"})
    place = ["query_id", "slot", "n_tokens", "query_hash"]
    rooted = query_tokens.select(*place, "token").join(root_of, "token", "left")
    stems = rooted.select(*place, F.coalesce("root", "token").alias("stem"))
    same_root = stems.join(words, stems["stem"] == words["root"]).select(*place, F.col("word").alias("token"))
    changed = words.filter(F.col("word") != F.col("root")).select(F.col("word").alias("stem"))
    root_itself = stems.join(changed, "stem", "left_anti").select(*place, F.col("stem").alias("token"))
    return same_root.unionByName(root_itself).distinct()
