"""Exact matching level by level: pairs are made from the rarest token a query needs, not from any token.

A hit that drops the last d tokens of a query holds all tokens before them, so
it is in the posting list of the rarest of these. Going through a query from
the left, the tokens rarer than all before them are its *records*: record j
answers for the levels whose prefix ends before record j + 1. Records are opened
from the rarest to the most frequent, and a query is closed as soon as its
stricter hits are enough. A round opens all records up to a document frequency,
the next one goes 32 times higher, so there are at most log32(documents) rounds,
and a query makes at most some 32 times the pairs it needs.

Pairs meet the texts by groups of documents: the tokens of a group are sorted
once and every token of every pair is one binary search, whatever the length
of the text. Pairs of many queries would be too many to move: beyond
``FEW_QUERIES`` blocks of documents meet blocks of queries (``blocks.py``).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.skew import BROADCAST_ROWS, broadcast_checked
from gleaner.functions.text import tokens
from gleaner.operators.blocks import match_blocks
from gleaner.operators.match import Match, document_scores, search
from gleaner.operators.postings import postings
from gleaner.session import stored

# Queries whose pairs are moved to the texts; more of them meet blocks.
FEW_QUERIES = 1024
# Document frequency opened by the first round, and the factor between rounds.
FIRST_FREQUENCY = 1024
STEP = 32
# Pairs of all records together that are made in one round: rounds save pairs, and so few are not worth a second job.
ALL_AT_ONCE = 1 << 20
# Tokens of a group of documents, and pairs that meet one group in one task.
GROUP_TOKENS = 1 << 20
GROUP_PAIRS = 1 << 18
# Tokens of pairs looked up at a time.
LOOKED_UP = 1 << 21
HIT = ["query_id", "id", "score", "weight", "matched_fields", "typo_cost", "dropped"]


def match_documents(
    docs: DataFrame, fields: list[str], queries: DataFrame, how: Match, words: DataFrame | None = None, best: int | None = None
) -> DataFrame:
    """All hits of all queries in documents (id and the fields), as ``search`` gives them.

    Options under which a token stands for itself alone go level by level;
    the others need the postings of every alternative. Who takes only the first
    ``best`` hits of a query in the default order says so; then others may be missing.
    """
    return counted_documents(docs, fields, queries, how, words, best)[0]


def counted_documents(
    docs: DataFrame, fields: list[str], queries: DataFrame, how: Match, words: DataFrame | None = None, best: int | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """The hits of ``match_documents``, and (query_id, found), the number of all hits, where it is known without them."""
    if takes_tokens_as_they_are(how):
        return search_levels(docs, queries, how, best)
    return search(postings(docs, fields), queries, how, words), None


def takes_tokens_as_they_are(how: Match) -> bool:
    """No prefixes, infixes, typos, synonyms or stems."""
    inexact = any(
        how.per_field(how.prefix, n) or how.per_field(how.infix, n) not in (None, "off") or (how.per_field(how.num_typos, n) or 0) > 0
        for n in how.fields
    )
    return not inexact and (how.synonyms is None or not how.enable_synonyms) and how.stemming is None


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda t: F.xxhash64(t))


def _texts(docs: DataFrame, fields: tuple[str, ...]) -> tuple[DataFrame, int]:
    """id, group, distinct token hashes (held), and per field all hashes (f0, …) and that of the whole (h0, …); and the number of groups.

    Written once, since every round reads them.
    """
    none = F.array().cast("array<string>")
    lists = [F.coalesce(tokens(F.col(f)), none).alias(f"t{i}") for i, f in enumerate(fields)]
    listed = docs.select(F.col("id").cast("string").alias("id"), *lists)
    hashed = [c for i in range(len(fields)) for c in (_hashed(F.col(f"t{i}")).alias(f"f{i}"), F.xxhash64(f"t{i}").alias(f"h{i}"))]
    every = F.array_distinct(F.concat(*[F.col(f"f{i}") for i in range(len(fields))]))
    texts = stored(listed.select("id", *hashed).withColumn("held", every), "texts")
    size = reduce(lambda a, b: a + b, [F.size(f"f{i}") for i in range(len(fields))])
    total = texts.agg(F.sum(size.cast("long"))).first()[0] or 0
    groups = max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // GROUP_TOKENS))
    return texts.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")), groups


def _records(asked: DataFrame, texts: DataFrame) -> DataFrame:
    """(query_id, token, low, high, df, n): the records, each with the prefix lengths it answers for.

    Nothing holds a prefix with a token that occurs nowhere, so prefixes end before it.
    """
    slots = asked.select("query_id", "n", F.posexplode("hashes").alias("slot", "token"))
    wanted, _ = broadcast_checked(slots.select("token").distinct())
    found = texts.select(F.explode("held").alias("token")).join(wanted, "token", "left_semi")
    known = slots.join(found.groupBy("token").agg(F.count(F.lit(1)).alias("df")), "token", "left")
    before = Window.partitionBy("query_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("query_id").orderBy("slot").rowsBetween(1, 1)
    numbered = known.withColumn("df", F.coalesce("df", F.lit(0))).withColumn("least", F.min("df").over(before))
    records = numbered.filter("least IS NULL OR df < least").withColumn("high", F.coalesce(F.min("slot").over(after), F.col("n")))
    return records.filter("df > 0").select("query_id", "token", (F.col("slot") + 1).alias("low"), "high", "df", "n")


def pairs(texts: DataFrame, records: DataFrame) -> DataFrame:
    """(doc, part, query_id, low, high): documents that hold the token of a record, and their groups."""
    listed = texts.select(F.col("id").alias("doc"), F.col("group").alias("part"), F.explode("held").alias("token"))
    return listed.join(records.select("query_id", "token", "low", "high"), "token").drop("token")


def _found_in(texts: pa.Table, pairs: pa.Table, field: int, starts: np.ndarray, hashes: np.ndarray, doc: np.ndarray):
    """Where the tokens of pairs first stand in a field of their documents; -1 where they do not."""
    listed = texts.column(f"f{field}").combine_chunks()
    values = listed.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    lengths = listed.value_lengths().to_numpy(zero_copy_only=False)
    spread = np.arange(texts.num_rows, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    keys = values + np.repeat(spread, lengths)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    wanted = hashes + spread[doc]
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    if not len(keys):
        return np.full(len(wanted), -1)
    return np.where(keys[at] == wanted, place[order[at]], -1)


def _verified(texts: DataFrame, made: DataFrame, asked: DataFrame, groups: int, rows: int, queries: int, how: Match) -> DataFrame:
    """The pairs whose leading tokens held end where their record answers for, with what their score needs.

    A document has one number of leading tokens, so one record accepts it.
    ``rows`` is the number of pairs, ``queries`` that of their records; a group
    of documents that more pairs meet than one task takes is sent to several.
    """
    fields, early, places = len(how.fields), how.ranking_tokens, how.prioritize_token_position
    shares = max(1, -(-rows // (groups * GROUP_PAIRS)), -(-queries // GROUP_PAIRS))
    each = texts.drop("held").withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))) if shares > 1 else F.lit(0))
    met = made.join(asked.select("query_id", "hashes", "query_hash"), "query_id")
    met = met.withColumn("part_share", F.pmod(F.xxhash64("query_id"), F.lit(shares)).cast("int"))
    names = ["tokens", "in", "same"] + ["pos"] * places
    shape = "query_id string, id string, n_tokens int, lead int, " + ", ".join(
        f"{name}_{i} {'boolean' if name == 'same' else 'int'}" for i in range(fields) for name in names
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        step = max(1, LOOKED_UP // 64)
        for start in range(0, right.num_rows, step):
            parts.append(_look_up(left, right.slice(start, step)))
        return pa.concat_tables(parts) if parts else _look_up(left.slice(0, 0), right)

    def _look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column("id").combine_chunks()
        doc_of = right.column("doc").combine_chunks()
        which = pa.compute.index_in(doc_of, value_set=ids).to_numpy(zero_copy_only=False).astype(np.int64)
        listed = right.column("hashes").combine_chunks()
        hashes = listed.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        n = listed.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(n) - n
        pair = np.repeat(np.arange(len(n)), n)
        slot = np.arange(len(hashes)) - starts[pair]
        at = [_found_in(left, right, i, starts, hashes, which[pair]) for i in range(fields)]
        held = reduce(np.maximum, at) >= 0
        lead = np.minimum.reduceat(np.where(held, n[pair], slot), starts) if len(n) else n
        ok = (lead >= right.column("low").to_numpy()) & (lead <= right.column("high").to_numpy())
        columns = {"query_id": right.column("query_id"), "id": right.column("doc"), "n_tokens": n, "lead": lead}
        for i in range(fields):
            counted = (at[i] >= 0) & (slot < early if early is not None else True)
            length = left.column(f"f{i}").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
            whole = left.column(f"h{i}").to_numpy()
            columns[f"tokens_{i}"] = np.bincount(pair[counted], minlength=len(n))
            columns[f"in_{i}"] = np.bincount(pair[at[i] >= 0], minlength=len(n)) > 0
            columns[f"same_{i}"] = (whole[which] == right.column("query_hash").to_numpy()) & (length[which] == n)
            if places:
                columns[f"pos_{i}"] = np.minimum.reduceat(np.where(counted, at[i], 999), starts) if len(n) else n
        kinds = {"query_id": pa.string(), "id": pa.string()}
        arrays = [
            pa.compute.cast(v, kinds[k]) if k in kinds else pa.array(v.astype(bool if k.startswith("same") else np.int32))
            for k, v in columns.items()
        ]
        return pa.table(arrays, names=list(columns)).filter(pa.array(ok))

    grouped = each.groupBy("group", "share").cogroup(met.groupBy("part", "part_share"))
    return grouped.applyInArrow(run, shape)


def search_levels(docs: DataFrame, queries: DataFrame, how: Match, best: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """All hits of all queries, or the ``best``: the columns and rows of ``search`` for tokens as they are; their number if known.

    Runs a few jobs while the plan is built: the frequencies, and one count of
    hits per round. Texts and queries without tokens have no hits. Tokens are
    compared by 64-bit hashes.
    """
    words = queries.select(F.col("query_id").cast("string").alias("query_id"), tokens(F.col("q")).alias("words"))
    asked = words.filter(F.size("words") > 0).select(
        "query_id", _hashed(F.col("words")).alias("hashes"), F.xxhash64("words").alias("query_hash"), F.size("words").alias("n")
    )
    asked = stored(asked, "asked")
    count, size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if count > FEW_QUERIES:
        hits, found = match_blocks(docs, asked, size, how, best)
        return _scored(hits, how), found
    asked, _ = broadcast_checked(asked, size=8 * F.col("n") + 32)
    texts, groups = _texts(docs, how.fields)
    records = stored(_records(asked, texts), "records")

    def verified(opened: DataFrame) -> DataFrame:
        queries, rows = opened.agg(F.count(F.lit(1)), F.coalesce(F.sum("df"), F.lit(0))).first()
        opened = F.broadcast(opened) if queries <= BROADCAST_ROWS else opened
        return _verified(texts, pairs(texts, opened), asked, groups, rows, queries, how)

    if how.drop_tokens_threshold > 0:
        hits = _opened(records, verified, how.drop_tokens_threshold)
    else:
        hits = verified(records.filter("high = n").withColumn("low", F.col("n")))
    return _scored(hits, how), None


def _scored(hits: DataFrame, how: Match) -> DataFrame:
    costs = {f"cost_{i}": F.lit(0) for i in range(len(how.fields))}
    return hits.withColumns(costs).select(
        "query_id", "id", *document_scores(how), F.lit(0).alias("typo_cost"), (F.col("n_tokens") - F.col("lead")).alias("dropped")
    ).select(*HIT)


def _opened(records: DataFrame, verified, threshold: int) -> DataFrame:
    """Hits of all levels that are admitted."""
    most, every = records.agg(F.coalesce(F.max("df"), F.lit(0)), F.coalesce(F.sum("df"), F.lit(0))).first()
    found, limit, below = [], (max(most, 1) if every <= ALL_AT_ONCE else FIRST_FREQUENCY), 0
    while below < most:
        opened = records.filter((F.col("df") > below) & (F.col("df") <= limit))
        if found:
            counts = _so_far(found).groupBy("query_id").agg(F.count(F.lit(1)).alias("hits"))
            opened = stored(opened.join(counts.filter(F.col("hits") >= threshold), "query_id", "left_anti"), "opened")
        found.append(stored(verified(opened), "found"))
        below, limit = limit, limit * STEP
    if not found:
        return verified(records)
    hits = _so_far(found)
    levels = hits.groupBy("query_id", "lead").agg(F.count(F.lit(1)).alias("hits"))
    stricter = Window.partitionBy("query_id").orderBy(F.desc("lead")).rowsBetween(Window.unboundedPreceding, -1)
    open_levels = levels.withColumn("before", F.coalesce(F.sum("hits").over(stricter), F.lit(0))).filter(F.col("before") < threshold)
    last = open_levels.groupBy("query_id").agg(F.min("lead").alias("last"))
    return hits.join(last, "query_id").filter(F.col("lead") >= F.col("last")).drop("last")


def _so_far(found: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, found)
