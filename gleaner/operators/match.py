"""Keyword search: query tokens joined with postings, scored per document."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.skew import BROADCAST_ROWS
from gleaner.functions.text import (
    gram_key, gram_keys, prefix_key, prefix_keys, segment_keys, segment_probes, tokens,
)
from gleaner.operators.lexical import stem_alternatives, synonym_alternatives
from gleaner.operators.postings import vocabulary

# Query tokens per bit mask; longer queries use several masks.
MASK_BITS = 62
# Masks kept side by side per query; still longer queries take one row per mask.
MASKS = 8


@dataclass(frozen=True)
class Match:
    """How a batch of queries is matched; per-field settings are dicts by field name."""

    fields: tuple[str, ...]
    weights: dict[str, int] = field(default_factory=dict)
    prefix: bool | dict[str, bool] = True
    infix: str | dict[str, str] = "off"
    num_typos: int | dict[str, int] = 2
    min_len_1typo: int = 4
    min_len_2typo: int = 7
    typos_on_digits: bool = False
    typo_tokens_threshold: int = 1
    drop_tokens_threshold: int = 1
    text_match_type: str = "max_score"
    ranking_tokens: int | None = None
    prioritize_exact_match: bool = True
    prioritize_token_position: bool = False
    prioritize_num_matching_fields: bool = False
    synonyms: DataFrame | None = None
    enable_synonyms: bool = True
    synonym_prefix: bool = False
    synonym_num_typos: int = 0
    stemming: DataFrame | None = None
    collection: str | None = None

    def per_field(self, setting, name):
        return setting.get(name) if isinstance(setting, dict) else setting


EXACT_ONLY = dict(prefix=False, num_typos=0, drop_tokens_threshold=0)


def tokenize_queries(queries: DataFrame) -> DataFrame:
    """(query_id, slot, token, n_tokens, query_words, query_hash) from (query_id, q)."""
    words = queries.select("query_id", tokens(F.col("q")).alias("query_words"))
    facts = words.withColumns({"n_tokens": F.size("query_words"), "query_hash": F.xxhash64("query_words")})
    return facts.select("*", F.posexplode("query_words").alias("slot", "token"))


def _expand(column: str, wanted: DataFrame, words: DataFrame, query_key, word_key, verify: Column) -> DataFrame:
    """Query tokens to vocabulary tokens through an equi-join on a derived key."""
    left = wanted.withColumn("key", query_key)
    right = words.select(F.col("field"), F.col("token").alias(column), F.explode(word_key).alias("key"))
    return left.join(right, ["field", "key"]).filter(verify).drop("key")


def candidates(query_tokens: DataFrame, words: DataFrame | None, how: Match) -> DataFrame:
    """Tokens that satisfy a slot: (query_id, slot, field, alt, word_no, n_words, token, cost, infix, …).

    The length and hash of the query ride along, so that no later join is needed for them.
    """
    out = []
    slots = query_tokens.select("query_id", "slot", "token", "n_tokens", "query_hash")

    def emit(df, token="token", cost=F.lit(0), infix=F.lit(0)):
        single = "alt" not in df.columns
        out.append(
            df.select(
                "query_id", "slot", "field",
                (F.lit(0).cast("long") if single else F.col("alt")).alias("alt"),
                (F.lit(0) if single else F.col("word_no")).alias("word_no"),
                (F.lit(1) if single else F.col("n_words")).alias("n_words"),
                F.col(token).alias("token"), cost.alias("cost"), infix.alias("infix"), "n_tokens", "query_hash",
            )
        )

    def with_fields(df, names):
        return df.withColumn("field", F.explode(F.array(*[F.lit(n) for n in names])))

    emit(with_fields(slots, how.fields))

    by_prefix = [n for n in how.fields if how.per_field(how.prefix, n)]
    if by_prefix:
        last = with_fields(slots.filter(F.col("slot") == F.col("n_tokens") - 1), by_prefix)
        found = _expand(
            "word", last, words, prefix_key(F.col("token")), prefix_keys(F.col("token")),
            F.startswith(F.col("word"), F.col("token")),
        )
        emit(found, "word")

    for mode in ("always", "fallback"):
        by_infix = [n for n in how.fields if how.per_field(how.infix, n) == mode]
        if by_infix:
            found = _expand(
                "word", with_fields(slots, by_infix), words, gram_key(F.col("token")), gram_keys(F.col("token")),
                F.contains(F.col("word"), F.col("token")),
            )
            emit(found, "word", infix=F.lit(1 if mode == "fallback" else 0))

    for bound in (1, 2):
        by_typo = [n for n in how.fields if (how.per_field(how.num_typos, n) or 0) >= bound]
        if not by_typo:
            continue
        shortest = how.min_len_1typo if bound == 1 else how.min_len_2typo
        misspelt = slots.filter(F.length("token") >= shortest)
        if not how.typos_on_digits:
            misspelt = misspelt.filter(~F.col("token").rlike("[0-9]"))
        probes = with_fields(misspelt, by_typo).withColumn("key", F.explode(segment_probes(F.col("token"), bound)))
        keyed = words.select("field", F.col("token").alias("word"), F.explode(segment_keys(F.col("token"), bound)).alias("key"))
        edits = F.levenshtein("token", "word", bound)
        found = probes.join(keyed, ["field", "key"]).withColumn("edits", edits).filter("edits > 0")
        emit(found, "word", cost=F.col("edits"))

    if how.synonyms is not None and how.enable_synonyms:
        expanded = synonym_alternatives(query_tokens, how.synonyms, how.collection, how.synonym_num_typos)
        expanded = with_fields(expanded, how.fields)
        emit(expanded)
        if how.synonym_prefix:
            found = _expand(
                "word", expanded, words, prefix_key(F.col("token")), prefix_keys(F.col("token")),
                F.startswith(F.col("word"), F.col("token")),
            )
            emit(found, "word")

    if how.stemming is not None:
        emit(with_fields(stem_alternatives(query_tokens, how.stemming), how.fields))

    every = reduce(DataFrame.unionByName, out)
    if len(out) == 1:
        return every
    keys = ["query_id", "slot", "field", "alt", "word_no", "n_words", "token", "n_tokens", "query_hash"]
    return every.groupBy(*keys).agg(F.min(F.struct("infix", "cost")).alias("best")).select(
        *keys, "best.cost", "best.infix"
    )


def needs_vocabulary(how: Match) -> bool:
    return (
        any(how.per_field(how.prefix, n) for n in how.fields)
        or any(how.per_field(how.infix, n) not in (None, "off") for n in how.fields)
        or any((how.per_field(how.num_typos, n) or 0) > 0 for n in how.fields)
        or (how.synonyms is not None and how.enable_synonyms and how.synonym_prefix)
    )


def _leading(mask: Column) -> Column:
    """Number of query tokens matched from the left without a gap."""
    return F.bit_count(F.shiftright(mask.bitwiseXOR(mask + 1), 1))


def _bit(slot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (slot % MASK_BITS).cast("int"))


def search(postings: DataFrame, queries: DataFrame, how: Match, words: DataFrame | None = None) -> DataFrame:
    """All hits of all queries: (query_id, id, score, weight, matched_fields, typo_cost, dropped).

    ``postings`` are occurrences or a stored index; ``words`` its vocabulary.
    One shuffle by (query_id, id), pre-aggregated per task, holds the work:
    the matched slots of a document travel as bit masks.
    """
    query_tokens = tokenize_queries(queries)
    if words is None and needs_vocabulary(how):
        words = vocabulary(postings.filter(F.col("field").isin(*how.fields)))
    wanted, longest = _checked(candidates(query_tokens, words, how))
    found = postings.filter(F.col("field").isin(*how.fields)).join(wanted, ["field", "token"])
    columns = [
        "query_id", "id", "field", "slot", "pos", "cost", "infix", "field_length", "field_hash",
        "n_tokens", "query_hash",
    ]
    if how.synonyms is not None and how.enable_synonyms:
        found = _complete_alternatives(found, columns)
    scored = _score(found, how, masks=max(1, -(-longest // MASK_BITS)))
    return _relax(scored, how)


def _checked(wanted: DataFrame) -> tuple[DataFrame, int]:
    """The candidate tokens, sent to all tasks if their counted number allows it; and the longest query.

    Then the postings are filtered where they lie. Beyond the limit both sides
    are shuffled by token, and adaptive execution splits the hot tokens.
    """
    wanted = wanted.persist()
    rows, longest = wanted.agg(F.count(F.lit(1)), F.max("n_tokens")).first()
    return (F.broadcast(wanted) if rows <= BROADCAST_ROWS else wanted), longest or 0


def _complete_alternatives(found: DataFrame, columns: list[str]) -> DataFrame:
    """Alternatives of several words count only where all their words stand in the field."""
    facts = ["field_length", "field_hash", "n_tokens", "query_hash"]
    single = found.filter("n_words = 1").select(*columns)
    several = (
        found.filter("n_words > 1")
        .groupBy("query_id", "id", "field", "slot", "alt", "n_words", *facts)
        .agg(
            F.count_distinct("word_no").alias("words"), F.min("pos").alias("pos"),
            F.max("cost").alias("cost"), F.max("infix").alias("infix"),
        )
        .filter("words = n_words")
    )
    return single.unionByName(several.select(*columns))


def _uses(how: Match) -> tuple[bool, bool]:
    """Whether typos can occur, and whether infixes are a fallback."""
    typos = any((how.per_field(how.num_typos, n) or 0) > 0 for n in how.fields)
    fallback = any(how.per_field(how.infix, n) == "fallback" for n in how.fields)
    return typos, fallback


def _score(found: DataFrame, how: Match, masks: int) -> DataFrame:
    """One row per (query, document): matched slots as masks, then scores and levels.

    Only the masks that the options can tell apart are aggregated. Queries of
    more than 62 tokens have several masks in the row; beyond MASKS of them,
    one row per mask is aggregated and the rows are summed.
    """
    typos, fallback = _uses(how)
    levels = (0, 1, 2) if typos else (0,)
    last = levels[-1]
    bit = _bit(F.col("slot"))
    block = F.floor(F.col("slot") / MASK_BITS)
    by_row = masks > MASKS
    keys = ["query_id", "id"] + (["block"] if by_row else [])
    if by_row:
        found, masks = found.withColumn("block", block), 1
    if how.prioritize_exact_match:
        same = (F.col("field_hash") == F.col("query_hash")) & (F.col("field_length") == F.col("n_tokens"))
        found = found.withColumn("same", same)

    aggs: dict[str, Column] = {}

    def add_masks(name: str, condition: Column | None, level: int) -> None:
        parts = [condition] if condition is not None else []
        if level < last:
            parts.append(F.col("cost") <= level)
        for b in range(masks):
            tests = parts + ([block == b] if masks > 1 else [])
            aggs[f"{name}__{b}"] = F.bit_or(F.when(reduce(lambda x, y: x & y, tests), bit).otherwise(0) if tests else bit)

    strict = F.col("infix") == 0 if fallback else None
    for level in levels:
        add_masks(f"u{level}", strict, level)
    add_masks("any", None, last)
    aggs["n_tokens"] = F.max("n_tokens")
    for i, name in enumerate(how.fields):
        here = None if len(how.fields) == 1 else F.col("field") == name
        aggs[f"in_{i}"] = F.max(F.lit(1) if here is None else here.cast("int"))
        if how.prioritize_exact_match:
            aggs[f"same_{i}"] = F.max("same" if here is None else F.when(here, F.col("same")))
        if how.ranking_tokens is not None:
            early = F.col("slot") < how.ranking_tokens
            here = early if here is None else here & early
        for level in levels:
            add_masks(f"m{level}_{i}", here, level)
        if how.prioritize_token_position:
            aggs[f"pos_{i}"] = F.min("pos" if here is None else F.when(here, F.col("pos")))
    grouped = found.groupBy(*keys).agg(*[column.alias(name) for name, column in aggs.items()])

    def ones(name: str) -> Column:
        return reduce(lambda x, y: x + y, [F.bit_count(F.col(f"{name}__{b}")) for b in range(masks)])

    def leading(name: str) -> Column:
        run = _leading(F.col(f"{name}__{masks - 1}"))
        for b in reversed(range(masks - 1)):
            here = _leading(F.col(f"{name}__{b}"))
            run = F.when(here == MASK_BITS, here + run).otherwise(here)
        return run

    def cost_of(prefix: str, suffix: str = "") -> Column:
        if not typos:
            return F.lit(0)
        zero, one, two = (ones(f"{prefix}{level}{suffix}") for level in levels)
        return one - zero + 2 * (two - one)

    parts = {
        "matched": ones(f"u{last}"),
        "matched_any": ones("any"),
        "cost": cost_of("u"),
        "lead": leading(f"u{last}"),
        "lead_any": leading("any"),
    }
    for i in range(len(how.fields)):
        parts[f"tokens_{i}"] = ones(f"m{last}_{i}")
        parts[f"cost_{i}"] = cost_of("m", f"_{i}")
    counted = grouped.withColumns(parts)
    if by_row:
        counted = _join_blocks(counted, how)
    return counted.select("query_id", "id", "n_tokens", *document_scores(how), *_levels())


def _join_blocks(counted: DataFrame, how: Match) -> DataFrame:
    """Sum the masks of very long queries; there is one row per 62 tokens of a query."""
    aggs = [F.sum(c).alias(c) for c in ("matched", "matched_any", "cost")] + [F.max("n_tokens").alias("n_tokens")]
    for lead in ("lead", "lead_any"):
        blocks = F.sort_array(F.collect_list(F.struct("block", F.col(lead).cast("long").alias("lead"))))
        run = F.aggregate(
            blocks, F.lit(0).cast("long"),
            lambda acc, b: F.when(acc == b["block"] * MASK_BITS, acc + b["lead"]).otherwise(acc),
        )
        aggs.append(run.alias(lead))
    for i in range(len(how.fields)):
        aggs += [F.sum(c).alias(c) for c in (f"tokens_{i}", f"cost_{i}")]
        aggs += [F.max(c).alias(c) for c in (f"in_{i}", f"same_{i}") if c in counted.columns]
        aggs += [F.min(c).alias(c) for c in (f"pos_{i}",) if c in counted.columns]
    return counted.groupBy("query_id", "id").agg(*aggs)


def document_scores(how: Match) -> list[Column]:
    """Document score from field scores; the weights of the terms are fixed values."""
    per_field, weights = [], []
    for i, name in enumerate(how.fields):
        hit = F.col(f"tokens_{i}") > 0
        value = (
            F.lit(100_000_000).cast("long") * F.col(f"tokens_{i}")
            + F.lit(1_000_000).cast("long") * (9 - F.least(F.lit(9), F.col(f"cost_{i}")))
        )
        if how.prioritize_exact_match:
            value = value + F.lit(100_000).cast("long") * F.coalesce(f"same_{i}", F.lit(False)).cast("int")
        if how.prioritize_token_position:
            value = value + F.lit(100).cast("long") * (999 - F.least(F.lit(999), F.col(f"pos_{i}")))
        per_field.append(F.when(hit, value))
        weights.append(int(how.weights.get(name, 1)))

    ranked = F.array(*[
        F.when(v.isNotNull(), F.struct(v.alias("score"), F.lit(w).alias("weight"))) for v, w in zip(per_field, weights)
    ])
    by_weight = F.array(*[
        F.when(v.isNotNull(), F.struct(F.lit(w).alias("weight"), v.alias("score"))) for v, w in zip(per_field, weights)
    ])
    zero = F.lit(0).cast("long")
    if how.text_match_type == "max_score":
        score, weight = F.array_max(ranked)["score"], F.array_max(ranked)["weight"]
    elif how.text_match_type == "max_weight":
        score, weight = F.array_max(by_weight)["score"], F.array_max(by_weight)["weight"]
    elif how.text_match_type == "sum_score":
        score = reduce(lambda a, b: a + b, [F.coalesce(v * w, zero) for v, w in zip(per_field, weights)])
        weight = F.array_max(by_weight)["weight"]
    else:
        raise ValueError(f"unknown text_match_type {how.text_match_type!r}")
    matching = reduce(lambda a, b: a + b, [F.col(f"in_{i}") for i in range(len(how.fields))])
    score = F.coalesce(score, zero)
    if how.prioritize_num_matching_fields:
        score = score + F.least(F.lit(99), matching)
    return [
        score.cast("long").alias("score"),
        F.coalesce(weight, F.lit(0)).cast("int").alias("weight"),
        matching.cast("int").alias("matched_fields"),
    ]


def _levels() -> list[Column]:
    """What had to be relaxed for a hit: infix fallback, dropped tokens, typos."""
    n = F.col("n_tokens")
    plain = F.col("matched") == n
    by_infix = ~plain & (F.col("matched_any") == n)
    infix = F.when(plain, 0).when(by_infix | (F.col("lead") == 0), 1).otherwise(0)
    dropped = F.when(plain | by_infix, 0).when(F.col("lead") > 0, n - F.col("lead")).otherwise(n - F.col("lead_any"))
    return [infix.alias("infix"), dropped.cast("int").alias("dropped"), F.col("cost").cast("int").alias("typo_cost")]


def _relax(scored: DataFrame, how: Match) -> DataFrame:
    """Admit a relaxed hit only if the stricter hits of its query are too few.

    Levels are counted per query with a grouped count; the window runs over
    the few levels of a query, not over its hits.
    """
    out = ["query_id", "id", "score", "weight", "matched_fields", "typo_cost", "dropped"]
    hits = scored.filter(F.col("dropped") < F.col("n_tokens"))
    can_drop = how.drop_tokens_threshold > 0
    typos_used, infix_used = _uses(how)
    if not can_drop:
        hits = hits.filter("dropped = 0")
    if not (can_drop or infix_used or typos_used):
        return hits.select(*out)

    hits = hits.persist()  # read twice: for the level counts and for the hits themselves
    levels = ["infix", "dropped", "typo_cost"]
    counts = hits.groupBy("query_id", *levels).agg(F.count(F.lit(1)).alias("n"))
    stricter = Window.partitionBy("query_id").orderBy(*levels).rowsBetween(Window.unboundedPreceding, -1)
    unlimited = F.lit(2**62)
    allowed = F.least(
        F.when(F.col("infix") > 0, F.lit(1)).otherwise(unlimited),
        F.when(F.col("dropped") > 0, F.lit(how.drop_tokens_threshold)).otherwise(unlimited),
        F.when(F.col("typo_cost") > 0, F.lit(how.typo_tokens_threshold)).otherwise(unlimited),
    )
    admitted = counts.withColumn("before", F.coalesce(F.sum("n").over(stricter), F.lit(0))).filter(
        F.col("before") < allowed
    )
    return hits.join(admitted.select("query_id", *levels), ["query_id", *levels], "left_semi").select(*out)
