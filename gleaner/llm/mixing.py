"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the schedule is the point i * golden ratio mod 1. Cumulative targets
cut the unit interval into one stretch per source; the source whose stretch
holds the point fills the slot. The k-th slot of a source takes the k-th block
of its words: its shuffled documents one after the other, up to twice, cut into
blocks of equal size. Any stretch of the schedule so holds the sources in their
weights, up to a few blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.native import WORD, buckets_for, hash_bucket, running, seeded, stored, stratum, word_count

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
SEED = "mixture"
# Words of a block, at least; the schedule never has more than 2**30 slots.
BLOCK_WORDS, MOST_SLOTS_BITS = 64, 30
# Points are multiples of 2**-32: i * round(2**32 / golden ratio) mod 2**32.
GOLDEN, POINT_BITS = 2654435769, 32
# The interval is looked up by its first bits; slots are counted in chunks.
BIN_BITS, CHUNK_BITS = 12, 14


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Each source's target: stratum, source_size, target.

    Sources in code point order, null last, take the weights in turn and share
    ``share`` times all sizes. A target ends at ``most`` times its source's
    size; the excess goes to the others by weight until none is above. Sorted
    by that limit per weight, the sources at their limit come first, so running
    sums find the level that the others reach. One row per source is handled
    in one task.
    """
    by_name = Window.orderBy(F.col("stratum") == "", "stratum")
    named = sizes.withColumn("_n", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_n") % len(weights) + 1).cast("int"))
    )
    by_limit = Window.orderBy(F.col("cap") / F.col("weight"), "_n")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    levels = (
        named.withColumn("cap", F.col("source_size") * most)
        .withColumn("_given", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("_weights", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("_level", (F.sum("source_size").over(whole) * F.lit(share) - F.col("_given")) / F.col("_weights"))
    )
    reached = F.min(F.when(F.col("cap") / F.col("weight") >= F.col("_level"), F.struct(F.col("cap") / F.col("weight"), F.col("_n"), F.col("_level").alias("level")))).over(whole)
    level = F.coalesce(reached["level"], F.lit(float("inf")))
    return levels.withColumn("_reached", level).select(
        "stratum", "source_size", F.least(F.col("cap").cast("double"), F.col("_reached") * F.col("weight")).alias("target")
    )


def block_words(total: float) -> int:
    """Words of a block for so many words in all: small, unless the schedule grew too long."""
    return max(BLOCK_WORDS, int(total) >> MOST_SLOTS_BITS)


def schedule(goals: DataFrame, total: float, block: int) -> DataFrame:
    """The slots of the mixture: slot, stratum, block (the slot's rank within its source).

    Slots are points mapped through the cumulative targets. They are ranked in
    chunks of consecutive slots, whose counts per source are summed before.
    """
    spark = goals.sparkSession
    slots = -int(-total // block)
    by_name = Window.orderBy(F.col("stratum") == "", "stratum")
    upto = F.sum("target").over(by_name.rowsBetween(Window.unboundedPreceding, 0))
    all_targets = F.sum("target").over(Window.partitionBy())
    edge = F.round(upto / all_targets * float(2**POINT_BITS)).cast("long")
    shift = POINT_BITS - BIN_BITS
    stretches = (
        goals.filter("target > 0")
        .withColumn("high", edge)
        .withColumn("low", F.coalesce(F.lag("high").over(by_name), F.lit(0)))
        .filter("high > low")
        .withColumn("bin", F.explode(F.sequence(F.shiftright("low", shift), F.shiftright(F.col("high") - 1, shift))))
        .select("bin", "low", "high", "stratum")
    )
    points = spark.range(slots).select(
        F.col("id").alias("slot"), F.expr(f"id * {GOLDEN}L & {2**POINT_BITS - 1}L").alias("point")
    )
    filled = points.withColumn("bin", F.shiftright("point", shift)).join(stretches, "bin")
    filled = filled.filter((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high"))).select("slot", "stratum")
    chunked = filled.withColumn("chunk", F.shiftright("slot", CHUNK_BITS))
    return running(chunked, ["stratum"], "chunk", [F.col("slot")], F.lit(1), "block").select("slot", "stratum", "block")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED,
        key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """What every slot of the mixture takes of every document, a row per piece.

    Columns: slot, stratum, block, key, size, source_size, target, start (the
    document's place in its source, which names the row), first (the first
    word taken) and words. Documents without words, and pieces whose block no
    slot has taken, are there with a null slot and ``words`` 0, so that every
    row of ``docs`` is found. A document gives at most ``most`` times its words.

    Null and empty texts have size 0 and give nothing; a source of such texts
    has the target 0; null sources are one source. Repeated rows are rows like
    others. The order depends on the seed and the rows only. An empty table
    gives an empty result. Only sizes are moved, no text; a hot source is
    numbered in ranges of its shuffle order.
    """
    rows = stored(
        docs.select(
            F.col(key).alias("doc_id"),
            stratum(F.col(source)).alias("stratum"),
            word_count(F.col(text)).alias("size"),
            seeded(seed, F.col(key), F.col(text)).alias("order"),
        ),
        "mixing",
    )
    sizes = rows.groupBy("stratum").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    facts = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    total = facts[0] * share
    block = block_words(total)
    goals = stored(targets(sizes.drop("_rows"), weights, share, most), "targets")
    slots = schedule(goals, total, block)

    placed = running(
        rows.withColumn("bucket", hash_bucket(F.col("order"), buckets_for(facts[1]))),
        ["stratum"], "bucket", [F.col("order"), F.col("doc_id")], F.col("size"), "start",
    ).join(goals, "stratum")
    kept = ["doc_id", "size", "source_size", "target", "stratum", "start"]
    # Every pass over the source adds its size to the places of its words.
    turns = placed.filter("size > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    begin = turns.withColumn("begin", F.col("start") + F.col("turn") * F.col("source_size"))
    blocks = F.sequence(F.expr(f"begin div {block}"), F.expr(f"(begin + size - 1) div {block}"))
    pieces = (
        begin.withColumn("block", F.explode(blocks))
        .withColumn("_from", F.greatest("begin", F.col("block") * block))
        .withColumn("_to", F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block))
        .join(slots, ["stratum", "block"], "left")
    )
    taken = pieces.select(
        "slot", "block", *kept, (F.col("_from") - F.col("begin")).alias("first"),
        F.when(F.col("slot").isNotNull(), F.col("_to") - F.col("_from")).otherwise(0).cast("long").alias("words"),
    )
    nothing = F.lit(None).cast("long")
    empty = placed.filter("size = 0").select(
        nothing.alias("slot"), nothing.alias("block"), *kept, nothing.alias("first"), F.lit(0).cast("long").alias("words")
    )
    return taken.unionByName(empty)


def taken_words(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row per document: key, size, source_size, target, taken.

    Documents are told apart by their place in their source; those without
    words have none and stay as they are.
    """
    named = ["doc_id", "size", "source_size", "target"]
    whole = pieces.filter("size > 0").groupBy("stratum", "start", *named).agg(F.sum("words").alias("taken"))
    empty = pieces.filter("size = 0").select(*named, F.lit(0).cast("long").alias("taken"))
    return whole.select(*named, "taken").unionByName(empty).withColumnRenamed("doc_id", key)


def taken_sql(table: str = "documents", weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> str:
    """SQL of ``taken_words``, with each row's ``rid`` from the table if it has one."""
    listed = ", ".join(map(str, weights))
    shift = POINT_BITS - BIN_BITS
    return f"""
r AS (
  SELECT *, coalesce('=' || source, '') AS stratum, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         md5(concat_ws('|', '{seed}', coalesce(doc_id::VARCHAR, '\\N'), coalesce(text, '\\N'))) AS ord
  FROM {table}),
src AS (SELECT stratum, sum(size)::BIGINT AS source_size FROM r GROUP BY stratum),
n AS (
  SELECT *, row_number() OVER (ORDER BY stratum = '', stratum) - 1 AS n,
         ([{listed}])[(row_number() OVER (ORDER BY stratum = '', stratum) - 1) % {len(weights)} + 1] AS weight, source_size * {most} AS cap
  FROM src),
lv AS (
  SELECT *, cap::DOUBLE / weight AS ratio,
         ((sum(source_size) OVER ())::DOUBLE * {share}::DOUBLE - coalesce(sum(cap) OVER b, 0)::DOUBLE)
           / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level
  FROM n WINDOW b AS (ORDER BY cap::DOUBLE / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cut AS (SELECT coalesce((SELECT level FROM lv WHERE ratio >= level ORDER BY ratio, n LIMIT 1), 'inf'::DOUBLE) AS reached),
goal AS (SELECT stratum, source_size, least(cap::DOUBLE, reached * weight) AS target FROM lv, cut),
c AS (
  SELECT greatest({BLOCK_WORDS}, floor(coalesce(sum(source_size), 0)::DOUBLE * {share})::BIGINT >> {MOST_SLOTS_BITS}) AS block,
         coalesce(sum(source_size), 0)::DOUBLE * {share} AS total FROM src),
edge AS (
  SELECT stratum, round(sum(target) OVER (ORDER BY stratum = '', stratum ROWS UNBOUNDED PRECEDING) / sum(target) OVER () * {2.0**POINT_BITS})::BIGINT AS high
  FROM goal WHERE target > 0),
bins AS (
  SELECT stratum, low, high, unnest(range(low >> {shift}, ((high - 1) >> {shift}) + 1)) AS bin
  FROM (SELECT *, coalesce(lag(high) OVER (ORDER BY high), 0) AS low FROM edge) WHERE high > low),
slots AS (
  SELECT stratum, row_number() OVER (PARTITION BY stratum ORDER BY slot) - 1 AS block
  FROM (SELECT slot, slot * {GOLDEN}::BIGINT & {2**POINT_BITS - 1}::BIGINT AS point FROM (SELECT unnest(range(ceil(total / block)::BIGINT)) AS slot FROM c)) p
  JOIN bins ON p.point >> {shift} = bin AND point >= low AND point < high),
placed AS (
  SELECT r.*, source_size, target, row_number() OVER () AS row_id,
         (sum(size) OVER (PARTITION BY stratum ORDER BY ord, doc_id ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM r JOIN goal USING (stratum)),
piece AS (
  SELECT row_id, stratum, begin, size, block AS width, unnest(range(begin // block, (begin + size - 1) // block + 1)) AS block
  FROM (SELECT *, start + turn * source_size AS begin FROM placed, (SELECT unnest(range({most})) AS turn) WHERE size > 0), c),
sums AS (
  SELECT row_id, sum(least(begin + size, (block + 1) * width) - greatest(begin, block * width)) AS taken
  FROM piece JOIN slots USING (stratum, block) GROUP BY row_id),
mixed AS (SELECT placed.*, coalesce(taken, 0)::BIGINT AS taken FROM placed LEFT JOIN sums USING (row_id))"""
