"""Shards that all hold the mixture of the whole: proportional stratified interleaving.

Rows are shuffled within their source by a seeded hash and ranked; the rank as
a share of the source (its fractional rank) spreads every source evenly over
the interval from 0 to 1. Sorted by that share, any stretch of rows holds the
sources in their proportions, and equal cuts give the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.native import buckets_for, hash_bucket, running, seeded, stored, stratum, text_or_empty

SEED = "interleave"


def interleave(
    docs: DataFrame, shards: int, seed: str = SEED, key: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """Every row with its shard and slot: key, size, text_crc32, law, shard, slot, grown_shard.

    The law kept is ``rows``: the shards' row counts differ by one at most, and
    the rows of any source in two shards by a few. ``size`` is the UTF-8 bytes
    of the text plus 1. A null text has the size 1 and the checksum 0 of an
    empty one; null sources are a source of their own; repeated rows are rows
    like others, interchangeable among themselves. ``grown_shard`` is null, as
    it belongs to another law. An empty table gives an empty result. The order
    depends on the seed and the rows only, not on files or tasks.
    """
    given = docs.select(
        F.col(key).alias("doc_id"),
        stratum(F.col(source)).alias("stratum"),
        (F.octet_length(text_or_empty(F.col(text))) + 1).cast("long").alias("size"),
        F.crc32(text_or_empty(F.col(text))).alias("text_crc32"),
        seeded(seed, F.col(key), F.col(text)).alias("order"),
    )
    rows = stored(given, "interleave")
    sources = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("of"))
    total = rows.count()
    buckets = buckets_for(total)

    ranked = running(
        rows.withColumn("bucket", hash_bucket(F.col("order"), buckets)),
        ["stratum"], "bucket", [F.col("order")], F.lit(1), "rank",
    ).join(sources, "stratum")
    share = (F.col("rank") + 0.5) / F.col("of")
    spread = ranked.withColumn("share", share).withColumn("bucket", F.floor(F.col("share") * buckets))
    placed = running(
        spread.withColumn("all", F.lit(0)),
        ["all"], "bucket", [F.col("share"), F.col("stratum"), F.col("order")], F.lit(1), "place",
    )
    shard = F.expr(f"place * {shards} div {max(1, total)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select(
        F.col("doc_id").alias(key),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("place") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


# Slice-by-byte table of the checksum, made from its polynomial.
_CRC_TABLE = (
    "list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: "
    "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n))"
)
_BYTES = (
    "flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN c = '' THEN [] "
    "WHEN unicode(c) < 128 THEN [unicode(c)] "
    "WHEN unicode(c) < 2048 THEN [192 + unicode(c) // 64, 128 + unicode(c) % 64] "
    "WHEN unicode(c) < 65536 THEN [224 + unicode(c) // 4096, 128 + unicode(c) // 64 % 64, 128 + unicode(c) % 64] "
    "ELSE [240 + unicode(c) // 262144, 128 + unicode(c) // 4096 % 64, 128 + unicode(c) // 64 % 64, 128 + unicode(c) % 64] END))"
)


def crc32_sql(text: str) -> str:
    """SQL of the unsigned CRC-32 of a text's UTF-8 bytes; needs ``crc_table`` with its column ``t``."""
    return (
        f"xor(list_reduce({_BYTES.format(text=text)}, lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), "
        "4294967295::BIGINT), 4294967295::BIGINT)"
    )


CRC_TABLE_SQL = f"crc_table AS MATERIALIZED (SELECT list_transform({_CRC_TABLE}, lambda x: x::BIGINT) AS t)"


def interleave_sql(shards: int, seed: str = SEED) -> str:
    return f"""
WITH {CRC_TABLE_SQL},
r AS (
  SELECT doc_id, coalesce('=' || source, '') AS stratum, coalesce(text, '') AS body, strlen(coalesce(text, '')) + 1 AS size,
         md5(concat_ws('|', '{seed}', coalesce(doc_id::VARCHAR, '\\N'), coalesce(text, '\\N'))) AS ord
  FROM documents),
s AS (
  SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY ord) - 1 + 0.5::DOUBLE) / count(*) OVER (PARTITION BY stratum) AS share
  FROM r),
p AS (
  SELECT *, row_number() OVER (ORDER BY share, stratum, ord) - 1 AS place, count(*) OVER () AS total FROM s)
SELECT doc_id, size::BIGINT AS size, {crc32_sql("body")}::BIGINT AS text_crc32, 'rows' AS law,
       (place * {shards} // total)::INTEGER AS shard,
       (place - ((place * {shards} // total) * total + {shards - 1}) // {shards})::BIGINT AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM p, crc_table
"""
