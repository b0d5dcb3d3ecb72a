"""Column expressions and row numbering shared by the operators written in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.session import work_path

# A word: code points other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Rows that one bucket of a distributed numbering holds on average.
BUCKET_ROWS = 4000


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(text_or_empty(text), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z folded, all else as it is; texts without A-Z are not rebuilt."""
    return F.when(text.rlike("[A-Z]"), F.translate(text, UPPER, UPPER.lower())).otherwise(text)


def removed(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def stratum(source: Column) -> Column:
    """A join key for a source that may be null: null is a source of its own."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))


def seeded(seed: str, *parts: Column) -> Column:
    """A reproducible shuffle key: 32 hexadecimal digits, the same on every engine."""
    texts = [F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts]
    return F.md5(F.concat_ws("|", F.lit(seed), *texts))


def hash_bucket(key: Column, buckets: int) -> Column:
    """Which of ``buckets`` equal ranges of ``seeded`` keys a key lies in."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(2**32)).cast("long")


def buckets_for(rows: int) -> int:
    return max(1, rows // BUCKET_ROWS)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read from there, for rows used more than once."""
    folder = work_path(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def running(df: DataFrame, keys: list[str], bucket: str, order: list[Column], amount: Column, name: str) -> DataFrame:
    """The sum of ``amount`` over the earlier rows of a key, without sending a key to one task.

    ``bucket`` numbers ranges of the order. Sums inside a bucket are windows of
    one bucket each; the buckets' own sums, few per key, give their starts.
    """
    df = df.withColumn("_amount", amount)
    sums = df.groupBy(*keys, bucket).agg(F.sum("_amount").alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, bucket, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_inside", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
        .join(starts, [*keys, bucket])
        .withColumn(name, (F.col("_start") + F.col("_inside")).cast("long"))
        .drop("_amount", "_start", "_inside")
    )
