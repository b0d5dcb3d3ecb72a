"""Search log, events and the aggregates made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.skew import top_by, top_n

EVENT_TYPES = ("click", "conversion", "custom")
EVENT_SCHEMA = "type string, name string, data struct<q:string, doc_id:string, user_id:string, position:int>"


def search_log(searches: DataFrame, enabled: Column | None = None) -> DataFrame:
    """(ts, user_id, tag, collection, q, found) of the searches that are to be logged."""
    kept = searches if enabled is None else searches.filter(enabled)
    return kept.select("ts", "user_id", "tag", "collection", "q", "found")


def parse_events(raw: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Typed events, and rejected ones with a reason, from JSON text."""
    parsed = raw.withColumn("event", F.from_json(F.col(body), EVENT_SCHEMA))
    reason = (
        F.when(F.col("event.type").isNull(), F.lit("not an event"))
        .when(~F.col("event.type").isin(*EVENT_TYPES), F.concat(F.lit("unknown type "), F.col("event.type")))
        .when(F.col("event.name").isNull(), F.lit("missing name"))
    )
    judged = parsed.withColumn("error", reason)
    others = [c for c in raw.columns if c != body]
    good = judged.filter("error is null").select(*others, "event.type", "event.name", "event.data.*")
    return good, judged.filter("error is not null").select(*others, body, "error")


def popular_queries(log: DataFrame, limit: int | None = None, keys: list[str] | None = None) -> DataFrame:
    """Most frequent queries with their counts, all without a limit; ties go to the smaller text."""
    keys = keys or []
    counts = log.groupBy(*keys, "q").agg(F.count(F.lit(1)).alias("count"))
    return counts if limit is None else _most_frequent(counts, keys, limit)


def nohits_queries(log: DataFrame, limit: int | None = None, keys: list[str] | None = None) -> DataFrame:
    return popular_queries(log.filter("found = 0"), limit, keys)


def _most_frequent(counts: DataFrame, keys: list[str], limit: int) -> DataFrame:
    if not keys:
        return counts.orderBy(F.col("count").desc(), F.col("q").asc()).limit(limit)
    return top_n(counts, keys, [F.col("count").desc(), F.col("q").asc()], limit).drop("rank")


def run_rules(log: DataFrame, rules: DataFrame) -> DataFrame:
    """All rules in one job: (rule, destination, q, count).

    The log is reduced to counts per collection and query before it meets
    the rules, and each rule cuts to its own limit.
    """
    counts = log.groupBy("collection", "q").agg(
        F.count(F.lit(1)).alias("searches"), F.count_if(F.col("found") == 0).alias("misses")
    )
    sources = rules.select("name", "type", "destination", "limit", F.explode("source_collections").alias("collection"))
    joined = counts.join(sources, "collection")
    number = F.when(F.col("type") == "popular_queries", F.col("searches")).when(
        F.col("type") == "nohits_queries", F.col("misses")
    )
    summed = (
        joined.withColumn("_n", number)
        .filter("_n > 0")
        .groupBy("name", "destination", "limit", "q")
        .agg(F.sum("_n").alias("count"))
    )
    ranked = top_by(summed, ["name"], [F.col("count").desc(), F.col("q").asc()], "limit")
    return ranked.select(F.col("name").alias("rule"), "destination", "q", "count")


def query_conversion(events: DataFrame) -> DataFrame:
    """Per query: searches, clicks, conversions and their ratios, from (q, kind)."""
    sums = events.groupBy("q").agg(
        F.count_if(F.col("kind") == "search").alias("searches"),
        F.count_if(F.col("kind") == "click").alias("clicks"),
        F.count_if(F.col("kind") == "conversion").alias("conversions"),
    )
    ratio = lambda part: F.when(F.col("searches") > 0, F.col(part) / F.col("searches"))
    return sums.withColumn("click_ratio", ratio("clicks")).withColumn("conversion_ratio", ratio("conversions"))


def click_positions(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy("q", "doc_id").agg(
        F.count(F.lit(1)).alias("clicks"), F.avg("position").alias("avg_position"), F.min("position").alias("best_position")
    )


def tag_breakdown(log: DataFrame) -> DataFrame:
    return log.groupBy("tag", "q").agg(
        F.count(F.lit(1)).alias("searches"), F.count_if(F.col("found") == 0).alias("misses")
    )
