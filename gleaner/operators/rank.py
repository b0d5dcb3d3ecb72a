"""Order, page and group hits; everything is per query_id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.skew import BROADCAST_ROWS, broadcast_checked, ordinals, top_n

PER_PAGE = 10
MAX_PER_PAGE = 250


def asc(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).asc_nulls_last()


def desc(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).desc_nulls_last()


def default_order(default_sorting_field: str | None = None) -> list[Column]:
    """Text match, then weight of the matched field, then the collection's own sort field."""
    order = [desc("score"), desc("weight")]
    return order + [desc(default_sorting_field)] if default_sorting_field else order


def seeded_order(seed: int, key: str = "id") -> Column:
    """Random order that is the same for the same seed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key))).asc()


def random_order() -> Column:
    return F.rand().asc()


def page(
    hits: DataFrame,
    order: list[Column],
    page: int = 1,
    per_page: int = PER_PAGE,
    offset: int | None = None,
    limit_hits: int | None = None,
) -> DataFrame:
    """One page per query, ranked from 1; ties go to the smaller id."""
    if not 0 <= per_page <= MAX_PER_PAGE:
        raise ValueError(f"per_page must be within 0..{MAX_PER_PAGE}")
    if page < 1:
        raise ValueError("pages are counted from 1")
    start = (page - 1) * per_page if offset is None else offset
    end = start + per_page
    if limit_hits is not None:
        end = min(end, limit_hits)
    return top_n(hits, ["query_id"], [*order, F.col("id").asc()], max(end, 0)).filter(F.col("rank") > start)


def attach(shown: DataFrame, docs: DataFrame) -> DataFrame:
    """Document columns for the rows of a page.

    The page is counted and sent to the documents, so whole texts are not
    shuffled to meet a few rows. Of a page too large for that, the distinct ids
    are sent if they are few enough, and only the texts shown are shuffled.
    """
    rows, count = broadcast_checked(shown)
    if count > BROADCAST_ROWS:
        ids, count = broadcast_checked(rows.select("id").distinct())
        docs = docs.join(ids, "id", "left_semi") if count <= BROADCAST_ROWS else docs
    return docs.join(rows, "id")


def found(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """Total matches per query, 0 for a query without any."""
    return totals(hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("found")), queries)


def totals(counts: DataFrame, queries: DataFrame) -> DataFrame:
    """Counted matches (query_id, found) of every query, 0 where there are none."""
    return queries.select("query_id").join(counts, "query_id", "left").select(
        "query_id", F.coalesce("found", F.lit(0)).alias("found")
    )


def page_facts(totals: DataFrame, page: int, per_page: int) -> DataFrame:
    last = F.greatest(F.lit(1), F.ceil(F.col("found") / F.lit(per_page))).cast("int")
    return totals.select(
        "query_id",
        "found",
        F.lit(page).alias("page"),
        F.lit(per_page).alias("per_page"),
        last.alias("last_page"),
        (F.lit(page) > 1).alias("has_previous"),
        (F.lit(page) < last).alias("has_next"),
        F.when(F.lit(page) > 1, F.lit(page - 1)).alias("previous_page"),
        F.when(F.lit(page) < last, F.lit(page + 1)).alias("next_page"),
    )


def score_buckets(hits: DataFrame, buckets: int, order: list[Column] | None = None) -> DataFrame:
    """Split the hits of a query into equal score buckets, best first.

    A query may match a large share of all documents, so the positions come
    from ``ordinals`` and the bucket follows from position and total.
    """
    order = order or [desc("score")]
    ranked = ordinals(hits, ["query_id"], [*order, F.col("id").asc()], "_position")
    totals = ranked.groupBy("query_id").agg(F.max("_position").alias("_total"))
    small = F.floor(F.col("_total") / buckets)
    larger = F.col("_total") % buckets
    position = F.col("_position") - 1
    in_larger = larger * (small + 1)
    bucket = F.when(
        position < in_larger, F.floor(position / (small + 1))
    ).otherwise(larger + F.floor((position - in_larger) / F.greatest(small, F.lit(1))))
    return (
        ranked.join(totals, "query_id")
        .withColumn("bucket", (bucket + 1).cast("int"))
        .drop("_position", "_total")
    )


def group_hits(
    hits: DataFrame,
    field: str,
    order: list[Column],
    group_limit: int = 3,
    groups: int = PER_PAGE,
    include_missing: bool = True,
    max_candidates: int | None = None,
) -> DataFrame:
    """Best hits per value of a field: (…, group_rank, rank, group_found).

    A group ranks as its best hit does. ``group_found`` counts all matches of
    the group, or those among the first ``max_candidates`` hits of the query.
    """
    if not include_missing:
        hits = hits.filter(F.col(field).isNotNull())
    hits = hits.persist()  # read for the groups and again for their sizes
    order = [*order, F.col("id").asc()]
    counted = hits if max_candidates is None else top_n(hits, ["query_id"], order, max_candidates, "_n")
    sizes = counted.groupBy("query_id", field).agg(F.count(F.lit(1)).alias("group_found"))
    kept = top_n(hits, ["query_id", field], order, group_limit)
    leaders = Window.partitionBy("query_id").orderBy(*order)
    ranks = kept.filter("rank = 1").withColumn("group_rank", F.row_number().over(leaders))
    ranks = ranks.filter(F.col("group_rank") <= groups).select("query_id", field, "group_rank")
    same = lambda other: (kept["query_id"] == other["query_id"]) & kept[field].eqNullSafe(other[field])
    out = kept.join(ranks, same(ranks)).drop(ranks["query_id"]).drop(ranks[field])
    sizes = sizes.withColumnsRenamed({"query_id": "_query", field: "_value"})
    out = out.join(sizes, (F.col("query_id") == F.col("_query")) & F.col(field).eqNullSafe(F.col("_value")), "left")
    return out.drop("_query", "_value").withColumn("group_found", F.coalesce("group_found", F.lit(0)))
