"""Checked queries: index maintenance and analytics from streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.session import table, work_path
from gleaner.sources.store import latest
from gleaner.streaming import changes as ch
from gleaner.streaming import popular
from gleaner.workload.base import query

# Events as a stream of changes of customers: errors delete, other events save.
_CHANGES = """(SELECT CAST(user_id AS VARCHAR) AS id, event_id AS seq, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op,
    CASE WHEN event_type = 'signup' THEN 'visitors' ELSE 'customers' END AS collection FROM events)"""
_LAST = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM {_CHANGES} WHERE collection = 'customers') WHERE rn = 1)"
_LIVE = "(SELECT CAST(c_custkey AS VARCHAR) AS id, c_name, c_acctbal FROM customer WHERE c_acctbal >= 0)"


def _as_changes(events):
    return events.select(
        F.when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("op"),
        F.when(F.col("event_type") == "signup", "visitors").otherwise("customers").alias("collection"),
        F.col("user_id").cast("string").alias("id"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def event_stream(spark, sf):
    """The events as they arrive; the pattern admits one file as well as a folder of files."""
    known = table(spark, sf, "events").schema
    return spark.readStream.schema(known).parquet(f"{sf.rstrip('/')}/events.parquet*")


def change_stream(spark, sf):
    return _as_changes(event_stream(spark, sf))


def customers(spark, sf):
    """Customers as they are now; those in debt are no longer there."""
    return table(spark, sf, "customer").filter("c_acctbal >= 0").select(
        F.col("c_custkey").cast("string").alias("id"), "c_name", "c_acctbal"
    )


def _maintained(spark, sf, enabled=True):
    log = work_path(spark, "changes")
    stream = ch.listed(change_stream(spark, sf), ["customers"], enabled)
    run = ch.maintain(stream, lambda: customers(spark, sf), log, work_path(spark, "changes-checkpoint"))
    run.awaitTermination()
    return spark.read.parquet(log).drop("epoch")


@query("cdc_upsert", f"SELECT id, c_name, c_acctbal FROM {_LAST} JOIN {_LIVE} USING (id) WHERE op = 'upsert'")
def cdc_upsert(spark, sf):
    """Documents after the whole stream was applied."""
    return latest(_maintained(spark, sf))


@query("cdc_delete", f"SELECT id, seq FROM {_LAST} WHERE op = 'delete'")
def cdc_delete(spark, sf):
    """Tombstones the stream has left behind."""
    from gleaner.functions.skew import best_per_key

    newest = best_per_key(_maintained(spark, sf), ["id"], [F.col("seq").desc()])
    return newest.filter("op = 'delete'").select("id", "seq")


@query("cdc_refetch", f"SELECT id, seq, c_name, c_acctbal FROM {_LAST} JOIN {_LIVE} USING (id) WHERE op = 'upsert'")
def cdc_refetch(spark, sf):
    """Upserts with the row fetched anew; rows gone since give no document."""
    kept = ch.listed(_as_changes(table(spark, sf, "events")), ["customers"])
    return ch.refetch(kept, customers(spark, sf))


@query(
    "popular_queries_stream",
    "SELECT 'k' || json_extract_string(props, '$.k') AS q, count(*) AS count FROM events WHERE event_type IN ('view', 'error') GROUP BY 1",
)
def popular_queries_stream(spark, sf):
    searches = event_stream(spark, sf).filter(F.col("event_type").isin("view", "error")).select(
        F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("q")
    )
    path = work_path(spark, "popular-stream")
    popular.count_queries(searches, path, work_path(spark, "popular-checkpoint")).awaitTermination()
    return popular.current_counts(spark, path)
