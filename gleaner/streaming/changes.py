"""Index maintenance from a stream of changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from gleaner.functions.skew import BROADCAST_ROWS, best_per_key, broadcast_checked

CHANGE = "op string, collection string, id string, seq long, ts timestamp"


def listed(changes: DataFrame, collections: list[str], enabled: bool = True) -> DataFrame:
    """Changes of the collections that are kept up to date; none when switched off."""
    return changes.filter(F.col("collection").isin(*collections) & F.lit(enabled))


def newest(changes: DataFrame) -> DataFrame:
    return best_per_key(changes, ["collection", "id"], [F.col("seq").desc(), F.col("ts").desc()])


def refetch(changes: DataFrame, current: DataFrame) -> DataFrame:
    """Upserts with the row as it is now; a row that is gone since gives no document.

    The changed ids are counted and sent to the source, which is not shuffled
    for a batch of usual size.
    """
    wanted, _ = broadcast_checked(newest(changes).filter("op = 'upsert'").select("id", "seq"))
    return current.join(wanted, "id")


def _write_batch(log_path: str, documents: Callable[[], DataFrame]) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, epoch: int) -> None:
        last = newest(batch).persist()
        ids = last.filter("op = 'upsert'").select("id", "seq", "op")
        upserts = documents().join(F.broadcast(ids) if last.count() <= BROADCAST_ROWS else ids, "id")
        deletes = last.filter("op = 'delete'").select("id", "seq", "op")
        rows = upserts.unionByName(deletes, allowMissingColumns=True)
        # A replayed batch overwrites itself: the log never holds a batch twice.
        rows.write.mode("overwrite").parquet(f"{log_path}/epoch={epoch}")
        last.unpersist()

    return write


def maintain(
    changes: DataFrame,
    documents: Callable[[], DataFrame],
    log_path: str,
    checkpoint: str,
    mode: str = "sync",
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Apply a stream of changes to a change log, read back with ``sources.store.latest``.

    ``sync`` handles what has arrived and stops; ``async`` keeps running.
    ``documents`` gives the present source rows as documents, read anew for
    every batch.
    """
    writer: DataStreamWriter = changes.writeStream.foreachBatch(_write_batch(log_path, documents)).option(
        "checkpointLocation", checkpoint
    )
    if mode == "sync":
        writer = writer.trigger(availableNow=True)
    elif mode == "async":
        writer = writer.trigger(processingTime=interval)
    else:
        raise ValueError(f"mode must be sync or async, got {mode!r}")
    return writer.start()
