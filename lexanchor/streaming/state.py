"""Streams: current state from an append-only event log, and a resumable embedding worklist.

A late event is ordered by when it occurred, so no watermark is needed; the state
kept is one row per aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexanchor.operators.core import state_events
from lexanchor.operators.keyed import first_per_key
from lexanchor.operators.reconcile import snapshot_diff
from lexanchor.operators.vectors import pending_chunks


def newest_states(rows: DataFrame) -> DataFrame:
    """Newest state per aggregate by time of occurrence, lowest event id on ties, as a plain aggregation."""
    rank = F.struct((-F.unix_micros(F.col("occurred_at").cast("timestamp"))).alias("t"), "event_id")
    return rows.groupBy("aggregate_id").agg(F.min_by(F.struct("event_id", "to_state", "occurred_at"), rank).alias("s")).select("aggregate_id", "s.*")


def current_state_stream(ev: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Keeps the newest state of every aggregate under ``path`` from a stream of events.

    Each micro-batch reduces its own rows and writes them to a folder named by the
    batch, so a batch that is run again replaces itself. ``read_current_state``
    reduces the folders; ``compact_state`` folds them into one.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        newest_states(state_events(batch)).write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}")

    return ev.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_current_state(spark: SparkSession, path: str) -> DataFrame:
    return newest_states(spark.read.parquet(f"{path}/batch=*"))


def compact_state(spark: SparkSession, path: str, target: str) -> None:
    """Writes the reduced state as the first folder of a new location."""
    read_current_state(spark, path).write.mode("overwrite").parquet(f"{target}/batch={0:012d}")


def state_updates(ev: DataFrame) -> DataFrame:
    """The same state as a streaming aggregation, for sinks in update mode."""
    return newest_states(state_events(ev))


def worklist_stream(chunks: DataFrame, emb_path: str, model: str, out: str, checkpoint: str):
    """Pending chunks of each new batch; a restart goes on where it stopped."""
    spark = chunks.sparkSession

    def sink(batch: DataFrame, batch_id: int) -> None:
        done = spark.read.parquet(emb_path)
        first = first_per_key(batch, ["chunk_slug"], [F.col("chunk_text").asc()])
        pending_chunks(first, done, model).write.mode("overwrite").parquet(f"{out}/batch={batch_id:012d}")

    return chunks.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def poll_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """What a periodic poll of the source brought: new and removed keys."""
    return snapshot_diff(old, new, key).filter(F.col("status") != "kept")
