"""Keyed state over streams: what is known last of every key, and only the changes of it.

``newest_changes`` keeps one small row per key in the state store (the newest time, its tie
breaker and value). A row leaves only if it is newer than what the key's state holds, so a late
row changes nothing and a stream that is stopped, restarted and fed in another order ends with the
same state as one batch over all rows. The state has one row per key and no watermark: no row is
ever too late.

Rows without a key form a key of their own; rows without a time or tie breaker have no place in
the order and are left out, as they are in ``newest_of``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

ROWS = "key string, at long, tie string, value string"
CHANGES = f"{ROWS}, status string, previous string"


def observations(df: DataFrame, key, at, tie, value) -> DataFrame:
    """(key, at, tie, value): what was seen of a key, when (in microseconds), and what orders equal times (lowest first)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in (key, at, tie, value)]
    micros = F.unix_micros(cols[1].cast("timestamp"))
    rows = df.select(cols[0].cast("string").alias("key"), micros.alias("at"), cols[2].cast("string").alias("tie"), cols[3].cast("string").alias("value"))
    return rows.filter(F.col("at").isNotNull() & F.col("tie").isNotNull())


def newest_of(rows: DataFrame) -> DataFrame:
    """The newest observation of every key as a plain aggregation."""
    rank = F.struct((-F.col("at")).alias("t"), "tie")
    return rows.groupBy("key").agg(F.min_by(F.struct("at", "tie", "value"), rank).alias("s")).select("key", "s.*")


def _combine(batches):
    """One row per key of each Arrow batch, so that a busy key sends few rows to its state."""
    for part in batches:
        part = part.sort_values(["at", "tie"], ascending=[False, True], kind="stable")
        yield part.drop_duplicates("key")


def _processor():
    # a local class travels with the query: executors need not have this package
    from pyspark.sql import Row
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Newest(StatefulProcessor):
        def init(self, handle) -> None:
            self.newest = handle.getValueState("newest", "at long, tie string, value string")

        def handleInputRows(self, key, rows, timerValues):
            at, tie, value = min(((r.at, r.tie, r.value) for r in rows), key=lambda r: (-r[0], r[1]))
            old = self.newest.get() if self.newest.exists() else None
            if old is None or (-at, tie) < (-old[0], old[1]):
                self.newest.update((at, tie, value))
                status = "new" if old is None else "kept" if old[2] == value else "removed" if value is None else "changed"
                yield Row(key=key[0], at=at, tie=tie, value=value, status=status, previous=old[2] if old else None)

        def close(self) -> None:
            pass

    return Newest()


def newest_changes(rows: DataFrame) -> DataFrame:
    """Stream of observations to the stream of those that became the newest of their key.

    ``status`` is new, changed, removed (the value is now NULL) or kept (newer, with the same
    value); ``previous`` is the value before. Runs in update mode.
    """
    rows.sparkSession.conf.set(STORE, ROCKS)
    few = rows.mapInPandas(_combine, ROWS)
    return few.groupBy("key").transformWithState(_processor(), CHANGES, "Update", "None")


def write_changes(changes: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, where: Column | None = None):
    """Starts a query that writes each batch of changes under ``path``; a batch that runs again replaces itself."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        (batch if where is None else batch.filter(where)).write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}")

    return changes.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"availableNow": True})).start()


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """Everything that changed, with the number of the batch that brought it."""
    return spark.read.schema(f"{CHANGES}, batch long").option("basePath", path).parquet(f"{path}/batch=*")


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """What holds now, from the changes alone."""
    return newest_of(read_changes(spark, path))


def state_observations(ev: DataFrame) -> DataFrame:
    """Events with a state, as observations of their aggregates (first event id on equal times)."""
    from lexanchor.operators.core import state_events

    return observations(state_events(ev), "aggregate_id", "occurred_at", "event_id", "to_state")


def state_change_stream(ev: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Current state as a stateful stream: transitions of aggregates, each once."""
    return write_changes(newest_changes(state_observations(ev)), path, checkpoint, trigger)


def poll_stream(polls: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """What periodic polls of a source brought: observations (key, at, tie, content hash) to new, changed and removed keys.

    A poll that finds a key as it was leaves no row; a key that is gone is an observation with a
    NULL hash (``poll_diff`` gives the keys that a whole poll no longer has).
    """
    return write_changes(newest_changes(polls), path, checkpoint, trigger, F.col("status") != "kept")


def removals(known: DataFrame, poll: DataFrame, at, tie) -> DataFrame:
    """Observations with a NULL hash for the keys that a whole poll lacks; ``known`` are the newest observations so far."""
    gone = known.filter(F.col("value").isNotNull()).join(poll.select("key"), "key", "left_anti")
    return observations(gone.select("key"), "key", F.lit(at), F.lit(tie), F.lit(None).cast("string"))
