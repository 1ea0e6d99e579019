"""Keyed streams: stopped, restarted and fed in any order they end as one batch does."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from lexanchor.streaming import changes as CH

SCHEMA = "key string, at long, tie string, value string"


def feed(spark, src, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)


def run(spark, tmp_path, start=CH.poll_stream, files=1):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(str(tmp_path / "src"))
    q = start(stream, str(tmp_path / "out"), str(tmp_path / "progress"))
    q.awaitTermination()


def expected(rows):
    best = {}
    for key, at, tie, value in rows:
        if at is not None and (key not in best or (-at, tie) < best[key][:2]):
            best[key] = (-at, tie, value)
    return {k: (-a, t, v) for k, (a, t, v) in best.items()}


def test_restarted_stream_with_late_rows_equals_the_batch(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(f"k{rnd.randrange(9)}" if i % 11 else None, rnd.randrange(40), f"e{i:03d}", rnd.choice(["a", "b", None])) for i in range(180)]
    src = str(tmp_path / "src")
    keep_all = lambda s, out, progress: CH.write_changes(CH.newest_changes(s), out, progress)
    feed(spark, src, rows[:60])
    feed(spark, src, rows[60:90])
    run(spark, tmp_path, keep_all)
    feed(spark, src, rows[90:] + rows[:5])  # later and earlier times, and rows that were there before
    run(spark, tmp_path, keep_all)
    got = {r.key: (r.at, r.tie, r.value) for r in CH.read_newest(spark, str(tmp_path / "out")).collect()}
    assert got == expected(rows)
    batch = spark.createDataFrame(rows, SCHEMA)
    assert got == {r.key: (r.at, r.tie, r.value) for r in CH.newest_of(batch).collect()}
    # each change names the value it replaced, in order of its batches
    last = {}
    for r in CH.read_changes(spark, str(tmp_path / "out")).orderBy("batch").collect():
        assert r.previous == last.get(r.key) and (r.status == "new") == (r.key not in last)
        last[r.key] = r.value


def test_polls_leave_changes_only(spark, tmp_path):
    src = str(tmp_path / "src")
    feed(spark, src, [("a", 1, "p1", "h1"), ("b", 1, "p1", "h2"), ("c", 1, "p1", "h3")])
    run(spark, tmp_path)
    poll = [("a", 2, "p2", "h1"), ("b", 2, "p2", "new text"), ("d", 2, "p2", "h4")]
    gone = CH.removals(CH.read_newest(spark, str(tmp_path / "out")), spark.createDataFrame(poll, SCHEMA), "1970-01-01 00:00:00.000002", "p2")
    feed(spark, src, poll + [tuple(r) for r in gone.collect()])
    run(spark, tmp_path)
    seen = defaultdict(set)
    for r in CH.read_changes(spark, str(tmp_path / "out")).collect():
        seen[r.status].add((r.key, r.value, r.previous))
    assert seen == {"new": {("a", "h1", None), ("b", "h2", None), ("c", "h3", None), ("d", "h4", None)},
                    "changed": {("b", "new text", "h2")}, "removed": {("c", None, "h3")}}


def test_states_from_a_log_without_rows_or_times(spark, tmp_path):
    schema = "event_id string, aggregate_id string, payload string, occurred_at timestamp"
    ev = spark.createDataFrame([("e1", "x", '{"to_state":"s1"}', None), ("e2", "y", "{}", None)], schema)
    assert CH.newest_of(CH.state_observations(ev)).count() == 0
    assert CH.newest_of(CH.state_observations(ev.filter("false"))).count() == 0
    some = ev.unionByName(ev.select("event_id", "aggregate_id", "payload", F.timestamp_seconds(F.lit(5)).alias("occurred_at")))
    assert [tuple(r) for r in CH.newest_of(CH.state_observations(some)).collect()] == [("x", 5_000_000, "e1", "s1")]
