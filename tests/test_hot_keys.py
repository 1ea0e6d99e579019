"""Segments, factors and intervals where one key, text or chain holds most of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from lexanchor.operators import blocks as B, core as C, graph as G, keyed as K, signals as S


def busy_day(spark):
    """A case with a third of the events on one day, many of them in the same second, among ordinary cases."""
    r = random.Random(4)
    rows = [(f"e{i:05d}", "hot", f"2020-01-05 00:{r.randrange(3):02d}:{r.randrange(60) if i % 2 else 0:02d}") for i in range(1500)]
    rows += [(f"c{i:05d}", f"case{i % 90}", f"2020-01-{1 + i % 20:02d} 10:00:{i % 60:02d}") for i in range(3000)]
    return spark.createDataFrame(rows, "event_id string, aggregate_id string, t string").select(
        "event_id", "aggregate_id", F.lit("k").alias("type_slug"), F.lit('{"to_state":"s"}').alias("payload"), F.col("t").cast("timestamp_ntz").alias("occurred_at"))


def test_busy_days_are_cut_into_bounded_segments(spark, monkeypatch):
    ev = busy_day(spark)
    at = ["aggregate_id"], ["occurred_at", "event_id"]
    seg = K.bounded_segments(ev, *at, K.time_segment("occurred_at"), rows=100)
    sizes = [r["count"] for r in seg.groupBy("aggregate_id", "__seg").count().collect()]
    assert max(sizes) <= 250 and len([s for s in sizes if s > 50]) >= 6
    bound = K.bounded_segments
    for module in (S, C):
        monkeypatch.setattr(module, "bounded_segments", lambda *a: bound(*a, rows=100))
    rows = sorted((r.aggregate_id, r.occurred_at, r.event_id) for r in ev.collect())
    before = {b[2]: (a[1] if a[0] == b[0] else None) for a, b in zip([(None,) * 3, *rows], rows)}
    assert {r.event_id: r.previous_at for r in S.time_between(ev).collect()} == before
    steps, n = {}, {}
    for case, _, e in rows:
        n[case] = steps[e] = n.get(case, 0) + 1
    assert {r.event_id: r.step for r in S.trajectory(ev).collect()} == steps
    after = {a[2]: (b[1] if a[0] == b[0] else None) for a, b in zip(rows, [*rows[1:], (None,) * 3])}
    assert {r.event_id: r.to_at for r in C.state_intervals(ev).collect()} == after


def test_a_text_with_many_blocks_and_slugs_stays_in_factors(spark):
    rows = [(i, f"art-{i % 40}" if i % 9 else "", "same text" if i < 2000 else f"text {i % 700}" if i % 5 else "", 0.5, "x") for i in range(4000)]
    b = spark.createDataFrame(rows, "block_id long, anchor_slug string, block_text string, anchor_confidence double, anchor_source string")
    pairs, members = B.anchor_factors(b)
    assert pairs.count() + members.count() < 3 * len(rows)
    expanded = B.block_anchors(b)
    assert expanded.count() > 60_000
    want = expanded.groupBy("anchor_role").agg(F.count("*").alias("total"), F.count_distinct("block_id").alias("unique_blocks"), F.count_distinct("anchor_slug").alias("unique_slugs"))
    assert sorted(map(tuple, B.block_anchor_summary(b).select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert "collect_" not in B.co_anchors(b)._jdf.queryExecution().optimizedPlan().toString()


def totals(links, own):
    parent = dict(links)
    out = {}
    for node, v in own.items():
        at = node
        while at is not None:
            a, b = out.get(at, (0, 0))
            out[at] = (a + (v if at == node else 0), b + v)
            at = parent.get(at)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rollup_by_intervals_on_random_forests(spark, seed):
    r = random.Random(seed)
    links = [(f"n{i}", f"n{r.randrange(max(0, i - 5) if seed == 1 else 0, i)}") for i in range(1, 120) if r.random() < 0.9]
    own = {f"n{r.randrange(130)}": r.randrange(1, 9) for _ in range(50)}
    labels = G.interval_labels(spark.createDataFrame(links, "node string, parent string"))
    got = G.rollup_by_intervals(spark.createDataFrame(list(own.items()), "node string, n long"), labels, size=16)
    assert {x.node: (x.own, x.total) for x in got.collect()} == totals(links, own)
    spans = {x.node: (x.root, x.enter, x.leave) for x in labels.collect()}
    assert all(spans[p][0] == spans[c][0] and spans[p][1] < spans[c][1] < spans[c][2] < spans[p][2] for c, p in links)


def test_a_long_chain_rolls_up(spark):
    n = 100_000
    links = spark.range(1, n).select(F.concat(F.lit("n"), "id").alias("node"), F.concat(F.lit("n"), F.col("id") - 1).alias("parent"))
    labels = G.interval_labels(links)
    got = G.rollup_by_intervals(spark.range(n).select(F.concat(F.lit("n"), "id").alias("node"), F.lit(1).cast("long").alias("n")), labels)
    wrong = got.filter(F.col("total") != n - F.substring("node", 2, 20).cast("long"))
    assert got.count() == n and wrong.isEmpty()


def test_cycles_and_second_parents_are_reported(spark):
    for links, said in (([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "cycle"), ([("a", "b"), ("a", "c")], "two parents")):
        with pytest.raises(ValueError, match=said):
            G.interval_labels(spark.createDataFrame(links, "node string, parent string"))
