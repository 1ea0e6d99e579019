"""Versions from events and edges, and the back-test of learned profiles, on hand-made rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lexanchor.operators import graph as G, learn as L, versions as V


def day(n):
    return datetime(2000, 1, n)


def told(i, node, amendment, action, n):
    return (f"e{i}", "emenda_aplicada", node, f'{{"emenda_slug":"{amendment}","action":"{action}","node_afetado":"{node}"}}', day(n))


def tables(spark):
    events = [told(1, "a", "ec1", "alterou_texto", 3), told(2, "a", "ec2", "revogou", 7), told(3, "b", "ec1", "adicionou_paragrafo", 3),
              ("e9", "anulacao", "b", '{"reason":"x"}', day(9)), ("s1", "mudanca_estado", "a", '{"to_state":"revogada"}', day(7)),
              ("s2", "mudanca_estado", "c", '{"to_state":"revogada"}', day(7)), ("s3", "mudanca_estado", "c", '{"to_state":"vigente"}', day(8))]
    ev = spark.createDataFrame(events, "event_id string, type_slug string, aggregate_id string, payload string, t timestamp").withColumn("occurred_at", F.col("t").cast("timestamp_ntz")).drop("t")
    edges = [("m1", "amends", "ec1", "a", day(3), None), ("m2", "amends", "ec3", "a", day(5), None), ("m3", "amends", "ec3", "c", day(5), day(6)), ("v1", "version_of", "v-ec1", "w", day(3), None)]
    e = spark.createDataFrame(edges, "edge_id string, type_slug string, source_id string, target_id string, f timestamp, u timestamp").select(
        "edge_id", "type_slug", "source_id", "target_id", F.col("f").cast("timestamp_ntz").alias("valid_from"), F.col("u").cast("timestamp_ntz").alias("valid_to"))
    return ev, e


def test_versions_are_intervals_of_events_and_bare_edges(spark):
    ev, e = tables(spark)
    got = [(r.node, r.version, r.amendment, r.action, r.state, r.from_at.day, r.to_at and r.to_at.day) for r in V.node_versions(ev, e).orderBy("node", "from_at").collect()]
    assert got == [("a", 1, "ec1", "alterou_texto", "vigente", 3, 5), ("a", 2, "ec3", None, "vigente", 5, 7), ("a", 3, "ec2", "revogou", "revogada", 7, None),
                   ("b", 1, "ec1", "adicionou_paragrafo", "vigente", 3, 9), ("b", 1, None, "anulou", "anulada", 9, None)]
    at = {r.node: r.version for r in V.versions_at(V.node_versions(ev, e), "2000-01-06 00:00:00").collect()}
    assert at == {"a": 2, "b": 1}


def test_summary_names_the_version_object(spark):
    ev, e = tables(spark)
    o = spark.createDataFrame([("a", "sa", "artigo"), ("b", "sb", "paragrafo")], "id string, slug string, type_slug string")
    s = V.version_summary(V.version_changes(ev, e, o), V.version_marks(e, F.substring("source_id", 3, 99)))
    got = {r.amendment: (r.nodes_added, r.nodes_changed, r.nodes_repealed, r.version, r.work) for r in s.collect()}
    assert got == {"ec1": (1, 1, 0, "v-ec1", "w"), "ec2": (0, 0, 1, None, None), "ec3": (0, 1, 0, None, None)}


def test_repealed_nodes_in_the_caches(spark):
    ev, amends = tables(spark)
    o = spark.createDataFrame([(n, n, "artigo", '{"text_content":"x"}', None) for n in "abc"], "id string, slug string, type_slug string, payload string, valid_to timestamp_ntz")
    links = spark.createDataFrame([("parent_of", "a", "b", None)], "type_slug string, source_id string, target_id string, valid_to timestamp_ntz")
    got = {r.id: (r.depth, r.is_leaf, r.is_repealed, r.total_amendments) for r in G.derive_caches(o, links, ev, amends).collect()}
    assert got == {"a": (0, False, True, 3), "b": (1, True, False, 1), "c": (0, True, False, 0)}


def test_back_test_scores_what_the_past_predicted(spark):
    rows = [("relator", "r1", f"2020-0{m}-01", n, *[rate] * 4) for m, n, rate in ((1, 10, 0.5), (2, 10, 0.5), (3, 20, 0.5))]
    rows += [("relator", "r2", f"2020-0{m}-01", 10, *[rate] * 4) for m, rate in ((1, 0.0), (2, 1.0))]
    p = spark.createDataFrame(rows, "profile_type string, target_slug string, period_start string, sample_size long, " + ", ".join(f"{r} double" for r in L.RATES))
    got = {(r.target_slug, r.period_start[5:7]): (r.confidence_score, r.stability_score, r.predictive_gain) for r in L.back_test(p).collect()}
    assert got["r1", "01"] == (0.5, None, None)
    assert got["r1", "02"] == pytest.approx((20 / 30, 1.0, 0.25))  # all targets together had 0.25
    assert got["r2", "02"] == pytest.approx((20 / 30, 0.0, 0.75 - 1.0))
    assert got["r1", "03"] == pytest.approx((40 / 50, 1.0, 0.0))
