"""Versions of norm nodes, told by the event log and the edges.

A version is a mark in time, not a copy. What was done to a node comes from its
``emenda_aplicada`` events; an ``amends`` edge without such an event still marks a version, dated
by the edge. An ``anulacao`` event ends the node's last version. Version objects point to the work
by ``version_of`` edges and belong to the amendment that their name holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexanchor.operators.core import active
from lexanchor.operators.keyed import bounded_segments, segmented_scan, time_segment

APPLIED = "emenda_slug string, action string, node_afetado string, node_adicionado string"
#: A node is amended seldom, so its segments are long.
YEAR = 365 * 86400


def amendments(ev: DataFrame, e: DataFrame) -> DataFrame:
    """(amendment, node, occurred_at, event_id, action) from events, and from edges that no event backs (action null)."""
    told = ev.filter(F.col("type_slug") == "emenda_aplicada").withColumn("p", F.from_json("payload", APPLIED)).select(
        F.col("p.emenda_slug").alias("amendment"), F.coalesce("p.node_adicionado", "p.node_afetado", "aggregate_id").alias("node"), "occurred_at", "event_id",
        F.col("p.action").alias("action"))
    drawn = active(e.filter(F.col("type_slug") == "amends")).select(
        F.col("source_id").alias("amendment"), F.col("target_id").alias("node"), F.col("valid_from").alias("occurred_at"), F.col("edge_id").alias("event_id"))
    bare = drawn.join(told.select("amendment", "node").distinct(), ["amendment", "node"], "left_anti")
    return told.unionByName(bare.withColumn("action", F.lit(None).cast("string")))


def version_changes(ev: DataFrame, e: DataFrame, o: DataFrame) -> DataFrame:
    """Nodes touched by each amendment, with the kind of change."""
    nodes = o.select(F.col("id").alias("node"), F.col("slug").alias("node_slug"), "type_slug")
    action = F.coalesce("action", F.lit(""))
    return amendments(ev, e).join(nodes, "node").select(
        "amendment", "occurred_at", "node", "node_slug", "type_slug", "action", F.startswith(action, F.lit("adicionou")).alias("added"), (action == "revogou").alias("repealed"))


def version_marks(e: DataFrame, amendment_of: Column) -> DataFrame:
    """(version, work, amendment) of the version objects."""
    return active(e.filter(F.col("type_slug") == "version_of")).select(F.col("source_id").alias("version"), F.col("target_id").alias("work"), amendment_of.alias("amendment"))


def version_summary(changes: DataFrame, marks: DataFrame) -> DataFrame:
    """One row per amendment with its version object: when it came and how many nodes it added, changed and repealed."""
    per = changes.groupBy("amendment").agg(
        F.min("occurred_at").alias("occurred_at"), F.count_if("added").alias("nodes_added"),
        F.count_if(~F.col("added") & ~F.col("repealed")).alias("nodes_changed"), F.count_if("repealed").alias("nodes_repealed"))
    return per.join(marks, "amendment", "left")


def node_versions(ev: DataFrame, e: DataFrame, segment: Column | None = None) -> DataFrame:
    """Versions of each node as intervals: node, version, amendment, action, state, from_at, to_at (null while it holds)."""
    ended = ev.filter(F.col("type_slug") == "anulacao").select(F.col("aggregate_id").alias("node"), "occurred_at", "event_id", F.lit("anulou").alias("action"))
    rows = amendments(ev, e).unionByName(ended, allowMissingColumns=True).withColumnRenamed("occurred_at", "from_at")
    key, order = ["node"], ["from_at", "event_id"]
    rows = bounded_segments(rows, key, order, time_segment("from_at", YEAR) if segment is None else segment)
    x = segmented_scan(rows, key, order, "__seg", counts={"version": ~F.col("action").eqNullSafe("anulou")})
    x = segmented_scan(x, key, order, "__seg", prev={"to_at": F.col("from_at")}, descending=True)
    state = F.when(F.col("action") == "anulou", "anulada").when(F.col("action") == "revogou", "revogada").otherwise("vigente")
    return x.select("node", "version", "amendment", "action", state.alias("state"), "from_at", "to_at")


def versions_at(versions: DataFrame, ts) -> DataFrame:
    """The version of each node that holds at ``ts``."""
    t = F.lit(ts).cast("timestamp_ntz")
    return versions.filter((F.col("from_at") <= t) & (F.col("to_at").isNull() | (F.col("to_at") > t)))
