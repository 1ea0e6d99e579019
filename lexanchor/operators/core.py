"""Readable views, current state, tree nodes and temporal reconstruction over the four primitives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexanchor.functions.text import jget, jhas
from lexanchor.operators.keyed import bounded_segments, first_per_key, segmented_scan, time_segment


def active(df: DataFrame) -> DataFrame:
    return df.filter(F.col("valid_to").isNull())


def _types(t: DataFrame) -> DataFrame:
    # type tables are closed vocabularies of a few dozen rows
    return F.broadcast(t)


def objects_readable(o: DataFrame, ot: DataFrame) -> DataFrame:
    t = _types(ot.select("type_slug", "domain_slug", "ontological_class", F.col("label").alias("type_label")))
    return o.join(t, "type_slug").select(
        "id", "slug", "type_slug", "domain_slug", "ontological_class", "type_label", "payload", "hash_content",
        "valid_from", "valid_to", "recorded_at",
    )


def edges_readable(e: DataFrame, et: DataFrame, o: DataFrame, a: DataFrame | None = None) -> DataFrame:
    """Edges with type and endpoint slugs. Only objects resolve, unless actors are given too."""
    ends = o.select("id", "slug") if a is None else o.select("id", "slug").unionByName(a.select("id", "slug"))
    t = _types(et.select("type_slug", "epistemic_class", F.col("label").alias("type_label")))
    src = ends.select(F.col("id").alias("source_id"), F.col("slug").alias("source_slug"))
    tgt = ends.select(F.col("id").alias("target_id"), F.col("slug").alias("target_slug"))
    # types last, so that their texts do not travel; edges are hashed to the ends of their partition, not sorted
    return e.join(src.hint("shuffle_hash"), "source_id", "left").join(tgt.hint("shuffle_hash"), "target_id", "left").join(t, "type_slug")


def state_events(ev: DataFrame) -> DataFrame:
    """Events that set a state; a key with a null value counts."""
    return ev.filter(jhas("payload", "to_state")).withColumn("to_state", jget("payload", "to_state"))


def latest_state(ev: DataFrame) -> DataFrame:
    """Newest state event per aggregate, lowest event id on equal times."""
    rows = state_events(ev).select("aggregate_id", "event_id", "to_state", "occurred_at")
    return first_per_key(rows, ["aggregate_id"], [F.col("occurred_at").desc(), F.col("event_id").asc()])


def current_state(ev: DataFrame, o: DataFrame, a: DataFrame, ot: DataFrame, at: DataFrame) -> DataFrame:
    def named(df, types, p):
        t = _types(types.select("type_slug", F.col("domain_slug").alias(f"{p}_domain")))
        return df.select("id", F.col("slug").alias(f"{p}_slug"), "type_slug").join(t, "type_slug", "left").withColumnRenamed(
            "type_slug", f"{p}_type")

    s = latest_state(ev).withColumnRenamed("aggregate_id", "id")
    s = s.join(named(o, ot, "o"), "id", "left").join(named(a, at, "a"), "id", "left")
    return s.select(
        "id", F.coalesce("o_slug", "a_slug").alias("slug"), F.coalesce("o_type", "a_type").alias("type_slug"),
        F.coalesce("o_domain", "a_domain").alias("domain_slug"), F.col("to_state").alias("current_state"),
        F.col("occurred_at").alias("last_event_at"),
    )


def tree_nodes(o: DataFrame, ot: DataFrame, e: DataFrame) -> DataFrame:
    links = active(e.filter(F.col("type_slug") == "parent_of")).select(
        F.col("target_id").alias("id"), F.col("source_id").alias("parent_id"))
    parents = o.select(F.col("id").alias("parent_id"), F.col("slug").alias("parent_slug"))
    nodes = active(o).join(_types(ot.select("type_slug", "domain_slug")), "type_slug")
    # most nodes have no parent: links meet the parents first, or all those nodes would meet under one null key
    return nodes.join(links.join(parents, "parent_id", "left"), "id", "left").select(
        "id", "slug", "type_slug", "domain_slug", "parent_id", "parent_slug",
        jget("payload", "path_slug").alias("path_slug"), jget("payload", "depth_level").try_cast("int").alias("depth_level"),
        jget("payload", "sibling_order").try_cast("int").alias("sibling_order"),
    )


def decidability_index(o: DataFrame, ot: DataFrame, e: DataFrame, domain: str = "normativo") -> DataFrame:
    """Active in-edges per norm node and type. Edges are counted before the join, so hot nodes travel as counts."""
    n = active(e).groupBy("target_id", "type_slug").agg(F.count("*").alias("edge_count"))
    nodes = active(o).join(_types(ot.filter(F.col("domain_slug") == domain).select("type_slug", "domain_slug")), "type_slug")
    nodes = nodes.select(F.col("id").alias("node_id"), F.col("slug").alias("node_slug"), "domain_slug")
    return n.join(nodes, n["target_id"] == nodes["node_id"]).select(
        "node_id", "node_slug", "domain_slug", F.col("type_slug").alias("edge_type"), "edge_count")


def decidability_totals(index: DataFrame) -> DataFrame:
    """One row per node with the total and the map of counts by edge type."""
    return index.groupBy("node_id", "node_slug", "domain_slug").agg(
        F.sum("edge_count").alias("total_edges"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("edge_type", "edge_count")))).alias("edge_count_by_type"),
    )


# ------------------------------------------------------------------- temporal
def as_of(o: DataFrame, ev: DataFrame, e: DataFrame, ts) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Objects valid at ``ts``, events up to it, edges active at it."""
    t = F.lit(ts).cast("timestamp_ntz")
    started = F.col("valid_from").isNull() | (F.col("valid_from") <= t)
    open_ = F.col("valid_to").isNull() | (F.col("valid_to") > t)
    return o.filter(started & open_), ev.filter(F.col("occurred_at") <= t), e.filter(started & open_)


def known_at(df: DataFrame, ts) -> DataFrame:
    return df.filter(F.col("recorded_at") <= F.lit(ts).cast("timestamp_ntz"))


def state_intervals(ev: DataFrame, segment: Column | None = None) -> DataFrame:
    """Each state of an aggregate from its event to the next state event."""
    rows = state_events(ev).select("aggregate_id", "event_id", F.col("to_state").alias("state"), F.col("occurred_at").alias("from_at"))
    key, order = ["aggregate_id"], ["from_at", "event_id"]
    rows = bounded_segments(rows, key, order, time_segment("from_at") if segment is None else segment)
    return segmented_scan(rows, key, order, "__seg", prev={"to_at": F.col("from_at")}, descending=True).drop("__seg")


def with_terminal(states: DataFrame, st: DataFrame) -> DataFrame:
    """Adds the terminal flag of the current state; unknown states are not terminal."""
    t = _types(st.select(F.col("type_slug").alias("current_state"), F.col("object_type_slug").alias("type_slug"), "terminal"))
    return states.join(t, ["current_state", "type_slug"], "left").withColumn("terminal", F.coalesce("terminal", F.lit(False)))


def close_entities(df: DataFrame, at, reason: str, actor: str) -> tuple[DataFrame, DataFrame]:
    """Closed rows (valid_to set) and the annulment events that record it."""
    t = F.lit(at).cast("timestamp_ntz")
    live = active(df)
    closed = live.withColumn("valid_to", t)
    events = live.select(
        F.concat(F.lit("ev-"), F.md5(F.concat_ws("|", F.lit("anulacao"), "id"))).alias("event_id"),
        F.lit("anulacao").alias("type_slug"), F.col("id").alias("aggregate_id"), F.lit(actor).alias("actor_id"),
        F.to_json(F.struct(F.lit(reason).alias("reason"), F.col("hash_content").alias("hash_anulado"))).alias("payload"),
        t.alias("occurred_at"),
    )
    return closed, events


def corrections(old: DataFrame, new: DataFrame) -> DataFrame:
    """Correction events for slugs whose content hash changed."""
    o = old.select("slug", F.col("hash_content").alias("hash_anterior"))
    n = new.select("slug", "id", F.col("hash_content").alias("hash_novo"))
    return n.join(o, "slug").filter(~F.col("hash_anterior").eqNullSafe(F.col("hash_novo"))).select(
        F.concat(F.lit("ev-"), F.md5(F.concat_ws("|", F.lit("correcao"), "slug", "hash_novo"))).alias("event_id"),
        F.lit("correcao").alias("type_slug"), F.col("id").alias("aggregate_id"),
        F.to_json(F.struct("hash_anterior")).alias("payload"),
    )
