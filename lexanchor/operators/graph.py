"""Trees, chains and the relational form of the decision blocks.

Hierarchies are walked by doubling: each round joins what is known at distance d to
reach 2d, so a chain of n links takes about log2(n) joins. Rounds cut their lineage
with reliable checkpoints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexanchor.functions import text as T
from lexanchor.operators.blocks import anchor_factors, filled, with_text_key
from lexanchor.operators.core import active, latest_state
from lexanchor.operators.keyed import position_segment, segmented_scan
from lexanchor.operators.reconcile import split_processes
from lexanchor.operators.versions import amendments
from lexanchor.session import cut


def parent_links(e: DataFrame) -> DataFrame:
    links = active(e) if "valid_to" in e.columns else e
    return links.filter(F.col("type_slug") == "parent_of").select(F.col("target_id").alias("node"), F.col("source_id").alias("parent"))


def ancestor_closure(links: DataFrame) -> DataFrame:
    """Every (node, ancestor, distance) of a (node, parent) table; a cycle is reported as soon as a node meets itself."""
    known = cut(links.select("node", F.col("parent").alias("ancestor"), F.lit(1).alias("distance")))
    reach = 1
    if not known.filter("node = ancestor").isEmpty():
        raise ValueError("parent links form a cycle")
    while True:
        edge = known.filter(F.col("distance") == reach)
        up = known.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("next"), F.col("distance").alias("d"))
        more = edge.join(up, "ancestor").select("node", F.col("next").alias("ancestor"), (F.col("distance") + F.col("d")).alias("distance"))
        more = cut(more)
        if more.isEmpty():
            return known
        if not more.filter("node = ancestor").isEmpty():
            raise ValueError("parent links form a cycle")
        known, reach = known.unionByName(more), reach * 2


def chain_roots(nodes: DataFrame, key: str, parent: str) -> DataFrame:
    """Root and number of links of each node, by pointer jumping; finished nodes leave the joins.

    A node whose parent is not in the table is a root itself.
    """
    there = nodes.select(F.col(key).alias("up"), F.lit(True).alias("seen"))
    known = nodes.select(key, F.col(parent).alias("up")).join(there, "up", "left").withColumn("up", F.when(F.col("seen"), F.col("up")))
    live = cut(known.select(key, "up", F.when(F.col("up").isNull(), 0).otherwise(1).alias("links")))
    table, done, covered, total = live, None, 1, live.count()
    while True:
        # a pointer that leads nowhere has found its root
        step = live.filter(F.col("up").isNotNull()).join(
            table.select(F.col(key).alias("up"), F.col("up").alias("next"), F.col("links").alias("more")), "up", "left")
        ended = live.filter(F.col("up").isNull()).select(key, F.col(key).alias("root"), "links")
        step = cut(step.select(key, "up", "next", "links", "more"))
        found = step.filter(F.col("next").isNull()).select(key, F.col("up").alias("root"), "links")
        ended = ended.unionByName(found)
        done = ended if done is None else done.unionByName(ended)
        live = step.filter(F.col("next").isNotNull()).select(key, F.col("next").alias("up"), (F.col("links") + F.col("more")).alias("links"))
        if live.isEmpty():
            return done
        if covered > total:
            raise ValueError("parent links form a cycle")
        covered *= 2
        table = cut(live.unionByName(done.select(key, F.nullif("root", key).alias("up"), "links")))


def tree_closure(o: DataFrame, e: DataFrame) -> DataFrame:
    """Depth, root, leaf flag and path of every active object under parent_of."""
    links = parent_links(e)
    c = ancestor_closure(links)
    top = c.groupBy(F.col("node").alias("id")).agg(
        F.max("distance").alias("depth"), F.max_by("ancestor", "distance").alias("root"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(-F.col("distance"), F.col("ancestor")))), lambda s: s["ancestor"]), "/").alias("up_path"))
    parents = links.select(F.col("parent").alias("id"), F.lit(False).alias("is_leaf")).distinct()
    return active(o).select("id", "slug").join(top, "id", "left").join(parents, "id", "left").select(
        "id", "slug", F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("root", "id").alias("root"), F.coalesce("is_leaf", F.lit(True)).alias("is_leaf"),
        F.concat_ws("/", "up_path", "id").alias("path"))


def _tour(links: DataFrame) -> DataFrame:
    """The walk around each tree as (elem, next): entering and leaving every node, children in the order of a hash.

    Nodes are linked to their next sibling, spread over buckets, so a parent of many children is no single task.
    """
    child = links.withColumn("__b", F.pmod(F.xxhash64("node"), F.lit(256)))
    after = segmented_scan(child, ["parent"], ["__b", "node"], "__b", prev={"sibling": F.col("node")}, descending=True)
    first = child.groupBy(F.col("parent").alias("node")).agg(F.min_by("node", F.struct("__b", "node")).alias("child"))
    nodes = links.select("node").unionByName(links.select(F.col("parent").alias("node"))).distinct()
    enter, leave = (lambda c: F.concat(F.lit("+"), c)), (lambda c: F.concat(F.lit("-"), c))
    down = nodes.join(first, "node", "left").select(enter("node").alias("elem"), F.coalesce(enter("child"), leave("node")).alias("next"))
    on = nodes.join(after.select("node", "parent", "sibling"), "node", "left").select(
        leave("node").alias("elem"), F.coalesce(enter("sibling"), leave("parent"), leave("node")).alias("next"))
    return down.unionByName(on)


def interval_labels(links: DataFrame) -> DataFrame:
    """(node, root, enter, leave) of a table (node, parent) with one parent a node: descendants lie between enter and leave.

    The walk around each tree is ranked by pointer jumping: each round doubles what a pointer
    spans, so a chain of n links takes about log2(2 n) rounds over 2 n narrow rows at most. Rows
    that have reached the end of their walk leave the joins.
    """
    if not links.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        raise ValueError("a node has two parents")
    live = cut(_tour(links).withColumns({"steps": (F.col("elem") != F.col("next")).cast("bigint"), "end": F.col("elem") == F.col("next")}))
    table, done, span, total = live, live.filter("end"), 1, live.count()
    live = live.filter("not end")
    while not live.isEmpty():
        if span > total:
            raise ValueError("parent links form a cycle")
        ahead = table.select(F.col("elem").alias("next"), F.col("next").alias("__next"), F.col("steps").alias("__steps"), F.col("end").alias("__end"))
        moved = cut(live.join(ahead, "next").select("elem", F.col("__next").alias("next"), (F.col("steps") + F.col("__steps")).alias("steps"), F.col("__end").alias("end")))
        done, live, span = done.unionByName(moved.filter("end")), moved.filter("not end"), span * 2
        table = done.unionByName(live)
    at = done.select(F.substring("elem", 2, 1 << 30).alias("node"), F.substring("next", 2, 1 << 30).alias("root"), F.startswith("elem", F.lit("+")).alias("entering"), "steps")
    ends = at.groupBy("node").agg(F.max("root").alias("root"), F.max(F.when(F.col("entering"), F.col("steps"))).alias("a"), F.max(F.when(~F.col("entering"), F.col("steps"))).alias("b"))
    # steps count back from the end of the root's walk
    length = ends.filter(F.col("node") == F.col("root")).select("root", F.col("a").alias("length"))
    return cut(ends.join(length, "root").select("node", "root", (F.col("length") - F.col("a")).alias("enter"), (F.col("length") - F.col("b")).alias("leave")))


def rollup_by_intervals(counts: DataFrame, labels: DataFrame, value: str = "n", size: int = 4096) -> DataFrame:
    """Own and accumulated totals per node, as ``rollup_to_ancestors``: differences of running sums along the walk.

    Nodes without anything of their own or below are left out; nodes outside the trees keep their own.
    """
    own = counts.groupBy("node").agg(F.sum(value).alias("own"))
    known = labels.join(own, "node", "left")
    zero = F.lit(0).cast("bigint")
    enter = known.select("node", "root", F.col("enter").alias("pos"), F.coalesce("own", zero).alias("v"), F.col("own").isNotNull().cast("bigint").alias("c"))
    walk = enter.unionByName(known.select("node", "root", F.col("leave").alias("pos"), zero.alias("v"), zero.alias("c")))
    sums = segmented_scan(walk, ["root"], ["pos"], position_segment("pos", size), sums={"run": F.col("v"), "seen": F.col("c")})
    per = sums.groupBy("node").agg(F.max("v").alias("own"), (F.max("run") - F.min("run") + F.max("v")).alias("total"), (F.max("seen") - F.min("seen") + F.max("c")).alias("__c"))
    outside = own.join(labels, "node", "left_anti").select("node", "own", F.col("own").alias("total"))
    return per.filter("__c > 0").drop("__c").unionByName(outside)


def rollup_by_levels(counts: DataFrame, links: DataFrame, value: str = "n", shrink: int = 4) -> DataFrame:
    """Own and accumulated totals per node, as ``rollup_by_intervals``: leaves hand their totals up and leave, round by round.

    Rounds go on as long as one node in ``shrink`` or more is a leaf, so all rounds together read a few
    times the nodes. What is left then (long chains, cycles) is summed along its walk.
    """
    if not links.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        raise ValueError("a node has two parents")
    own = counts.groupBy("node").agg(F.sum(value).alias("own"))
    tops = links.select(F.col("parent").alias("node")).distinct().join(links.select("node"), "node", "left_anti")
    nodes = links.select("node", "parent").unionByName(tops.withColumn("parent", F.lit(None).cast("string")))
    # ``sum`` is null until the node, or one below it, has something of its own
    live = cut(nodes.join(own, "node", "left").select("node", "parent", "own", F.col("own").alias("sum")))
    outside, done, left = own.join(nodes.select("node"), "node", "left_anti").select("node", "own", F.col("own").alias("total")), None, live.count()
    while left:
        kids = live.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.lit(True).alias("inner"))
        marked = cut(live.join(kids, "node", "left"))
        leaves = marked.filter("inner is null")
        n = leaves.count()
        if shrink * n < left:
            break
        ended = leaves.select("node", "own", F.col("sum").alias("total"))
        done = ended if done is None else done.unionByName(ended)
        up = leaves.groupBy(F.col("parent").alias("node")).agg(F.sum("sum").alias("below"))
        live = cut(marked.filter("inner").join(up, "node", "left").select("node", "parent", "own", F.when(
            F.col("sum").isNotNull() | F.col("below").isNotNull(), F.coalesce("sum", F.lit(0)) + F.coalesce("below", F.lit(0))).alias("sum")))
        left -= n
    if left:
        summed = rollup_by_intervals(live.filter("sum is not null").select("node", F.col("sum").alias("n")), interval_labels(live.filter("parent is not null").select("node", "parent")))
        rest = live.select("node", F.col("own").alias("__own")).join(summed, "node").select("node", F.col("__own").alias("own"), "total")
        done = rest if done is None else done.unionByName(rest)
    if done is not None:
        outside = outside.unionByName(done.filter("total is not null"))
    return outside.select("node", F.coalesce("own", F.lit(0).cast("bigint")).alias("own"), "total")


def rollup_to_ancestors(counts: DataFrame, closure: DataFrame, value: str = "n") -> DataFrame:
    """Own and accumulated totals per node: values are summed per node before they climb."""
    own = counts.groupBy("node").agg(F.sum(value).alias("own"))
    up = own.join(closure.select("node", "ancestor"), "node").select(F.col("ancestor").alias("node"), F.lit(0).cast("bigint").alias("own"), F.col("own").alias("t"))
    return own.select("node", "own", F.col("own").alias("t")).unionByName(up).groupBy("node").agg(F.sum("own").alias("own"), F.sum("t").alias("total"))


def subject_rollup(e: DataFrame, subject_links: DataFrame) -> DataFrame:
    """Cases per subject, with those of its narrower subjects."""
    n = active(e.filter(F.col("type_slug") == "sobre")).groupBy(F.col("target_id").alias("node")).agg(F.count("*").alias("n"))
    return rollup_by_levels(n, parent_links(subject_links))


def cross_edges(e: DataFrame, o: DataFrame, ot: DataFrame) -> DataFrame:
    """Edges between objects of different domains."""
    d = o.join(F.broadcast(ot.select("type_slug", "domain_slug")), "type_slug").select("id", "domain_slug")
    src = d.select(F.col("id").alias("source_id"), F.col("domain_slug").alias("source_domain"))
    tgt = d.select(F.col("id").alias("target_id"), F.col("domain_slug").alias("target_domain"))
    return e.select("edge_id", "type_slug", "source_id", "target_id").join(src, "source_id").join(tgt, "target_id").filter(
        F.col("source_domain") != F.col("target_domain"))


def causation_chain(ev: DataFrame) -> DataFrame:
    """First cause and number of steps behind each event."""
    return chain_roots(ev, "event_id", "causation_id").withColumnRenamed("links", "steps")


def succession(e: DataFrame) -> DataFrame:
    """Founder and rank of each actor in a line of succession (source succeeds target)."""
    s = e.filter(F.col("type_slug") == "sucede").select(F.col("source_id").alias("actor"), F.col("target_id").alias("before"))
    first = s.select(F.col("before").alias("actor")).distinct().join(s.select("actor"), "actor", "left_anti").withColumn("before", F.lit(None).cast("string"))
    return chain_roots(s.unionByName(first), "actor", "before").withColumnRenamed("links", "rank")


def derive_caches(o: DataFrame, e: DataFrame, ev: DataFrame, amends: DataFrame) -> DataFrame:
    """Leaf, depth, repeal (the last state event), normalized text and number of amendments of each node."""
    t = tree_closure(o, e).select("id", "depth", "is_leaf")
    repealed = latest_state(ev).select(F.col("aggregate_id").alias("id"), (F.col("to_state") == "revogada").alias("is_repealed"))
    n = amendments(ev, amends).groupBy(F.col("node").alias("id")).agg(F.count("*").alias("total_amendments"))
    text = T.norm_key(T.jget("payload", "text_content"))
    return active(o).select("id", text.alias("normalized_text")).join(t, "id").join(repealed, "id", "left").join(n, "id", "left").select(
        "id", "depth", "is_leaf", F.coalesce("is_repealed", F.lit(False)).alias("is_repealed"), "normalized_text",
        F.coalesce("total_amendments", F.lit(0)).alias("total_amendments"))


# ------------------------------------------------- relational form of the blocks
def record_slugs(b: DataFrame, size: int = 4096) -> DataFrame:
    """Record slug of each block: its process and its number inside the process."""
    rec = split_processes(b)[1].select("block_id", "process_slug")
    x = segmented_scan(rec, ["process_slug"], ["block_id"], position_segment("block_id", size), counts={"n": F.lit(True)})
    return x.select("block_id", "process_slug", F.concat("process_slug", F.lit("-rj-"), F.col("n").cast("string")).alias("record_slug"))


def blocks_to_graph(b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Process and record objects, and the anchor, process and rapporteur edges of the blocks.

    A record is anchored to its own device; the other devices of its text are edges of the
    text, to which its records are tied (``expand_co_anchors`` writes them out).
    """
    # everything but the texts, read several times
    narrow = cut(with_text_key(b).drop("block_text", "metadata_text"))
    procs, _ = split_processes(narrow)
    # one row per block: a column of it looks small enough to be broadcast where files are compressed well, and would pass through the driver
    rec = cut(record_slugs(narrow)).hint("merge")
    payload = F.to_json(F.struct(
        F.col("block_text").alias("conteudo"), F.col("metadata_text").alias("rotulo_final"), F.col("editorial_marker").alias("camada_editorial"),
        F.col("decision_unit_type").alias("tipo_decisorio")))
    proc_payload = F.to_json(F.struct(F.col("process_class").alias("classe"), F.col("process_number").alias("numero"), "relator", "redator"))
    objects = procs.select(F.col("process_slug").alias("slug"), F.lit("processo").alias("type_slug"), proc_payload.alias("payload")).unionByName(
        b.join(rec, "block_id").select(F.col("record_slug").alias("slug"), F.lit("registro_jurisprudencial").alias("type_slug"), payload.alias("payload")))
    none = F.lit(None).cast("double")
    edge = lambda kind, source, target, weight: (F.lit(kind).alias("type_slug"), F.col(source).alias("source"), target.alias("target"), weight.alias("weight"))
    anchors = narrow.filter(filled("anchor_slug")).join(rec, "block_id").select(*edge("ancora_normativa", "record_slug", F.col("anchor_slug"), F.col("anchor_confidence")))
    pairs, members = anchor_factors(narrow)
    text = F.concat(F.lit("txt-"), "text_key")
    tied = members.join(rec, "block_id").select(*edge("mesmo_texto", "record_slug", text, F.col("anchor_confidence")))
    shared = pairs.filter(filled("anchor_slug")).withColumn("text", text).select(*edge("ancora_normativa", "text", F.col("anchor_slug"), none))
    anchors = anchors.unionByName(tied).unionByName(shared)
    belongs = rec.select(F.lit("ancora_processual").alias("type_slug"), F.col("record_slug").alias("source"), F.col("process_slug").alias("target"), none.alias("weight"))
    ruled = procs.filter(filled("relator")).select(
        F.lit("relator_de").alias("type_slug"), F.concat(F.lit("min-"), F.replace(T.norm_key("relator"), F.lit(" "), F.lit("-"))).alias("source"),
        F.col("process_slug").alias("target"), none.alias("weight"))
    return objects, anchors.unionByName(belongs).unionByName(ruled)


def expand_co_anchors(e: DataFrame) -> DataFrame:
    """Edges with those of shared texts written out for each record: its own device once, the others of its text."""
    tied = e.filter(F.col("type_slug") == "mesmo_texto").select("source", F.col("target").alias("text"), "weight")
    of_text = e.filter(F.col("type_slug") == "ancora_normativa").select(F.col("source").alias("text"), "target")
    own = e.filter(F.col("type_slug") == "ancora_normativa").select("source", "target")
    more = tied.join(of_text, "text").join(own, ["source", "target"], "left_anti")
    plain = e.filter(F.col("type_slug") != "mesmo_texto").filter(~F.startswith("source", F.lit("txt-")))
    return plain.unionByName(more.select(F.lit("ancora_normativa").alias("type_slug"), "source", "target", "weight"))


def anchor_degree(e: DataFrame) -> DataFrame:
    """Devices per process and processes per device, through the records that carry both anchors.

    A process meets the devices of a shared text once, however many records tie it to the text.
    """
    dev = e.filter(F.col("type_slug") == "ancora_normativa").select("source", F.col("target").alias("device"))
    proc = e.filter(F.col("type_slug") == "ancora_processual").select("source", F.col("target").alias("process"))
    tied = e.filter(F.col("type_slug") == "mesmo_texto").select("source", F.col("target").alias("text"))
    through = proc.join(tied, "source").select("process", F.col("text").alias("source")).distinct()
    pairs = proc.unionByName(through).join(dev, "source").select("process", "device").distinct()
    return pairs.groupBy(F.lit("process").alias("kind"), F.col("process").alias("slug")).agg(F.count("*").alias("degree")).unionByName(
        pairs.groupBy(F.lit("device").alias("kind"), F.col("device").alias("slug")).agg(F.count("*").alias("degree")))
