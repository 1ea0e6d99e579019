"""Merkle manifest of a dataset, with proofs.

Every row is a leaf: the SHA-256 of its fields, each with its length in bytes, so that no
two rows read the same. The leaves of a language, in order of their ids, form a tree in
which runs of ``FAN`` nodes hash to their parent until one node remains; the subroots, in
order of the languages, form one more tree in the same way, and its last node stands for
the whole dataset. All hashes are lowercase hex, and digests are hashed as that text.

Only every ``TIER``-th level is kept, as rows that hold the nodes of one aligned subtree
(at most ``FAN ** TIER`` of them): checkpoints of a level in between are never written.
Whoever needs those nodes, the next tier or a proof, computes them again from the kept
descendants in the row and forgets them with it. Proofs go down from the root: a subtree
gets what stands above it, adds the siblings of its own levels for each of its nodes, and
passes that on to the tier below, so a proof is put together without reading a tree twice.

Positions come from a range partitioning over (tree, order): a row's place in its task plus
what lies in the tasks before. A language with most of the rows is spread over all tasks.

A null field counts as ``-``; a null id comes before all others, a null language before all
others with a tree of its own, an empty text has length 0. Rows with equal ids are ordered
by their leaves; repeated rows are leaves of their own with equal digests. Texts are hashed
whole, however long. Further columns of any name are not read. An empty table has no root
and no proofs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lexanchor.llm.common import LOWER, UPPER, crc_mod, query, table, written
from lexanchor.operators.keyed import compute_once

FAN = 8
#: Levels from one kept level to the next.
TIER = 3
#: Rows of one range when leaves are ordered.
PART_ROWS = 200_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Forest:
    """Trees over ordered leaves.

    ``tiers[t]`` has (tree, size, block, nodes): of a kept level the nodes of one aligned
    subtree and how many nodes the level has in the tree. ``roots`` has (tree, node).
    """

    tiers: list[DataFrame]
    roots: DataFrame


@dataclass(frozen=True)
class Manifest:
    rows: Forest
    trees: Forest


def leaf(fields: Sequence[str] = FIELDS, **instead: Column) -> Column:
    """Digest of a row; ``instead`` gives other values for some fields."""

    def part(name: str) -> Column:
        value = instead.get(name, F.col(f"`{name}`")).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)), 256)


def tree_key(col: str = "lang") -> Column:
    """A name for each value that sorts like the values, null first."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{col}`").cast("string")), F.lit(""))


def in_order(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds pos (within the tree) and size (of the tree) to rows with a column ``tree``."""
    spark = leaves.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(leaves.count() / PART_ROWS))
    numbered = leaves.withColumn("row", F.monotonically_increasing_id())  # of a written table; splits rows that are equal in all else
    ranged = numbered.repartitionByRange(parts, "tree", *order, "row").sortWithinPartitions("tree", *order, "row")
    ranged = written(ranged.drop("row").withColumn("place", F.monotonically_increasing_id()), "leaves")
    task = F.shiftright("place", 33)
    runs = ranged.groupBy("tree", task.alias("task")).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    runs = runs.withColumns({
        "base": F.expr("coalesce(sum(n) over (partition by tree order by task rows between unbounded preceding and 1 preceding), 0)"),
        "size": F.expr("sum(n) over (partition by tree)"),
    }).select("tree", "task", "first", "base", "size")
    placed = ranged.withColumn("task", task).join(runs, ["tree", "task"])
    return placed.withColumn("pos", F.col("place") - F.col("first") + F.col("base")).drop("task", "place", "first", "base")


def _subtrees(nodes: DataFrame, name: str) -> DataFrame:
    """(tree, size, pos, node as struct) to one row for each aligned subtree."""
    width = FAN ** TIER
    blocks = nodes.groupBy("tree", "size", F.expr(f"pos div {width}").alias("block")).agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    return written(blocks, name)


def _with_levels(blocks: DataFrame) -> DataFrame:
    """Computes the levels within each subtree again: l0 (its kept nodes) to l``TIER`` (one node).

    Where a tree has a single node left, that node goes on unchanged.
    """
    df = blocks.withColumn("l0", F.expr("transform(nodes, x -> x.digest)"))
    for t in range(TIER):
        run = f"sha2(array_join(slice(l{t}, i * {FAN} + 1, {FAN}), ''), 256)"
        up = f"transform(sequence(0, (size(l{t}) - 1) div {FAN}), i -> {run})"
        df = compute_once(df, {f"l{t + 1}": F.expr(f"case when {_level_size(t)} > 1 then {up} else l{t} end")})
    return df


def _level_size(t: int) -> str:
    return f"((size + {FAN ** t - 1}) div {FAN ** t})"


def build(leaves: DataFrame, order: Sequence[str], name: str = "merkle") -> Forest:
    """Trees over rows with the columns ``tree``, ``digest`` and the order; further columns stay beside their leaf."""
    rest = [c for c in leaves.columns if c not in ("tree", "digest")]
    nodes = in_order(leaves, order).select("tree", "size", "pos", F.struct("pos", "digest", *rest).alias("node"))
    tiers = [_subtrees(nodes, f"{name}-0")]
    largest = tiers[0].agg(F.max("size")).first()[0] or 0
    while True:
        top = _with_levels(tiers[-1]).select("tree", F.expr(f"(size + {FAN ** TIER - 1}) div {FAN ** TIER}").alias("size"),
                                             F.col("block").alias("pos"), F.expr(f"element_at(l{TIER}, 1)").alias("digest"))
        largest = -(-largest // FAN ** TIER)
        if largest <= 1:
            return Forest(tiers, written(top.select("tree", F.col("digest").alias("node")), f"{name}-roots"))
        tiers.append(_subtrees(top.select("tree", "size", "pos", F.struct("pos", "digest").alias("node")), f"{name}-{len(tiers)}"))


def _section(i: str) -> str:
    """Siblings of node ``i`` of a subtree on the subtree's own levels, those on the left and those on the right."""
    steps = []
    for t in range(TIER):
        at = f"({i} div {FAN ** t})"
        first = f"({at} - {at} % {FAN})"
        steps.append(f"case when {_level_size(t)} > 1 then named_struct('left', array_join(slice(l{t}, {first} + 1, {at} % {FAN}), ''), "
                     f"'right', array_join(slice(l{t}, {at} + 2, {FAN - 1} - {at} % {FAN}), '')) end")
    return f"filter(array({', '.join(steps)}), s -> s is not null)"


def proofs(forest: Forest, above: DataFrame) -> DataFrame:
    """A proof for every leaf: from (tree, above, ...) to (node, proof, ...).

    ``above`` is the proof of each tree's root, empty for a root of its own. A proof is an
    array of (left, right): the digests on either side in each run on the way up. Further
    columns of ``above`` come along.
    """
    rest = [c for c in above.columns if c not in ("tree", "above")]
    known = above.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(forest.tiers):
        met = _with_levels(blocks).join(known, ["tree", "block"])
        one = f"named_struct('node', nodes[i], 'above', concat({_section('i')}, above))"
        found = met.select("tree", *rest, F.expr(f"inline(transform(sequence(0, size(nodes) - 1), i -> {one}))"))
        known = found.select("tree", F.col("node.pos").alias("block"), "above", *rest)
    return found.select("node", F.col("above").alias("proof"), *rest)


def folded(digest: Column, proof: Column) -> Column:
    """The root that follows from a leaf's digest and its proof."""
    return F.aggregate(proof, digest, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def siblings_digest(proof: Column) -> Column:
    """One digest of all siblings of a proof, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, order: str = "doc_id", by: str = "lang", beside: dict[str, Column] | None = None) -> Manifest:
    """The trees of a table's rows by language and the tree of their roots; ``beside`` is kept with each leaf."""
    beside = beside or {}
    leaves = docs.select(tree_key(by).alias("tree"), leaf(fields).alias("digest"), F.col(f"`{order}`").alias("at"), *[c.alias(n) for n, c in beside.items()])
    rows = build(written(leaves, "leaves"), ["at", "digest"])
    roots = rows.roots.select(F.lit("").alias("tree"), F.col("node").alias("digest"), F.col("tree").alias("of"))
    return Manifest(rows, build(roots, ["of"], "merkle-trees"))


def all_proofs(m: Manifest) -> DataFrame:
    """For every row of the dataset: node (pos, digest, at and what is kept beside), proof, subroot, root."""
    empty = F.expr("filter(array(named_struct('left', '', 'right', '')), s -> false)")
    tops = proofs(m.trees, m.trees.roots.select("tree", empty.alias("above"), F.col("node").alias("root")))
    return proofs(m.rows, tops.select(F.col("node.of").alias("tree"), F.col("proof").alias("above"), F.col("node.digest").alias("subroot"), "root"))


def _sql(levels: int = 7, tops: int = 3) -> str:
    """The same trees level by level, for up to ``FAN ** levels`` rows in a language."""

    def tree(p: str, start: str, n_levels: int) -> str:
        text = f"{p}0 as (select tree, n, pos, digest as node from {start})"
        for k in range(n_levels):
            size = f"(n + {FAN ** k - 1}) // {FAN ** k}"
            text += f""",
{p}s{k} as (select tree, pos, coalesce(string_agg(node, '') over (partition by tree, pos // {FAN} order by pos rows between unbounded preceding and 1 preceding), '') as l,
    coalesce(string_agg(node, '') over (partition by tree, pos // {FAN} order by pos rows between 1 following and unbounded following), '') as r from {p}{k}),
{p}{k + 1} as (select tree, n, pos // {FAN} as pos, case when {size} > 1 then sha256(string_agg(node, '' order by pos)) else min(node) end as node
  from {p}{k} group by tree, n, pos // {FAN})"""
        return text

    def fold(p: str, f: str, start: str, n_levels: int) -> str:
        text = f"{f}0 as ({start})"
        for k in range(n_levels):
            more = f"(f.n + {FAN ** k - 1}) // {FAN ** k} > 1"
            text += f""",
{f}{k + 1} as (select f.* exclude (acc, sibs), case when {more} then sha256(s.l || f.acc || s.r) else f.acc end as acc,
    case when {more} then f.sibs || s.l || s.r else f.sibs end as sibs from {f}{k} f join {p}s{k} s on f.tree = s.tree and f.pos // {FAN ** k} = s.pos)"""
        return text

    enc = " || ".join(f"coalesce(strlen(cast({{{c}}} as varchar)) || ':' || cast({{{c}}} as varchar), '-')" for c in FIELDS)
    plain = {c: c for c in FIELDS}
    lower = plain | {"text": f"translate(text, '{UPPER}', '{LOWER}')"}
    return f"""with crc as (select list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
  lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)) as t),
marked as (select *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(cast(doc_id as varchar), ''), ''), lambda c: ascii(c))),
  lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])), 4294967295) % 3 = 0 as hit from documents, crc),
hashed as (select doc_id, coalesce('=' || lang, '') as tree, sha256({enc.format(**plain)}) as digest,
  case when hit then sha256({enc.format(**lower)}) else sha256({enc.format(**plain)}) end as claimed from marked),
leaves as (select *, count(*) over (partition by tree) as n, row_number() over (partition by tree order by doc_id nulls first, digest) - 1 as pos from hashed),
{tree("d", "leaves", levels)},
subroots as (select '' as tree, tree as lang, node as digest, count(*) over () as n, row_number() over (order by tree) - 1 as pos from d{levels}),
{tree("t", "subroots", tops)},
{fold("d", "f", "select *, claimed as acc, '' as sibs from leaves", levels)},
{fold("t", "g", f"select f.doc_id, f.digest as leaf, s.digest as subroot, s.tree, s.n, s.pos, f.acc, f.sibs from f{levels} f join subroots s on f.tree = s.lang", tops)}
select g.doc_id, g.leaf, g.subroot, r.node as root, sha256(g.sibs) as proof_sha256, g.acc as folded_root, g.acc = r.node as verified
from g{tops} g join t{tops} r on g.tree = r.tree"""


@query("op11_merkle_manifest", _sql())
def op11(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(crc_mod(3) == 0, leaf(text=F.translate("text", UPPER, LOWER)))
    found = compute_once(all_proofs(manifest(docs, beside={"claimed": tampered})).withColumnRenamed("root", "whole"), {
        "proof_sha256": siblings_digest(F.col("proof")),
        "folded_root": folded(F.coalesce("node.claimed", "node.digest"), F.col("proof")),
    })
    return found.select(F.col("node.at").alias("doc_id"), F.col("node.digest").alias("leaf"), "subroot", F.col("whole").alias("root"),
                        "proof_sha256", "folded_root", (F.col("folded_root") == F.col("whole")).alias("verified"))
