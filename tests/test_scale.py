"""Plans and inputs as they are at scale: nothing that grows passes through the driver, tables may be folders of files."""

import os

import pytest
from pyspark.sql import functions as F

from lexanchor.fixtures import Corpus
from lexanchor.operators import blocks as B, core as C, graph as G
from lexanchor.plans.registry import QUERIES

DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def linked(tmp_path, **folders):
    """A data directory whose other tables are those of DIR."""
    for name in os.listdir(DIR):
        if name.split(".")[0] not in folders:
            os.symlink(f"{DIR}/{name}", tmp_path / name)
    for name, df in folders.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_blocks_are_not_broadcast_to_their_records(spark):
    objects, edges = G.blocks_to_graph(B.resolve_blocks(Corpus(spark, DIR).blocks))
    for df in (objects, objects.select("slug", "type_slug"), edges):
        assert "SortMergeJoin [block_id" in plan(df) and "BroadcastHashJoin [block_id" not in plan(df)


def test_streamed_tables_may_be_folders(spark, tmp_path):
    base = Corpus(spark, DIR)
    folder = linked(tmp_path, documents=base.table("documents").repartition(3), events=base.table("events").repartition(2))
    for name in ("str3_worklist_stream", "str2_current_state_stream", "str2_state_changes"):
        got = rows(QUERIES[name](spark, folder))
        assert got and got == rows(QUERIES[name](spark, DIR)), name


@pytest.fixture
def shuffled_joins(spark):
    """Joins as they are where no side is small, with partitions left as they fall."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_nodes_without_a_parent_are_spread(spark, shuffled_joins):
    x = Corpus(spark, DIR)
    got = C.tree_nodes(x.objects, x.object_types, x.edges)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert got.filter("parent_id is null").count() > 0.5 * got.count() and max(sizes) < 0.5 * sum(sizes)


def test_edges_are_not_sorted_to_meet_their_ends(spark, shuffled_joins):
    x = Corpus(spark, DIR)
    for actors in (None, x.actors):
        got = C.edges_readable(x.edges, x.edge_types, x.objects, actors)
        assert "Sort" not in plan(got) and plan(got).count("ShuffledHashJoin") == 2
