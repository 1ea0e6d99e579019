"""Tables in place: right rows, and untouched partitions keep their files."""

import os
from collections import Counter

from pyspark.sql import functions as F

from lexanchor.sources import in_place as P


def files(path):
    """Every data file with its time of writing, by partition."""
    out = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                out[os.path.join(os.path.relpath(folder, path), n)] = os.stat(os.path.join(folder, n)).st_mtime_ns
    return out


def rows(spark, path, cols):
    return Counter(tuple(r) for r in spark.read.parquet(path).select(*cols).collect())


def test_upsert_touches_only_buckets_with_changes(spark, tmp_path):
    path, cols = str(tmp_path / "t"), ["k", "v", "a b.c"]
    schema = "k string, v int, `a b.c` string"
    base = [(f"k{i}", i, "x") for i in range(400)] + [(None, 1, None), ("dup", 2, "b"), ("dup", 1, "a")]
    P.create_bucketed(spark.createDataFrame(base, schema), path, ["k"], buckets=16)
    before = files(path)
    want = {k: (k, v, t) for k, v, t in base if k != "dup"} | {"dup": ("dup", 1, "a")}
    # the same rows once more, and an empty batch
    assert P.upsert_in_place(spark.createDataFrame(base[:50] + base[-1:], schema), path, ["k"], 16) == 0
    assert P.upsert_in_place(spark.createDataFrame([], schema), path, ["k"], 16) == 0
    assert files(path) == before
    batch = [("k7", 70, None), ("k7", 71, "y"), ("fresh", 5, "z"), ("k9", 9, "x"), (None, None, "q")]
    want |= {"k7": ("k7", 71, "y"), "fresh": batch[2], None: batch[4]}
    got = P.upsert_in_place(spark.createDataFrame(batch, schema), path, ["k"], 16, newest="v")
    after = files(path)
    assert rows(spark, path, ["k", "v", "`a b.c`"]) == Counter(want.values())
    same = {f.split("/")[0] for f in before if after.get(f) == before[f]}
    assert 1 <= got <= 3 and len(same) == len({f.split("/")[0] for f in before}) - got
    assert P.upsert_in_place(spark.createDataFrame(batch, schema), path, ["k"], 16, newest="v") == 0
    assert files(path) == after
    assert os.listdir(tmp_path) == ["t"], "nothing staged is left"


def test_refresh_replaces_and_removes_partitions(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "p string, a int, b int"
    one = [("x", 1, None), ("x", 1, None), ("y", 2, 2), ("z", 3, 3), (None, 4, 4), ("hot/key =", 5, 5)]
    df = lambda r: spark.createDataFrame(r, schema)
    assert P.refresh_in_place(df(one), path, "p") == (5, 0)
    before = files(path)
    assert P.refresh_in_place(df(one[::-1]), path, "p") == (0, 0) and files(path) == before
    two = [("x", None, 1), ("x", None, 1), ("y", 2, 2), ("hot/key =", 5, 6), ("new", 9, 9)]
    assert P.refresh_in_place(df(two), path, "p") == (3, 2)
    assert rows(spark, path, ["p", "a", "b"]) == Counter(two)
    after = files(path)
    assert [f for f in after if after[f] == before.get(f)] == [f for f in before if f.startswith("p=y/")]
    assert P.refresh_in_place(df([("", 1, 1), (None, 1, 1)]), path, "p") == (1, 4)
    assert P.refresh_in_place(df([("", 1, 1), (None, 1, 1)]), path, "p") == (0, 0)
    assert rows(spark, path, ["p", "a", "b"]) == Counter({(None, 1, 1): 2})
    assert P.refresh_in_place(df([]), path, "p") == (0, 1)
    assert files(path) == {}


def test_digest_counts_repeated_rows_and_nulls_by_column(spark):
    parts = {"a": [(1, None)], "b": [(None, 1)], "c": [(1, None)] * 2, "d": [(1, None), (2, 2), (2, 2)], "e": [(2, 2), (1, None), (1, None)]}
    df = spark.createDataFrame([(p, *r) for p, rs in parts.items() for r in rs], "p string, a int, b int")
    got = {r.p: (r.rows, r.digest) for r in P.content_digest(df, "p").collect()}
    assert len(set(got.values())) == 5
    assert P.content_digest(df.filter(F.lit(False)), "p").count() == 0
