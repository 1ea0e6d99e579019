"""Tables kept in place: only partitions whose rows change are written again.

A table is a folder of partitions by one column, named by the caller or a bucket of the keys. New
contents are staged next to the table and then replace the partitions they touch (dynamic partition
overwrite), so no folder is read while it is written. Running a step again, after a failure or
not, gives the same table, and a second run changes no file.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lexanchor.operators.keyed import first_per_key
from lexanchor.sources.tables import upsert

BUCKET = "key_bucket"
MAX_PARTITIONS = 100_000  # values of a partition column that may reach the driver


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    where, fs = _folder(spark, path)
    return fs.exists(where)


def _remove(spark: SparkSession, path: str) -> None:
    where, fs = _folder(spark, path)
    fs.delete(where, True)


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """A bucket of the keys that depends on their values only."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def content_digest(df: DataFrame, by: str) -> DataFrame:
    """Per partition: rows and two order-free sums of row hashes, in which a NULL counts by its column."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != by]
    row = F.xxhash64(*rest, *[c.isNull() for c in rest])
    other = F.xxhash64(F.lit(1), *rest, *[c.isNull() for c in rest])
    total = [F.sum(h.cast("decimal(38,0)")) for h in (row, other)]
    return df.groupBy(by).agg(F.count("*").alias("rows"), F.struct(*[t.alias(f"s{i}") for i, t in enumerate(total)]).alias("digest"))


def _values(df: DataFrame, by: str) -> list:
    """The distinct values of the partition column (a bounded number, checked)."""
    got = [r[0] for r in df.select(by).distinct().limit(MAX_PARTITIONS + 1).collect()]
    if len(got) > MAX_PARTITIONS:
        raise ValueError(f"more than {MAX_PARTITIONS} values of {by}: choose a coarser partition column")
    return got


def _among(by: str, values: list) -> Column:
    known = [v for v in values if v is not None]
    out = F.col(by).isin(known) if known else F.lit(False)
    return out | F.col(by).isNull() if len(known) < len(values) else out


def _replace(rows: DataFrame, path: str, by: str) -> None:
    """Stages rows and puts them in place of the partitions they belong to."""
    spark, staged = rows.sparkSession, f"{path.rstrip('/')}__staged-{uuid.uuid4().hex}"
    # one partition value may hold a third of the rows: adaptive execution splits what is too large
    rows.hint("rebalance", by).write.partitionBy(by).parquet(staged)
    try:
        ready = spark.read.schema(rows.schema).parquet(staged)
        ready.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    finally:
        _remove(spark, staged)


def create_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 256) -> None:
    """A new table of one row per key, in buckets of its keys."""
    rows = first_per_key(df, keys, [F.struct(*[F.col(f"`{c}`") for c in df.columns]).asc()])
    rows.withColumn(BUCKET, key_bucket(keys, buckets)).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)


def upsert_in_place(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 256, newest: str | None = None) -> int:
    """Insert or replace by key in a table of ``create_bucketed``; the number of partitions written.

    Only incoming rows that are new or differ from the row of their key count; buckets without such
    rows keep their files. Of several incoming rows of a key the one with the largest ``newest``, then
    the least row, is taken. ``buckets`` must be that of the table.
    """
    spark = df.sparkSession
    table = spark.read.parquet(path)
    cols = [c for c in table.columns if c != BUCKET]
    order = ([F.col(newest).desc()] if newest else []) + [F.struct(*[F.col(f"`{c}`") for c in cols]).asc()]
    fresh = first_per_key(df.select(*[F.col(f"`{c}`") for c in cols]), keys, order).withColumn(BUCKET, key_bucket(keys, buckets))
    old = table.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)], F.col(BUCKET).alias("__b"), F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__old"))
    same_key = F.col(BUCKET) == F.col("__b")
    for i, k in enumerate(keys):
        same_key &= F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}"))
    new = F.struct(*[F.col(f"`{c}`") for c in cols])
    staged = f"{path.rstrip('/')}__incoming-{uuid.uuid4().hex}"
    fresh.join(old, same_key, "left").filter(~F.col("__old").eqNullSafe(new)).select(*[F.col(f"`{c}`") for c in fresh.columns]).write.parquet(staged)
    try:
        changed = spark.read.schema(fresh.schema).parquet(staged)
        touched = _values(changed, BUCKET)
        if touched:
            kept = table.filter(_among(BUCKET, touched)).select(*[F.col(f"`{c}`") for c in changed.columns])
            _replace(upsert(changed, kept, keys), path, BUCKET)
        return len(touched)
    finally:
        _remove(spark, staged)


def refresh_in_place(df: DataFrame, path: str, by: str) -> tuple[int, int]:
    """Makes the table equal to ``df``; the numbers of partitions written and removed.

    Partitions are compared by digests of their rows, in whatever order; equal ones keep their
    files, and those that ``df`` no longer has are removed. A folder cannot be named by an empty
    text: such values of ``by`` are kept as NULL.
    """
    spark = df.sparkSession
    if df.schema[by].dataType == T.StringType():
        df = df.withColumn(by, F.nullif(F.col(by), F.lit("")))
    cols = [c for c in df.columns if c != by] + [by]
    if not _exists(spark, path):
        df.select(*[F.col(f"`{c}`") for c in cols]).hint("rebalance", by).write.partitionBy(by).parquet(path)
        return len(_values(spark.read.parquet(path), by)), 0
    table = spark.read.schema(df.select(*[F.col(f"`{c}`") for c in cols]).schema).parquet(path)
    new, old = content_digest(df, by), content_digest(table.select(*[F.col(f"`{c}`") for c in df.columns]), by)
    a, b = new.select(F.col(by), F.struct("rows", "digest").alias("n")), old.select(F.col(by).alias("__by"), F.struct("rows", "digest").alias("o"))
    both = a.join(b, F.col(by).eqNullSafe(F.col("__by")), "full").filter(~F.col("n").eqNullSafe(F.col("o")))
    differ = both.select(F.when(F.col("n").isNull(), F.col("__by")).otherwise(F.col(by)).alias(by), F.col("n").isNull().alias("gone")).limit(MAX_PARTITIONS + 1).collect()
    if len(differ) > MAX_PARTITIONS:
        raise ValueError(f"more than {MAX_PARTITIONS} partitions differ: choose a coarser partition column")
    write, gone = [r[0] for r in differ if not r.gone], [r[0] for r in differ if r.gone]
    if write:
        _replace(df.filter(_among(by, write)).select(*[F.col(f"`{c}`") for c in cols]), path, by)
    if gone:
        where = table.filter(_among(by, gone)).select(F.input_file_name().alias("f")).distinct().select(F.regexp_extract("f", "^(.*)/[^/]*$", 1).alias("d")).distinct()
        for r in where.limit(MAX_PARTITIONS).collect():
            _remove(spark, unquote(r.d))  # names of input files are encoded as URIs
    return len(write), len(gone)
