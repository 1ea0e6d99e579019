"""Helpers shared by the training-data operators."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

#: A word is a run of characters other than space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


_BATCH_ROWS, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Prepares a session: sends this package to the executors, once for each application, and bounds Arrow batches.

    Batches of 10,000 rows, the default, hold tens of megabytes of text on either side of a
    Python task; another value that the session has set is left alone.
    """
    sc = spark.sparkContext
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, str(BATCH_ROWS))
    if sc.applicationId not in _SHIPPED:
        _SHIPPED.add(sc.applicationId)
        package = Path(__file__).resolve().parents[1]
        if package.is_dir():  # otherwise it was shipped itself
            sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='ship-')}/{package.name}", "zip", package.parent, package.name))
    return spark


def query(name: str, sql: str | None = None):
    """Registers ``fn(spark, sf_dir)`` and, where SQL can express it, its SQL twin."""

    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(ship(spark), sf_dir)
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a local session without one gets a temporary folder."""
    sc = spark.sparkContext
    place = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if place is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        place = tempfile.mkdtemp(prefix="llm-")
        sc.setCheckpointDir(place)
    return place.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and not lost with an executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_few(df: DataFrame, name: str) -> DataFrame:
    """A narrow table as ``written``, in no more files than four for each core of the cluster."""
    return written(df.coalesce(4 * max(2, df.sparkSession.sparkContext.defaultParallelism)), name)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def crc_mod(n: int, col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % n


def first_by_hash(df: DataFrame, label: str, limits: dict, *order: str) -> DataFrame:
    """The first rows of each label (``limits``: label to number) by a hash of ``order``, then ``order``; with column ``rn``, from 1.

    No label is sorted whole: rows are counted by the hash's leading 14 bits first, and only
    those up to the bits where the limit is reached are ranked, the limit and about one in
    16,384 of the label's rows. Labels that ``limits`` does not name, and null, have no rows.
    """
    limit = F.coalesce(*(F.when(F.col(label) == F.lit(v), F.lit(n)) for v, n in limits.items()))
    near = df.withColumn("hash", F.xxhash64(*order)).withColumn("lead", F.shiftright("hash", 50)).withColumn("limit", limit).filter("limit is not null")
    counts = near.groupBy(label, "limit", "lead").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy(label).orderBy("lead").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n")
    cuts = counts.withColumn("before", before).filter("before < limit").groupBy(label).agg(F.max("lead").alias("cut"))  # a row for each label
    ranked = near.join(F.broadcast(cuts), label).filter("lead <= cut").withColumn("rn", F.row_number().over(W.partitionBy(label).orderBy("hash", *order)))
    return ranked.filter("rn <= limit").select(*df.columns, "rn")


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of Python values, a bounded slice at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def arrow_schema(df_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df_schema)


def batch_of(schema: pa.Schema, cols: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, schema, strict=True)], schema=schema)


_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x += _GOLD
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x
