"""Session settings for local runs; settings of a submitted job win."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lexanchor", cores: str | None = None) -> SparkSession:
    n = cores or os.environ.get("BENCH_CPUS") or "8"
    wanted = {
        "spark.master": f"local[{n}]", "spark.app.name": app, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": "8", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false",
        "spark.lexanchor.textPartitions": n,  # the test files are one split each
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    given = {k for k, _ in SparkConf().getAll()}  # what spark-submit has set
    builder = SparkSession.builder
    for key, value in wanted.items():
        if key not in given:
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session without one gets a temporary folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        place = sc.getConf().get("spark.checkpoint.dir")
        if place is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            place = tempfile.mkdtemp(prefix="lexanchor-checkpoint-")
        sc.setCheckpointDir(place)
    return (sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()).rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materializes a narrow intermediate table and drops its lineage (reliable checkpoint).

    Uses the folder the cluster names in ``spark.checkpoint.dir``; a temporary one
    only in a local session where none is set, as in tests.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()
