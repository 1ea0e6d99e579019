"""From raw documents to packed training sequences.

Each stage works on all that the stage before it has kept; what it returns is written as
Parquet in the shared folder and read again. All but the last return the columns of
documents. The mix repeats a document up to three times, once for each pass of its source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexanchor.llm.common import ship, table, written
from lexanchor.llm.exact_dedup import drop_exact_duplicates
from lexanchor.llm.mixing import mixed_documents
from lexanchor.llm.near_dedup import drop_near_duplicates
from lexanchor.llm.packing import packed_documents
from lexanchor.llm.quality import drop_bad_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return drop_bad_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packed_documents(docs, remembered=80_000)  # workers still hold what earlier stages have left


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("minhash near dedup", near_dedup),
    ("mix sources", mix_sources),
    ("best-fit packing", pack),
]

#: SQL can express neither the tokenizer nor the packing; tests follow the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ship(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
