"""Readers, writers and table maintenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lexanchor import vocab as V
from lexanchor.fixtures import values_sql
from lexanchor.operators.keyed import first_per_key


def read_tsv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Tab-separated text with header, every column a string, empty as NULL.

    Quoted line breaks need ``multiline``; without them turn it off, so that one
    large file is read by many tasks.
    """
    df = (
        spark.read.option("sep", "\t").option("header", True).option("multiLine", multiline).option("quote", '"')
        .option("escape", '"').option("encoding", "UTF-8").csv(path)
    )
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated text with header; missing values are written as ''."""
    text = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])
    text.write.mode(mode).option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option(
        "emptyValue", "").csv(path)


def union_all_columns(*parts: DataFrame) -> DataFrame:
    """Rows of every part under the union of their columns."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


BLOCK_SCHEMA = T.StructType([T.StructField(c, T.LongType() if c in ("block_id", "paragraph_start", "paragraph_end") else T.StringType()) for c in (
    "block_id", "anchor_slug", "anchor_artigo", "anchor_paragrafo", "anchor_inciso", "anchor_alinea", "editorial_marker", "block_text",
    "metadata_text", "process_class", "process_number", "relator", "data_julgamento", "dje", "tema", "paragraph_start", "paragraph_end")])


def read_blocks_json(spark: SparkSession, path: str, schema: T.StructType = BLOCK_SCHEMA) -> DataFrame:
    """A JSON array of blocks per file, with a fixed schema."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def materialize(df: DataFrame, root: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Writes a result as a table and returns the table."""
    path = f"{root.rstrip('/')}/{name}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int, **options) -> DataFrame:
    """A relational table, read in key ranges."""
    return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties=options)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def latin1_text(c) -> Column:
    """Text of bytes in ISO-8859-1."""
    return F.decode(F.col(c) if isinstance(c, str) else c, "ISO-8859-1")


def taxonomies(spark: SparkSession) -> dict[str, DataFrame]:
    """The seeded type tables as constant relations."""
    spec = {
        "domains": (["domain_slug", "label", "parent_domain_slug"], V.DOMAINS),
        "object_types": (["type_slug", "domain_slug", "ontological_class", "label"], V.OBJECT_TYPES),
        "actor_types": (["type_slug", "domain_slug", "actor_class", "label"], V.ACTOR_TYPES),
        "event_types": (["type_slug", "domain_slug", "event_class", "label"], V.EVENT_TYPES),
        "edge_types": (["type_slug", "source_domain_slug", "target_domain_slug", "epistemic_class", "label", "bidirectional",
                        "allows_multiple", "weight_semantics", "weight_required"], V.EDGE_TYPES),
        "state_types": (["type_slug", "object_type_slug", "domain_slug", "label", "terminal"], V.STATE_TYPES),
    }
    return {n: spark.sql(values_sql(cols, rows)) for n, (cols, rows) in spec.items()}


def new_rows(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the target lacks, one per key."""
    fresh = first_per_key(df, keys, [F.struct(*[F.col(c) for c in df.columns if c not in keys] or [F.lit(0)]).asc()])
    return fresh.join(target.select(*keys), list(keys), "left_anti")


def append_new(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Idempotent insert: a second run adds nothing."""
    spark = df.sparkSession
    new_rows(df, spark.read.parquet(path), keys).write.mode("append").parquet(path)


def upsert(df: DataFrame, target: DataFrame, keys: Sequence[str], newest: str | None = None) -> DataFrame:
    """Target with the incoming rows in place of those of equal key; ``newest`` orders several incoming rows."""
    cols = [F.col(f"`{c}`") for c in target.columns]
    both = df.select(*cols, F.lit(0).alias("__side")).unionByName(target.select(*cols, F.lit(1).alias("__side")))
    order = [F.col("__side").asc()] + ([F.col(newest).desc()] if newest else [])
    return first_per_key(both, keys, order).drop("__side")


def changed_only(df: DataFrame, prev: DataFrame, key: str, hash_col: str) -> DataFrame:
    """Rows that are new or whose content hash changed since the last run."""
    p = prev.select(key, F.col(hash_col).alias("__h"))
    return df.join(p, key, "left").filter(~F.col("__h").eqNullSafe(F.col(hash_col)) | F.col("__h").isNull()).drop("__h")


def publish_objects(o: DataFrame, cols: Sequence[str] = ("slug", "type_slug", "payload", "hash_content")) -> DataFrame:
    """One JSON document and its hash per slug."""
    return o.select("slug", F.to_json(F.struct(*cols)).alias("payload_json")).withColumn("payload_hash", F.sha2("payload_json", 256))


def split_by_class(df: DataFrame, column: str = "block_type") -> dict[str, DataFrame]:
    """The four typed tables of a block table."""
    return {t: df.filter(F.col(column) == t) for t in ("A_normativo", "B_editorial", "C_textual", "D_metadados")}


def export_tree(nodes: DataFrame, path: str) -> None:
    """Flat norm tree as tab-separated text, texts on one line."""
    flat = nodes.withColumn("text", F.translate(F.col("text"), "\t\n", "  "))
    write_tsv(flat, path)
