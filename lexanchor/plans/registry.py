"""Catalogue of named queries: a Spark plan over a data directory, and its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lexanchor.fixtures import Corpus, cte

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _portable(df: DataFrame) -> DataFrame:
    """Timestamps and dates leave as text, so every client reads the same value."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd").alias(f.name)
        out.append(c)
    return df.select(*out)


def query(name: str, sql: str | None = None, needs: tuple[str, ...] = (), ctes: str = "", recursive: bool = False):
    """Registers ``fn(corpus)``. ``needs`` are the mapped tables the SQL twin reads, ``ctes`` further named subqueries."""

    def add(fn: Callable[[Corpus], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")
        QUERIES[name] = lambda spark, sf_dir: _portable(fn(Corpus(spark, sf_dir)))
        if sql is not None:
            head = cte(*needs) if needs else ""
            if ctes:
                head = f"{head},\n{ctes}" if head else f"with {ctes}"
            if recursive:
                head = head.replace("with ", "with recursive ", 1)
            ORACLE[name] = f"{head}\n{sql}".strip()
        return fn

    return add


def ts(col: str) -> str:
    """SQL text of a timestamp column in the portable format."""
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"
