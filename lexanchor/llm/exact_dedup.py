"""Exact duplicates by counting quotient filters.

Every partition builds a counting quotient filter over the 64-bit fingerprints of its
texts: the leading bits choose a slice, the next ones (the quotient) a bucket, and the
bucket's run holds the sorted remainders with their counters. Filters of one slice merge
without loss, because quotient and remainder give the fingerprint back. Only fingerprints
whose merged count is above one go to the comparison of whole texts, byte by byte.

Null texts count as empty. Rows with a null id can stay only where every row of the group
has a null id; of rows equal in text and id, one stays.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from lexanchor.llm.common import batch_of, query, rows, table, written
from lexanchor.operators.keyed import first_per_key

#: Fingerprints that one slice of the merged filter holds on average.
SLICE_ENTRIES = 1 << 20
#: Text that a map task holds back while it folds equal texts together.
HELD_BYTES = 4 << 20


class QuotientFilter:
    """A counting quotient filter in numpy: fingerprints of ``width`` bits with counts.

    ``occupied`` has a bit for each quotient, ``run_end`` one for each slot; slots hold the
    remainders, ascending within a run. Counters above one are stored beside their slot.
    """

    HEAD = struct.Struct("<BBII")

    def __init__(self, prints: np.ndarray, counts: np.ndarray, width: int):
        order = np.argsort(prints, kind="stable")
        prints, counts = prints[order], counts[order].astype(np.int64)
        first = np.flatnonzero(np.r_[True, prints[1:] != prints[:-1]]) if len(prints) else np.zeros(0, np.int64)
        self.width, self.prints = width, prints[first]
        self.counts = np.add.reduceat(counts, first) if len(first) else counts

    @classmethod
    def merged(cls, parts: list[QuotientFilter]) -> QuotientFilter:
        return cls(np.concatenate([p.prints for p in parts]), np.concatenate([p.counts for p in parts]), parts[0].width)

    def to_bytes(self) -> bytes:
        n = len(self.prints)
        q = min(self.width, max(0, (n - 1).bit_length()))
        r = self.width - q
        quotient = (self.prints >> np.uint64(r)).astype(np.int64) if r < 64 else np.zeros(n, np.int64)
        occupied = np.zeros(1 << q, bool)
        occupied[quotient] = True
        run_end = np.r_[quotient[1:] != quotient[:-1], True] if n else np.zeros(0, bool)
        wide = (r + 7) // 8
        rest = (self.prints & np.uint64((1 << r) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :wide]
        more = np.flatnonzero(self.counts > 1)
        return b"".join([
            self.HEAD.pack(self.width, q, n, len(more)), np.packbits(occupied).tobytes(), np.packbits(run_end).tobytes(), rest.tobytes(),
            more.astype("<u4").tobytes(), self.counts[more].astype("<u8").tobytes()])

    @classmethod
    def from_bytes(cls, raw: bytes) -> QuotientFilter:
        width, q, n, n_more = cls.HEAD.unpack_from(raw)
        at, r = cls.HEAD.size, width - q

        def take(size: int, kind) -> np.ndarray:
            nonlocal at
            at += size
            return np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at - size)

        occupied = np.flatnonzero(np.unpackbits(take(((1 << q) + 7) // 8, np.uint8), count=1 << q))
        run_end = np.unpackbits(take((n + 7) // 8, np.uint8), count=n)
        run = np.cumsum(run_end) - run_end
        wide = (r + 7) // 8
        rest = np.zeros((n, 8), np.uint8)
        rest[:, :wide] = take(n * wide, np.uint8).reshape(n, wide)
        prints = rest.view("<u8").reshape(n).astype(np.uint64)
        if q:
            prints = prints | (occupied[run].astype(np.uint64) << np.uint64(r))
        counts = np.ones(n, np.int64)
        more = take(4 * n_more, "<u4")
        counts[more] = take(8 * n_more, "<u8")
        return cls(prints, counts, width)


def normalised(text: str | None) -> bytes:
    """The text in UTF-8 with A-Z lower-cased and nothing else."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("fp", pa.int64()), ("sha", pa.binary())])
    out: list[list] = [[], [], [], []]
    at = TaskContext.get().partitionId() << 36
    for doc_id, text in rows(batches):
        norm = normalised(text)
        for col, v in zip(out, (at, doc_id, xxhash.xxh3_64_intdigest(norm) - (1 << 63), hashlib.sha256(norm).digest()), strict=True):
            col.append(v)
        at += 1
        if len(out[0]) >= 4096:
            yield batch_of(schema, out)
            out = [[], [], [], []]
    yield batch_of(schema, out)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole normalised texts, equal ones of a task folded together."""
    schema = pa.schema([("fp", pa.int64()), ("sha", pa.binary()), ("norm", pa.binary()), ("n", pa.int64())])
    held: dict[bytes, int] = {}
    size = 0

    def flush() -> pa.RecordBatch:
        keys = list(held)
        return batch_of(schema, [
            [xxhash.xxh3_64_intdigest(k) - (1 << 63) for k in keys], [hashlib.sha256(k).digest() for k in keys], keys, list(held.values())])

    for (text,) in rows(batches):
        norm = normalised(text)
        if norm in held:
            held[norm] += 1
            continue
        held[norm] = 1
        size += len(norm)
        if size > HELD_BYTES:
            yield flush()
            held, size = {}, 0
    yield flush()


def _filters(slice_bits: int):
    """One filter for each slice of a task's fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("slice", pa.int32()), ("filter", pa.binary())])
        width = 64 - slice_bits
        prints = [b.column(0).to_numpy(zero_copy_only=False) for b in batches]
        whole = np.concatenate(prints).astype(np.int64).view(np.uint64) if prints else np.zeros(0, np.uint64)
        place = (whole >> np.uint64(width)).astype(np.int64) if slice_bits else np.zeros(len(whole), np.int64)
        order = np.argsort(place, kind="stable")
        whole, place = whole[order] & np.uint64((1 << width) - 1), place[order]
        if not len(whole):
            return
        ids, starts = np.unique(place, return_index=True)
        ends = np.r_[starts[1:], len(place)]
        yield batch_of(schema, [ids, [QuotientFilter(whole[a:b], np.ones(b - a), width).to_bytes() for a, b in zip(starts, ends, strict=True)]])

    return run


def _merge(slice_bits: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        done = QuotientFilter.merged([QuotientFilter.from_bytes(x) for x in pdf["filter"]])
        often = done.counts > 1
        prints = done.prints[often]
        if slice_bits:
            prints = prints | (np.uint64(key[0]) << np.uint64(64 - slice_bits))
        return pd.DataFrame({"fp": prints.view(np.int64), "times": done.counts[often]})

    return run


def repeated_fingerprints(prints: DataFrame, slice_entries: int = SLICE_ENTRIES) -> DataFrame:
    """Fingerprints (column ``fp``) that occur more than once, with their counts, by merged filters."""
    n = prints.count()
    bits = max(3, (max(1, n // slice_entries) - 1).bit_length())
    filters = prints.select("fp").mapInArrow(_filters(bits), "slice int, filter binary")
    return filters.groupBy("slice").applyInPandas(_merge(bits), "fp long, times long")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): row, doc_id, keep_id, group_size, kept, text_sha256."""
    digests = written(docs.select("doc_id", "text").mapInArrow(_digest, "row long, doc_id long, fp long, sha binary"), "digests")
    repeated = written(repeated_fingerprints(digests), "repeated")
    texts = docs.select("text").mapInArrow(_texts, "fp long, sha binary, norm binary, n long")
    verified = texts.join(repeated, "fp").groupBy("fp", "norm").agg(F.sum("n").alias("n"), F.min("sha").alias("sha"))
    verified = verified.filter("n > 1").select("fp", "sha", "n")
    stays = digests.groupBy("fp", "sha").agg(F.max(F.struct("doc_id", "row")).alias("keep"))
    groups = written(verified.join(stays, ["fp", "sha"]), "groups")
    return digests.join(groups, ["fp", "sha"], "left").select(
        "row", "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep.row") == F.col("row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _with_sha(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sha = [hashlib.sha256(normalised(t)).digest() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sha, pa.binary())], names=[*batch.schema.names, "__sha"])


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, without the rows whose text repeats that of a row that stays."""
    names = [f"__c{i}" if set(c) & set(".`") else c for i, c in enumerate(docs.columns)]  # a map over batches cannot take such names
    columns, docs = docs.columns, docs.toDF(*names)
    stay = exact_duplicates(docs).filter("kept").select(F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__digest"))
    marked = docs.mapInArrow(_with_sha, T.StructType([*docs.schema.fields, T.StructField("__sha", T.BinaryType())]))
    one = first_per_key(marked, ["doc_id", "__sha"], [F.col(c).asc() for c in docs.columns if c in ("lang", "source", "n_chars")] or [F.lit(0)])
    met = one.join(stay, one["doc_id"].eqNullSafe(stay["__id"]) & (one["__sha"] == stay["__digest"]), "left_semi")
    return met.select(*names).toDF(*columns)


SQL = """
with t as (
  select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as s from documents)
select doc_id, max(doc_id) over (partition by s) as keep_id, count(*) over (partition by s) as group_size,
  doc_id = max(doc_id) over (partition by s) as kept, s as text_sha256
from t"""


@query("op6_exact_dedup", SQL)
def op6(spark, sf_dir) -> DataFrame:
    out = exact_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
