"""Best-two-fit packing of token sequences.

Documents are encoded once; pieces longer than a sequence are cut, the first piece takes
the remainder. Only narrow rows (no ids) are dealt at random into groups of bounded size,
and every group is packed alone: a bin is filled greedily with the largest piece that
fits, then its smallest piece gives way to the two unpacked pieces that fill the widened
gap best, if they fill it better. Each group wastes about one bin, whatever the input.

Null texts are empty: a piece with the end id alone. Null and repeated ids are ordinary
rows, told apart by the slot that a task gives each piece. An empty table gives an empty
result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lexanchor.llm.common import batch_of, query, rows, table, text_or_empty, written
from lexanchor.llm.tokens import REMEMBERED, encoder

SEQUENCE = 2048
END_ID = 0
#: Pieces that one task packs together.
GROUP_PIECES = 16384

_PIECES = pa.schema([("slot", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                     ("length", pa.int64()), ("ids_crc32", pa.int64())])


def _cut(path: str, space: bool, end_id: int, longest: int, with_ids: bool, remembered: int):
    schema = _PIECES.append(pa.field("ids", pa.binary())) if with_ids else _PIECES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, space, remembered)
        slot = TaskContext.get().partitionId() << 36
        out: list[list] = [[] for _ in schema]
        size = 0
        for doc_id, text in rows(batches):
            ids = np.append(enc.encode(text), np.uint32(end_id)).astype("<u4")
            first = len(ids) % longest or longest
            starts = [0, *range(first, len(ids), longest)]
            for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                raw = ids[a:b].tobytes()
                for col, v in zip(out, (slot, doc_id, piece, a, b - a, zlib.crc32(raw), raw), strict=False):
                    col.append(v)
                slot += 1
                size += len(raw)
            if len(out[0]) >= 4096 or size > 1 << 24:
                yield batch_of(schema, out)
                out, size = [[] for _ in schema], 0
        yield batch_of(schema, out)

    return run


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; all lengths lie in 1..capacity."""
    by_length: dict[int, list[int]] = {}
    for i in np.argsort(-np.arange(len(lengths)), kind="stable"):
        by_length.setdefault(int(lengths[i]), []).append(int(i))
    free = np.bincount(lengths, minlength=capacity + 1)
    values = np.arange(capacity + 1)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    largest = np.maximum.accumulate(np.where(free > 0, values, 0))
    left, at = len(lengths), 0

    def change(length: int, by: int) -> None:
        nonlocal largest
        free[length] += by
        if free[length] == max(by, 0):  # it has run out, or come back
            largest = np.maximum.accumulate(np.where(free > 0, values, 0))

    while left:
        inside, gap = [], capacity
        while gap and (take := int(largest[gap])):
            inside.append(take)
            change(take, -1)
            gap -= take
        smallest = inside[-1]
        if gap and (wide := gap + smallest) >= 2:
            a = values[1:wide // 2 + 1]
            b = largest[wide - a]
            good = (free[a] > 0) & (b >= a) & ((b > a) | (free[a] > 1))
            total = np.where(good, a + b, 0)
            best = int(total.argmax()) if len(total) else 0
            if len(total) and total[best] > smallest:
                inside[-1:] = [int(b[best]), int(a[best])]
                change(smallest, 1)
                change(int(b[best]), -1)
                change(int(a[best]), -1)
        place = 0
        for length in inside:
            i = by_length[length].pop()
            bins[i], offsets[i] = at, place
            place += length
        left -= len(inside)
        at += 1
    return bins, offsets


def _pack_group(longest: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("slot", ignore_index=True)
        bins, offsets = best_two_fit(pdf["length"].to_numpy(), longest)
        return pdf.drop(columns="part").assign(sequence_id=(int(key[0]) << 32) + bins, offset=offsets)

    return run


def encoded_pieces(docs: DataFrame, path: str, space_in_front: bool, end_id: int = END_ID, longest: int = SEQUENCE, with_ids: bool = False,
                   remembered: int = REMEMBERED) -> DataFrame:
    """Pieces of (doc_id, text): slot, doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""
    schema = "slot long, doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(_cut(path, space_in_front, end_id, longest, with_ids, remembered), schema)


def packed(pieces: DataFrame, longest: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to written pieces (without ids)."""
    groups = max(1, round(pieces.count() / group_pieces))
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("slot"), F.lit(groups)))
    return dealt.groupBy("part").applyInPandas(
        _pack_group(longest), "slot long, doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def packed_ids(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """The sequences themselves, as little-endian bytes: pieces with ids meet their places; a sequence has a bounded length."""
    met = pieces.select("slot", "ids").join(places.select("slot", "sequence_id", "offset"), "slot")
    parts = met.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids")))).alias("parts"))
    return parts.select("sequence_id", F.unhex(F.array_join("parts.ids", "")).alias("ids"))


def packed_documents(docs: DataFrame, remembered: int = REMEMBERED) -> DataFrame:
    """Places of all pieces; ``remembered`` bounds the chunks that a worker keeps (memory against time, same result)."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packed(written(encoded_pieces(docs, path, True, remembered=remembered), "pieces")).drop("slot")


@query("op4_best_fit_packing")
def op4(spark, sf_dir) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))
