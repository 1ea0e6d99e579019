"""Token ids as patched frame-of-reference blocks.

Documents are put in ascending order of doc_id by range, each task writes one shard. A
shard is a sequence of pages of whole documents. A page holds its ids in blocks of 128:
the block's minimum is subtracted, the rest is packed with the bits that a percentile of
the block's values needs, and the high bits of larger values stand in an exception list
(position, high bits). The page starts with an index of where its blocks begin, so a part
of it can be read alone. Pages are rows of a Parquet table (shard, page, start in the
shard, ids, documents and their lengths, payload): Spark's commit then drops what a lost
or repeated task has written, on any file system.

Null and empty texts have the end id alone. Null ids come first; rows with equal ids are
ordered by a hash of their text. An empty table gives an empty file.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from lexanchor.llm.common import batch_of, query, rows, table, text_or_empty, written
from lexanchor.llm.tokens import encoder

BLOCK = 128
#: Ids after which a page ends with its document.
PAGE_IDS = 1 << 16
#: Share of a block's values that its width has room for.
PERCENTILE = 0.95
END_ID = 1
_HEAD = struct.Struct("<4sII")
_MAGIC = b"PFR1"
_PAGES = "shard int, page int, start long, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def _pack_bits(values: np.ndarray, w: int) -> np.ndarray:
    """The low ``w`` bits of each value of a block, end to end: eight values fill ``w`` bytes."""
    lanes = values.reshape(len(values), BLOCK // 8, 8)
    out = np.zeros((len(values), BLOCK // 8, w), np.uint8)
    for j in range(8):
        byte, bit = divmod(j * w, 8)
        v = (lanes[:, :, j].astype(np.uint64) & np.uint64((1 << w) - 1)) << np.uint64(bit)
        for t in range((bit + w + 7) // 8):
            out[:, :, byte + t] |= (v >> np.uint64(8 * t)).astype(np.uint8)
    return out.reshape(len(values), -1)


def _unpack_bits(packed: np.ndarray, w: int) -> np.ndarray:
    groups = packed.reshape(len(packed), BLOCK // 8, w)
    out = np.empty((len(packed), BLOCK // 8, 8), np.uint32)
    for j in range(8):
        byte, bit = divmod(j * w, 8)
        v = np.zeros(groups.shape[:2], np.uint64)
        for t in range((bit + w + 7) // 8):
            v |= groups[:, :, byte + t].astype(np.uint64) << np.uint64(8 * t)
        out[:, :, j] = (v >> np.uint64(bit)) & np.uint64((1 << w) - 1)
    return out.reshape(len(packed), BLOCK)


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """A page of ids (unsigned 32-bit)."""
    n, count = len(ids), -(-len(ids) // BLOCK)
    if not n:
        return _HEAD.pack(_MAGIC, 0, 0)
    grid = np.full(count * BLOCK, ids[-1], np.uint32)
    grid[:n] = ids
    grid = grid.reshape(count, BLOCK)
    low = grid.min(axis=1)
    rest = grid - low[:, None]
    width = _bits(np.sort(rest, axis=1)[:, max(0, int(np.ceil(percentile * BLOCK)) - 1)])
    outside = _bits(rest) > width[:, None]
    extra = outside.sum(axis=1)
    sizes = 6 + BLOCK // 8 * width.astype(np.int64) + 5 * extra
    head = _HEAD.size + 4 * count
    starts = head + np.cumsum(sizes) - sizes
    out = np.zeros(head + sizes.sum(), np.uint8)
    out[:_HEAD.size] = np.frombuffer(_HEAD.pack(_MAGIC, n, count), np.uint8)
    out[_HEAD.size:head] = starts.astype("<u4").view(np.uint8)
    out[starts[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(count, 4)
    out[starts + 4], out[starts + 5] = width, extra
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        if w:
            packed = _pack_bits(rest[at], int(w))
            out[starts[at][:, None] + 6 + np.arange(packed.shape[1])] = packed
    block, place = np.nonzero(outside)
    if len(block):
        within = np.arange(len(block)) - np.repeat(np.cumsum(extra) - extra, extra)
        tail = starts[block] + 6 + BLOCK // 8 * width[block].astype(np.int64)
        out[tail + within] = place
        high = (rest[block, place] >> width[block].astype(np.uint32)).astype("<u4").view(np.uint8).reshape(-1, 4)
        out[(tail + extra[block] + 4 * within)[:, None] + np.arange(4)] = high
    return out.tobytes()


def unpack(raw: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a page; only the blocks that hold them are read."""
    magic, n, _ = _HEAD.unpack_from(raw)
    if magic != _MAGIC:
        raise ValueError("not a page of ids")
    stop = n if stop is None else min(stop, n)
    if stop <= start:
        return np.zeros(0, np.uint32)
    first, last = start // BLOCK, -(-stop // BLOCK)
    data = np.frombuffer(raw, np.uint8)
    starts = np.frombuffer(raw, "<u4", last - first, _HEAD.size + 4 * first).astype(np.int64)
    low = np.ascontiguousarray(data[starts[:, None] + np.arange(4)]).view("<u4").ravel().astype(np.uint32)
    width, extra = data[starts + 4], data[starts + 5].astype(np.int64)
    rest = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width):
        if w:
            at = np.flatnonzero(width == w)
            packed = data[starts[at][:, None] + 6 + np.arange(BLOCK // 8 * int(w))]
            rest[at] = _unpack_bits(packed, int(w))
    block = np.repeat(np.arange(len(starts)), extra)
    if len(block):
        within = np.arange(len(block)) - np.repeat(np.cumsum(extra) - extra, extra)
        tail = starts[block] + 6 + BLOCK // 8 * width[block].astype(np.int64)
        place = data[tail + within]
        high = np.ascontiguousarray(data[(tail + extra[block] + 4 * within)[:, None] + np.arange(4)]).view("<u4").ravel()
        rest[block, place] |= (high.astype(np.uint32) << width[block].astype(np.uint32))
    return (rest + low[:, None]).ravel()[start - first * BLOCK:stop - first * BLOCK]


def _write_pages(path: str, space: bool, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("page", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
                            ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())])
        enc, shard = encoder(path, space), TaskContext.get().partitionId()
        page, start, held, docs = 0, 0, [], []

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(held)
            return batch_of(schema, [[shard], [page], [start], [len(ids)], [docs], [[len(x) for x in held]], [pack(ids)]])

        size = 0
        for doc_id, text in rows(batches):
            held.append(np.append(enc.encode(text), np.uint32(end_id)))
            docs.append(doc_id)
            size += len(held[-1])
            if size >= PAGE_IDS:
                yield flush()
                page, start, size, held, docs = page + 1, start + size, 0, [], []
        if held:
            yield flush()

    return run


def write_token_pages(docs: DataFrame, path: str, space_in_front: bool, end_id: int = END_ID) -> DataFrame:
    """Encodes (doc_id, text) with a tokenizer file and writes the pages; returns the written table."""
    order = [F.col("doc_id"), F.xxhash64("text")]
    texts = docs.select("doc_id", text_or_empty().alias("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    return written(texts.mapInArrow(_write_pages(path, space_in_front, end_id), _PAGES), "token-pages")


def _read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("within", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    for shard, start, doc_ids, lengths, payload in rows(batches):
        ids = unpack(payload).astype("<u4")
        ends = np.cumsum(lengths)
        yield batch_of(schema, [doc_ids, [shard] * len(doc_ids), start + ends - lengths, lengths,
                                [ids[e - n:e].tobytes() for e, n in zip(ends, lengths, strict=True)]])


def read_token_pages(pages: DataFrame) -> DataFrame:
    """One row per document: doc_id, start, n_tokens and its ids as little-endian bytes."""
    sizes = pages.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    base = sizes.select("shard", F.coalesce(F.sum("n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    docs = pages.select("shard", "start", "doc_ids", "lengths", "payload").mapInArrow(
        _read_pages, "doc_id long, shard int, within long, n_tokens long, ids binary")
    # one row per shard, that is per task of the writing stage
    return docs.join(F.broadcast(base), "shard").select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids")


@query("op1_token_files")
def op1(spark, sf_dir) -> DataFrame:
    pages = write_token_pages(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), False)
    return read_token_pages(pages).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
