"""Chunks, embedding worklists, allocation by cosine, search and doctrine lines."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lexanchor.functions import text as T
from lexanchor.operators.blocks import filled
from lexanchor.operators.keyed import compute_once, position_segment, segmented_scan
from lexanchor.session import cut
from lexanchor.sources.tables import new_rows

#: Bytes of the plates of a tile or stripe, decisions of a block, and scores and plates that a task takes at once.
TILE_BYTES, BLOCK_ROWS, SCORES, MOST_PLATES = 16 * 1024 * 1024, 16384, 1 << 20, 2048


# --------------------------------------------------------------------- chunks
def build_chunks(b: DataFrame, page_chars: int = 24000) -> DataFrame:
    """Chunks per device: its decisions in date order (undated last), paged by characters.

    A page starts anew after every ``page_chars`` characters, so a group holds that much
    and one more decision; nothing is cut.
    """
    iso = F.coalesce(T.norm_date("julgamento_data"), F.lit("9999-99-99"))
    # dates are read once, not once for each pass of the scan
    x = compute_once(b, {"iso": iso, "__fit": filled("anchor_slug") & filled("block_text")}).filter("__fit")
    x = cut(x.select("anchor_slug", "block_id", "iso", "block_text"))
    day = F.replace("iso", F.lit("-"), F.lit("")).cast("bigint")
    seg = F.when(F.col("iso") < "9999", day).otherwise(day + position_segment("block_id"))
    own = F.length("block_text") + 1
    x = segmented_scan(x, ["anchor_slug"], ["iso", "block_id"], seg, sums={"__end": own})
    x = x.withColumn("chunk_index", F.floor((F.col("__end") - own) / page_chars).cast("int"))
    parts = F.array_sort(F.collect_list(F.struct("iso", "block_id", "block_text")))
    c = x.groupBy("anchor_slug", "chunk_index").agg(
        F.array_join(F.transform(parts, lambda p: p["block_text"]), "\n").alias("chunk_text"), F.count("*").alias("units"),
        F.min(F.when(F.col("iso") < "9999", F.col("iso"))).alias("first_date"))
    return c.select(
        F.concat_ws("/", "anchor_slug", F.col("chunk_index").cast("string")).alias("chunk_slug"), "anchor_slug", "chunk_index",
        T.parse_slug("anchor_slug")["depth"].alias("anchor_depth"), "units", "first_date", "chunk_text",
        T.token_estimate("chunk_text").alias("token_estimate"), F.md5("chunk_text").alias("hash_chunk"))


def pending_chunks(chunks: DataFrame, emb: DataFrame, model: str) -> DataFrame:
    """Chunks with text that have no vector of the model yet."""
    have = emb.filter(F.col("embedding_model") == model).select("chunk_slug")
    return chunks.filter(filled("chunk_text")).join(have, "chunk_slug", "left_anti")


def embedding_worklist(chunks: DataFrame, emb: DataFrame, model: str, limit: int = 24000) -> DataFrame:
    """Inputs to embed: consecutive pieces of each chunk of the size that the model accepts."""
    p = pending_chunks(chunks, emb, model).select("chunk_slug", F.posexplode(T.pieces_for_model("chunk_text", limit)).alias("piece", "input"))
    return p.withColumn("token_estimate", T.token_estimate("input"))


def embedding_budget(chunks: DataFrame, price_per_million: float = 0.02) -> DataFrame:
    n = chunks.agg(F.count("*").alias("chunks"), F.coalesce(F.sum("token_estimate"), F.lit(0)).alias("tokens"))
    return n.withColumn("cost", F.round(F.col("tokens") / 1_000_000 * price_per_million, 6))


def accept_vectors(vectors: DataFrame, target: DataFrame, dim: int) -> DataFrame:
    """Vectors of the right size that the target does not hold yet."""
    return new_rows(vectors.filter(F.size("vector_ref") == dim), target, ["chunk_slug", "embedding_model"])


# ----------------------------------------------------------------- allocation
def _unit_rows(vectors: pd.Series) -> np.ndarray:
    m = np.stack(vectors.to_numpy()).astype(np.float64)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0, 1, norm)


def _unit_lists(column: pa.ChunkedArray) -> np.ndarray:
    m = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]).astype(np.float64).reshape(len(column), -1)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0, 1, norm)


class _Best:
    """The k best (score, plate) of each decision of a block so far; the smaller plate wins ties."""

    def __init__(self, rows: int, k: int):
        self.k, self.score, self.plate = k, np.full((rows, k), -np.inf), np.full((rows, k), -1)

    def offer(self, rows: np.ndarray, left: np.ndarray, plates: np.ndarray, right: np.ndarray) -> None:
        """Scores all given rows against all given plates; only scores that reach a row's k-th are rounded and merged."""
        raw = left @ right.T
        least = self.score[rows, -1] - 1e-8
        if raw.shape[1] > self.k and np.isneginf(least).any():
            least = np.maximum(least, np.partition(raw, raw.shape[1] - self.k, axis=1)[:, raw.shape[1] - self.k] - 1e-8)
        row, col = np.nonzero(raw >= least[:, None])
        if not len(row):
            return
        touched = np.unique(row)
        score = np.r_[np.round(raw[row, col], 9), self.score[rows[touched]].ravel()]
        plate = np.r_[plates[col], self.plate[rows[touched]].ravel()]
        row = np.r_[row, np.repeat(touched, self.k)]
        order = np.lexsort((plate, -score, row))
        row = row[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        order, row, rank = order[rank < self.k], rows[row[rank < self.k]], rank[rank < self.k]
        self.score[row, rank], self.plate[row, rank] = score[order], plate[order]


def _scores(k: int, key: str, vector: str, step: int):
    """The k best plates of a stripe for each decision of a block, ``step`` plates at a time.

    Where plates have a ``tile``, a decision meets those whose bit is set in its ``open``.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            kinds = (left.schema.field(key).type, right.schema.field("plate").type, pa.float64())
            return pa.table([pa.array([], t) for t in kinds], names=[key, "plate", "score"])
        right = right.sort_by("plate")
        ours, theirs = _unit_lists(left.column(vector)), _unit_lists(right.column("plate_vector"))
        best, fit = _Best(len(left), k), np.isfinite(ours).all(axis=1)
        usable = np.flatnonzero(np.isfinite(theirs).all(axis=1))
        if "tile" in right.column_names:
            tile = right.column("tile").to_numpy()[usable]
            bits = np.frombuffer(b"".join(left.column("open").to_pylist()), np.uint8).reshape(len(left), -1)
            groups = [(usable[tile == t], fit & (bits[:, t // 8] >> (7 - t % 8) & 1).astype(bool)) for t in np.unique(tile)]
        else:
            groups = [(usable, fit)]
        for plates, open_ in groups:
            rows = np.flatnonzero(open_)
            for p in range(0, len(plates), step):
                some = plates[p:p + step]
                take = max(1, SCORES // len(some))
                for at in range(0, len(rows), take):
                    part = rows[at:at + take]
                    best.offer(part, ours[part], some, theirs[some])
        row, rank = np.nonzero(best.plate >= 0)
        return pa.table([left.column(key).take(pa.array(row)), right.column("plate").take(pa.array(best.plate[row, rank])), pa.array(best.score[row, rank])],
                        names=[key, "plate", "score"])

    return run


def nearest_plates(
    decisions: DataFrame, plates: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding",
    block_rows: int = BLOCK_ROWS, tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """The k plates of highest cosine for each decision, with rank; any number of plates is exact.

    Decisions are dealt to blocks and plates to stripes of bounded size by a hash; every block
    meets every stripe in one task, which walks the stripe in tiles of ``tile_bytes`` at most and keeps
    the k best, and those of each stripe are merged. So rows are copied once per stripe or block,
    however small the tiles. Vectors that are missing or of another size than most plates' take no part.
    """
    size = plates.filter(F.col(vector).isNotNull()).agg(F.count("*").alias("n"), F.mode(F.size(vector)).alias("d")).first()
    dim = size["d"] or 0
    usable = F.col(vector).isNotNull() & (F.size(vector) == dim)
    ours, theirs = decisions.filter(usable).select(key, vector), plates.filter(usable)
    stripes = max(1, -(-size["n"] * dim * 8 // max(tile_bytes, TILE_BYTES)))
    blocks = max(1, -(-ours.count() // block_rows))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    d = ours.withColumn("b", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")).withColumn("t", spread(stripes))
    p = theirs.select(F.col(key).alias("plate"), F.col(vector).alias("plate_vector"), F.pmod(F.xxhash64(key), F.lit(stripes)).cast("int").alias("t")).withColumn("b", spread(blocks))
    schema = f"{key} {decisions.schema[key].dataType.simpleString()}, plate {plates.schema[key].dataType.simpleString()}, score double"
    step = min(MOST_PLATES, max(1, tile_bytes // max(1, dim * 8)))
    best = d.groupBy("b", "t").cogroup(p.groupBy("b", "t")).applyInArrow(_scores(k, key, vector, step), schema)
    # at most k rows per stripe and decision
    per = best.groupBy(key).agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "plate"))).alias("all"))
    return per.select(key, F.posexplode(F.slice("all", 1, k)).alias("i", "x")).select(
        key, F.col("x.plate").alias("plate"), (-F.col("x.s")).alias("score"), (F.col("i") + 1).alias("rank"))


def allocate(decisions: DataFrame, plates: DataFrame, k: int = 5, tau: float = 0.75, **kw) -> tuple[DataFrame, DataFrame]:
    """Allocations at or above the threshold, and the queue: all decisions without any, with the reason."""
    near = nearest_plates(decisions, plates, k, **kw)
    key, vector = kw.get("key", "vec_id"), kw.get("vector", "embedding")
    good = near.filter(F.col("score") >= tau)
    first = near.filter(F.col("rank") == 1).select(key, F.col("score").alias("best_score"))
    reason = F.when(F.col(vector).isNull(), "no vector").when(F.col("best_score").isNull(), "no comparable plate").otherwise("below threshold")
    queue = decisions.select(key, vector).join(first, key, "left").filter(F.col("best_score").isNull() | (F.col("best_score") < tau))
    return good, queue.select(key, "best_score", reason.alias("reason"))


def _literal(vector: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in vector])


def search(df: DataFrame, query: Sequence[float], k: int, key: str = "vec_id", vector: str = "embedding", where: Column | None = None) -> DataFrame:
    """Filter first, then the k rows closest to the query vector."""
    rows = df if where is None else df.filter(where)
    return rows.withColumn("score", F.round(T.cosine(vector, _literal(query)), 9)).orderBy(F.desc("score"), key).limit(k)


def similarity_check(df: DataFrame, plates: DataFrame, n: int, seed: int, key: str = "vec_id") -> DataFrame:
    """Nearest plate of a repeatable sample, for inspection."""
    draw = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return nearest_plates(df.orderBy(draw, key).limit(n), plates, 1, key)


# ---------------------------------------------------------------- lexical search
def text_search(b: DataFrame, terms: Sequence[str], key: str = "block_id", text: str = "block_text") -> DataFrame:
    """Rows with any of the terms and how many they hold; case and accents do not matter."""
    wanted = F.array_distinct(F.array(*[T.word_key(F.lit(t), prefixes=False) for t in terms]))
    words = F.array_distinct(F.split(T.word_key(text, prefixes=False), " "))
    return b.select(key, F.size(F.array_intersect(words, wanted)).alias("matched")).filter(F.col("matched") > 0)


def trigrams(c) -> Column:
    """Distinct three-letter pieces of each word, padded with two spaces before and one after."""
    words = F.filter(F.split(T.word_key(c, prefixes=False), " "), lambda w: w != "")
    return F.array_distinct(F.flatten(F.transform(words, lambda w: F.transform(
        F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))))


def trigram_similarity(a, b) -> Column:
    """Shared trigrams over all trigrams."""
    x, y = trigrams(a), trigrams(b)
    return F.round(F.size(F.array_intersect(x, y)) / F.nullif(F.size(F.array_union(x, y)).cast("double"), F.lit(0.0)), 6)


# ------------------------------------------------------------------ doctrine lines
def line_positions(alloc: DataFrame, line: str = "plate", order: Sequence[str] = ("decided_at", "vec_id"), segment: Column | None = None) -> DataFrame:
    """Place of each decision in its line by date."""
    seg = position_segment(order[-1]) if segment is None else segment
    return segmented_scan(alloc, [line], list(order), seg, counts={"line_position": F.lit(True)})


def decision_lines(alloc: DataFrame, dates: DataFrame, key: str = "vec_id", method: str = "cosine", segment: Column | None = None) -> DataFrame:
    """Decision x line rows with position, score, rank, method and date."""
    x = alloc.join(dates.select(key, "decided_at"), key)
    return line_positions(x, order=("decided_at", key), segment=segment).withColumn("method", F.lit(method))


def turning_points(line: DataFrame, tau: float, k: int, by: str = "label", order: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Places where a line leaves its earlier doctrine and stays away for the next k decisions.

    The earlier doctrine is the vector just before. It is sent to the k + 1 places
    after it and compared there, so a long line is spread by (line, place).
    """
    x = segmented_scan(line.select(by, order, vector), [by], [order], position_segment(order), counts={"n": F.lit(True)})
    base = x.select(by, F.explode(F.sequence(F.col("n") + 1, F.col("n") + 1 + k)).alias("n"), (F.col("n") + 1).alias("turn"), F.col(vector).alias("before"))
    d = x.join(base, [by, "n"]).withColumn("divergence", 1 - T.cosine(vector, "before"))
    t = d.groupBy(by, "turn").agg(F.round(F.min("divergence"), 6).alias("least_divergence"), F.count("*").alias("windows"),
                                  F.min_by(order, "n").alias(order))
    return t.filter((F.col("windows") == k + 1) & (F.col("least_divergence") >= tau)).select(by, order, F.col("turn").alias("line_position"), "least_divergence")
