"""Nearest plates with pruning: exact top k that visits only the tiles that can hold one.

Plates are grouped by direction: each belongs to its nearest centre, and a tile holds the
plates of one centre whose angles to it lie in a narrow ring. For a decision at angle ``a``
to the centre, no plate of a ring from ``lo`` to ``hi`` is nearer than the distance of ``a`` from
the ring, so its cosine is a bound on all scores of the tile. A first visit to the tile with
the best bound gives every decision a k-th score; the second pass visits the tiles whose
bound is not below that. Consecutive tiles make up stripes of bounded size: a decision
travels once to a stripe, with a bit for each tile that it visits there. Centres are fitted on a bounded sample, which decides how many
tiles are visited but not what is found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexanchor.operators.keyed import first_per_key
from lexanchor.operators.vectors import BLOCK_ROWS, MOST_PLATES, TILE_BYTES, _scores, _unit_rows
from lexanchor.session import cut

CENTRES, SAMPLE, ROUNDS = 64, 8192, 8
#: Rings that the angle to a centre is divided into at most.
RINGS = 360
TILE_ROWS = 16384


@dataclass(frozen=True)
class Tiles:
    """Unit centres, for each tile its centre and the least and greatest angle of a plate, and the first tile of each stripe."""

    centres: np.ndarray
    centre: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    starts: np.ndarray

    def bounds(self, unit: np.ndarray) -> np.ndarray:
        """What each decision (a row) can score at most in each tile."""
        angle = _angles(unit, self.centres)[:, self.centre]
        return np.cos(np.maximum(0.0, np.maximum(angle - self.hi, self.lo - angle) - 1e-7)) + 1e-9


@dataclass(frozen=True)
class Nearest:
    """The rows found, the (decision, tile) visits made, and how many there would be without pruning."""

    rows: DataFrame
    visits: int
    possible: int


def _angles(unit: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ centres.T, -1, 1))


def fit_centres(sample: np.ndarray, most: int = CENTRES) -> np.ndarray:
    """Unit centres by spherical k-means from evenly spaced rows of the sample."""
    k = max(1, min(most, math.isqrt(len(sample))))
    centres = sample[np.linspace(0, len(sample) - 1, k).astype(int)].copy()
    for _ in range(ROUNDS):
        nearest = (sample @ centres.T).argmax(axis=1)
        for c in range(k):
            total = sample[nearest == c].sum(axis=0)
            if np.linalg.norm(total) > 0:
                centres[c] = total / np.linalg.norm(total)
    return centres


def _placed(sent, vector: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angle = _angles(_unit_rows(batch.column(vector).to_pandas()), sent.value)
            nearest = angle.argmin(axis=1)
            own = angle[np.arange(len(nearest)), nearest]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest.astype(np.int32)), pa.array(own)], names=[*batch.schema.names, "centre", "angle"])

    return run


def _visits(sent, key: str, vector: str, first: bool):
    """Tiles that a decision visits: the most promising one at first, then all others not below its k-th score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles: Tiles = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                bound = tiles.bounds(_unit_rows(part.column(vector).to_pandas()))
                best = bound.argmax(axis=1)
                open_ = np.zeros(bound.shape, bool) if first else bound >= part.column("kth").to_numpy()[:, None]
                open_[np.arange(len(best)), best] = first
                for stripe, mine in enumerate(np.split(open_, tiles.starts[1:], axis=1)):
                    n = mine.sum(axis=1)
                    row = np.flatnonzero(n)
                    bits = pa.array([x.tobytes() for x in np.packbits(mine[row], axis=1)], pa.binary())
                    yield pa.RecordBatch.from_arrays([part.column(key).take(pa.array(row)), pa.array(np.full(len(row), stripe, np.int32)), bits, pa.array(n[row].astype(np.int32))],
                                                     names=[key, "stripe", "open", "visits"])

    return run


def _stripe_starts(rows: np.ndarray, most: int) -> np.ndarray:
    """The first tile of each stripe: consecutive tiles of ``most`` rows together, or one."""
    starts, held = [0], 0
    for i, n in enumerate(rows):
        if held and held + n > most:
            starts.append(i)
            held = 0
        held += n
    return np.array(starts)


def tiled(plates: DataFrame, key: str, vector: str, dim: int, tile_rows: int, centres: int) -> tuple[DataFrame, Tiles]:
    """Plates with their stripe and the number of their tile in it, and the tiles."""
    spark = plates.sparkSession
    sample = plates.orderBy(F.xxhash64(key), key).limit(SAMPLE).select(vector).toPandas()[vector]
    fitted = fit_centres(_unit_rows(sample), centres) if len(sample) else np.zeros((1, dim))
    kind = plates.schema[key].dataType.simpleString()
    at = cut(plates.mapInArrow(_placed(spark.sparkContext.broadcast(fitted), vector), f"{key} {kind}, {vector} {plates.schema[vector].dataType.simpleString()}, centre int, angle double")
             .withColumn("ring", F.floor(F.col("angle") / math.pi * RINGS).cast("int")))
    # a row for each centre and ring at most
    rings = at.groupBy("centre", "ring").agg(F.count("*").alias("n"), F.min("angle").alias("lo"), F.max("angle").alias("hi")).orderBy("centre", "ring").collect()
    found, of_ring = [], []  # tiles as [centre, lo, hi, rows, parts]
    for r in rings:
        last = found[-1] if found else None
        if last and last[0] == r.centre and last[3] + r.n <= tile_rows:
            last[2], last[3] = r.hi, last[3] + r.n
        else:
            found.append([r.centre, r.lo, r.hi, r.n, -(-r.n // tile_rows)])
        of_ring.append(len(found) - 1)
    base = np.cumsum([0, *[t[4] for t in found]])
    parts = [t[4] for t in found]
    each = lambda i, kind: np.repeat(np.array([t[i] for t in found], kind), parts) if found else np.zeros(0, kind)
    starts = _stripe_starts(np.repeat([-(-t[3] // t[4]) for t in found], parts), max(tile_rows, TILE_BYTES // (8 * dim)))
    table = spark.createDataFrame([(r.centre, r.ring, int(base[t]), int(found[t][4])) for r, t in zip(rings, of_ring, strict=True)], "centre int, ring int, base int, parts int")
    placed = at.join(F.broadcast(table), ["centre", "ring"])  # at most CENTRES * RINGS rows
    placed = placed.select(key, vector, (F.col("base") + F.pmod(F.xxhash64(key), F.col("parts"))).cast("int").alias("tile"))
    first = F.array(*[F.lit(int(x)) for x in starts])
    placed = placed.withColumn("stripe", F.size(F.filter(first, lambda x: x <= F.col("tile"))) - 1).withColumn("tile", F.col("tile") - F.get(first, F.col("stripe")))
    return placed, Tiles(fitted, each(0, np.int64), each(1, float), each(2, float), starts)


def _scored(visits: DataFrame, decisions: DataFrame, plates: DataFrame, k: int, key: str, vector: str, block_rows: int) -> DataFrame:
    """The k best plates of the visited tiles of each stripe."""
    blocks = visits.groupBy("stripe").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    d = visits.drop("visits").join(F.broadcast(blocks), "stripe").withColumn("b", F.pmod(F.xxhash64(key), F.col("blocks")).cast("int")).drop("blocks").join(decisions.select(key, vector), key)
    p = plates.select(F.col(key).alias("plate"), F.col(vector).alias("plate_vector"), "tile", "stripe").join(F.broadcast(blocks), "stripe").withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    schema = f"{key} {decisions.schema[key].dataType.simpleString()}, plate {plates.schema[key].dataType.simpleString()}, score double"
    return d.groupBy("stripe", "b").cogroup(p.drop("blocks").groupBy("stripe", "b")).applyInArrow(_scores(k, key, vector, MOST_PLATES), schema)


def nearest(
    decisions: DataFrame, plates: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding",
    block_rows: int = BLOCK_ROWS, tile_rows: int = TILE_ROWS, centres: int = CENTRES,
) -> Nearest:
    """The k plates of highest cosine for each decision, with rank, as ``vectors.nearest_plates`` gives them.

    Vectors that are missing or of another size than most plates' take no part; keys are unique.
    """
    size = plates.filter(F.col(vector).isNotNull()).agg(F.mode(F.size(vector)).alias("d")).first()
    usable = F.col(vector).isNotNull() & (F.size(vector) == (size["d"] or 0))
    ours = decisions.filter(usable).select(key, vector)
    theirs, tiles = tiled(plates.filter(usable).select(key, vector), key, vector, size["d"] or 1, tile_rows, centres)
    sent = decisions.sparkSession.sparkContext.broadcast(tiles)  # at most CENTRES centres and three numbers a tile
    pair = f"{key} {decisions.schema[key].dataType.simpleString()}, stripe int, open binary, visits int"
    order = [F.col("score").desc(), F.col("plate").asc()]
    if not len(tiles.centre):
        none = theirs.select(F.col(key).alias("plate"), F.lit(0.0).alias("score"), F.lit(1).alias("rank"))
        return Nearest(ours.select(key).limit(0).join(none.limit(0), F.lit(False)), 0, 0)
    home = cut(ours.mapInArrow(_visits(sent, key, vector, True), pair))
    first = cut(_scored(home, ours, theirs, k, key, vector, block_rows))
    kth = first.groupBy(key).agg(F.when(F.count("*") >= k, F.min("score")).otherwise(-2.0).alias("kth"))
    more = ours.join(kth, key, "left").withColumn("kth", F.coalesce("kth", F.lit(-2.0)))
    others = cut(more.mapInArrow(_visits(sent, key, vector, False), pair))
    both = first.unionByName(_scored(others, ours, theirs, k, key, vector, block_rows))
    best = first_per_key(both, [key], order, k)
    per = best.groupBy(key).agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "plate"))).alias("all"))
    rows = per.select(key, F.posexplode("all").alias("i", "x")).select(
        key, F.col("x.plate").alias("plate"), (-F.col("x.s")).alias("score"), (F.col("i") + 1).alias("rank"))
    n = home.count()
    return Nearest(rows, n + (others.agg(F.sum("visits")).first()[0] or 0), n * len(tiles.centre))
