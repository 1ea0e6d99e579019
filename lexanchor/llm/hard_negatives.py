"""Hard negatives for anchors, by lists that the anchors of a cluster share.

A vector's components are whole numbers, ``floor(256 * x)``; scores are inner products. An
anchor's positives are its best other rows of the same label, and the negatives of a pair
are the best rows of other labels whose score lies between 80 and 100 % of the positive's.

Anchors are clustered by direction (spherical k-means on a bounded sample, every anchor
assigned). With the centre at angle ``a`` from a candidate and no member further than ``r``
from the centre, a member's score is at most ``|anchor| * |candidate| * cos(max(0, a - r))``.
Candidates are sorted by that bound once for a cluster, and every member walks the list, a
slice at a time, until what it still lacks cannot be further on: its fifth best score, or
the lower end of its band, is above the bound. So nothing is missed, whatever the clusters
look like; vectors without directions in common only make walks longer.

Candidates are dealt to tiles and anchors to chunks, both of bounded size and by row number,
so that copies of one vector or label spread out; each chunk meets each tile in one task,
which walks the tile's part of the list, and the best of all tiles are merged. The stated
anchors meet all rows: no pairs are kept but the best of a tile. A first pass finds the
positives, a second one the negatives, whose walks know their bands from the start.

Rows with a null label, a null vector, or a null or non-finite component take no part. A
shorter vector counts as ending in zeros; a vector without components scores 0. Components
are cut at 2 ** 26 either way, so that scores of up to 2048 components stay exact. A null id comes last among ties. Equal rows are rows of their
own: a copy of an anchor can be its positive. Anchors without a positive or a negative give
no rows. Other columns are not read. An empty table, or one without anchors, gives an empty
result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lexanchor.llm.common import query, table, written
from lexanchor.operators.keyed import first_per_key

POSITIVES, NEGATIVES = 5, 5
#: Percent of the positive's score that a negative's has at least and at most.
LOW, HIGH = 80, 100
TILE, CHUNK = 8192, 4096
#: Tiles are not made smaller than this to keep more tasks busy.
LEAST_TILE = 512
SAMPLE, CLUSTERS, ROUNDS = 4096, 64, 8
#: Candidates that a walk scores at a time.
SLICE = 256
LIMIT = 2 ** 26
_NONE = np.iinfo(np.int64).min
_NO_ID = np.iinfo(np.int64).max


def prepared(rows: DataFrame, anchor: Column) -> DataFrame:
    """(vec_id, label, embedding) to rows that take part, with whole components: row, vec_id, label, is_anchor, q."""
    taking = rows.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull()
                         & F.expr("forall(embedding, x -> x is not null and not isnan(x) and abs(cast(x as double)) < double('infinity'))"))
    whole = F.expr(f"transform(embedding, x -> greatest(least(floor(256D * x), {LIMIT}L), -{LIMIT}L))")
    return written(taking.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                                 F.coalesce(anchor, F.lit(False)).alias("is_anchor"), whole.alias("q")), "vectors")


def matrix(vectors, dim: int) -> np.ndarray:
    """Whole vectors as rows, padded with zeros."""
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``."""
    if np.abs(a).max(initial=0) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1) < 2 ** 52:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))


def _directions(x: np.ndarray) -> np.ndarray:
    n = _norms(x)
    return x / np.where(n > 0, n, 1)[:, None]


def fit_centres(sample: np.ndarray, clusters: int = CLUSTERS) -> np.ndarray:
    """Unit centres of the sample's directions, about the root of half its size many."""
    x = _directions(sample)
    k = max(1, min(clusters, math.isqrt(len(x) // 2)))
    centres = x[:k].copy()
    for _ in range(ROUNDS):
        nearest = (x @ centres.T).argmax(axis=1)
        for c in range(k):
            total = x[nearest == c].sum(axis=0)
            if np.linalg.norm(total) > 0:
                centres[c] = total / np.linalg.norm(total)
    return centres


def angles(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Angles to a centre; a vector of zeros is at angle 0."""
    return np.where(_norms(x) > 0, np.arccos(np.clip(_directions(x) @ centre, -1, 1)), 0.0)


@dataclass
class SharedList:
    """Candidates of a cluster in falling order of what any member may score with them, for an anchor of length one."""

    row: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    q: np.ndarray
    bound: np.ndarray
    scored: int = 0

    @classmethod
    def sorted_for(cls, centre: np.ndarray, radius: float, row, vec_id, label, q) -> SharedList:
        slack = 1e-6  # of angles that rounding has made too large
        bound = _norms(q) * np.cos(np.maximum(0.0, angles(q, centre) - radius - slack))
        order = np.argsort(-bound, kind="stable")
        return cls(row[order], vec_id[order], label[order], q[order], bound[order])

    def where(self, keep: np.ndarray) -> SharedList:
        return SharedList(self.row[keep], self.vec_id[keep], self.label[keep], self.q[keep], self.bound[keep])

    def walk(self, q: np.ndarray, row: np.ndarray, label: np.ndarray | None, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best scores between low and high, and their ids, for every member and each of its bands.

        ``low`` and ``high`` have a row for each member and a column for each band; an
        empty band has low above high. Candidates of the member's own label are passed
        over where ``label`` is given, the member itself always. Missing ones score ``_NONE``.
        """
        best = np.full((*low.shape, k), _NONE)
        ids = np.full((*low.shape, k), _NO_ID)
        length = _norms(q)
        going = np.flatnonzero((low <= high).any(axis=1))
        for at in range(0, len(self.bound), SLICE):
            # a band is done when its last place, or its lower end, is above all that is left
            left = length[going] * self.bound[at]
            left = left + 1e-9 * np.abs(left) + 1e-6
            done = (np.maximum(best[going, :, -1], low[going]) > left[:, None]) | (low[going] > high[going])
            going = going[~done.all(axis=1)]
            if not len(going):
                break
            part = slice(at, at + SLICE)
            score = inner(q[going], self.q[part])
            self.scored += score.size
            barred = self.row[part] == row[going, None]
            if label is not None:
                barred |= self.label[part] == label[going, None]
            score[barred] = _NONE
            for band in range(low.shape[1]):
                fits = (score >= low[going, band, None]) & (score <= high[going, band, None]) & (score >= best[going, band, -1:]) & ~barred
                some = np.flatnonzero(fits.any(axis=1))
                if len(some):
                    who = going[some]
                    both = np.concatenate([best[who, band], np.where(fits[some], score[some], _NONE)], axis=1)
                    names = np.concatenate([ids[who, band], np.where(fits[some], self.vec_id[part], _NO_ID)], axis=1)
                    order = np.lexsort((names, -np.maximum(both, _NONE + 1)), axis=-1)[:, :k]
                    best[who, band] = np.take_along_axis(both, order, 1)
                    ids[who, band] = np.take_along_axis(names, order, 1)
        return best, ids


@dataclass(frozen=True)
class Clusters:
    """Centres of the anchors with the largest angle of a member, and the chunk of each (cluster, part)."""

    dim: int
    centres: np.ndarray
    radius: np.ndarray
    parts: np.ndarray
    chunk: dict[tuple[int, int], int]


def _assign(sent, dim):
    def run(batches):
        for batch in batches:
            q = matrix(batch.column("q").to_pylist(), dim)
            nearest = (_directions(q) @ sent.value.T).argmax(axis=1)
            angle = np.array([angles(q[i:i + 1], sent.value[c])[0] for i, c in enumerate(nearest)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest.astype(np.int32)), pa.array(angle, pa.float64())],
                                             names=[*batch.schema.names, "cluster", "angle"])

    return run


def clustered(vectors: DataFrame) -> tuple[DataFrame, Clusters]:
    """Anchors with their cluster, and the clusters. The centres come from at most ``SAMPLE`` anchors, the first by a hash."""
    spark = vectors.sparkSession
    anchors = vectors.filter("is_anchor").drop("is_anchor")
    dim = vectors.agg(F.max(F.size("q"))).first()[0] or 0
    sample = [r.q for r in anchors.orderBy(F.xxhash64("vec_id", "row"), "row").limit(SAMPLE).select("q").collect()]
    centres = fit_centres(matrix(sample, dim)) if sample else np.zeros((1, dim))
    sent = spark.sparkContext.broadcast(centres)  # at most CLUSTERS vectors
    anchors = written(anchors.mapInArrow(_assign(sent, dim), "row long, vec_id long, label long, q array<long>, cluster int, angle double"), "anchors")
    n, radius = np.zeros(len(centres), np.int64), np.zeros(len(centres))
    for r in anchors.groupBy("cluster").agg(F.count("*").alias("n"), F.max("angle").alias("far")).collect():  # a row a cluster
        n[r.cluster], radius[r.cluster] = r.n, r.far
    parts = np.maximum(1, -(-n // CHUNK))
    chunk, filled, last = {}, 0, 0
    for c in np.argsort(-n, kind="stable"):
        for p in range(parts[c]):
            size = n[c] / parts[c]
            if filled + size > CHUNK:
                filled, last = 0, last + 1
            chunk[int(c), p] = last
            filled += size
    return anchors, Clusters(dim, centres, radius, parts, chunk)


def _met(anchors: DataFrame, vectors: DataFrame, clusters: Clusters, unit, schema: str) -> DataFrame:
    """``unit`` on each chunk of anchors with each tile of candidates."""
    spark = vectors.sparkSession
    rows, width = vectors.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    tiles = max(1, math.ceil(rows / TILE), min(width, rows // LEAST_TILE))
    chunks = max(clusters.chunk.values()) + 1
    parts, chunk_of = (F.array(*[F.lit(int(x)) for x in xs]) for xs in (clusters.parts, [clusters.chunk[int(c), 0] for c in range(len(clusters.parts))]))
    # the parts of a cluster lie in consecutive chunks
    part = F.pmod(F.xxhash64("row"), parts[F.col("cluster")])
    dealt = anchors.withColumn("chunk", (chunk_of[F.col("cluster")] + part).cast("int")).withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    given = vectors.drop("is_anchor").withColumn("tile", F.pmod(F.xxhash64("row"), F.lit(tiles)).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    sent = spark.sparkContext.broadcast(clusters)  # at most CLUSTERS centres and a number for each chunk

    def run(members: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        return unit(sent.value, members, candidates)

    return dealt.groupBy("tile", "chunk").cogroup(given.groupBy("tile", "chunk")).applyInPandas(run, schema)


def _lists(clusters: Clusters, members: pd.DataFrame, candidates: pd.DataFrame):
    """The members of each cluster with the list that they share."""
    if len(candidates):
        q = matrix(candidates["q"], clusters.dim)
        ids = candidates["vec_id"].astype("Int64").fillna(_NO_ID).to_numpy(np.int64)
        row, label = candidates["row"].to_numpy(), candidates["label"].to_numpy()
        for c, of in members.groupby("cluster"):
            yield of, matrix(of["q"], clusters.dim), SharedList.sorted_for(clusters.centres[c], clusters.radius[c], row, ids, label, q)


def _frame(columns: dict[str, list[np.ndarray]], ids: str) -> pd.DataFrame:
    out = pd.DataFrame({n: np.concatenate(v) if v else np.array([], np.int64) for n, v in columns.items()})
    out[ids] = out[ids].astype("Int64").mask(out[ids] == _NO_ID)
    return out


def _positive_unit(k: int):
    def unit(clusters: Clusters, members: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"anchor_row": [], "positive_id": [], "positive_score": []}
        for of, q, shared in _lists(clusters, members, candidates):
            labels = of["label"].to_numpy()
            for label in np.unique(labels):
                mine = labels == label
                row = of["row"].to_numpy()[mine]
                best, ids = shared.where(shared.label == label).walk(
                    q[mine], row, None, np.full((len(row), 1), _NONE + 1), np.full((len(row), 1), _NO_ID), k)
                who, _, at = np.nonzero(best > _NONE)
                out["anchor_row"].append(row[who])
                out["positive_id"].append(ids[who, 0, at])
                out["positive_score"].append(best[who, 0, at])
        return _frame(out, "positive_id")

    return unit


def _negative_unit(k: int, low: int, high: int, n_bands: int):
    def unit(clusters: Clusters, members: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"anchor_row": [], "band": [], "negative_id": [], "negative_score": []}
        for of, q, shared in _lists(clusters, members, candidates):
            # low * p <= 100 * s <= high * p in whole numbers
            from_, until = np.ones((len(of), n_bands), np.int64), np.zeros((len(of), n_bands), np.int64)
            for i, ps in enumerate(of["scores"]):
                for j, p in enumerate(ps):
                    from_[i, j], until[i, j] = -(-low * int(p) // 100), high * int(p) // 100
            row = of["row"].to_numpy()
            best, ids = shared.walk(q, row, of["label"].to_numpy(), from_, until, k)
            who, band, at = np.nonzero(best > _NONE)
            out["anchor_row"].append(row[who])
            out["band"].append(band)
            out["negative_id"].append(ids[who, band, at])
            out["negative_score"].append(best[who, band, at])
        return _frame(out, "negative_id")

    return unit


def mine(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """Hard negatives of each anchor and positive of (vec_id, label, embedding): anchor_id, positive_id, rank, negative_id and both scores."""
    vectors = prepared(rows, anchor)
    anchors, clusters = clustered(vectors)
    found = _met(anchors, vectors, clusters, _positive_unit(positives), "anchor_row long, positive_id long, positive_score long")
    order = [F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last()]
    found = written(first_per_key(found, ["anchor_row"], order, positives), "positives")  # a few for each anchor
    place = F.struct((-F.col("positive_score")).alias("s"), F.col("positive_id").isNull().alias("none"), "positive_id", "positive_score")
    ranked = found.groupBy("anchor_row").agg(F.sort_array(F.collect_list(place)).alias("ps"))
    banded = written(anchors.join(ranked, anchors["row"] == ranked["anchor_row"]).drop("anchor_row", "angle").withColumn("scores", F.col("ps.positive_score")), "banded")
    met = _met(banded.drop("ps"), vectors, clusters, _negative_unit(negatives, low, high, positives), "anchor_row long, band int, negative_id long, negative_score long")
    order = [F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last()]
    best = first_per_key(met, ["anchor_row", "band"], order, negatives)
    best = best.withColumn("rank", F.row_number().over(W.partitionBy("anchor_row", "band").orderBy(*order)))
    pairs = banded.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"), F.posexplode("ps").alias("band", "p"))
    return best.join(pairs, ["anchor_row", "band"]).select(
        "anchor_id", F.col("p.positive_id").alias("positive_id"), "rank", "negative_id", F.col("p.positive_score").alias("positive_score"), "negative_score")


_SQL = f"""with valid as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, cast(list_inner_product(a.q, b.q) as bigint) as score
  from valid a join valid b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
pairs as (
  select anchor_id, other_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= {POSITIVES})
select p.anchor_id, p.positive_id, cast(row_number() over w as integer) as rank, s.other_id as negative_id, p.positive_score, s.score as negative_score
from pairs p join scored s on s.anchor_id = p.anchor_id and not s.same
  and {LOW} * p.positive_score <= 100 * s.score and 100 * s.score <= {HIGH} * p.positive_score
window w as (partition by p.anchor_id, p.positive_id order by s.score desc, s.other_id)
qualify row_number() over w <= {NEGATIVES}"""


@query("op13_hard_negatives", _SQL)
def op13(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end").alias("label"), "embedding")
    return mine(rows, F.col("vec_id") % 100 == 0)
