"""Pruned nearest plates against all pairs."""

import re

import numpy as np
import pytest

from lexanchor.operators import nearest as N, vectors as V


def frame(spark, x, start=0, none=()):
    return spark.createDataFrame([(start + i, None if i in none else [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")


def rows(df):
    return sorted((r.vec_id, r.plate, round(r.score, 6), r.rank) for r in df.collect())


def gathered(n, groups, dim=16, spread=0.05, seed=1):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(groups, dim))
    return centres[r.integers(groups, size=n)] + spread * r.normal(size=(n, dim))


def test_gathered_vectors_visit_few_tiles(spark):
    x = gathered(1500, 12)
    decisions, plates = frame(spark, x[:900], none={5}), frame(spark, x[900:], 5000)
    got = N.nearest(decisions, plates, 5, tile_rows=40, centres=12, block_rows=100)
    assert rows(got.rows) == rows(V.nearest_plates(decisions, plates, 5))
    assert got.visits < 0.25 * got.possible


@pytest.mark.parametrize("tile_rows", [7, 1000])
def test_scattered_vectors_are_exact_too(spark, tile_rows):
    r = np.random.default_rng(2)
    x = np.r_[r.normal(size=(150, 8)), np.zeros((3, 8)), np.ones((30, 8))]  # ties and vectors of zeros
    decisions, plates = frame(spark, x[::2]), frame(spark, np.r_[x[1::2], x[:3]], 1000)
    got = N.nearest(decisions, plates, 4, tile_rows=tile_rows)
    assert rows(got.rows) == rows(V.nearest_plates(decisions, plates, 4))


def test_few_or_no_plates(spark):
    decisions = frame(spark, np.eye(4))
    assert rows(N.nearest(decisions, frame(spark, np.eye(4)[:2], 10), 5).rows) == rows(V.nearest_plates(decisions, frame(spark, np.eye(4)[:2], 10), 5))
    assert N.nearest(decisions, frame(spark, np.zeros((0, 4))), 5).rows.count() == 0


def test_small_tiles_do_not_copy_decisions(spark):
    x = np.random.default_rng(3).normal(size=(200, 8))
    got = V.nearest_plates(frame(spark, x[:100]), frame(spark, x[100:], 1000), 5, tile_bytes=8 * 8 * 2)
    copies = [int(n) for n in re.findall(r"explode\(sequence\(0, (\d+)", got._jdf.queryExecution().analyzed().toString())]
    assert copies == [0, 0]  # one stripe, one block
    assert rows(got) == rows(V.nearest_plates(frame(spark, x[:100]), frame(spark, x[100:], 1000), 5))


def test_vectors_without_a_direction_take_no_place(spark):
    x = np.random.default_rng(4).normal(size=(60, 8))
    with_nan = np.r_[x[20:], [[np.nan] * 8, [1.0] * 7 + [np.inf]]]
    got, want = (rows(V.nearest_plates(frame(spark, x[:20]), frame(spark, p, 1000), 5)) for p in (with_nan, x[20:]))
    assert got == want and len(got) == 100


def test_several_stripes_are_exact_and_tiles_travel_as_bits(spark, monkeypatch):
    x = np.random.default_rng(5).normal(size=(400, 8))
    decisions, plates = frame(spark, x[:150]), frame(spark, x[150:], 1000)
    want = rows(V.nearest_plates(decisions, plates, 5))
    monkeypatch.setattr(V, "TILE_BYTES", 8 * 8 * 60)
    monkeypatch.setattr(N, "TILE_BYTES", 8 * 8 * 60)
    sent = []
    monkeypatch.setattr(N, "_scored", lambda visits, *a, f=N._scored: (sent.append(visits.count()), f(visits, *a))[1])
    got = N.nearest(decisions, plates, 5, tile_rows=4, block_rows=40)
    assert rows(got.rows) == rows(V.nearest_plates(decisions, plates, 5, tile_bytes=8 * 8 * 3, block_rows=40)) == want
    assert sent[0] == 150 and sent[1] < got.visits / 3  # a row for each decision and stripe
