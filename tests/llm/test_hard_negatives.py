import math

import numpy as np
import pytest

from lexanchor.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, row int, scores string"


def table(n, dim=6, seed=3, groups=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(groups, dim)) if groups else None
    out = []
    for i in range(n):
        v = r.normal(size=dim) if not groups else centres[i % groups] + 0.02 * r.normal(size=dim)
        out.append((i, int(r.integers(3)), [float(np.float32(x)) for x in v], 1, "x"))
    return out


ODD = [(None, 1, [1.0, 1.0, 0.0], 0, ""), (700, None, [1.0], 0, ""), (701, 1, None, 0, ""), (702, 1, [None, 1.0], 0, ""), (703, 2, [math.nan], 0, ""),
       (704, 2, [math.inf, 1.0], 0, ""), (800, 1, [], 0, ""), (900, 1, [0.0] * 6, 0, ""), (901, 0, [2.0, 2.0], 0, ""), (None, None, None, 0, "")]


def by_loops(rows):
    rows = [(i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * x) for x in v]) for i, label, v, *_ in rows
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    first = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for k, (i, label, v) in enumerate(rows):
        if i is None or i % 100:
            continue
        others = [(score(v, w), j, m) for n, (j, m, w) in enumerate(rows) if n != k]
        for p, j, _ in sorted([o for o in others if o[2] == label], key=first)[:5]:
            fits = sorted([o for o in others if o[2] != label and 80 * p <= 100 * o[0] <= 100 * p], key=first)[:5]
            for rank, (s, m, _) in enumerate(fits, 1):
                yield i, j, rank, m, p, s


def op(spark, monkeypatch, rows):
    monkeypatch.setattr(H, "table", lambda *_: spark.createDataFrame(rows, SCHEMA))
    return sorted(map(str, map(tuple, H.op13(spark, "").collect())))


def test_equals_loops(spark, monkeypatch):
    rows = table(600) + ODD
    rows += [rows[100], rows[100], rows[200], rows[7]] + [(2000 + i, 1 + i % 2, rows[300][2], 0, "") for i in range(40)]  # ties and repeated rows
    assert op(spark, monkeypatch, rows) == sorted(map(str, by_loops(rows)))


def test_small_tiles_and_chunks(spark, monkeypatch):
    rows = table(900, groups=4)
    for name, value in (("TILE", 100), ("CHUNK", 2), ("SLICE", 16), ("CLUSTERS", 3)):
        monkeypatch.setattr(H, name, value)
    assert op(spark, monkeypatch, rows) == sorted(map(str, by_loops(rows)))


@pytest.mark.parametrize("rows", [[], ODD, [(1, 1, [1.0], 0, "")], [(100, 1, [3.0], 0, "")]])
def test_nothing_to_mine(spark, monkeypatch, rows):
    assert op(spark, monkeypatch, rows) == sorted(map(str, by_loops(rows)))


def test_large_components_are_exact(spark, monkeypatch):
    rows = [(i * 50, i % 2, [2.0 ** 18 - 99 + i, -(2.0 ** 17) + 3 * i, 1.0 * i], 0, "") for i in range(12)]
    assert op(spark, monkeypatch, rows) == sorted(map(str, by_loops(rows)))


def test_walks_end_early_where_directions_gather():
    r = np.random.default_rng(1)
    centres = r.normal(size=(20, 32))
    q = np.floor(256 * (centres[np.arange(20000) % 20] + 0.05 * r.normal(size=(20000, 32)))).astype(np.int64)
    members = np.arange(0, 20000, 100)[:20]
    members = members[members % 20 == members[0] % 20]
    centre = H.fit_centres(q[members], 1)[0]
    radius = H.angles(q[members], centre).max()
    ids = np.arange(20000)
    shared = H.SharedList.sorted_for(centre, radius, ids, ids, ids % 3, q)
    best, found = shared.walk(q[members], members, None, np.full((len(members), 1), H._NONE + 1), np.full((len(members), 1), H._NO_ID), 5)
    full = q[members] @ q.T
    full[np.arange(len(members)), members] = H._NONE
    assert (best[:, 0] == np.sort(full, axis=1)[:, ::-1][:, :5]).all()
    assert shared.scored < 0.3 * full.size
