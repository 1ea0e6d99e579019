import itertools
import math

import numpy as np
import pytest

from helpers import corpus, crc, docs
from lexanchor.llm import line_quality as L
from lexanchor.llm.common import crc_mod

RNG = np.random.default_rng(5)


def weight(own, states, t):
    return math.exp(sum(u * s for u, s in zip(own, states)) + sum(t[a, b] for a, b in zip(states, states[1:])))


@pytest.mark.parametrize("n", [1, 2, 7])
def test_marginals_equal_the_sum_over_all_labellings(n):
    own, t = RNG.normal(size=n) * 2, RNG.normal(size=(2, 2))
    total, good = 0.0, np.zeros(n)
    for states in itertools.product((0, 1), repeat=n):
        total += (w := weight(own, states, t))
        good += w * np.array(states)
    assert L._logistic(L.chain_log_odds(own.tolist(), t)) == pytest.approx(good / total)


def test_gradient_equals_differences_of_the_likelihood():
    n_lines = np.array([4, 3, 1])
    own, t, y = RNG.normal(size=8), RNG.normal(size=(2, 2)), np.array([1, 0, 0, 1, 1, 1, 0, 0.0])

    def likelihood(own, t):
        out, at = 0.0, 0
        for n in n_lines:
            part = own[at:at + n]
            out += math.log(weight(part, y[at:at + n].astype(int), t) / sum(weight(part, s, t) for s in itertools.product((0, 1), repeat=int(n))))
            at += n
        return out

    p, pairs = L._chain_gradient(own, y, n_lines, t)
    for i in range(8):
        step = np.eye(8)[i] * 1e-5
        assert y[i] - p[i] == pytest.approx((likelihood(own + step, t) - likelihood(own - step, t)) / 2e-5, abs=1e-6)
    for a, b in itertools.product((0, 1), repeat=2):
        step = np.zeros((2, 2))
        step[a, b] = 1e-5
        assert pairs[a, b] == pytest.approx((likelihood(own, t + step) - likelihood(own, t - step)) / 2e-5, abs=1e-6)


def by_loops(model, text):
    """Score of a document, line by line."""
    found = list(L.lines(text))
    sums = []
    for k, (_, words) in enumerate(found):
        x = L.measured(L.Words(), [found[:k + 1]])
        total = np.zeros(3)
        for m in x.measures[-1]:
            total += model.weights[m]
        for w in words:
            for kind, s in (("w", w.lower()), ("s", L.shape(w.translate(L._KINDS)))):
                total += model.weights[L._hashed(kind, s)] / len(words)
        sums.append(total)
    own = [s[0] + (sums[k - 1][1] if k else model.edge[0]) + (sums[k + 1][2] if k + 1 < len(sums) else model.edge[1]) for k, s in enumerate(sums)]
    p = L._logistic(L.chain_log_odds(own, model.transition))
    length = np.array([n for n, _ in found])
    slope, shift = model.calibration
    return L._logistic(slope * L._logit((p * length).sum() / length.sum()) + shift)


def labelled(n=160):
    """Good documents of sentences, bad ones in which junk lines follow a good line."""
    rows = []
    for i in range(n):
        good = [f"The {w} of this place stands by the water." for w in ("house", "road", f"tree{i}")]
        junk = [f"BUY!! ### NOW{i % 7} $$$ | {k} | click" for k in range(6)]
        rows.append((i, "\n".join(good + [""] + (good[:1] + junk if i % 3 == 0 else good[1:])), "en", "a"))
    return rows


def test_learns_lines_from_documents(spark):
    rows = labelled()
    df = docs(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(160)] + [(0, 1, 0), (None, 1, 1), (7, None, 0), (9999, 0, 0)], "doc_id long, quality int, toxic int")
    model = L.learn(df, labels, crc_mod(5) != 0)
    odd = [(1000, None, None, None), (1001, "", "en", "a"), (1002, " \t\n\n ", "en", "a"), (1003, "x" * 50000 + "\n" + "word " * 3000, "en", "b"), (None, "A line.", None, None), rows[1], rows[1]]
    scored = L.with_scores(docs(spark, rows + odd).select("doc_id", (crc_mod(5) == 0).alias("held_out"), "text"), model).collect()
    assert len(scored) == len(rows) + len(odd)
    texts = {r[0]: r[1] for r in rows + odd}
    for r in scored:
        assert r.held_out == (crc(r.doc_id) % 5 == 0) and 0 <= r.score <= 1
        assert r.score == pytest.approx(by_loops(model, texts[r.doc_id]), abs=1e-9)
        if r.doc_id is not None and r.doc_id < 160:
            assert (r.score >= 0.3) == (r.doc_id % 3 > 0)
    lines = L.line_marginals(model, rows[3][1])
    assert [p >= 0.5 for _, p in lines[:2]] == [True, True] and [p >= 0.5 for _, p in lines[-4:]] == [False] * 4  # a bad document's good lines


def test_no_model_without_both_kinds(spark):
    df = docs(spark, corpus(20))
    for labels in ([], [(1, 1, 0), (2, 1, 0)]):
        assert L.learn(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), L.F.lit(True)) is None
    assert {r.score for r in L.with_scores(df.select("doc_id", L.F.lit(True).alias("held_out"), "text"), None).collect()} == {0.5}
    assert L.with_scores(docs(spark, []).select("doc_id", L.F.lit(True).alias("held_out"), "text"), None).count() == 0


def test_held_out_documents(spark):
    rows = L.op12(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.9 * len(rows)


def test_windows_bound_what_is_learned_from():
    text = [(10, ["w"] * 30)] * 100
    assert sum(len(w) for _, w in L.window(text, 200)) <= 200 and L.window(text, 10) == text[:1] and L.window(text[:2], 200) == text[:2]
