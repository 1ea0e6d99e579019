"""Totals up a tree: leaves first, chains by their walk."""

import random

import pytest

from lexanchor.operators import graph as G


def brute(links, own):
    parent = dict(links)
    total, seen = {}, {n for l in links for n in l} | set(own)
    for n in seen:
        at = n
        while at is not None:
            total[at] = total.get(at, 0) + own.get(n, 0)
            at = parent.get(at)
    below = set()
    for n in own:
        while n is not None and n not in below:
            below.add(n)
            n = parent.get(n)
    return sorted((n, own.get(n, 0), total[n]) for n in below)


def test_rollup_by_levels(spark, monkeypatch):
    rng = random.Random(5)
    bushy = [(f"b{i}", f"b{i // 5}") for i in range(1, 200)] + [(f"b{rng.randrange(200)}x{i}", f"b{rng.randrange(200)}") for i in range(50)]
    chain = [(f"c{i}", f"c{i + 1}") for i in range(60)]
    walks = []
    whole = G.interval_labels
    monkeypatch.setattr(G, "interval_labels", lambda links: walks.append(links.count()) or whole(links))
    for links, walked in ((bushy, False), (chain, True), (bushy + chain, True)):
        nodes = sorted({n for l in links for n in l})
        own = {n: rng.randint(0, 9) for n in rng.sample(nodes, len(nodes) // 3)} | {"alone": 4}
        walks.clear()
        got = G.rollup_by_levels(spark.createDataFrame(list(own.items()), "node string, n long"), spark.createDataFrame(links, "node string, parent string"))
        assert sorted(map(tuple, got.select("node", "own", "total").collect())) == brute(links, own)
        assert bool(walks) == walked and all(n < 70 for n in walks)  # a bushy tree is gone before a walk


def test_rollup_by_levels_reports_cycles_and_two_parents(spark):
    n = spark.createDataFrame([("a", 1)], "node string, n long")
    for links in ([("a", "b"), ("b", "a")], [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a")], [("a", "b"), ("a", "c")]):
        with pytest.raises(ValueError):
            G.rollup_by_levels(n, spark.createDataFrame(links, "node string, parent string")).collect()
