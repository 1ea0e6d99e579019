import hashlib
from collections import defaultdict

import pytest

from helpers import corpus, crc, docs
from lexanchor.llm import merkle as M
from lexanchor.llm.common import LOWER, UPPER

LOWERED = str.maketrans(UPPER, LOWER)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def path(tree, pos):
    """(left, right) siblings on every level below the root."""
    for nodes in tree[:-1]:
        first = pos - pos % 8
        yield "".join(nodes[first:pos]), "".join(nodes[pos + 1:first + 8])
        pos //= 8


def by_loops(rows):
    trees = defaultdict(list)
    for i, text, lang, source in rows:
        row = (i, source, lang, None if text is None else len(text), text)
        claimed = (*row[:4], text.translate(LOWERED)) if text is not None and crc(i) % 3 == 0 else row
        trees[lang].append((i is not None, i or 0, leaf(row), leaf(claimed)))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {x: levels([r[2] for r in sorted(trees[x])]) for x in langs}
    top = levels([built[x][-1][0] for x in langs])
    for k, lang in enumerate(langs):
        for pos, (known, i, own, claimed) in enumerate(sorted(trees[lang])):
            steps = [*path(built[lang], pos), *path(top, k)]
            acc = claimed
            for left, right in steps:
                acc = digest(left + acc + right)
            yield (i if known else None, own, built[lang][-1][0], top[-1][0], digest("".join(a + b for a, b in steps)), acc, acc == top[-1][0])


def op(spark, monkeypatch, df):
    monkeypatch.setattr(M, "table", lambda *_: df)
    return sorted(map(str, map(tuple, M.op11(spark, "").collect())))


@pytest.mark.parametrize("n", [1, 2, 60])
def test_rows_follow_the_trees(spark, monkeypatch, n):
    table = corpus(n) if n > 5 else [(i, "Some Text", "en", None) for i in range(n)]
    table += [(i, f"Zeile {i}", "de", "a") for i in range(1000, 1000 + 700 * (n > 5))]  # more than one kept tier
    assert op(spark, monkeypatch, docs(spark, table)) == sorted(map(str, by_loops(table)))


def test_many_trees_and_an_empty_table(spark, monkeypatch):
    table = [(i, f"T{i}", f"x{i % 70}", None) for i in range(150)]
    assert op(spark, monkeypatch, docs(spark, table)) == sorted(map(str, by_loops(table)))
    assert op(spark, monkeypatch, docs(spark, [])) == []


def test_only_every_third_level_is_kept(spark):
    m = M.manifest(docs(spark, [(i, "t", "en", None) for i in range(5000)]))
    assert [t.selectExpr("sum(size(nodes))").first()[0] for t in m.rows.tiers] == [5000, 10]
    assert max(t.selectExpr("max(size(nodes))").first()[0] for t in m.rows.tiers) <= M.FAN ** M.TIER
    assert m.trees.roots.count() == 1


def test_a_changed_row_does_not_fold_to_the_root(spark):
    proofs = M.all_proofs(M.manifest(docs(spark, [(i, f"t{i}", "en", None) for i in range(100)])))
    good = proofs.select((M.folded(M.F.col("node.digest"), M.F.col("proof")) == M.F.col("root")).alias("v"))
    bad = proofs.select((M.folded(M.F.sha2("node.digest", 256), M.F.col("proof")) == M.F.col("root")).alias("v"))
    assert good.filter("v").count() == 100 and bad.filter("v").count() == 0
