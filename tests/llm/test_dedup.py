import hashlib
from collections import defaultdict

import numpy as np

from helpers import corpus, docs, words
from lexanchor.llm import exact_dedup as E, near_dedup as N


def lower(text):
    return (text or "").encode().lower()


def test_quotient_filters_merge_without_loss():
    r = np.random.default_rng(2)
    for width in (61, 20, 8):
        parts = [r.integers(0, 2**width, n, dtype=np.uint64) for n in (0, 1, 700, 3000)]
        parts.append(parts[2][:300])
        filters = [E.QuotientFilter.from_bytes(E.QuotientFilter(p, np.ones(len(p)), width).to_bytes()) for p in parts]
        merged = E.QuotientFilter.from_bytes(E.QuotientFilter.merged(filters).to_bytes())
        prints, counts = np.unique(np.concatenate(parts), return_counts=True)
        assert (merged.prints == prints).all() and (merged.counts == counts).all()


def test_exact_duplicates_against_a_dictionary(spark):
    table = corpus()
    groups = defaultdict(list)
    for d, t, *_ in table:
        groups[lower(t)].append(d)
    got = E.exact_duplicates(docs(spark, table)).collect()
    assert len(got) == len(table)
    kept = defaultdict(int)
    for r in got:
        group = next(g for text, g in groups.items() if hashlib.sha256(text).hexdigest() == r.text_sha256)
        known = [d for d in group if d is not None]
        assert r.group_size == len(group) and r.keep_id == (max(known) if known else None)
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert E.exact_duplicates(docs(spark, [])).count() == 0


def test_dropping_exact_duplicates_keeps_columns_and_one_row(spark):
    table = corpus()
    df = docs(spark, table)
    out = E.drop_exact_duplicates(df)
    assert out.columns == df.columns
    texts = [lower(r.text) for r in out.collect()]
    assert len(texts) == len(set(texts)) == len({lower(t) for _, t, *_ in table})


def shingles(text):
    w = lower(text).split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def components_of(table):
    sets = [shingles(t) for _, t, *_ in table]
    top = list(range(len(table)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(table)):
        members[find(i)].append(i)
    least = {}
    for rows in members.values():
        ids = [table[i][0] for i in rows if table[i][0] is not None]
        for i in rows:
            least[i] = min(ids) if ids else None
    return sets, least


def check_components(spark, table):
    sets, least = components_of(table)
    want = sorted(str((d, len(sets[i]), least[i], d == least[i])) for i, (d, *_) in enumerate(table))
    got = N.near_duplicates(docs(spark, table)).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id, r.kept)) for r in got) == want


def test_near_duplicates_against_all_pairs(spark):
    check_components(spark, corpus())
    assert N.near_duplicates(docs(spark, [])).count() == 0


def test_a_group_of_near_copies_that_are_not_all_near_each_other(spark):
    base = words(120, 5).split()
    table = []
    for i in range(150):  # a chain: neighbours share most, ends share nothing
        text = words(i, 6).split()[:i] if False else [*base[i % 60:], *(f"w{i // 3}x{k}" for k in range(i % 60))]
        table.append((i, " ".join(text), "en", "a"))
    for i in range(60):
        edited = list(base)
        edited[(i * 7) % 120] = f"e{i}"
        edited[(i * 13) % 120] = f"f{i}"
        table.append((1000 + i, " ".join(edited), "en", "b"))
    check_components(spark, table)


def test_estimate_does_not_drop_links():
    r = np.random.default_rng(4)
    worst = 0
    for n in (4, 40, 400, 4000):
        for _ in range(60):
            pool = np.unique(r.integers(0, 2**63, 2 * n, dtype=np.uint64))
            shared = int(np.ceil(0.75 * n))
            a = np.sort(pool[:n])
            b = np.sort(np.r_[pool[:shared], pool[n:n + max(0, int(shared / 0.75) - n)]])
            assert 100 * shared >= 75 * len(np.union1d(a, b))
            ok = N.may_link(N.sketch(a)[None], N.sketch(b)[None], np.array([len(a)]), np.array([len(b)]))[0]
            worst += not ok
            common = set(N.band_keys(N.sketch(a))) & set(N.band_keys(N.sketch(b)))
            worst += not common
    assert worst == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (103, 101)], "a long, b long")
    got = {r.node: r.label for r in N.components(links).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in (100, 101, 103)} == {100}


def test_dropping_near_duplicates_keeps_one_of_each(spark):
    table = [t for t in corpus() if t[0] is not None and t[0] != 3]
    df = docs(spark, table)
    out = N.drop_near_duplicates(df)
    _, least = components_of(table)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted({least[i] for i in range(len(table))})


def test_groups_of_null_and_repeated_ids_keep_one(spark):
    near = lambda seed, k: words(200, seed, 500) + f" end{k}"
    table = [(None, near(1, k), None, None) for k in range(4)]
    table += [(5, near(2, k), None, None) for k in range(3)] + [(9, near(2, 7), None, None)]
    table += [(None, near(3, 0), None, None), (7, near(3, 1), None, None)]
    table += [(11, near(4, 0), None, None)] * 2 + [(12, None, None, None)] * 2
    out = N.drop_near_duplicates(docs(spark, table)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == [(False, 5), (False, 7), (False, 11), (False, 12), (False, 12), (True, 0)]


def test_columns_with_dots_in_their_names_stay(spark):
    df = docs(spark, corpus(12)).withColumn("a.b", E.F.lit(1))
    assert E.drop_exact_duplicates(df).columns == df.columns and N.drop_near_duplicates(df).columns == df.columns
