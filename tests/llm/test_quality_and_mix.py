import re
from collections import Counter, defaultdict

import pytest

from helpers import corpus, docs
from lexanchor.llm import mixing as M, quality as Q
from lexanchor.llm.common import written

WORD = re.compile("[^\x20\x09-\x0d]+")


def measures(text):
    w = WORD.findall(text or "")
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def expectation_maximisation(patterns):
    """The same model with plain loops: {votes: n} to {votes: posterior}."""
    m, total = len(Q.RULES), sum(patterns.values())
    prior, theta = Q.START_GOOD, {(j, y, v): Q.START[y][v] for j in range(m) for y in (0, 1) for v in (0, 1, 2)}
    pad = total * Q.PRIOR_SHARE

    def good(v):
        like = [1 - prior, prior]
        for y in (0, 1):
            for j in range(m):
                like[y] *= theta[j, y, v[j]]
        return like[1] / sum(like)

    for _ in range(Q.ITERATIONS):
        g = {v: good(v) for v in patterns}
        mass = [sum(n * (1 - g[v]) for v, n in patterns.items()), sum(n * g[v] for v, n in patterns.items())]
        new = {}
        for (j, y, x) in theta:
            s = sum(n * (g[v] if y else 1 - g[v]) for v, n in patterns.items() if v[j] == x)
            new[j, y, x] = (s + pad * Q.START[y][x]) / (mass[y] + pad)
        prior, theta = (mass[1] + Q.START_GOOD * pad) / (sum(mass) + pad), new
    return {v: good(v) for v in patterns}


def test_measures_and_verdicts(spark):
    table = corpus(120) + [(900, "line one here\nline one here\n\nother\nline one here", "en", "a"), (901, "w " * 80, "en", "a"),
                           (902, " ".join(f"w{i}!" for i in range(90)), "en", "a"), (903, "x" * 200000, "en", "b")]
    got = Q.judged(docs(spark, table, clashing=False), "doc_id").collect()
    assert sorted(map(str, [(d, *measures(t)) for d, t, *_ in table])) == sorted(
        str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got)
    split = lambda p: tuple(p // 3 ** j % 3 for j in range(len(Q.RULES)))
    want = expectation_maximisation(Counter(split(r.pattern) for r in got))
    for r in got:
        assert r.p_good == pytest.approx(want[split(r.pattern)])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.p_good >= 0.5)
    assert Q.judged(docs(spark, []), "doc_id").count() == 0


def test_stage_drops_what_is_judged_bad(spark):
    table = corpus(80)
    df = docs(spark, table)
    out = Q.drop_bad_documents(df)
    kept = [r.doc_id for r in Q.judged(df.select("doc_id", "text"), "doc_id").collect() if r.kept]
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == sorted(kept)


def targets_by_loop(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return {s: 3.0 * sizes[s] if s in capped else share[s] for s in order}
        capped |= above


@pytest.mark.parametrize("block", [1, 7, 256])
def test_targets_and_takes(spark, block):
    table = corpus(90)
    sized = written(docs(spark, table).select("doc_id", "source", "text").transform(M.with_words).drop("text"), "test")
    placed, taken = M.mix(sized, block=block, shard_slots=16)
    rows = {r.row: r for r in placed.collect()}
    assert len(rows) == len(table)
    sizes = defaultdict(int)
    for r in rows.values():
        sizes[r.source] += r.size
    want = targets_by_loop(sizes)
    words, slots, repeats = defaultdict(int), defaultdict(int), Counter()
    for t in taken.collect():
        r = rows[t.row]
        assert 0 <= t["from"] < t.until <= r.size
        words[r.source] += t.until - t["from"]
        slots[t.shard, t.slot] += t.until - t["from"]
        for w in range(t["from"], t.until):
            repeats[t.row, w] += 1
    for r in rows.values():
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
    for source, target in want.items():
        assert abs(words[source] - target) <= 0.5 + 1e-9
    assert max(repeats.values()) <= 3 and max(slots.values()) <= block
    again = M.mix(sized, block=block, shard_slots=16)[1]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, taken.collect()))


def test_shards_draw_multinomial_counts(spark):
    """Mean and variance of the draws over many shards, and sources that meet their slots after the correction."""
    slots = [500, 12_000, 30_000, 57_500]
    bases = [sum(slots[:i]) for i in range(4)]
    counts = spark.createDataFrame([(i + 1, b, n) for i, (b, n) in enumerate(zip(bases, slots))], "rank long, slot_base long, slots long")
    shards = 100_000 // 100
    drawn = {(r.shard, r["rank"]): r.n for r in M.draw_counts(counts, 100, 100_000).collect()}
    assert sum(drawn.values()) == 100_000
    for rank, n in enumerate(slots, 1):
        p = n / 100_000
        got = [drawn.get((s, rank), 0) for s in range(shards)]
        mean = sum(got) / shards
        assert abs(mean - 100 * p) < 4 * (100 * p * (1 - p) / shards) ** 0.5
        variance = sum((x - mean) ** 2 for x in got) / (shards - 1)
        assert 0.8 < variance / (100 * p * (1 - p)) < 1.25


@pytest.mark.parametrize("shard_slots", [1, 16, 1000])
def test_every_slot_is_dealt_once(spark, shard_slots):
    sized = written(docs(spark, corpus(90)).select("doc_id", "source", "text").transform(M.with_words).drop("text"), "test")
    targets = M.source_targets(sized.groupBy("source").agg(M.F.sum("size").alias("source_size")))
    rows = M.draw_slots(targets, 7, shard_slots).collect()
    counts = {r["rank"]: r for r in M._slot_counts(targets, 7).collect()}
    assert Counter(r["rank"] for r in rows) == {k: c.slots for k, c in counts.items() if c.slots}
    for k, c in counts.items():  # a block is taken once in each pass
        mine = Counter((r["pass"], r.block) for r in rows if r["rank"] == k)
        assert set(mine.values()) <= {1} and all(b < c.blocks for _, b in mine)
    places = Counter((r.shard, r.slot) for r in rows)
    assert set(places.values()) == {1} and all(slot < shard_slots for _, slot in places)
    sizes = Counter(r.shard for r in rows)
    assert all(sizes[s] == shard_slots for s in range(len(rows) // shard_slots))


def test_shuffles_are_permutations(spark):
    for n in (1, 2, 3, 10, 997):
        df = spark.range(n).withColumns({"n": M.F.lit(n).cast("long"), "k": M.F.lit(5).cast("long")})
        out = M._shuffled(M._shuffled(df, "y", "id", "n", "k"), "z", "y", "n", "k", back=True).collect()
        assert sorted(r.y for r in out) == list(range(n)) and all(r.z == r.id for r in out)


def test_mixed_documents_take_whole_words(spark):
    table = [t for t in corpus(60) if t[0] != 3]
    df = docs(spark, table)
    out = M.mixed_documents(df)
    assert out.columns == df.columns
    texts = defaultdict(list)  # ids repeat, null ones too
    for t in table:
        texts[t[0]].append(Counter(WORD.findall(t[1] or "")))
    per = Counter()
    for r in out.collect():
        got = Counter(WORD.findall(r.text))
        assert r.n_chars == len(r.text) and any(got <= whole for whole in texts[r.doc_id])
        per[r.doc_id] += got.total()
    assert all(n <= 3 * sum(whole.total() for whole in texts[d]) for d, n in per.items())
    assert M.mixed_documents(docs(spark, [])).count() == 0
