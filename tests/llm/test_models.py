import math
from collections import Counter

import numpy as np
import pytest

from helpers import corpus, crc, docs, words
from lexanchor.llm import language as L, language_model as G, toxicity as T, url_filter as U
from lexanchor.llm.common import crc_mod, first_by_hash

DIR = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ toxicity
def test_noisy_or_finds_the_sentence(spark):
    r = np.random.default_rng(1)
    bags = []
    for i in range(300):
        sentences = [set(words(6, 1000 * i + k, 60).split()) for k in range(5)]
        if i % 4 == 0:
            sentences[r.integers(5)] |= {"vileness"}
        bags.append((int(i % 4 == 0), sentences))
    model = T.fit(bags)
    text = words(6, 1, 60) + ". " + words(5, 2, 60) + " vileness. " + words(6, 3, 60)
    spans, p = model.sentence_scores(text)
    assert p.argmax() == 1 and p[1] > 0.3 and text[slice(*spans[1])].endswith("vileness")
    assert T.noisy_or(np.array([0.5, 0.5])) == pytest.approx(0.75) and T.noisy_or(np.array([])) == 0
    df = docs(spark, [(1, text, None, None), (2, None, None, None)])
    assert [(x.doc_id, text[x["from"]:x.until]) for x in T.offending_sentences(df, model).collect() if "vileness" in text[x["from"]:x.until]]


def test_document_scores_by_a_plain_loop(spark):
    r = np.random.default_rng(4)
    vocabulary = words(300, 5).split()
    model = T.Model({f: float(r.normal(0, 0.8)) for w in vocabulary for f in T.features(w)}, -1.5)
    texts = [". ".join(words(9, i) for i in range(k, k + 4)) for k in range(20)]
    for text in texts:
        clean = 1.0
        for sentence in text.split("."):
            z = model.bias
            for w in set(sentence.lower().split()):
                z += sum(model.words.get(f, 0.0) for f in (w, *[w[:k] + "-" for k in T.STEMS if len(w) >= k]))
            clean *= 1 - 1 / (1 + math.exp(-z))
        assert model.score(text)[0] == pytest.approx(1 - clean, abs=1e-9)


def test_samples_are_the_first_rows_of_each_label(spark):
    df = spark.range(30_000).selectExpr("case when id % 11 = 0 then null else id % 3 = 0 end as toxic", "id as doc_id", "'x' as n")
    order = df.withColumn("h", G.F.xxhash64("doc_id")).collect()
    for limits in ({True: 700, False: 5}, {True: 10**6, False: 9000}, {False: 1}):
        want = [(y, r.doc_id, k + 1) for y, n in limits.items()
                for k, r in enumerate(sorted((r for r in order if r.toxic is y), key=lambda r: (r.h, r.doc_id))[:n])]
        got = first_by_hash(df, "toxic", limits, "doc_id").collect()
        assert sorted((r.toxic, r.doc_id, r.rn) for r in got) == sorted(want)
    assert first_by_hash(df.limit(0), "toxic", {True: 3, False: 3}, "doc_id").count() == 0


def test_long_sentences_are_cut_whole():
    text = words(95, 9)
    parts = list(T.sentences(text))
    assert len(parts) == 3 and set().union(*(w for _, _, w in parts)) == set(text.split())


def test_toxicity_edges(spark):
    df = docs(spark, corpus(40))
    labels = spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i in range(40)] + [(1, 0, None), (None, 0, 1), (99999, 1, 1), (7, 1, 0)], "doc_id long, quality int, toxic int")
    model = T.learn(df, labels, crc_mod(4) != 2)
    got = T.with_scores(df.select("doc_id", (crc_mod(4) == 2).alias("held_out"), "text"), model).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 and r.held_out == (crc(r.doc_id) % 4 == 2) for r in got)
    assert T.learn(df, labels.filter("toxic = 0"), crc_mod(4) != 2) is None
    none = T.with_scores(docs(spark, []).selectExpr("doc_id", "true as held_out", "text"), None)
    assert none.count() == 0


def test_held_out_toxicity(spark):
    d = "/root/testdata/sf0.1"
    rows = T.op5(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("held_out").collect()
    hit = [r.predicted for r in rows if r.toxic == 1]
    false = [r.predicted for r in rows if r.toxic == 0]
    assert np.mean(hit) > 0.6 and np.mean(false) < 0.02


# ------------------------------------------------------------------ language
def test_language_by_family_then_pairs(spark):
    rows = [(r.doc_id, r.lang, r.lang_pred, r.held_out) for r in L.op7(spark, DIR).join(spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()]
    assert np.mean([a == b for _, a, b, held in rows if held]) > 0.98


def test_language_edges(spark):
    table = corpus(60)
    df = docs(spark, table)
    model = L.learn(df, crc_mod(3) != 1)
    assert {f for f, _ in model.families} == {"germanic", "romance", "other"} or {f for f, _ in model.families} == {"germanic", "romance"}
    got = L.with_language(df.select("doc_id", (crc_mod(3) == 1).alias("held_out"), "text"), model).collect()
    assert len(got) == len(table)
    letterless = {d for d, t, *_ in table if t is None or not any(map(str.isalpha, t))}
    for r in got:
        if r.doc_id in letterless and r.doc_id is not None:
            assert (r.lang_pred, r.score) == ("und", 0.0)
        assert 0 <= r.score <= 1
    assert L.learn(df.filter("lang is null"), crc_mod(3) != 1) is None
    assert {r.lang_pred for r in L.with_language(df.selectExpr("doc_id", "true as held_out", "text"), None).collect()} == {"und"}


def test_margins_count_every_byte_the_same_way():
    r = np.random.default_rng(0)
    model = L.Model([("a", ["x"])], [], r.normal(size=(L.FEATURES, 1)).astype(np.float32), np.zeros(1))
    texts = ["kurz", "é", "ein längerer Text " * 70000, "z"]
    together = L._margins(texts, model)
    for i, t in enumerate(texts):
        codes = L._codes(L._bytes(t))
        assert together[i, 0] == pytest.approx(model.weights[codes].mean() * L.SCALE, rel=1e-3)


# ------------------------------------------------------------------ URLs
def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    return host, tail[:min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "abc", "x://", "HTTP://A.COM/x?y", "a://b://c/d", "http://WWW.Example.com/en/#a", "http://notcom/", "http://a.net?/es/", "http://net/es/",
        "http://www.example.com/en", "http://m.www.example.com/en/1?q#r", "http://x.net/fr/" + "é" * 5000, "https://q.example.org/de/1", "https://q.example.org/de/1"]


def test_urls_against_loops(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(100 + i, f"http://{'ab'[i % 2]}{i}.{'com' if i % 3 else 'net'}/{'es' if i % 3 == 0 else 'de'}/{i}") for i in range(60)] + [(None, "http://a.org/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'h' as host", "'v' as verdict", "1 as score")
    got = {(r.page_id): r for r in U.judge_urls(pages).collect()}
    judged = U.with_rule(pages.select("page_id", "url"))
    model = U.learn(judged)
    for i, u in rows:
        host, path = split(u)
        rule, verdict = rule_of(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == (verdict or ("allow" if model.score(u or "") >= model.threshold else "block"))
    assert U.judge_urls(pages.filter("page_id < 0")).count() == 0
    assert {r.verdict for r in U.judge_urls(pages.filter("page_id in (2, 7)")).collect()} == {"allow"}


def test_markov_chances_sum_to_one():
    m = U.MarkovModel.fitted(["http://abc.com/", "http://abd.net/x", "zzz"], order=3)
    for context in ("", "a", "ttp", "zz", "q"):
        seen = {c for x in m.seen.values() for c in x}
        others = 256 - len(seen)
        total = sum(math.exp(m.log_chance(context, c)) for c in seen) + others * math.exp(m.log_chance(context, "\x7f"))
        assert total == pytest.approx(1, abs=1e-6)


def test_url_scores_and_threshold_by_plain_loops():
    accepted, rejected = [f"http://{w}.com/en/" for w in words(60, 1).split()], [f"http://{w}.net/{w[::-1]}" for w in words(60, 2).split()]

    def chance(texts, context, char):
        """Witten-Bell from the shortest context up, with all occurrences counted anew each time."""
        p = 1 / 256
        for k in range(len(context) + 1):
            tail = context[len(context) - k:]
            after = [whole[i + k] for whole in texts for i in range(len(whole) - k) if whole.startswith(tail, i) and (i + k > 0)]
            if not after or (len(after) < 2 and tail):
                continue
            kinds = len(set(after))
            p = (after.count(char) + kinds * p) / (len(after) + kinds)
        return p

    def score(url):
        whole = "\x02" + url + "\x03"
        sides = [["\x02" + t + "\x03" for t in x] for x in fitted]
        logs = [sum(math.log(chance(t, whole[max(0, i - U.ORDER):i], whole[i])) for i in range(1, len(whole))) for t in sides]
        return (logs[0] - logs[1]) / (len(url) + 1)

    parts = [([u for i, u in enumerate(x) if i % U.HOLD_OUT], x[::U.HOLD_OUT]) for x in (accepted, rejected)]
    fitted = [p[0] for p in parts]
    model = U.fit(accepted, rejected)
    for url in (accepted[0], rejected[0], "http://new.org/", ""):
        assert model.score(url) == pytest.approx(score(url), abs=1e-9)
    good, bad = ([model.score(u) for u in p[1]] for p in parts)
    value = lambda t: sum(x >= t for x in good) / len(good) + sum(x < t for x in bad) / len(bad)
    assert value(model.threshold) == max(map(value, [*good, *bad, max(good + bad) + 1]))


# ------------------------------------------------------------------ language model
def test_base_scores_against_counts_and_order_of_scores(spark):
    table = corpus(80)
    got = G.scores(docs(spark, table), crc_mod(7) != 2, crc_mod(7) == 2).collect()
    tokens = lambda t: (t or "").encode().lower().split() + [b" "]
    counts = Counter(w for d, t, *_ in table if crc(d) % 7 != 2 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted(str((d, crc(d) % 7 == 2, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
                       round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 6))) for d, t, *_ in table)
    assert sorted(str((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))) for r in got) == want
    assert all(r.score < 0 for r in got)
    none = G.scores(docs(spark, table), G.F.lit(False), G.F.lit(True)).collect()
    assert {r.train_tokens for r in none} == {0} and all(abs(r.base_score) < 1e-9 for r in none)
    assert G.scores(docs(spark, []), crc_mod(7) != 2, crc_mod(7) == 2).count() == 0


def test_chances_of_all_tokens_sum_to_one():
    counts = Counter(words(20000, 3, 3000).split())
    best = counts.most_common()
    lexicon = G.Lexicon([w.encode() for w, _ in best], np.array([c for _, c in best], float), sum(counts.values()), len(counts))
    w, sums = G.Weights.unigram(lexicon), G.Weights(np.zeros(G.Weights.SIZE, np.float32))
    ranks, codes, _ = G.Reader(lexicon).read(words(20000, 4, 3000).encode().split())
    features, target = G._batches_of([(ranks, codes)], lexicon.size)
    before = G.log10_chances(w, features, target).mean()
    for at in range(0, len(target), G.BATCH):
        G.train_batch(w, sums, features[at:at + G.BATCH], target[at:at + G.BATCH])
    assert G.log10_chances(w, features, target).mean() > before
    one = np.repeat(features[:1], lexicon.size + 1, axis=0)
    every = np.r_[np.arange(lexicon.size), -1]
    assert (10 ** G.log10_chances(w, one, every)).sum() == pytest.approx(1, abs=1e-4)
    rare = sum(c + 1 for _, c in best[lexicon.size:]) + 1
    assert lexicon.rare_mass == rare


def test_held_out_scores_beat_the_base(spark):
    rows = [r for r in G.op9(spark, DIR).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_context_tells_less_frequent_words_apart():
    filler = [f"f{i}" for i in range(2000)]
    pairs = [w for _ in range(6) for w in [x for f in filler for x in [f] * 2] + [x for i in range(200) for x in (f"a{i % 2}", "the", f"w{i % 2}")]]
    counts = Counter(pairs)
    best = sorted(counts.items(), key=lambda r: (-r[1], r[0]))
    extra = [(f"z{i:04d}", 900) for i in range(1000)]  # a thousand words come before w0 and w1
    best = extra + best + [("once", 1)]
    lexicon = G.Lexicon([w.encode() for w, _ in best], np.array([c for _, c in best], float), sum(c for _, c in best), len(best))
    assert lexicon.size == len(best) - 1 and lexicon.rank[b"w0"] >= 992
    w, sums = G.Weights.unigram(lexicon), G.Weights(np.zeros(G.Weights.unigram(lexicon).flat.size, np.float32))
    ranks, codes, _ = G.Reader(lexicon).read([x.encode() for x in pairs])
    features, target = G._batches_of([(ranks, codes)], lexicon.size)
    for at in range(0, len(target), 256):
        G.train_batch(w, sums, features[at:at + 256], target[at:at + 256])
    score = lambda *text: G.log10_chances(w, *G._batches_of([G.Reader(lexicon).read([x.encode() for x in text])[:2]], lexicon.size))[-1]
    assert score("a0", "the", "w0") > score("a1", "the", "w0") + 0.3 and score("a1", "the", "w1") > score("a0", "the", "w1") + 0.3
    assert score("a0", "x", "the") != score("a1", "x", "y", "the")


def test_skip_to_the_third_word_and_a_table_that_grows():
    text = [x for i in range(3000) for x in (f"k{i % 2}", "p", "q", f"v{i % 2}")]
    counts = Counter(text)
    best = sorted(counts.items(), key=lambda r: (-r[1], r[0]))
    lexicon = G.Lexicon([w.encode() for w, _ in best], np.array([c for _, c in best], float), len(text), len(best))
    w, sums = G.Weights.unigram(lexicon), G.Weights(np.zeros(G.Weights.SIZE, np.float32))
    ranks, codes, _ = G.Reader(lexicon).read([x.encode() for x in text])
    features, target = G._batches_of([(ranks, codes)], lexicon.size)
    for at in range(0, len(target), 256):
        G.train_batch(w, sums, features[at:at + 256], target[at:at + 256])
    chances = G.log10_chances(w, features, target)[-400:]
    assert chances[np.array(text[-400:]) == "v0"].mean() > -0.15  # without the skip: log10(1/2)
    many = G.Lexicon([str(i).encode() for i in range(600_000)], np.full(600_000, 3.0), 1_800_000, 600_000)
    assert many.size == 600_000 and len(G.Weights.unigram(many).flat) >= G.PER_WORD * many.size > G.Weights.SIZE


def small_model(seed=5, least=G.LEAST_TABLE):
    counts = Counter(words(9000, seed, 900).split())
    best = counts.most_common()
    lexicon = G.Lexicon([w.encode() for w, _ in best], np.array([c for _, c in best], float), sum(counts.values()), len(counts))
    w = G.Weights(np.random.default_rng(seed).normal(0, 0.3, least).astype(np.float32), lexicon.classes)
    ranks, codes, _ = G.Reader(lexicon).read(words(300, seed + 1, 900).encode().split())
    return lexicon, w, *G._batches_of([(ranks, codes)], lexicon.size)


def softmaxes_by_loop(lexicon, w, feature, target):
    """(node, output, rows, chances) on a target's path: classes are cut from the whole list of leaves, node by node."""
    mass = [lexicon.rare_mass, *(lexicon.counts[:lexicon.size] + 1)]
    leaves, node, out = list(range(len(mass))), 0, []
    for level, c in enumerate(lexicon.classes.classes):
        single = G.WIDTH - c
        outputs = [[x] for x in leaves[:single]] + [leaves[single + k::c] for k in range(c)]
        rows = [int(w.rows(feature[j:j + 1], np.array([node]))[0]) for j in range(len(feature))]
        z = [math.log(sum(mass[x] for x in o)) + sum(float(w.table[r, k]) for r in rows) if o else -math.inf for k, o in enumerate(outputs)]
        total = sum(math.exp(x) for x in z)
        taken = next(k for k, o in enumerate(outputs) if target + 1 in o)
        out.append((node, taken, rows, [math.exp(x) / total for x in z]))
        if taken < single:
            return out
        node = int(lexicon.classes.first[level + 1] + (node - lexicon.classes.first[level]) * c + taken - single)
        leaves = outputs[taken]
    raise AssertionError("the leaf is on no path")


def test_chances_by_a_plain_loop():
    lexicon, w, features, target = small_model()
    assert len(lexicon.classes.classes) > 2 and len({len(softmaxes_by_loop(lexicon, w, f, t)) for f, t in zip(features, target, strict=True)}) > 1
    want = [sum(math.log10(p[k]) for _, k, _, p in softmaxes_by_loop(lexicon, w, f, t)) for f, t in zip(features, target, strict=True)]
    assert G.log10_chances(w, features, target) == pytest.approx(want, abs=1e-4)


def test_a_step_by_a_plain_loop():
    lexicon, w, features, target = small_model(8)
    features, target = np.repeat(features[:12], 7, axis=0), np.repeat(target[:12], 7)
    paths = [softmaxes_by_loop(lexicon, w, f, t) for f, t in zip(features, target, strict=True)]
    change: dict = {}
    for path in paths:
        for _, taken, rows, p in path:
            for j, r in enumerate(rows):
                g = change.setdefault((j, r), np.zeros(G.WIDTH))
                g += p
                g[taken] -= 1
    assert len({r for _, r in change}) == len(change)  # no two pairs share a row here
    before, sums = w.table.copy(), G.Weights(np.zeros_like(w.flat))
    G.train_batch(w, sums, features, target)
    want = before.copy()
    for (_, r), g in change.items():
        want[r] -= G.RATE * g / np.sqrt(g * g + G.DAMPING)
        assert sums.table[r] == pytest.approx(g * g, rel=1e-3, abs=1e-4)
    assert np.abs(w.table - want).max() < 1e-4 and (w.table != before).any(axis=1).sum() == len(change)


def test_gradients_are_summed_by_row():
    r = np.random.default_rng(3)
    row, g = np.r_[r.integers(0, 40, 90), r.integers(100, 400, 200), np.full(50, 7)], r.normal(size=(340, 4))
    rows, total = G.sum_by_row(g, row)
    assert rows.tolist() == sorted(set(row.tolist()))
    for x, t in zip(rows, total, strict=True):
        assert t == pytest.approx(g[row == x].sum(axis=0))


def test_exponentials_stay_within_range_and_rows_are_put_whole():
    r = np.random.default_rng(4)
    for low, high in ((-3, 3), (55, 59), (70, 90), (-200, -100), (-500, 500)):
        z = r.uniform(low, high, (50, 8)).astype(np.float32)
        z[::3, 5:] = -np.inf  # outputs that no leaf takes
        e, total, shift = G.exponentials(z.copy())
        want = np.log(np.exp(z.astype(float) - z.max(axis=1, keepdims=True)).sum(axis=1)) + z.max(axis=1)
        assert np.log(total.astype(float)) + shift == pytest.approx(want, abs=1e-4) and np.isfinite(e).all()
    assert isinstance(G.exponentials(np.zeros((2, 4), np.float32))[2], float)  # no maximum for each row where none is needed
    table = r.normal(size=(30, 4)).astype(np.float32)
    want = table.copy()
    want[[3, 29, 0]] = 7
    G.put_rows(table, np.array([3, 29, 0]), np.full((3, 4), 7, np.float32))
    assert (table == want).all()


def test_words_outside_the_lexicon_have_their_own_codes():
    lexicon = G.Lexicon([b"a", b"bc"], np.array([5.0, 3.0]), 8, 2)
    ranks, codes, missing = G.Reader(lexicon).read([b"x1", b"a", b"x2", b"bc", b"x1"])
    assert ranks.tolist() == [-1, 0, -1, 1, -1] and missing == [b"x1", b"x2", b"x1"]
    assert codes.tolist() == [G.suffix_code(b"x1"), lexicon.codes[0], G.suffix_code(b"x2"), lexicon.codes[1], G.suffix_code(b"x1")]


def test_classes_hold_every_leaf_once():
    for n in (1, 2, 31, 32, 33, 40, 600, 9001):
        classes = G.Classes(np.sort(np.random.default_rng(n).integers(1, 1000, n))[::-1].astype(float))
        ends: dict = {}
        for at, node, output in classes.paths(np.arange(n)):
            ends.update(zip(at.tolist(), zip(node.tolist(), output.tolist(), strict=True), strict=True))
        assert len(ends) == n == len(set(ends.values())) and len(classes.bias) <= 1 + n


def test_learning_toxicity_never_collects_texts(spark, monkeypatch):
    df = docs(spark, corpus(40))
    labels = spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i in range(40)], "doc_id long, quality int, toxic int")

    def refuse(self):
        raise AssertionError(f"collects {self.columns}")

    want = sorted((r.doc_id, int(r.doc_id % 7 == 0), r.text) for r in df.dropDuplicates(["doc_id"]).filter("doc_id < 40").collect() if crc(r.doc_id) % 4 != 2)
    monkeypatch.setattr(type(df), "collect", refuse)
    monkeypatch.setattr(T, "fit", lambda bags: [y for y, _ in bags])
    assert T.learn(df, labels, crc_mod(4) != 2) == [y for _, y, _ in want]


def test_url_models_learn_from_every_ruled_url(spark):
    """The packed models against plain ones of the same URLs, of which none is left out."""
    urls = [f"http://{w}{i}.com/en/{i}" for i, w in enumerate(words(400, 5).split())] + [f"http://{w}{i}.net/es/{i}é\U0001F600" for i, w in enumerate(words(300, 6).split())]
    pages = spark.createDataFrame(list(enumerate([*urls, *urls[:50]])), "page_id long, url string")
    judged = U.with_rule(pages)
    got = U.learn(judged)
    sides = {}
    for r in judged.distinct().selectExpr("url", "rule_verdict", f"pmod(xxhash64(url), {U.HOLD_OUT}) = 0 as held").distinct().collect():
        sides.setdefault((r.rule_verdict, r.held), []).append(r.url)
    assert sum(map(len, sides.values())) == 700
    plain = U.UrlModel(*(U.MarkovModel.fitted(sides[kind, False]) for kind in ("allow", "block")))
    tests = ["", "x", "http://new.org/é", *urls[::7]]
    assert got.scores(tests) == pytest.approx([plain.score(u) for u in tests], abs=1e-9)
    good, bad = ([got.score(u) for u in sides[kind, True]] for kind in ("allow", "block"))
    value = lambda t: sum(x >= t for x in good) / len(good) + sum(x < t for x in bad) / len(bad)
    assert value(got.threshold) == pytest.approx(value(U.best_threshold(good, bad)), abs=0.02)


def test_url_models_know_runs_of_more_urls_than_a_sample(spark):
    """40,000 accepted URLs: a run that only one pair of them holds is scored as known."""
    number = "lpad(conv(id div 2 * 26, 10, 36), 5, 'q')"
    pages = spark.range(40_000).selectExpr("id as page_id", f"concat('h://', if(id % 2 = 0, 'a', 'b'), {number}, '.com/') as url")
    pages = pages.unionByName(spark.range(50).selectExpr("-1 - id as page_id", "concat('h://', id, '.net/es/') as url"))
    model = U.learn(U.with_rule(pages))
    learned = pages.filter(f"page_id >= 0 and pmod(xxhash64(url), {U.HOLD_OUT}) != 0").orderBy("page_id").collect()
    assert len(learned) > 30_000
    plain = U.MarkovModel.fitted([r.url for r in learned])
    tests = [r.url for r in learned[::500]]
    assert model.accepted.log_likelihoods(tests).tolist() == pytest.approx([plain.log_likelihood(u) for u in tests], abs=1e-8)


def test_a_row_that_kinds_share_takes_one_step():
    text = [f"w{i}".encode() for i in np.random.default_rng(6).integers(0, 18, 200)]
    counts = Counter(text)
    best = counts.most_common()
    lexicon = G.Lexicon([w for w, _ in best], np.array([c for _, c in best], float), sum(counts.values()), len(counts))
    w = G.Weights(np.random.default_rng(5).normal(0, 0.3, 16 * G.WIDTH).astype(np.float32), lexicon.classes)
    ranks, codes, _ = G.Reader(lexicon).read(text)
    features, target = G._batches_of([(ranks, codes)], lexicon.size)
    assert lexicon.classes.classes == [0]
    g = np.zeros((16, G.WIDTH))
    for f, t in zip(features, target, strict=True):
        (_, taken, rows, p), = softmaxes_by_loop(lexicon, w, f, t)
        for r in rows:
            g[r, :len(p)] += p
            g[r, taken] -= 1
    want = w.table - G.RATE * g / np.sqrt(g * g + G.DAMPING)
    sums = G.Weights(np.zeros_like(w.flat))
    G.train_batch(w, sums, features, target)
    assert np.abs(w.table - want).max() < 1e-4 and sums.table == pytest.approx(g * g, rel=1e-3, abs=1e-3)


def test_texts_are_read_as_a_plain_split_reads_them():
    r = np.random.default_rng(2)
    letters = [*map(chr, range(128)), "É", "é", "\x85", "\xa0", " ", "😀"]
    texts = [None, "", " ", "a", "  A\x1cb\tÉc ", *("".join(r.choice(letters, r.integers(0, 40))) for _ in range(500))]
    lexicon = G.Lexicon([b"a", b"b", G.END], np.array([5.0, 4.0, 3.0]), 12, 3)
    reader = G.Reader(lexicon)
    for column in (G.pa.array(texts), G.pa.array(texts, G.pa.large_string()), G.pa.array(["x y", *texts]).slice(1)):
        lengths, ranks, codes, word, distinct = reader.texts(column)
        want = [G.tokens(t) for t in texts]
        assert lengths.tolist() == [len(x) for x in want] and distinct.take(G.pa.array(word)).to_pylist() == [w for x in want for w in x]
        plain = reader.read([w for x in want for w in x])
        assert (ranks == plain[0]).all() and (codes == plain[1]).all()
        features, target = G._batches_of([reader.read(x)[:2] for x in want], lexicon.size)
        got = list(reader.batches(lengths, ranks, codes))
        assert (np.concatenate([f for f, _ in got]) == features).all() and (np.concatenate([t for _, t in got]) == target).all()
    batch = G.pa.RecordBatch.from_arrays([G.pa.array([*texts, "x" * (G.PIECE + 1), "y"])], names=["text"])
    assert [p.num_rows for p in G.pieces(iter([batch]))] == [len(texts), 1, 1]
    counted: Counter = Counter()
    for b in G._count(iter([batch])):
        counted.update(dict(zip(b["token"].to_pylist(), b["c"].to_pylist(), strict=True)))
    assert counted == Counter(w for t in batch["text"].to_pylist() for w in G.tokens(t))
