"""The inverted index and the similarity join against plain loops."""

import random
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexanchor.operators import search as S
from lexanchor.session import scratch

SCHEMA = "block_id long, block_text string"


def plain(text):
    low = unicodedata.normalize("NFD", (text or "").lower())
    return "".join(c if c.isalnum() else " " for c in low if not unicodedata.combining(c)).split()


def texts(n, seed=1):
    r = random.Random(seed)
    vocabulary = ["ação", "direta", "Art", "lei", "súmula", "voto", "é", *[f"t{i}" for i in range(40)]]
    return [(i, " ".join(r.choices(vocabulary, k=r.randrange(0, 25)))) for i in range(n)] + [(1000, None), (1001, ""), (1002, "lei " * 500)]


def expected(rows):
    return sorted((t, i, n) for i, text in rows for t, n in Counter(plain(text)).items())


def held(index):
    return sorted(map(tuple, index.live().drop("bucket").collect()))


def test_incremental_index_equals_a_rebuild(spark):
    index = S.TextIndex(spark, scratch(spark, "t"), buckets=8)
    first = texts(60)
    assert index.update(spark.createDataFrame(first, SCHEMA)) == len(first)
    assert held(index) == expected(first)
    second = [(i, t + " ementa" if t and i % 7 == 0 else t) for i, t in first if i % 10 != 3] + [(2000, "Novo voto")]
    changed = {i for i, t in second if dict(first).get(i, 0) != t}
    assert index.update(spark.createDataFrame(second, SCHEMA)) == len(changed)
    assert held(index) == expected(second)
    written = spark.read.parquet(f"{index.path}/postings").filter("gen = 2")
    assert {r.block_id for r in written.collect()} <= changed  # nothing else was indexed again
    assert index.update(spark.createDataFrame(second, SCHEMA)) == 0 and index.generation() == 2
    assert index.update(spark.createDataFrame(second[:5], SCHEMA)) == 0 and held(index) == expected(second[:5])  # only removals


def test_an_update_that_was_cut_off_is_unseen(spark):
    index = S.TextIndex(spark, scratch(spark, "t"), buckets=4)
    rows = texts(20)
    index.update(spark.createDataFrame(rows, SCHEMA))
    S.postings(spark.createDataFrame([(5, "meio")], SCHEMA), "block_id", "block_text").withColumn("bucket", F.lit(1)).write.partitionBy("bucket").parquet(f"{index.path}/postings/gen=2")
    assert held(index) == expected(rows)
    index.update(spark.createDataFrame([(5, "inteiro")], SCHEMA))
    assert held(index) == [("inteiro", 5, 1)]


def test_texts_travel_packed_not_by_their_postings(spark):
    index = S.TextIndex(spark, scratch(spark, "t"), buckets=11)
    first = texts(60)
    index.update(spark.createDataFrame(first, SCHEMA))
    second = [(i, t + " ementa lei" if t and i % 7 == 0 else t) for i, t in first if i % 10 != 3]
    index.update(spark.createDataFrame(second, SCHEMA))
    freq = index.frequencies()
    want = expected(second)
    assert {r.term: (r.documents, r.occurrences) for r in freq.collect()} == {
        t: (sum(w == t for w, _, _ in want), sum(n for w, _, n in want if w == t)) for t in {w for w, _, _ in want}}
    assert "/postings" not in "".join(freq.inputFiles()) and "/texts" in "".join(freq.inputFiles())
    older = S.TextIndex(spark, scratch(spark, "t"), buckets=11)  # as if written before there were packed texts
    spark.read.parquet(f"{index.path}/postings/gen=1").write.partitionBy("bucket").parquet(f"{older.path}/postings/gen=1")
    spark.read.parquet(f"{index.path}/docs/state=1").write.parquet(f"{older.path}/docs/state=1")
    first_terms = {t for t, _, _ in expected(first)}
    assert {r.term for r in older.frequencies().collect()} == first_terms
    older.update(spark.createDataFrame(second, SCHEMA))
    assert sorted(map(tuple, older.frequencies().collect())) == sorted(map(tuple, freq.collect()))
    packed = S.counted(spark.createDataFrame(second, SCHEMA), "block_id", "block_text")
    dealt = S.by_buckets(packed, "block_id", 11)
    assert sorted(map(tuple, dealt.drop("bucket").collect())) == want and dealt.filter(F.col("bucket") != S.bucket_of("term", 11)).count() == 0
    assert packed.count() == len({i for _, i, _ in want})


def test_search_reads_only_the_partitions_of_its_terms(spark):
    index = S.TextIndex(spark, scratch(spark, "t"), buckets=32)
    rows = texts(80)
    index.update(spark.createDataFrame(rows, SCHEMA))
    got = {r.block_id: (r.matched, r.hits) for r in index.search(["AÇÃO", "Sumula"]).collect()}
    want = {i: Counter(w for w in plain(t) if w in ("acao", "sumula")) for i, t in rows}
    assert got == {i: (len(c), c.total()) for i, c in want.items() if c}
    wanted = {r[0] for r in spark.createDataFrame([("acao",), ("sumula",)], "t string").select(S.bucket_of("t", 32)).collect()}
    plan = index.lookup(["AÇÃO", "Sumula"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket#" in plan.replace("isnotnull(gen", "bucket#") and all(f"{b}" in plan for b in wanted)
    read = spark.read.parquet(f"{index.path}/postings").filter(F.col("bucket").isin(list(wanted))).select(F.input_file_name().alias("f")).distinct().count()
    assert read <= len(wanted) < spark.read.parquet(f"{index.path}/postings").select("bucket").distinct().count()


def grams(name):
    return {("  " + w + " ")[i:i + 3] for w in plain(name) for i in range(len(w) + 1)}


@pytest.mark.parametrize("percent", [30, 60, 75, 100])
def test_similar_names_equal_all_pairs(spark, percent):
    r = random.Random(percent)
    parts = ["Cármen", "Lúcia", "Gilmar", "Mendes", "Barroso", "Luís", "Roberto", "Fux", "Mello", "de", "Celso", "Lucia", "Mendez"]
    names = [(i, " ".join(r.choices(parts, k=r.randrange(1, 4)))) for i in range(120)] + [(500, None), (501, ""), (502, "!!"), (503, "x")]
    names += [(600 + i, "Cármen Lúcia") for i in range(60)]  # copies
    members, pairs = S.similar_names(spark.createDataFrame(names, "id long, name string"), "id", "name", percent)
    sets = {}
    for i, n in names:
        if g := frozenset(grams(n)):
            sets.setdefault(g, []).append(i)
    assert sorted(map(tuple, members.collect())) == sorted((i, min(ids)) for ids in sets.values() for i in ids)
    keys = sorted((min(ids), g) for g, ids in sets.items())
    want = [(a, b, round(len(x & y) / len(x | y), 6)) for k, (a, x) in enumerate(keys) for b, y in keys[k + 1:] if 100 * len(x & y) >= percent * len(x | y)]
    assert sorted(map(tuple, pairs.collect())) == sorted(want)


def test_misspelt_terms_find_the_vocabulary(spark):
    vocabulary = spark.createDataFrame([(t,) for t in ("constituicao", "constituinte", "sumula", "sumulas", "voto")], "term string")
    got = {(r.query, r.term) for r in S.similar_terms(["constituisao", "súmla", "zzz", ""], vocabulary, 35).collect()}
    assert {("constituisao", "constituicao"), ("súmla", "sumula")} <= got and not any(q in ("zzz", "") for q, _ in got)


def test_similar_terms_look_only_at_terms_with_a_shared_trigram(spark, monkeypatch):
    """Against all pairs; of the vocabulary, only terms that share a trigram with the query are ordered and joined."""
    terms = ["acao", "acoes", "recurso", "zzz", "xyw", "lei"]
    docs = spark.createDataFrame([(1, "Ação ações <b>recurso</b> zzz"), (2, "xyw lei, lei."), (3, None)], "doc_id long, text string")
    vocabulary = S.vocabulary(docs, "text")
    assert sorted(r.term for r in vocabulary.collect()) == sorted(terms)
    seen = []
    monkeypatch.setattr(S, "token_classes", lambda df, *a, f=S.token_classes: (seen.append(sorted(r.term for r in df.collect())), f(df, *a))[1])
    got = {(r.query, r.term) for r in S.similar_terms(["acaos", "qqq"], vocabulary, 40).collect()}
    tri = lambda w: {("  " + w + " ")[i:i + 3] for i in range(len(w) + 1)}
    want = {(q, t) for q in ("acaos", "qqq") for t in terms if 100 * len(tri(q) & tri(t)) >= 40 * len(tri(q) | tri(t))}
    assert got == want and got and seen == [[t for t in sorted(terms) if tri(t) & (tri("acaos") | tri("qqq"))]]
    assert S.similar_terms([], vocabulary, 40).count() == 0
