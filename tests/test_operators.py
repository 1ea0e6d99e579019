"""Hand-made rows for the rules a wrong plan would get wrong."""

import random

import pytest
from pyspark.sql import functions as F

from lexanchor import vocab as V
from lexanchor.functions import metadata as M, text as T
from lexanchor.operators import blocks as B, core as C, graph as G, keyed as K, linkage as L, reconcile as R, structure as X
from lexanchor.sources import tables as S


def one(spark, col):
    return spark.range(1).select(col.alias("c")).first()[0]


def test_roman_numbers_both_ways(spark):
    r = spark.range(1, 400).select("id", T.roman_to_int(T.int_to_roman("id")).alias("b"))
    assert r.filter("id <> b").count() == 0
    assert one(spark, T.roman_to_int(F.lit("xiv"))) == 14 and one(spark, T.roman_to_int(F.lit("XLI"))) == 41
    assert one(spark, T.roman_to_int(F.lit("abc"))) is None


@pytest.mark.parametrize("html, text", [
    ("<b>S&uacute;</b>&#8364;&#65;", "S €A"), ("a&nbsp;&sect;&nbsp;1&ordm; &ldquo;x&rdquo;", 'a § 1º "x"'), ("  <p>a</p>\n<p>b</p> ", "a b"),
])
def test_strip_html(spark, html, text):
    assert one(spark, T.strip_html(F.lit(html))) == text


def test_slugs_dates_and_names(spark):
    assert one(spark, T.norm_slug(F.lit("cf-art-5-inc-XIV-ali-a"))) == "cf-1988-art-5-inc-14-ali-a"
    assert one(spark, T.move_slug(F.lit("cf-1988-art-5-inc-x"), F.lit(7))) == "cf-1988-art-7-inc-x"
    assert one(spark, T.norm_date(F.lit("5-6-2011"))) == "2011-06-05"
    assert one(spark, T.norm_date(F.lit("5-6-1900"))) is None and one(spark, T.norm_date(F.lit("17"))) is None
    assert one(spark, T.clean_name(F.lit("Roberto Barroso)."))) == "Luís Roberto Barroso"
    assert one(spark, T.canonical_name(F.lit("Ilmar Galvão) proposta pela parte interessada (x"))) == "Ilmar Galvão"


def test_bracket_metadata(spark):
    m = one(spark, M.extract_meta(F.lit("[ADI 1.234, rel. min. Nome Sobrenome, j. 5-5-2011, P, DJE de 14-10-2011, Tema 12, com mérito julgado.]")))
    assert (m.process_class, m.process_number, m.relator, m.julgamento_data, m.dje_data, m.tema_rg) == (
        "ADI", "1234", "Nome Sobrenome", "5-5-2011", "14-10-2011", "12")


def test_state_rules(spark):
    rows = [("e2", "a", '{"to_state":null}', "2020-01-02 00:00:00"), ("e1", "a", '{"to_state":"x"}', "2020-01-01 00:00:00"),
            ("f2", "b", '{"to_state":"late"}', "2020-01-01 00:00:00"), ("f1", "b", '{"to_state":"first"}', "2020-01-01 00:00:00"),
            ("g1", "c", "{}", "2020-01-01 00:00:00")]
    ev = spark.createDataFrame(rows, "event_id string, aggregate_id string, payload string, t string").withColumn("occurred_at", F.col("t").cast("timestamp_ntz"))
    got = {r.aggregate_id: r.to_state for r in C.latest_state(ev).collect()}
    assert got == {"a": None, "b": "first"}


def test_actor_endpoints_resolve_only_when_asked(spark):
    e = spark.createDataFrame([("e", "relator_de", "sup-1", "ord-1")], "edge_id string, type_slug string, source_id string, target_id string")
    o = spark.createDataFrame([("ord-1", "caso")], "id string, slug string")
    a = spark.createDataFrame([("sup-1", "ministro")], "id string, slug string")
    et = S.taxonomies(spark)["edge_types"]
    assert C.edges_readable(e, et, o).first().source_slug is None
    assert C.edges_readable(e, et, o, a).first().source_slug == "ministro"


def test_anchor_agreement_by_segment(spark):
    assert one(spark, B.agrees(F.lit("cf-1988-art-10"), F.lit("cf-1988-art-1"))) is False
    assert one(spark, B.agrees(F.lit("cf-1988-art-10"), F.lit("cf-1988-art-1"), segment_aware=False)) is True
    assert one(spark, B.agrees(F.lit("cf-1988-art-1-inc-i"), F.lit("cf-1988-art-1"))) is True


def test_segmented_scan_equals_plain_windows_on_a_hot_key(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"), F.col("id").alias("pos"),
        F.when(F.md5(F.col("id").cast("string")).substr(1, 1) < "3", F.col("id")).alias("v"))
    got = K.segmented_scan(df, ["k"], ["pos"], K.position_segment("pos", 64), fills={"f": F.col("v")}, counts={"n": F.col("v").isNotNull()}, prev={"p": F.col("v")})
    from pyspark.sql import Window as W

    w = W.partitionBy("k").orderBy("pos")
    want = df.select("*", F.last("v", True).over(w).alias("f"), F.count("v").over(w).alias("n"), F.lag("v").over(w).alias("p"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_first_per_key_prunes_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = K.first_per_key(df, ["k"], [F.col("id").asc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def stack_parents(kinds):
    """The plain stack rule the windowed form must equal."""
    stack, out = [("root", None)], []
    for pos, kind in enumerate(kinds):
        i = next((j for j in range(len(stack) - 1, -1, -1) if stack[j][0] in V.TREE_PARENTS[kind]), 0)
        out.append(stack[i][1])
        stack = stack[: i + 1] + [(kind, pos)]
    return out


def test_parents_equal_the_stack_rule(spark):
    rng, kinds = random.Random(5), list(V.TREE_PARENTS)
    docs = [[rng.choice(kinds) for _ in range(rng.randint(1, 40))] for _ in range(120)]
    rows = [(d, p, k) for d, ks in enumerate(docs) for p, k in enumerate(ks)]
    nodes = spark.createDataFrame(rows, "doc_id int, pos long, node_type string")
    got = {(r.doc_id, r.pos): r.parent_pos for r in X.assign_parents(nodes, size=7).collect()}
    for d, ks in enumerate(docs):
        for p, want in enumerate(stack_parents(ks)):
            assert got[(d, p)] == want, (d, ks[: p + 1])


def test_segments_close_after_metadata_and_reset(spark):
    text = ["Art. 1º Início", "fala um", "fala dois", "[ADI 1.000, rel. min. A B]", "outra", "Súmula", "Art. 10, § 5º da Lei 8", "XIV - inciso", "fim", "Art. 2º Segundo", "último"]
    lines = spark.createDataFrame([("d", i, t) for i, t in enumerate(text)], "doc_id string, pos long, text string")
    got = [(r.anchor_slug, r.editorial_marker, r.block_text, r.metadata_text) for r in X.segment_blocks(lines, size=3).orderBy("paragraph_start").collect()]
    assert got == [
        ("cf-1988-art-1", "sem_categoria", "fala um fala dois", "[ADI 1.000, rel. min. A B]"), ("cf-1988-art-1", "sem_categoria", "outra", ""),
        ("cf-1988-art-1", "sumula", "Art. 10, § 5º da Lei 8", ""), ("cf-1988-art-1-inc-xiv", "sumula", "fim", ""),
        ("cf-1988-art-2", "sem_categoria", "último", "")]


def test_long_chain_and_cycle(spark):
    n = spark.range(300).select(F.col("id").alias("k"), F.when(F.col("id") > 0, F.col("id") - 1).alias("up"))
    r = G.chain_roots(n, "k", "up")
    assert r.count() == 300 and r.filter("root <> 0 or links <> k").count() == 0
    loop = spark.createDataFrame([(1, 2), (2, 1)], "k long, up long")
    with pytest.raises(ValueError):
        G.chain_roots(loop, "k", "up").count()


def test_closure_contains_every_edge(spark):
    e = spark.range(1, 200).select(F.col("id").alias("node"), F.floor(F.col("id") / 3).alias("parent"))
    c = G.ancestor_closure(e)
    assert e.join(c.select("node", F.col("ancestor").alias("parent")), ["node", "parent"], "left_anti").count() == 0
    assert c.groupBy("node", "ancestor").count().filter("count > 1").count() == 0


def test_dedup_and_reconcile_are_fixpoints(spark):
    b = spark.createDataFrame([(1, "cf-1988-art-1", "x" * 40 + " um"), (2, "cf-1988-art-1", "x" * 40 + " um"), (3, "cf-1988-art-2-inc-i", "y y " * 20)],
                              "block_id long, anchor_slug string, block_text string")
    d = R.dedup_exact(b)
    assert [r.block_id for r in d.orderBy("block_id").collect()] == [1, 3]
    assert R.dedup_exact(d).count() == d.count()
    truth = spark.createDataFrame([(1, 9, "y y " * 20)], "pos long, article int, text string")
    log = R.reconcile_cascade(b, truth)
    assert {r.block_id: r.new_slug for r in log.collect()}[3] == "cf-1988-art-9-inc-i"
    again = R.reconcile_cascade(log.select("block_id", F.col("new_slug").alias("anchor_slug")).join(b.drop("anchor_slug"), "block_id"), truth)
    assert again.filter("status = 'fixed'").count() == 0


def test_short_keys_match_longer_official_keys(spark):
    b = spark.createDataFrame([(1, "cf-1988-art-1", "abcdefghij klmnopqrst uvw")], "block_id long, anchor_slug string, block_text string")
    truth = spark.createDataFrame([(1, 4, "abcdefghij klmnopqrst uvwxyz e mais texto oficial")], "pos long, article int, text string")
    assert R.fix_boundaries(b, truth).first().truth_article == 4


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "linha\nquebrada"), ("b", None)], "k string, v string")
    S.write_tsv(df, str(tmp_path / "t"))
    assert {(r.k, r.v) for r in S.read_tsv(spark, str(tmp_path / "t")).collect()} == {("a", "linha\nquebrada"), ("b", None)}
    t = S.materialize(df, str(tmp_path), "m")
    S.append_new(spark.createDataFrame([("b", "z"), ("c", "n")], "k string, v string"), str(tmp_path / "m"), ["k"])
    S.append_new(spark.createDataFrame([("c", "n")], "k string, v string"), str(tmp_path / "m"), ["k"])
    assert spark.read.parquet(str(tmp_path / "m")).count() == 3 and t.columns == ["k", "v"]
    (tmp_path / "b.json").write_text('[{"block_id": 1, "block_text": "t"}, {"block_id": 2}]')
    assert S.read_blocks_json(spark, str(tmp_path / "b.json")).count() == 2


def test_stream_equals_batch_in_any_order(spark, tmp_path):
    from lexanchor.streaming import state as ST

    rows = [(f"e{i}", f"a{i % 5}", f'{{"to_state":"s{i % 3}"}}', i * 7919 % 100) for i in range(60)]
    random.Random(1).shuffle(rows)
    ev = spark.createDataFrame(rows, "event_id string, aggregate_id string, payload string, t long").select(
        "event_id", "aggregate_id", "payload", F.timestamp_seconds("t").alias("occurred_at"))
    src = str(tmp_path / "log")
    for i in range(3):
        ev.filter(F.pmod(F.hash("event_id"), F.lit(3)) == i).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    ST.current_state_stream(stream, str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
    got = {(r.aggregate_id, r.to_state) for r in ST.read_current_state(spark, str(tmp_path / "s")).collect()}
    assert got == {(r.aggregate_id, r.to_state) for r in C.latest_state(ev).collect()}


def test_scoring_keeps_two_rows_per_text(spark):
    nodes = spark.createDataFrame([(f"cf-1988-art-{i}-par-unico", "paragrafo", "Parágrafo único", None, "único", "unico", "") for i in range(50)],
                                  "slug string, node_type string, label string, title string, number_raw string, number_norm string, path string")
    assert L.score_lookup(L.variant_index(nodes)).groupBy("norm").count().filter("count > 2").count() == 0


def test_pieces_join_to_the_text(spark):
    text = "".join(chr(97 + i % 26) for i in range(50_001)) + "é"
    got = one(spark, T.pieces_for_model(F.lit(text)))
    assert [len(p) for p in got] == [24000, 24000, 2002] and "".join(got) == text
    assert one(spark, T.pieces_for_model(F.lit(None).cast("string"))) == [""]


def test_cycles_are_found_at_once_and_lost_causes_are_roots(spark):
    for links in ([(1, 2), (2, 3), (3, 1)], [(7, 7)]):
        with pytest.raises(ValueError):
            G.ancestor_closure(spark.createDataFrame(links, "node int, parent int"))
    ev = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 99), (5, 4)], "event_id int, causation_id int")
    assert {(r.event_id, r.root, r.steps) for r in G.causation_chain(ev).collect()} == {(1, 1, 0), (2, 1, 1), (3, 1, 2), (4, 4, 0), (5, 4, 1)}


def test_boundary_keys_of_twenty_characters_count(spark):
    truth = spark.createDataFrame([(1, 5, "abcdefghij klmnopqrs and more of it"), (2, 6, "only twenty letters.")], "pos int, article int, text string")
    ours = spark.createDataFrame([(1, "cf-1988-art-9", "abcdefghij klmnopqrs"), (2, "cf-1988-art-9", "only twenty letters."), (3, "cf-1988-art-9", "abcdefghij klmnopqr")],
                                 "block_id int, anchor_slug string, block_text string")
    got = {r.block_id: (r.truth_article, r.status) for r in R.fix_boundaries(ours, truth).collect()}
    assert got == {1: (5, "fixed"), 2: (None, "unmatched"), 3: (None, "unmatched")}


def test_candidates_that_differ_in_accents_are_one(spark):
    b = spark.createDataFrame([(1, "art. 5, § 2 e Parágrafo 2 e Paragrafo 2", "")], "block_id int, block_text string, metadata_text string")
    norms = [r.norm for r in L.candidates(b).collect()]
    assert len(norms) == len(set(norms))


def test_allocation_is_whole_and_bounded(spark, monkeypatch):
    import numpy as np

    from lexanchor.operators import vectors as VE

    r = np.random.default_rng(0)
    mine, theirs = r.normal(size=(40, 4)), r.normal(size=(50_000, 4))
    decisions = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(mine)] + [(100, None), (101, [1.0])], "vec_id long, embedding array<double>")
    plates = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(theirs)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(VE, "SCORES", 100_000)
    near = VE.nearest_plates(decisions, plates, 3, block_rows=16, tile_bytes=400_000)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = np.round(unit(mine) @ unit(theirs).T, 9)
    want = {(i, int(p), k + 1) for i, row in enumerate(scores) for k, p in enumerate(np.lexsort((np.arange(len(row)), -row))[:3])}
    assert {(x.vec_id, x.plate, x["rank"]) for x in near.collect()} == want
    good, queue = VE.allocate(decisions, plates, 3, tau=0.99)
    allocated = {x.vec_id for x in good.collect()}
    reasons = {x.vec_id: x.reason for x in queue.collect()}
    assert allocated | set(reasons) == {*range(40), 100, 101} and not allocated & set(reasons)
    assert reasons[100] == "no vector" and reasons[101] == "no comparable plate"
    assert {x.reason for x in VE.allocate(decisions, plates.limit(0))[1].collect()} == {"no vector", "no comparable plate"}
