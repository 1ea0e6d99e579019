"""Steps over long texts: cheaper patterns match what the plain ones do, costly steps see only rows that need them."""

import random

from pyspark.sql import functions as F

from lexanchor import vocab as V
from lexanchor.fixtures import Corpus
from lexanchor.functions import text as T
from lexanchor.operators import blocks as B, citations as C, integrity as I, structure as X, vectors as V_
from lexanchor.plans.registry import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_class_patterns_look_ahead_and_find_the_same(spark):
    rng = random.Random(3)
    pieces = ["ADI", "adpf", "re", "STP", "Rcl", "agr", "SSn", "hcN", " ", "  ", "-", ".", "n", "N", "\n", "1.234", "7", "º", "ã", "_", "x", "artigo ", "(", ","]
    df = spark.createDataFrame([("".join(rng.choices(pieces, k=rng.randint(1, 14))),) for _ in range(4000)], "t string")
    for p in (V.P_PROC, V.P_PROC_LINKS):
        assert "(?=" in T.pat(p)
        plain, ahead = (F.regexp_extract_all("t", F.lit(x), F.lit(0)) for x in (p, T.pat(p)))
        both = df.select(plain.alias("plain"), ahead.alias("ahead"))
        assert both.filter("plain <> ahead").collect() == []
        assert both.filter("size(plain) > 0").count() > 300


def test_mentions_read_decisions_only_beside_links(spark):
    texts = ["RE 12 http://a.b/c, HC 3 https://d.e/f", "ADI 5 sem vínculo", "RE 1 :// x", None, "http://a.b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = C.url_mentions(df)
    assert sorted((r.doc_id, r.numero, r.url, r.acao_referente) for r in got.select("doc_id", "numero", "url", "acao_referente").collect()) == [
        (0, 1, "http://a.b/c,", "RE 12"), (0, 2, "https://d.e/f", "HC 3"), (4, 1, "http://a.b", "")]
    assert "://)" in plan(got)  # a filter on the texts, ahead of the list of decisions


def test_judgment_payloads_are_read_once(spark):
    full = '{"collegiality_mode":"colegiado","outcome":"x","decision_body":{"a":1},"adjudication_environment":"v","panel_size":5,"votes_present":[1],"extraction_method":"m","confidence_score":0.5}'
    payloads = [full, full.replace("5,", "null,", 1), full.replace('"outcome":"x",', ""), full.replace("colegiado", "monocratico"), None, "", "{}", full.replace('"x"', '""')]
    ev = spark.createDataFrame([(f"e{i}", "julgamento", "a", p) for i, p in enumerate(payloads)] + [("e90", "distribuicao", "a", full), ("e91", "julgamento", "b", full), ("e92", "julgamento", "c", full)],
                               "event_id string, type_slug string, aggregate_id string, payload string")
    e = spark.createDataFrame([("relator_de", "a", None), ("relator_de", "b", None), ("sobre", "c", None)], "type_slug string, target_id string, valid_to timestamp")
    roles = spark.createDataFrame([("exerce_papel", "a", '{"role":"relator"}'), ("exerce_papel", "b", '{"role":"votante"}'), ("exerce_papel", "c", '{"role":"relator"}')],
                                  "type_slug string, target_id string, payload string")
    got = I.complete_judgments(ev, e, roles)
    assert sorted(r.event_id for r in got.collect()) == ["e0", "e7"]
    assert "get_json_object" not in plan(got)


def test_dates_are_split_once(spark):
    rows = ["5-6-2011", " 05-06-2011 ", "32-1-2000", "1-13-2000", "1-1-1987", "1-1-2027", "1-2-20201", "x", "", None, "1-2-2020 e", "31-12-1988"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, d string")
    got = df.select("i", T.norm_date("d").alias("iso"))
    assert [r.iso for r in got.orderBy("i").collect()] == ["2011-06-05", "2011-06-05", *[None] * 9, "1988-12-31"]
    assert "regexp_extract" not in plan(got)


def test_judgment_dates_equal_those_of_resolved_blocks(spark):
    b = Corpus(spark, "/root/testdata/sf0.001").blocks
    got, want = (rows_of(f(b).select("block_id", "julgamento_data")) for f in (B.judgment_dates, B.resolve_blocks))
    assert got == want and any(d for _, d in got) and not all(d for _, d in got)


def test_chunks_read_only_dates(spark):
    x = Corpus(spark, "/root/testdata/sf0.001")
    keep = ["chunk_slug", "units", "first_date", "hash_chunk"]
    assert rows_of(V_.build_chunks(B.judgment_dates(x.blocks), 4000).select(*keep)) == rows_of(V_.build_chunks(B.resolve_blocks(x.blocks), 4000).select(*keep))
    assert "regexp_extract" not in plan(V_.build_chunks(B.judgment_dates(x.blocks), 4000))  # read before the scan, once


def test_keys_need_no_second_pass(spark):
    texts = ["", " ", "Ação – Única—x", "a < b", "<p>É&nbsp;isto</p>\n\n&sect;&#65; 1_2", "Súmula Vinculante 13\tx", "controle & concentrado", "ß–ÿ  z", "!!!", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    bare = F.regexp_replace(F.regexp_replace("t", r"<[^>]+>", " "), r"&[a-z]+;|&#\d+;", " ")
    words = F.trim(F.regexp_replace(F.regexp_replace(F.lower(T.strip_accents(bare)), r"[^\p{L}\p{N}_]", " "), r"\s+", " "))
    norm = T.norm_spaces(F.translate(F.lower(T.strip_accents(T.norm_spaces("t"))), "–—", "--"))
    assert df.filter(~(T.norm_key("t").eqNullSafe(norm) & T.word_key("t", prefixes=False).eqNullSafe(words) & T.folded_text("t").eqNullSafe(F.lower(T.strip_accents(bare))))).collect() == []
    assert plan(QUERIES["fn1_fn5_text_keys"](spark, "/root/testdata/sf0.001")).count("<[^>]+>") == 1


def test_link_summary_strips_a_text_once(spark):
    assert plan(QUERIES["fn26_link_summary"](spark, "/root/testdata/sf0.001")).count("<[^>]+>") == 1


def test_exported_trees_resolve_no_slugs(spark, monkeypatch):
    x = Corpus(spark, "/root/testdata/sf0.001")
    nodes = X.classify_lines(x.norm_lines).filter("node_type <> 'texto_livre'")
    parents = X.assign_parents(nodes)
    cols = ["doc_id", "pos", "label", "path", "depth"]
    assert rows_of(X.label_paths(nodes, parents).select(*cols)) == rows_of(X.node_paths(nodes, parents).select(*cols))
    chains, whole = [], X.resolve_chains
    monkeypatch.setattr(X, "resolve_chains", lambda *a: chains.append(list(a[3])) or whole(*a))
    QUERIES["src12_export_tree"](spark, "/root/testdata/sf0.001")
    assert chains == [["path"]]
