import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from helpers import corpus, docs
from lexanchor.llm.common import written
from test_dedup import components_of, lower
from test_quality_and_mix import WORD


def test_stages_against_brute_force(spark):
    table = [t for t in corpus(160, seed=8) if t[0] is not None and t[0] != 3]
    df = docs(spark, table)
    columns = df.columns
    kept = P.quality_rules(spark, df, "")
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert kept.columns == columns and 0 < len(rows) < len(table)

    exact = written(P.exact_dedup(spark, written(kept, "t"), ""), "t")
    best = {}
    for d, t in rows:
        best[lower(t)] = max(d, best.get(lower(t), -1))
    one = sorted((r.doc_id, r.text) for r in exact.collect())
    assert [d for d, _ in one] == sorted(best.values()) and exact.columns == columns

    near = written(P.near_dedup(spark, exact, ""), "t")
    _, least = components_of(one)
    assert sorted(r.doc_id for r in near.collect()) == sorted(set(least.values())) and near.columns == columns

    mixed = written(P.mix_sources(spark, near, ""), "t")
    size = sum(len(WORD.findall(r.text)) for r in near.collect())
    assert mixed.columns == columns and abs(sum(len(WORD.findall(r.text)) for r in mixed.collect()) - size) <= 5

    packed = P.pack(spark, mixed, "").collect()
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = sum(len(t.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed.collect())
    assert sum(r.length for r in packed) == total
    assert len({r.sequence_id for r in packed}) <= total / 2048 + 2


def test_stage_names():
    assert len(P.STAGES) == 5 and P.ORACLE_SQL is None
