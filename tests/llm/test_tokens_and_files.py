import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from helpers import corpus, docs
from lexanchor.llm import packing, token_files
from lexanchor.llm.tokens import Encoder

VOCABULARIES = [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)]
PIECES = ["a", "b", " ", "  ", "\n", "'s", "'", "é", "́", "1", "23", ".", "!!", "\t", "<|endoftext|>", "<|startoftext|>", " ", "😀", "\r\n", "İ", "ß", "ﬁ", "Å", "Σ", "Word", "naïve", "日本", "?"]


def reference(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name,space", VOCABULARIES)
def test_chunks_give_the_ids_of_whole_texts(name, space):
    encoder, whole, r = Encoder(public_tokenizers.path(name), space), reference(name), random.Random(3)
    texts = ["", " ", "a  b", " a", "a ", "a.\nb, \nc\n\nd e\nf", "\na b", "Élan, NAÏVE. ΣΑΣ a.b ...", "x" * 5000 + " y"]
    texts += ["".join(r.choice(PIECES) for _ in range(r.randint(1, 25))) for _ in range(4000)]
    for text in texts * 2:
        assert encoder.encode(text).tolist() == whole(text), repr(text)


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
@pytest.mark.parametrize("top", [1, 2, 300, 49408, 2**32])
def test_pages_round_trip(n, top):
    r = np.random.default_rng(n + top)
    ids = r.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
    ids[r.random(n) < 0.02] = 2**32 - 1
    raw = token_files.pack(ids)
    assert (token_files.unpack(raw) == ids).all() and len(token_files.unpack(raw)) == n
    assert (token_files.unpack(raw, n // 3, 2 * n // 3) == ids[n // 3:2 * n // 3]).all()


def test_outliers_do_not_widen_a_block():
    ids = np.arange(128, dtype=np.uint32) % 8
    with_outlier = ids.copy()
    with_outlier[5] = 40000
    assert len(token_files.pack(with_outlier)) == len(token_files.pack(ids)) + 5


def test_token_pages_against_whole_encoding(spark):
    table = corpus()
    whole = reference("word_bpe_49k.json")
    pages = token_files.write_token_pages(docs(spark, table), public_tokenizers.path("word_bpe_49k.json"), False)
    got = [(r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in token_files.read_token_pages(pages).collect()]
    assert sorted(map(str, [(d, ids) for d, _, ids in got])) == sorted(map(str, [(d, whole(t) + [1]) for d, t, *_ in table]))
    got.sort(key=lambda r: r[1])
    assert [g[0] for g in got] == sorted((r[0] for r in table), key=lambda i: (i is not None, i))
    assert [g[1] for g in got] == np.cumsum([0, *(len(g[2]) for g in got)])[:-1].tolist()
    assert token_files.read_token_pages(token_files.write_token_pages(docs(spark, []), public_tokenizers.path("word_bpe_49k.json"), False)).count() == 0


def test_best_two_fit_places_every_piece_and_beats_the_greedy_bin():
    lengths = np.array([70, 20, 55, 45, 30, 30, 25, 100, 1])
    bins, offsets = packing.best_two_fit(lengths, 100)
    sums = np.bincount(bins, lengths)
    assert sums.max() <= 100 and len(sums) == 4
    # 60 + 30 leaves 10; the two 20s fill what 30 leaves better
    bins, _ = packing.best_two_fit(np.array([60, 30, 20, 20]), 100)
    assert bins[0] == bins[2] == bins[3] != bins[1]
    r = np.random.default_rng(5)
    many = np.minimum(r.lognormal(5, 1, 5000).astype(int) + 1, 2048)
    bins, offsets = packing.best_two_fit(many, 2048)
    assert np.bincount(bins, many).max() <= 2048 and bins.max() + 1 <= many.sum() / 2048 * 1.01 + 1


def test_packed_pieces_against_whole_encoding(spark):
    table = corpus()
    whole = reference("byte_bpe_50k.json")
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.written(packing.encoded_pieces(docs(spark, table), path, True, with_ids=True), "test")
    places = packing.packed(pieces.drop("ids"))
    rows = places.collect()
    want = []
    for d, t, *_ in table:
        ids = np.array(whole(t) + [0], "<u4")
        first = len(ids) % 2048 or 2048
        for p, a in enumerate([0, *range(first, len(ids), 2048)]):
            b = first if p == 0 else a + 2048
            want.append((d, p, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(w[3] for w in want)
    assert len(sequences) <= total / 2048 + 2
    out = {r.sequence_id: len(r.ids) // 4 for r in packing.packed_ids(pieces, places).collect()}
    assert sum(out.values()) == total and len(out) == len(sequences)
    assert packing.packed_documents(docs(spark, [])).count() == 0


def test_encoder_takes_the_memory_it_is_asked_for():
    from lexanchor.llm import tokens as E

    path = public_tokenizers.path("byte_bpe_50k.json")
    small, usual = E.encoder(path, True, 80_000), E.encoder(path, True)
    assert (small.remembered, usual.remembered) == (80_000, E.REMEMBERED) and small.on_trial < usual.on_trial


def test_long_heads_are_encoded_but_not_kept():
    from lexanchor.llm import tokens as E

    path = public_tokenizers.path("byte_bpe_50k.json")
    e = E.Encoder(path, True)
    for text in ("漢字" * 500, "x" * 5000, "y" * 65 + " tail", "short head"):
        assert e.encode(text).tolist() == e.whole([text])[0]
    assert max(map(len, e.heads)) <= E.LONGEST_REMEMBERED and "short" in e.heads


@pytest.mark.parametrize("name,space,n", [(*VOCABULARIES[0], 2), (*VOCABULARIES[1], 5)])
def test_a_word_is_merged_once_whatever_stands_behind_it(name, space, n):
    e, whole, merged = Encoder(public_tokenizers.path(name), space), reference(name), []
    merge = e.merge
    e.merge = lambda piece: merged.append(piece) or merge(piece)
    text = "x élan élan, élan### élan&&&! Élan Élan. word word% word** (a) µÿ ÿ-ß\nélan word\nword"
    assert e.encode(text).tolist() == whole(text)
    assert len(set(merged)) == len(merged) and sum("lan" in p or "word" in p for p in merged) == n  # with a space in front, at a line's start, by case
    for text in ("x ΣΑΣ σας ΣΑΣ, σασ", "x ʼn İi İI, i̇", "a À À, à. Å Å"):
        assert e.encode(text).tolist() == whole(text)
