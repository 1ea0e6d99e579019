"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's chance of being toxic is logistic in the
words it holds, a document's chance is the noisy-or of its sentences, and only document
labels are learned from: the gradient of the document's likelihood goes to the sentences
by their share in it. The fitted sentence scores then locate the offending sentences. A word counts as
itself and as its beginnings of four, five and six letters, which inflected forms share.

The weights are fitted with Adam on at most ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` labelled
documents (the first by a hash of the id, spread over the corpus) on the driver, over
words that occur in at least ``MIN_DOCS`` of them; every document is scored whole.

Null and empty texts have no sentence and score 0. A document with conflicting labels
counts as toxic; labels without a document or with a null mark are left out. Without
labelled documents of both kinds every score is 0. Repeated rows get equal scores; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lexanchor.llm.common import crc_mod, first_by_hash, query, table

SAMPLE_TOXIC, SAMPLE_CLEAN = 2000, 6000
MIN_DOCS = 3
STEPS, RATE, DECAY = 150, 0.1, 5e-4
STEMS = (4, 5, 6)
#: Words whose weight a worker remembers.
REMEMBERED = 300_000
#: Documents with this score or more are predicted toxic; sentences with it offend.
THRESHOLD = 0.3
L1 = 2e-3
#: Sentences of more words are cut after so many.
LONGEST = 40
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")


@dataclass
class Model:
    words: dict[str, float]
    bias: float
    memory: dict[str, float] = field(default_factory=dict)

    def weight(self, word: str) -> float:
        found = self.memory.get(word)
        if found is None:
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            found = self.memory[word] = sum(self.words.get(f, 0.0) for f in features(word))
        return found

    def sentence_scores(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Spans of the sentences and their chances."""
        spans, sums = [], []
        weight = self.weight
        for start, end, words in sentences(text):
            spans.append((start, end))
            sums.append(sum(map(weight, words)))
        return spans, _logistic(np.array(sums) + self.bias)

    def score(self, text: str | None) -> tuple[float, int]:
        """The document's chance and how many sentences offend."""
        if not text:
            return 0.0, 0
        _, p = self.sentence_scores(text)
        return noisy_or(p), int((p >= THRESHOLD).sum())


def sentences(text: str) -> Iterator[tuple[int, int, set[str]]]:
    """Start, end and distinct lower-cased words of each sentence; long ones are cut."""
    for m in _SENTENCE.finditer(text):
        words = _WORD.findall(m.group().lower())
        if len(words) <= LONGEST:
            yield (*m.span(), set(words))
            continue
        places = [w.span() for w in _WORD.finditer(text, *m.span())]
        for at in range(0, len(places), LONGEST):
            part = places[at:at + LONGEST]
            yield part[0][0], part[-1][1], {text[a:b].lower() for a, b in part}


def features(word: str) -> list[str]:
    return [word, *(word[:k] + "-" for k in STEMS if len(word) >= k)]


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def noisy_or(p: np.ndarray) -> float:
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()))


def fit(bags: Iterable[tuple[int, list[set[str]]]]) -> Model | None:
    """A model from (label, sentences as words)."""
    numbers: dict[str, int] = {}
    labels, words, lengths, sizes = [], [], [], []
    for y, bag in bags:
        if bag:
            labels.append(float(y))
            words.append(np.array([numbers.setdefault(w, len(numbers)) for s in bag for w in sorted(s)], np.int32))
            lengths.append([len(s) for s in bag])
            sizes.append(len(bag))
    labels = np.array(labels)
    if not len(labels) or labels.min() == labels.max():
        return None
    # features of each distinct word, then the documents that hold a feature
    names: dict[str, int] = {}
    of_word = [[names.setdefault(f, len(names)) for f in features(w)] for w in numbers]
    n_docs = np.zeros(len(names), np.int64)
    for held in words:
        n_docs[list({f for w in np.unique(held) for f in of_word[w]})] += 1
    kept = np.cumsum(n_docs >= MIN_DOCS) - 1
    owner = np.repeat(np.arange(len(of_word)), [len(f) for f in of_word])
    feature = np.array([f for fs in of_word for f in fs], np.int64)
    often = n_docs[feature] >= MIN_DOCS
    owner, feature = owner[often], kept[feature[often]]
    n_features = int(kept[-1]) + 1 if len(kept) else 0
    word = np.concatenate(words)
    sentence = np.repeat(np.arange(sum(sizes)), np.concatenate(lengths))
    bag = np.repeat(np.arange(len(labels)), sizes)
    x = np.zeros(n_features + 1)
    x[-1] = -4.0
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, STEPS + 1):
        by_word = np.bincount(owner, x[feature], len(of_word))
        p = _logistic(np.bincount(sentence, by_word[word], len(bag)) + x[-1])
        clean = np.exp(np.bincount(bag, np.log1p(-np.minimum(p, 1 - 1e-12)), len(labels)))
        toxic = np.maximum(1 - clean, 1e-9)
        # derivative of the log-likelihood by each sentence's logit
        slope = p * np.where(labels[bag] > 0, (clean / toxic)[bag], -1.0)
        on_word = np.bincount(word, slope[sentence], len(of_word))
        g = np.append(np.bincount(feature, on_word[owner], n_features), slope.sum()) / len(labels)
        g[:-1] -= DECAY * x[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x += RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        x[:-1] = np.sign(x[:-1]) * np.maximum(np.abs(x[:-1]) - RATE * L1, 0)
    return Model({f: float(x[kept[i]]) for f, i in names.items() if n_docs[i] >= MIN_DOCS and abs(x[kept[i]]) > 1e-3}, float(x[-1]))


def learn(docs: DataFrame, labels: DataFrame, train: Column, sample: tuple[int, int] = (SAMPLE_CLEAN, SAMPLE_TOXIC)) -> Model | None:
    """A model from labelled rows of (doc_id, text) where ``train`` holds."""
    marked = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & train).groupBy("doc_id").agg(F.max(F.col("toxic") > 0).alias("toxic"))
    chosen = first_by_hash(marked, "toxic", {True: sample[1], False: sample[0]}, "doc_id").select("doc_id", "toxic")
    # at most ``sample`` ids of either label; of a repeated id the least text
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    # a part of the texts at a time; the fit keeps the numbers of their words only
    rows = texts.orderBy("doc_id").toLocalIterator()
    return fit((int(r.toxic), [words for _, _, words in sentences(r.text or "")]) for r in rows)


def _score(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                got = [model.score(t) if model else (0.0, 0) for t in part.column("text").to_pylist()]
                keep = [n for n in part.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in keep), pa.array([s for s, _ in got], pa.float64()), pa.array([n for _, n in got], pa.int32())],
                    names=[*keep, "score", "n_offending"])

    return run


def _locate(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = sent.value
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if text and model:
                    spans, p = model.sentence_scores(text)
                    for i in np.flatnonzero(p >= THRESHOLD):
                        for col, v in zip(out, (doc_id, *spans[i], float(p[i])), strict=True):
                            col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["doc_id", "from", "until", "score"])

    return run


def with_scores(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, text) with score and n_offending instead of the text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's words
    return docs.mapInArrow(_score(sent), "doc_id long, held_out boolean, score double, n_offending int")


def offending_sentences(docs: DataFrame, model: Model | None) -> DataFrame:
    """Character spans of the sentences of (doc_id, text) that offend."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(_locate(sent), "doc_id long, from long, until long, score double")


@query("op5_toxicity")
def op5(spark, sf_dir) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc_mod(4) == 2
    model = learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    out = with_scores(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_offending")
