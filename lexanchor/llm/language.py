"""Hierarchical language identification.

The family of a language is predicted first (one linear support vector machine against the
rest for each family); within the family one machine for each pair of languages votes.
Features are hashed byte trigrams of the lower-cased text as shares of all its trigrams,
so a score is the mean of the weights over the whole text, computed in numpy.

The machines are fitted on at most ``SAMPLE`` training texts of a language (chosen by a
hash of the id), by dual coordinate descent on the driver; every text is predicted.

Null texts and texts without a letter get ``und`` and score 0, also where nothing can be
learned. Rows with a null language are predicted but not learned from. Ties go to the
language that comes first by name. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lexanchor.llm.common import batch_of, crc_mod, mix, query, rows, table

#: Training texts of one language.
SAMPLE = 400
FEATURES = 1 << 16
#: Positions that are weighed at once.
CHUNK = 1 << 20
EPOCHS, COST, SCALE = 30, 1.0, 100.0
#: Slope from a margin to a chance.
SLOPE = 4.0

# Families of languages by ISO 639-1 code. Other codes are a family together.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nl", "no", "sv", "yi"),
    "romance": ("ca", "co", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "uralic": ("et", "fi", "hu"),
    "hellenic": ("el",),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "semitic": ("am", "ar", "he", "mt"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "sinitic": ("zh",), "japonic": ("ja",), "koreanic": ("ko",),
    "austronesian": ("id", "jv", "mg", "ms", "tl"),
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}


@dataclass
class Model:
    """Languages by family, and a weight column and bias for each family and each pair."""

    families: list[tuple[str, list[str]]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    bias: np.ndarray


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _codes(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    x = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    x *= np.uint32(2654435761)
    return x >> np.uint32(16)


def _bytes(text: str) -> bytes:
    return b" " + text.lower().encode("utf-8", "surrogatepass") + b" "


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse trigram shares of the texts to learn from."""
    schema = pa.schema([("lang", pa.string()), ("at", pa.binary()), ("share", pa.binary())])
    for lang, text in rows(batches):
        if has_letter(text):
            counts = np.bincount(_codes(_bytes(text)), minlength=FEATURES)
            at = np.flatnonzero(counts)
            share = (counts[at] / counts.sum() * SCALE).astype(np.float32)
            yield batch_of(schema, [[lang], [at.astype(np.int32).tobytes()], [share.tobytes()]])


def support_vector_machine(xs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = EPOCHS, cost: float = COST) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine with hinge loss, by dual coordinate descent; classes weigh the same."""
    w, bias = np.zeros(FEATURES), 0.0
    alpha = np.zeros(len(y))
    share = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    norms = np.array([float(v @ v) + 1.0 for _, v in xs])
    order = np.argsort(mix(np.arange(len(y), dtype=np.uint64)))
    for _ in range(epochs):
        for i in order:
            at, v = xs[i]
            gradient = y[i] * (w[at] @ v + bias) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost * share[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[at] += step * v
                bias += step
                alpha[i] = new
    return w, bias


def fit(samples: list[tuple[str, np.ndarray, np.ndarray]]) -> Model | None:
    """A model from (language, feature numbers, shares)."""
    langs = sorted({s[0] for s in samples})
    if not langs:
        return None
    family = {lang: _FAMILY.get(lang.lower().split("-")[0], "other") for lang in langs}
    families = [(f, [x for x in langs if family[x] == f]) for f in sorted(set(family.values()))]
    pairs = [p for _, members in families for p in combinations(members, 2)]
    columns, biases = [], []
    for name, _ in families:
        y = np.array([1.0 if family[s[0]] == name else -1.0 for s in samples])
        w, b = support_vector_machine([s[1:] for s in samples], y) if len(families) > 1 else (np.zeros(FEATURES), 1.0)
        columns.append(w)
        biases.append(b)
    for one, two in pairs:
        own = [s for s in samples if s[0] in (one, two)]
        w, b = support_vector_machine([s[1:] for s in own], np.array([1.0 if s[0] == one else -1.0 for s in own]))
        columns.append(w)
        biases.append(b)
    return Model(families, pairs, np.stack(columns, axis=1).astype(np.float32), np.array(biases))


def _margins(texts: list[str], model: Model) -> np.ndarray:
    """Margins of every machine on each text; all bytes count, a chunk of positions at a time."""
    data = [_bytes(t) for t in texts]
    sums, sizes = np.zeros((len(data), model.weights.shape[1])), np.array([max(1, len(d) - 2) for d in data])
    held: list[int] = []
    size = 0

    def flush() -> None:
        joined = b"".join(data[i] for i in held)
        codes = _codes(joined)
        starts = np.cumsum([0, *(len(data[i]) for i in held)])
        weights = model.weights[codes]
        for end in starts[1:-1]:  # trigrams that reach into the next text
            weights[end - 2:end] = 0
        sums[held] = np.add.reduceat(weights, starts[:-1], axis=0)

    for i, d in enumerate(data):
        if len(d) > CHUNK:
            for at in range(0, len(d) - 2, CHUNK):
                sums[i] += model.weights[_codes(d[at:at + CHUNK + 2])].sum(axis=0)
        else:
            held.append(i)
            size += len(d)
            if size > CHUNK:
                flush()
                held, size = [], 0
    if held:
        flush()
    return sums / sizes[:, None] * SCALE + model.bias


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-SLOPE * np.clip(margin, -50, 50)))


def predict(texts: list[str], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and chance of each text (with a letter)."""
    margins = _margins(texts, model)
    family = _chance(margins[:, :len(model.families)])
    family /= family.sum(axis=1, keepdims=True)
    best = family.argmax(axis=1)
    langs = [""] * len(texts)
    scores = family[np.arange(len(texts)), best]
    for f, (_, members) in enumerate(model.families):
        at = np.flatnonzero(best == f)
        votes = np.zeros((len(at), len(members)))
        for j, (one, two) in enumerate(model.pairs):
            if one in members:
                p = _chance(margins[at, len(model.families) + j])
                votes[:, members.index(one)] += p
                votes[:, members.index(two)] += 1 - p
        share = votes / np.maximum(1, len(members) - 1) if len(members) > 1 else np.ones((len(at), 1))
        top = share.argmax(axis=1) if len(at) else np.zeros(0, int)
        for i, t in zip(at, top, strict=True):
            langs[i] = members[t]
        scores[at] *= share[np.arange(len(at)), top]
    return langs, scores


def _predict(model_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of.value
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = part.column("text").to_pylist()
                langs, scores = ["und"] * len(texts), np.zeros(len(texts))
                known = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
                if known:
                    found, chances = predict([texts[i] for i in known], model)
                    scores[known] = chances
                    for i, lang in zip(known, found, strict=True):
                        langs[i] = lang
                cols = [c for c, n in zip(part.columns, part.schema.names, strict=True) if n != "text"]
                names = [n for n in part.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(langs, pa.string()), pa.array(scores)], names=[*names, "lang_pred", "score"])

    return run


def learn(docs: DataFrame, train: Column, sample: int = SAMPLE) -> Model | None:
    """A model from the rows of (doc_id, text, lang) where ``train`` holds."""
    usable = docs.filter(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = usable.select("doc_id", "lang").distinct().withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= sample).select("doc_id", "lang")
    # at most ``sample`` ids of a language
    chosen = usable.select("doc_id", "lang", "text").join(F.broadcast(ids), ["doc_id", "lang"]).dropDuplicates(["doc_id", "lang"])
    got = chosen.select("lang", "text").mapInArrow(_features, "lang string, at binary, share binary").collect()
    return fit(sorted(((r.lang, np.frombuffer(r.at, np.int32), np.frombuffer(r.share, np.float32)) for r in got), key=lambda s: (s[0], s[1].tobytes())))


def with_language(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, text) with lang_pred and score instead of the text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_predict(sent), "doc_id long, held_out boolean, lang_pred string, score double")


@query("op7_language_id")
def op7(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(3) == 1
    model = learn(docs.select("doc_id", "text", "lang"), ~held_out)
    return with_language(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
