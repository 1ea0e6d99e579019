"""Document quality from labelled lines: a linear-chain conditional random field.

A document is a chain of lines, each good or bad. A line's potential comes from its own
words and measures and from those of the lines before and after it; a table of transitions
says how often good and bad lines follow each other. Forward and backward messages give the
marginal chance that a line is good, and the mean of these, weighted by the lines' lengths
and calibrated, is the quality of the document.

Only documents carry labels. A first fit takes every line by itself, with its document's
label; lines of bad documents that it finds good are then marked good, up to half of the
document, and the field is fitted to these lines, so that it learns where bad lines begin
and end. The fit uses at most ``SAMPLE_GOOD`` and ``SAMPLE_BAD`` labelled documents (the first by a hash of
the id) with at most ``SAMPLE_WORDS`` words each, in consecutive lines; as numbers of words
and measures, not as texts. Every document is scored whole.

Lines without a word are passed over; a text without any word, or a null text, is one empty
line. Lines of more than ``LONGEST`` characters are cut after so many. A document with
conflicting labels counts as bad; labels without a document or with a null mark are left
out. Without labelled documents of both kinds every score is 0.5. Repeated rows get equal
scores; of rows that share a labelled id, the greatest text is learned from. Further columns
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lexanchor.llm.common import crc_mod, query, table

SAMPLE_GOOD, SAMPLE_BAD, SAMPLE_WORDS = 3000, 1500, 1000
LONGEST = 2000
THRESHOLD = 0.3
#: Words and shapes are hashed to so many numbers; those in fewer documents of the sample weigh nothing.
HASHED, MIN_DOCS = 2 ** 18, 4
STEPS, RATE, DECAY = 50, 0.2, 2e-4
REMEMBERED = 200_000
#: Texts whose lines are measured together.
SLICE = 256
SYMBOLS = frozenset("#*$%&|<>{}[]\\/_=~^@+")
#: Measures of a line, each in one of ``BUCKETS`` buckets.
MEASURES = ("words", "letters", "upper", "digits", "symbols", "marks", "word_length", "distinct", "end", "again", "stutter", "bangs", "one")
BUCKETS = 12


@dataclass
class Words:
    """What is known of each word met so far: its two hashed numbers and its counts of kinds of characters."""

    at: dict[str, int] = field(default_factory=dict)
    rows: np.ndarray = field(default_factory=lambda: np.zeros((0, 9), np.int64))
    fresh: list[tuple[int, ...]] = field(default_factory=list)

    def find(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each word the row that it has in a table of counts and hashed numbers, and the table."""
        found = list(map(self.at.get, words))
        if None in found:
            for w in words:
                if w not in self.at:
                    self._add(w)
            found = list(map(self.at.get, words))
        if self.fresh:
            self.rows, self.fresh = np.concatenate([self.rows, np.array(self.fresh, np.int64)]), []
        return np.array(found, np.int64), self.rows

    def _add(self, word: str) -> None:
        self.at[word] = len(self.at)
        kinds = word.translate(_KINDS)
        upper, lower, digits = kinds.count("A"), kinds.count("a"), kinds.count("0")
        other = len(word) - upper - lower - digits
        symbols = sum(c in SYMBOLS for c in word) if other else 0
        self.fresh.append((len(word), upper + lower, upper, digits, symbols, other - symbols, word.count("!") if other else 0,
                           _hashed("w", word.lower()), _hashed("s", shape(kinds))))

    def forget(self) -> None:
        """Keeps memory bounded; numbers given out before do not hold after."""
        if len(self.at) > REMEMBERED:
            self.at, self.rows = {}, self.rows[:0]


class _Kinds(dict):
    """Of a character its kind: A, a or 0, or the character itself."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        kind = self[code] = ("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c
        return kind


_KINDS = _Kinds()
_RUN = re.compile(r"(.)\1+", re.DOTALL)


def shape(kinds: str) -> str:
    """Kinds of characters in a row, each once: 'Ab12!!' has the shape 'Aa0!'."""
    return _RUN.sub(r"\1", kinds)[:12]


def _hashed(kind: str, word: str) -> int:
    return len(MEASURES) * BUCKETS + zlib.crc32(f"{kind}{word}".encode("utf-8", "replace")) % HASHED


def lines(text: str | None) -> Iterator[tuple[int, list[str]]]:
    """Length and words of each line that has a word; at least one line."""
    found = False
    for line in (text or "").split("\n"):
        for at in range(0, len(line), LONGEST):
            words = line[at:at + LONGEST].split()
            if words:
                found = True
                yield min(LONGEST, len(line) - at), words
    if not found:
        yield 1, []


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """0 for none, then tenths of what there is, rounded up."""
    return np.where(part > 0, np.minimum(1 + part * 10 // np.maximum(whole, 1), BUCKETS - 1), 0)


@dataclass
class Lines:
    """Lines of several texts, one after the other: texts' numbers of lines, lines' lengths, numbers of words, hashed words, measures."""

    n_lines: np.ndarray
    length: np.ndarray
    n_words: np.ndarray
    numbers: np.ndarray
    measures: np.ndarray


def measured(words: Words, texts: list[list[tuple[int, list[str]]]]) -> Lines:
    n_lines = np.array([len(t) for t in texts])
    flat = [x for t in texts for x in t]
    n_words = np.array([len(w) for _, w in flat])
    at, known = words.find([w for _, ws in flat for w in ws])
    of_line = np.repeat(np.arange(len(flat)), n_words)
    chars, letters, upper, digits, symbols, marks, bangs = (np.bincount(of_line, known[at, c], len(flat)).astype(np.int64) for c in range(7))
    stutter = np.bincount(of_line[1:][(at[1:] == at[:-1]) & (of_line[1:] == of_line[:-1])], minlength=len(flat))
    distinct = np.array([len(set(w)) for _, w in flat])
    again = np.zeros(len(flat), np.int64)
    k = 0
    for t in texts:
        seen = set()
        for _, w in t:
            key = hash(tuple(w))
            again[k] = key in seen
            seen.add(key)
            k += 1
    end = np.array([0 if not w else 1 if w[-1][-1] in ".!?…" else 2 if w[-1][-1] in ":;,)\"'" else 3 if w[-1][-1].isalnum() else 4 for _, w in flat])
    found = [np.minimum(np.log2(n_words + 1).astype(np.int64), BUCKETS - 1), _share(letters, chars), _share(upper, letters), _share(digits, chars),
             _share(symbols, chars), _share(marks, chars), np.minimum(chars // np.maximum(n_words, 1), BUCKETS - 1), _share(distinct, n_words), end, again,
             _share(stutter, n_words), _share(bangs, chars), np.zeros(len(flat), np.int64)]
    measures = np.stack(found, axis=1) + np.arange(len(MEASURES)) * BUCKETS
    return Lines(n_lines, np.array([n for n, _ in flat]), n_words, known[at, 7:], measures)


@dataclass
class Field:
    """``weights`` has for each feature what it says of its own line, of the line after it and of the line before it."""

    weights: np.ndarray
    transition: np.ndarray
    edge: np.ndarray
    calibration: tuple[float, float] = (1.0, 0.0)

    def potentials(self, x: Lines) -> np.ndarray:
        """Log-odds of good for each line without the chain."""
        return _shifted(_line_sums(self.weights, x), x.n_lines, self.edge)

    def marginals(self, x: Lines) -> np.ndarray:
        """Chance of good for each line."""
        out = self.potentials(x)
        for stop, n in zip(np.cumsum(x.n_lines), x.n_lines, strict=True):
            out[stop - n:stop] = _logistic(chain_log_odds(out[stop - n:stop].tolist(), self.transition))
        return out

    def document_scores(self, x: Lines) -> np.ndarray:
        of_text = np.repeat(np.arange(len(x.n_lines)), x.n_lines)
        mean = np.bincount(of_text, self.marginals(x) * x.length) / np.bincount(of_text, x.length)
        slope, shift = self.calibration
        return _logistic(slope * _logit(mean) + shift)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _line_sums(weights: np.ndarray, x: Lines) -> np.ndarray:
    """For each line what its measures and the mean of its words say."""
    sums = np.zeros((len(x.n_words), weights.shape[1]))
    stop = np.r_[0, np.cumsum(x.n_words)]
    for a in range(0, len(x.n_words), 4096):  # bounds the rows of weights that are gathered at a time
        b = min(a + 4096, len(x.n_words))
        got = weights[x.numbers[stop[a]:stop[b], 0]] + weights[x.numbers[stop[a]:stop[b], 1]]
        of = np.repeat(np.arange(b - a), x.n_words[a:b])
        for c in range(weights.shape[1]):
            sums[a:b, c] = np.bincount(of, got[:, c], b - a)
    return sums / np.maximum(x.n_words, 1)[:, None] + weights[x.measures].sum(axis=1)


def _shifted(sums: np.ndarray, n_lines: np.ndarray, edge: np.ndarray) -> np.ndarray:
    stop = np.cumsum(n_lines)
    first, last = np.zeros(len(sums), bool), np.zeros(len(sums), bool)
    first[stop - n_lines] = last[stop - 1] = True
    before = np.where(first, edge[0], np.r_[0, sums[:-1, 1]])
    after = np.where(last, edge[1], np.r_[sums[1:, 2], 0])
    return sums[:, 0] + before + after


def chain_log_odds(own: list[float], transition: np.ndarray) -> np.ndarray:
    """Log-odds of state 1 for each place of a chain: own potentials, ``transition[a, b]`` for a followed by b."""
    t = np.exp(transition)
    (t00, t01), (t10, t11) = t.tolist()
    n = len(own)
    forward, backward = [0.0] * n, [0.0] * n
    for i in range(1, n):
        odds = exp(max(-30.0, min(30.0, own[i - 1] + forward[i - 1])))
        forward[i] = log((t11 * odds + t01) / (t10 * odds + t00))
    for i in range(n - 2, -1, -1):
        odds = exp(max(-30.0, min(30.0, own[i + 1] + backward[i + 1])))
        backward[i] = log((t11 * odds + t10) / (t01 * odds + t00))
    return np.array(own) + np.array(forward) + np.array(backward)


def _chain_gradient(own: np.ndarray, y: np.ndarray, n_lines: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all chains, and observed less expected transitions; the longest chains first, a place of all chains at a time."""
    start = np.cumsum(n_lines) - n_lines
    longest = int(n_lines.max())
    active = [int((n_lines > j).sum()) for j in range(longest)]
    t = np.exp(transition)
    clip = lambda z: np.exp(np.clip(z, -30, 30))
    forward, backward = np.zeros(len(own)), np.zeros(len(own))
    for j in range(1, longest):
        at = start[:active[j]] + j
        odds = clip(own[at - 1] + forward[at - 1])
        forward[at] = np.log((t[1, 1] * odds + t[0, 1]) / (t[1, 0] * odds + t[0, 0]))
    for j in range(longest - 2, -1, -1):
        at = start[:active[j + 1]] + j
        odds = clip(own[at + 1] + backward[at + 1])
        backward[at] = np.log((t[1, 1] * odds + t[1, 0]) / (t[0, 1] * odds + t[0, 0]))
    p = _logistic(own + forward + backward)
    inner = np.ones(len(own), bool)
    inner[start] = False
    at = np.flatnonzero(inner)
    if not len(at):
        return p, np.zeros((2, 2))
    a, b = clip(own[at - 1] + forward[at - 1]), clip(own[at] + backward[at])
    joint = np.stack([t[0, 0] * np.ones_like(a), t[0, 1] * b, t[1, 0] * a, t[1, 1] * a * b])
    expected = (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
    observed = np.bincount((2 * y[at - 1] + y[at]).astype(np.int64), minlength=4).reshape(2, 2)
    return p, observed - expected


def _fit_field(x: Lines, y: np.ndarray, size: int, steps: int, alone: bool) -> Field:
    """Adam on the likelihood of the line labels; chains are in falling order of length. ``alone`` takes every line by itself."""
    f = Field(np.zeros((size, 3)), np.zeros((2, 2)), np.zeros(2))
    params = [f.weights, f.transition, f.edge]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    of_word = np.repeat(np.arange(len(x.n_words)), x.n_words)
    share = 1 / np.maximum(x.n_words, 1)
    stop = np.cumsum(x.n_lines)
    first, last = stop - x.n_lines, stop - 1
    used, place = np.unique(x.numbers, return_inverse=True)
    place = place.reshape(x.numbers.shape)
    for step in range(1, steps + 1):
        own = f.potentials(x)
        p, pairs = _chain_gradient(own, y, x.n_lines, f.transition)
        slope = y - p
        before, after = slope.copy(), slope.copy()
        before[first], after[last] = 0, 0
        # a line's features speak for itself, for the next line and for the one before
        by = np.stack([slope, np.r_[before[1:], 0], np.r_[0, after[:-1]]], axis=1)
        g = np.zeros_like(f.weights)
        for c in range(1 if alone else 3):
            per = by[:, c]
            on_word = (per * share)[of_word]
            g[used, c] += sum(np.bincount(place[:, k], on_word, len(used)) for k in (0, 1))
            g[:, c] += np.bincount(x.measures.ravel(), np.repeat(per, len(MEASURES)), size)
        g[-1] = 0  # of the numbers that are too rare to weigh
        grads = [g, 0 * pairs, np.zeros(2)] if alone else [g, pairs, np.array([slope[first].sum(), slope[last].sum()])]
        for param, grad, (m, v) in zip(params, grads, moments, strict=True):
            grad = grad / len(y) - DECAY * param
            m *= 0.9
            m += 0.1 * grad
            v *= 0.999
            v += 0.001 * grad * grad
            param += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return f


def relabelled(p: np.ndarray, y: np.ndarray, x: Lines) -> np.ndarray:
    """Lines of bad documents that look good become good, the likeliest first, up to half of the document's length."""
    out = y.copy()
    for stop, n in zip(np.cumsum(x.n_lines), x.n_lines, strict=True):
        part = slice(stop - n, stop)
        if n > 1 and not y[part].any():
            order = np.argsort(-p[part], kind="stable")
            taken = np.cumsum(x.length[part][order]) <= x.length[part].sum() / 2
            good = order[taken & (p[part][order] >= 0.5)]
            out[stop - n + good] = 1
    return out


def _calibrated(mean: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope (never negative) and shift of a logistic regression of the label on the log-odds of the mean."""
    z = _logit(mean)
    slope, shift = 1.0, 0.0
    for _ in range(25):
        p = _logistic(slope * z + shift)
        w = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((label - p) * z).sum() - 1e-2 * (slope - 1), (label - p).sum()])
        h = np.array([[(w * z * z).sum() + 1e-2, (w * z).sum()], [(w * z).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        slope, shift = max(slope + float(step[0]), 0.05), shift + float(step[1])
    return slope, shift


def fit(x: Lines, label: np.ndarray) -> Field | None:
    """A field from measured texts and their labels."""
    if not len(label) or label.min() == label.max():
        return None
    order = np.argsort(-x.n_lines, kind="stable")
    x, label = _taken(x, order), label[order].astype(np.float64)
    base = len(MEASURES) * BUCKETS
    # numbers in use, by documents that hold them; the others share one number whose weight stays 0
    of_text = np.repeat(np.repeat(np.arange(len(label)), x.n_lines), x.n_words)
    held = np.unique(np.tile(of_text, 2) * (base + HASHED) + x.numbers.T.ravel()) % (base + HASHED)
    kept, n_docs = np.unique(held, return_counts=True)
    kept = kept[n_docs >= MIN_DOCS]
    place = np.searchsorted(kept, x.numbers)
    known = (place < len(kept)) & (kept[np.minimum(place, max(len(kept) - 1, 0))] == x.numbers if len(kept) else False)
    size = base + len(kept) + 1
    small = Lines(x.n_lines, x.length, x.n_words, np.where(known, base + place, size - 1), x.measures)
    y = np.repeat(label, x.n_lines)
    alone = _fit_field(small, y, size, STEPS, alone=True)
    f = _fit_field(small, relabelled(alone.marginals(small), y, small), size, STEPS, alone=False)
    full = np.zeros((base + HASHED, 3))
    full[:base], full[kept] = f.weights[:base], f.weights[base:-1]
    f = Field(full, f.transition, f.edge)
    of_text = np.repeat(np.arange(len(label)), x.n_lines)
    mean = np.bincount(of_text, f.marginals(x) * x.length) / np.bincount(of_text, x.length)
    f.calibration = _calibrated(mean, label)
    return f


def _taken(x: Lines, order: np.ndarray) -> Lines:
    """Texts in another order."""
    stop = np.cumsum(x.n_lines)
    at = np.concatenate([np.arange(stop[i] - x.n_lines[i], stop[i]) for i in order])
    word_stop = np.cumsum(x.n_words)
    words = np.concatenate([np.arange(word_stop[i] - x.n_words[i], word_stop[i]) for i in at]).astype(np.int64)
    return Lines(x.n_lines[order], x.length[at], x.n_words[at], x.numbers[words], x.measures[at])


def window(text: list[tuple[int, list[str]]], words: int = SAMPLE_WORDS) -> list[tuple[int, list[str]]]:
    """Consecutive lines around the middle with at most so many words; one line at least."""
    total = sum(len(w) for _, w in text)
    before, out = 0, []
    for length, w in text:
        if before >= (total - words) / 2 and (not out or sum(len(x) for _, x in out) + len(w) <= words):
            out.append((length, w))
        elif out:
            break
        before += len(w)
    return out or text[-1:]


_PACKED = "quality int, n_lines int, length binary, n_words binary, numbers binary, measures binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words()
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for _, texts in enumerate_chunks(batch.column("text").to_pylist()):
            words.forget()
            x = measured(words, [window(list(lines(t))) for t in texts])
            line, word = np.r_[0, np.cumsum(x.n_lines)], np.r_[0, np.cumsum(x.n_words)]
            for i, n in enumerate(x.n_lines):
                at, of = slice(line[i], line[i + 1]), slice(word[line[i]], word[line[i + 1]])
                for col, v in zip(out, (int(n), x.length[at].astype(np.int32).tobytes(), x.n_words[at].astype(np.int32).tobytes(),
                                        x.numbers[of].astype(np.int32).tobytes(), x.measures[at].astype(np.int16).tobytes()), strict=True):
                    col.append(v)
        kinds = (pa.int32(), *[pa.binary()] * 4)
        yield pa.RecordBatch.from_arrays([batch.column("quality"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
                                         names=["quality", "n_lines", "length", "n_words", "numbers", "measures"])


def learn(docs: DataFrame, labels: DataFrame, train: Column, sample: tuple[int, int] = (SAMPLE_BAD, SAMPLE_GOOD)) -> Field | None:
    """A field from labelled rows of (doc_id, text) where ``train`` holds."""
    marked = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & train).groupBy("doc_id").agg(
        F.min((F.col("quality") > 0).cast("int")).alias("quality"))
    marked = marked.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    first = [marked.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for q, n in enumerate(sample)]
    chosen = F.broadcast(first[0].unionByName(first[1]))  # at most ``sample`` ids of either label
    texts = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.first("quality").alias("quality"))
    got = texts.orderBy("doc_id").select("quality", "text").mapInArrow(_pack, _PACKED).collect()
    if not got:
        return None
    joined = lambda name, kind: np.concatenate([np.frombuffer(r[name], kind) for r in got]).astype(np.int64)
    x = Lines(np.array([r.n_lines for r in got]), joined("length", np.int32), joined("n_words", np.int32),
              joined("numbers", np.int32).reshape(-1, 2), joined("measures", np.int16).reshape(-1, len(MEASURES)))
    return fit(x, np.array([r.quality for r in got]))


def _score(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Field | None = sent.value
        words = Words()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                scores = np.full(part.num_rows, 0.5)
                if model is not None:
                    for i, text in enumerate_chunks(part.column("text").to_pylist()):
                        words.forget()
                        scores[i:i + len(text)] = model.document_scores(measured(words, [list(lines(t)) for t in text]))
                keep = [n for n in part.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in keep), pa.array(scores, pa.float64())], names=[*keep, "score"])

    return run


def enumerate_chunks(texts: list[str | None], chars: int = 2_000_000) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts with about so many characters, or one longer text, and where they start."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        if i > start and total + len(t or "") > chars:
            yield start, texts[start:i]
            start, total = i, 0
        total += len(t or "")
    if start < len(texts):
        yield start, texts[start:]


def with_scores(docs: DataFrame, model: Field | None) -> DataFrame:
    """(doc_id, held_out, text) with score instead of the text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size
    return docs.mapInArrow(_score(sent), "doc_id long, held_out boolean, score double")


def line_marginals(model: Field, text: str | None) -> list[tuple[list[str], float]]:
    """The words of each line and its chance of being good."""
    found = list(lines(text))
    return [(w, float(p)) for (_, w), p in zip(found, model.marginals(measured(Words(), [found])), strict=True)]


@query("op12_line_quality")
def op12(spark, sf_dir) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc_mod(5) == 0
    model = learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    out = with_scores(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
