"""URL filter by the ratio of two character language models.

Rules of a host and a path prefix decide first: a rule fits its host and all subdomains if
the path starts with its own; the longest one wins. The other URLs are judged by two
variable-order Markov models over characters, one of URLs that rules accept and one of
those they reject. A model keeps the contexts of up to ``ORDER`` characters it has seen at
least twice and smooths by Witten-Bell, down to equal chances. The difference of the
log-likelihoods, divided by the length, is compared with a threshold that is calibrated on
URLs kept out of the counts: the one with the best balanced accuracy.

The models learn from every distinct URL that a rule decides: every ``HOLD_OUT``-th, by a
hash, calibrates, the others are counted. Runs of characters are counted in tasks by a
64-bit hash and summed by a shuffle; held-out scores reach the driver as counts by bins of
1 / ``BINS``. A model has two numbers for each run of up to ``ORDER`` + 1 characters that it
keeps, so it grows with the different runs, not with the URLs. Null URLs and those without ``://`` have an empty host and path; they are
judged like any other text (null: empty). With no accepted or no rejected URLs to learn
from, what no rule decides is allowed. Ties with the threshold are allowed. Repeated rows
get equal verdicts; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lexanchor.llm.common import LOWER, UPPER, mix, query, table, written_few

ORDER = 5
#: Every so many-th URL calibrates the threshold.
HOLD_OUT = 5
#: Bins of held-out scores for a difference of 1 in log-likelihood a character.
BINS = 1 << 14
#: (verdict, host, path)
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    after = F.substring(url, F.length(rest) + 4, F.length(url))
    host = F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def with_rule(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Adds host, path, rule and the rule's verdict (null where none fits)."""
    host, path = host_and_path(F.col("url"))
    df = pages.withColumns({"host": host, "path": path})
    rule = verdict = None
    for kind, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2])):
        fits = ((F.col("host") == h) | F.endswith("host", F.lit("." + h))) & F.startswith("path", F.lit(p))
        rule = F.when(fits, F.lit(h + p)) if rule is None else rule.when(fits, F.lit(h + p))
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    none = F.lit(None).cast("string")
    return df.withColumns({"rule": none if rule is None else rule, "rule_verdict": none if verdict is None else verdict})


@dataclass
class MarkovModel:
    """Log chances of seen characters after seen contexts, and what a context leaves to its shorter one."""

    order: int = ORDER
    seen: dict[str, dict[str, float]] = field(default_factory=dict)
    left: dict[str, float] = field(default_factory=dict)

    @classmethod
    def fitted(cls, texts: list[str], order: int = ORDER) -> MarkovModel:
        counts: dict[str, Counter] = defaultdict(Counter)
        for text in texts:
            whole = "\x02" + text + "\x03"
            for i in range(1, len(whole)):
                for k in range(min(order, i) + 1):
                    counts[whole[i - k:i]][whole[i]] += 1
        model = cls(order)
        for context in sorted(counts, key=len):  # shorter contexts first: longer ones rest on them
            nexts = counts[context]
            total, kinds = sum(nexts.values()), len(nexts)
            if total < 2 and context:
                continue
            model.left[context] = math.log(kinds / (total + kinds))
            shorter = context[1:]
            model.seen[context] = {
                c: math.log((n + kinds * math.exp(model.log_chance(shorter, c) if context else -math.log(256))) / (total + kinds)) for c, n in nexts.items()}
        return model

    def log_chance(self, context: str, char: str) -> float:
        left = 0.0
        while True:
            nexts = self.seen.get(context)
            if nexts is not None:
                known = nexts.get(char)
                if known is not None:
                    return left + known
                left += self.left[context]
            if not context:
                return left - math.log(256)
            context = context[1:]

    def log_likelihood(self, text: str) -> float:
        whole = "\x02" + text + "\x03"
        return sum(self.log_chance(whole[max(0, i - self.order):i], whole[i]) for i in range(1, len(whole)))


@dataclass
class UrlModel:
    accepted: MarkovModel
    rejected: MarkovModel
    threshold: float = 0.0

    def score(self, url: str) -> float:
        """Difference of log-likelihoods for each character and the end."""
        return (self.accepted.log_likelihood(url) - self.rejected.log_likelihood(url)) / (len(url) + 1)


def best_threshold(good: list[float], bad: list[float]) -> float:
    """The middle of the gap between scores that gives the best balanced accuracy."""
    if not good or not bad:
        return 0.0
    scores = np.array(good + bad)
    is_good = np.r_[np.ones(len(good)), np.zeros(len(bad))]
    order = np.argsort(scores, kind="stable")
    scores, is_good = scores[order], is_good[order]
    below_bad, below_good = np.r_[0, np.cumsum(1 - is_good)], np.r_[0, np.cumsum(is_good)]
    value = below_bad / len(bad) + (len(good) - below_good) / len(good)
    ok = np.r_[True, scores[1:] > scores[:-1], True]
    at = int(np.where(ok, value, -1).argmax())
    if at == 0:
        return float(scores[0])
    return float(scores[at - 1] + 1e-9 if at == len(scores) else (scores[at - 1] + scores[at]) / 2)


def fit(accepted: list[str], rejected: list[str]) -> UrlModel | None:
    """A model from URLs of both kinds, each in a fixed order."""
    if not accepted or not rejected:
        return None
    parts = [([u for i, u in enumerate(x) if i % HOLD_OUT or len(x) < HOLD_OUT], x[::HOLD_OUT]) for x in (accepted, rejected)]
    model = UrlModel(*(MarkovModel.fitted(learn) for learn, _ in parts))
    model.threshold = best_threshold(*([model.score(u) for u in test] for _, test in parts))
    return model


def _runs(texts: list[str], order: int = ORDER) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length of context, the longest first: rows, places (numbered over all texts), hashes of the contexts and of the runs they begin."""
    whole = "".join("\x02" + t + "\x03" for t in texts)
    code = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    sizes = np.array([len(t) + 2 for t in texts], np.int64)
    row, start = np.repeat(np.arange(len(texts)), sizes), np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.arange(len(code))
    for k in range(order, -1, -1):
        place = at[at - start >= max(k, 1)]
        context = np.full(len(place), k, np.uint64)
        for back in range(k, 0, -1):
            context = mix(context ^ code[place - back])
        yield k, row[place], place, context, mix(context ^ (code[place] << np.uint64(32)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, order, context, run, shorter, n) of the URLs of each batch; ``shorter`` is the run without its first character."""
    for batch in batches:
        verdicts = np.array(batch.column("rule_verdict").to_pylist(), object)
        urls = np.array(batch.column("url").to_pylist(), object)
        for kind in ("allow", "block"):
            texts = list(urls[verdicts == kind])
            if not texts:
                continue
            levels = list(_runs(texts))
            for (k, _, place, context, run), below in zip(levels, [*levels[1:], None], strict=True):
                shorter = below[4][np.searchsorted(below[2], place)] if below else np.zeros(len(run), np.uint64)
                each, index, n = np.unique(run, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * len(each), pa.string()), pa.array(np.full(len(each), k, np.int32)),
                     *(pa.array(x.view(np.int64)) for x in (context[index], each, shorter[index])), pa.array(n.astype(np.int64))],
                    names=["kind", "k", "context", "run", "shorter", "n"])


@dataclass
class PackedModel:
    """A ``MarkovModel`` in sorted arrays, its contexts and runs by hashes; scores many texts at once."""

    runs: np.ndarray
    chances: np.ndarray
    contexts: np.ndarray
    left: np.ndarray

    @classmethod
    def of(cls, k: np.ndarray, context: np.ndarray, run: np.ndarray, shorter: np.ndarray, n: np.ndarray) -> PackedModel:
        """From the counted runs of all contexts that are kept; a shorter context of a kept one is kept."""
        order = np.argsort(run)
        k, context, run, shorter, n = k[order], context[order], run[order], shorter[order], n[order].astype(np.float64)
        contexts, at = np.unique(context, return_inverse=True)
        total, kinds = np.bincount(at, n), np.bincount(at).astype(np.float64)
        chance = np.empty(len(run))
        for level in range(int(k.max(initial=0)) + 1):
            here = np.flatnonzero(k == level)
            rest = chance[np.searchsorted(run, shorter[here])] if level else 1 / 256
            of = at[here]
            chance[here] = (n[here] + kinds[of] * rest) / (total[of] + kinds[of])
        return cls(run, np.log(chance), contexts, np.log(kinds / (total + kinds)))

    def log_likelihoods(self, texts: list[str]) -> np.ndarray:
        sizes = np.array([len(t) + 2 for t in texts], np.int64)
        total, open_ = np.zeros(sizes.sum()), np.ones(sizes.sum(), bool)
        for k, _, place, context, run in _runs(texts):
            live = open_[place]
            place, context, run = place[live], context[live], run[live]
            i = np.minimum(np.searchsorted(self.runs, run), len(self.runs) - 1)
            known = self.runs[i] == run
            total[place[known]] += self.chances[i[known]]
            open_[place[known]] = False
            place, context = place[~known], context[~known]
            i = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
            seen = self.contexts[i] == context
            total[place[seen]] += self.left[i[seen]]
            if not k:
                total[place] -= math.log(256)
        return np.bincount(np.repeat(np.arange(len(texts)), sizes), total, len(texts))


@dataclass
class PackedUrlModel:
    accepted: PackedModel
    rejected: PackedModel
    threshold: float = 0.0

    def scores(self, urls: list[str]) -> np.ndarray:
        """Difference of log-likelihoods for each character and the end."""
        return (self.accepted.log_likelihoods(urls) - self.rejected.log_likelihoods(urls)) / (np.array([len(u) for u in urls]) + 1)

    def score(self, url: str) -> float:
        return float(self.scores([url])[0])


def _binned(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.floor(sent.value.scores(batch.column("url").to_pylist()) * BINS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("rule_verdict"), pa.array(at)], names=["rule_verdict", "bin"])

    return run


def binned_threshold(good: dict[int, int], bad: dict[int, int]) -> float:
    """``best_threshold`` from counts of scores by bin: the middle of the gap between bins."""
    bins = np.array(sorted({*good, *bad}))
    g, b = (np.array([x.get(int(i), 0) for i in bins], np.float64) for x in (good, bad))
    value = np.r_[0, np.cumsum(b)] / b.sum() + 1 - np.r_[0, np.cumsum(g)] / g.sum()
    at = int(value.argmax())
    if at == 0:
        return float(bins[0] / BINS)
    return float((bins[at - 1] + 1) / BINS if at == len(bins) else (bins[at - 1] + 1 + bins[at]) / 2 / BINS)


def learn(judged: DataFrame) -> PackedUrlModel | None:
    """A model from all distinct URLs with a rule's verdict."""
    sc = judged.sparkSession.sparkContext
    urls = judged.filter(F.col("rule_verdict").isNotNull()).select("url", "rule_verdict").distinct()
    urls = written_few(urls.withColumn("held", F.pmod(F.xxhash64("url"), F.lit(HOLD_OUT)) == 0), "urls")
    sizes = {(r.rule_verdict, r.held): r.n for r in urls.groupBy("rule_verdict", "held").agg(F.count("*").alias("n")).collect()}  # four rows
    if len({kind for kind, _ in sizes}) < 2:
        return None
    few = F.col("rule_verdict").isin([kind for kind in ("allow", "block") if len({(kind, True), (kind, False)} & set(sizes)) < 2])  # all to both sides
    counted = urls.filter(~F.col("held") | few).select("url", "rule_verdict").mapInArrow(
        _counted, "kind string, k int, context long, run long, shorter long, n long")
    runs = counted.groupBy("kind", "k", "context", "run").agg(F.first("shorter").alias("shorter"), F.sum("n").alias("n"))
    kept = written_few(runs.withColumn("total", F.sum("n").over(W.partitionBy("kind", "context"))).filter("total > 1 or k = 0"), "url-runs")

    def packed(kind: str) -> PackedModel:
        t = kept.filter(F.col("kind") == kind).select("k", "context", "run", "shorter", "n").toArrow()
        k, *keys, n = (t.column(c).to_numpy() for c in t.column_names)
        return PackedModel.of(k, *(x.view(np.uint64) for x in keys), n)

    model = PackedUrlModel(packed("allow"), packed("block"))
    bins = urls.filter(F.col("held") | few).select("url", "rule_verdict").mapInArrow(_binned(sc.broadcast(model)), "rule_verdict string, bin long")
    found = bins.groupBy("rule_verdict", "bin").agg(F.count("*").alias("n")).collect()  # scores of URLs are a few nats apart
    model.threshold = binned_threshold(*({r.bin: r.n for r in found if r.rule_verdict == kind} for kind in ("allow", "block")))
    return model


def _judge(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: PackedUrlModel | None = sent.value
        for batch in batches:
            verdicts = batch.column("rule_verdict").to_pylist()
            scores: list[float | None] = [None] * len(verdicts)
            open_ = [i for i, v in enumerate(verdicts) if v is None]
            if open_ and model:
                urls = batch.column("url").to_pylist()
                for i, score in zip(open_, model.scores([urls[i] or "" for i in open_]).tolist(), strict=True):
                    verdicts[i], scores[i] = "allow" if score >= model.threshold else "block", score
            verdicts = [v or "allow" for v in verdicts]
            keep = [n for n in batch.schema.names if n not in ("url", "rule_verdict")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(verdicts, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*keep, "verdict", "score"])

    return run


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, url) with host, path, rule, verdict and, where the models decided, their score."""
    judged = with_rule(pages.select("page_id", "url"), rules)
    model = learn(judged)
    sent = pages.sparkSession.sparkContext.broadcast(model)  # two numbers for each run of characters
    return judged.select("page_id", "host", "path", "rule", "url", "rule_verdict").mapInArrow(
        _judge(sent), "page_id long, host string, path string, rule string, verdict string, score double")


@query("op8_url_filter")
def op8(spark, sf_dir) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))
