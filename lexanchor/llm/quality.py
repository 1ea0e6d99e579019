"""Quality rules as weak supervision.

Ten rules look at counts of a whole text; each votes good or bad, or abstains where its
measure is in between. Expectation-maximisation over the counts of vote patterns (at most
three to the power of the number of rules rows) estimates the prior of a good document and
how each rule votes on good and on bad ones, that is its accuracies. The posterior
probability of a good document replaces "all rules must pass". The measures are built
from array functions of one row, so no words are shuffled.

Null and empty texts have no words and fail the base rule. Equal rows give equal results;
an empty table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexanchor.llm.common import WORD, query, table, text_or_empty, written

MIN_WORDS = 50
ITERATIONS = 15
#: Share of the documents that the starting accuracies count for, so that rare votes don't run away.
PRIOR_SHARE = 0.05
START_GOOD = 0.8
#: Starting chance of a bad vote, a good vote and an abstention on a good and on a bad document.
START = {1: (0.05, 0.85, 0.10), 0: (0.45, 0.40, 0.15)}

#: (name, bad where, good where): conditions that both SQL dialects read.
RULES = [
    ("length", "n_words < 50", "n_words >= 80"),
    ("word_length", "2 * word_chars < 5 * n_words or word_chars > 14 * n_words", "word_chars >= 3 * n_words and word_chars <= 12 * n_words"),
    ("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    ("lines", "10 * n_dup_lines > 3 * n_lines", "20 * n_dup_lines <= n_lines"),
    ("repetition", "10 * n_repeat_words > 3 * n_words", "10 * n_repeat_words <= n_words"),
    ("shouting", "2 * n_upper > word_chars", "5 * n_upper <= word_chars"),
    ("letters", "5 * n_bare_words > n_words", "20 * n_bare_words <= n_words"),
    ("marks", "10 * n_marks > word_chars", "50 * n_marks <= 3 * word_chars"),
    ("variety", "100 * n_distinct < 15 * n_words", "100 * n_distinct >= 30 * n_words"),
    ("exclamation", "5 * n_bangs > n_words", "20 * n_bangs <= n_words"),
]
_M = len(RULES)
BASE_FAILED = f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words"


def _vote(bad: str, good: str) -> str:
    """0 bad, 1 good, 2 abstains."""
    return f"case when {bad} then 0 when {good} then 1 else 2 end"


def measured(docs: DataFrame) -> DataFrame:
    """Adds the counts that the rules look at: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_distinct, n_bare_words, n_marks, n_upper, n_bangs."""
    df = docs.withColumn("__text", text_or_empty())
    df = df.withColumn("__w", F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)))
    df = df.withColumn("__lines", F.expr(r"filter(split(__text, '\\n', -1), x -> x rlike '[^\\x20\\x09-\\x0D]')"))
    df = df.withColumn("__grams", F.expr("sort_array(transform(slice(__w, 1, greatest(size(__w) - 2, 0)), (x, i) -> struct(xxhash64(x, __w[i + 1], __w[i + 2]) as h, i as i)))"))
    df = df.withColumn("__again", F.expr(
        "filter(__grams, (g, i) -> (i > 0 and get(__grams, i - 1).h = g.h) or (i + 1 < size(__grams) and get(__grams, i + 1).h = g.h))"))
    df = df.withColumn("__at", F.expr("sort_array(transform(__again, g -> g.i))"))
    as_long = {
        "n_words": "size(__w)", "word_chars": "length(array_join(__w, ''))", "n_symbols": "regexp_count(__text, '[#*$%&|<>]')",
        "n_lines": "size(__lines)", "n_dup_lines": "size(__lines) - size(array_distinct(__lines))",
        "n_repeat_words": "aggregate(transform(__at, (p, i) -> least(coalesce(get(__at, i + 1) - p, 3), 3)), 0, (a, x) -> a + x)",
        "n_distinct": "size(array_distinct(__w))", "n_bare_words": r"size(filter(__w, x -> not x rlike '\\p{L}'))",
        "n_marks": r"regexp_count(__text, '[^\\p{L}\\p{M}\\p{N}\\x20\\x09-\\x0D]')", "n_upper": r"regexp_count(__text, '\\p{Lu}')", "n_bangs": "regexp_count(__text, '!')",
    }
    return df.withColumns({n: F.expr(e).cast("long") for n, e in as_long.items()}).drop("__text", "__w", "__lines", "__grams", "__again", "__at")


def with_votes(counts: DataFrame) -> DataFrame:
    """Adds base_failed and the pattern of votes, a number in base three."""
    code = " + ".join(f"{3 ** j} * ({_vote(bad, good)})" for j, (_, bad, good) in enumerate(RULES))
    return counts.withColumns({"base_failed": F.expr(BASE_FAILED), "pattern": F.expr(code)})


def _start() -> list[float]:
    return [START_GOOD] + [p for _ in RULES for y in (0, 1) for p in START[y]]


def pattern_posteriors(patterns: DataFrame) -> DataFrame:
    """From (pattern, n) the posterior of good for each pattern, with the estimated model.

    The model is an array: the prior, then for each rule six chances: of votes bad, good,
    abstain on bad documents, and on good ones. All patterns meet in one row, which their
    number bounds.
    """
    votes = ", ".join(f"pattern div {3 ** j} % 3" for j in range(_M))
    one = patterns.withColumn("v", F.expr(f"transform(array({votes}), x -> int(x))")).agg(
        F.sort_array(F.collect_list(F.struct("pattern", F.col("n").cast("double").alias("n"), "v"))).alias("p"), (F.sum("n") * PRIOR_SHARE).cast("double").alias("pad"))
    start = "array(" + ", ".join(f"{x}D" for x in _start()) + ")"

    def good(model: str, v: str) -> str:
        like = lambda y, prior: f"aggregate(sequence(0, {_M - 1}), {prior}, (a, j) -> a * {model}[1 + 6 * j + {3 * y} + {v}[j]])"
        pair = f"array({like(0, f'1D - {model}[0]')}, {like(1, f'{model}[0]')})"
        return f"transform(array({pair}), t -> t[1] / (t[0] + t[1]))[0]"

    total = lambda what: f"aggregate(e, 0D, (a, s) -> a + {what})"
    step = f"""transform(array(transform(p, s -> struct(s.v as v, s.n * {good('m', 's.v')} as g, s.n as n))), e ->
      transform(array(array({total('s.n - s.g')}, {total('s.g')})), mass -> transform(sequence(0, {6 * _M}), i ->
        case when i = 0 then (mass[1] + {START_GOOD}D * pad) / (mass[0] + mass[1] + pad)
        else (aggregate(e, 0D, (a, s) -> a + case when s.v[(i - 1) div 6] = (i - 1) % 3
            then (case when (i - 1) div 3 % 2 = 1 then s.g else s.n - s.g end) else 0D end) + pad * {start}[i])
          / (mass[int((i - 1) div 3 % 2)] + pad) end))[0])[0]"""
    model = one.withColumn("model", F.expr(f"aggregate(sequence(1, {ITERATIONS}), {start}, (m, round) -> {step})"))
    return model.select("model", F.inline("p")).select("pattern", F.expr(good("model", "v")).alias("p_good"))


def judged(docs: DataFrame, *keep: str) -> DataFrame:
    """Counts, base_failed, posterior p_good and kept for each row; ``keep`` names the columns to carry along."""
    votes = written(with_votes(measured(docs.select(*keep, "text"))).drop(*({"text"} - set(keep))), "votes")
    posterior = pattern_posteriors(votes.groupBy("pattern").agg(F.count("*").alias("n")))
    # one row per pattern of votes, 3 ** 7 at most
    met = votes.join(F.broadcast(posterior), "pattern")
    return met.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))


def drop_bad_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Rows are written once with their votes; verdicts come by the pattern, so no text is shuffled.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text"))
    return judged(whole, "doc").filter("kept").select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def _sql() -> str:
    names = [f"v{j}" for j in range(_M)]
    votes = ", ".join(f"{_vote(bad, good)} as {v}" for v, (_, bad, good) in zip(names, RULES, strict=True))
    cols = [f"m{i}" for i in range(6 * _M + 1)]
    ctes = ["model0 as (select " + ", ".join(f"cast({x} as double) as {c}" for c, x in zip(cols, _start(), strict=True)) + ")"]

    def pick(j: int, y: int) -> str:
        return f"case v{j} when 0 then m{1 + 6 * j + 3 * y} when 1 then m{2 + 6 * j + 3 * y} else m{3 + 6 * j + 3 * y} end"

    def like(y: int) -> str:
        return " * ".join([("m0" if y else "(1 - m0)"), *[f"({pick(j, y)})" for j in range(_M)]])

    def post(k: int) -> str:
        return f"select {', '.join(names)}, n, l1 / (l0 + l1) as g from (select p.*, {like(0)} as l0, {like(1)} as l1 from patterns p cross join model{k})"

    for k in range(ITERATIONS):
        sums = [f"(sum(n * g) + {START_GOOD} * sum(n) * {PRIOR_SHARE}) / (sum(n) + sum(n) * {PRIOR_SHARE}) as m0"]
        for i, start in enumerate(_start()[1:]):
            w = "n * g" if i // 3 % 2 else "n * (1 - g)"
            sums.append(f"(coalesce(sum({w}) filter (where v{i // 6} = {i % 3}), 0) + {start} * sum(n) * {PRIOR_SHARE}) / (sum({w}) + sum(n) * {PRIOR_SHARE}) as m{i + 1}")
        ctes += [f"post{k} as ({post(k)})", f"model{k + 1} as (select {', '.join(sums)} from post{k})"]
    chain = ",\n".join(ctes)
    ws = r"\x20\x09-\x0D"
    return f"""with texts as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (select r, unnest(regexp_extract_all(text, '[^{ws}]+')) as word, generate_subscripts(regexp_extract_all(text, '[^{ws}]+'), 1) as i from texts),
g as (select r, i, word, lead(word, 1) over o as b, lead(word, 2) over o as c from w window o as (partition by r order by i)),
again as (select r, i from (select r, i, count(*) over (partition by r, word, b, c) as k from g where c is not null) where k > 1),
hit as (select r, count(distinct i) as n from (select r, i from again union all select r, i + 1 from again union all select r, i + 2 from again) group by r),
per as (select r, count(*) as n_words, sum(length(word)) as word_chars, count(distinct word) as n_distinct, count(*) filter (where not regexp_matches(word, '\\p{{L}}')) as n_bare_words from w group by r),
l as (select r, line, count(*) as k from (select r, unnest(string_split(text, chr(10))) as line from texts) where regexp_matches(line, '[^{ws}]') group by r, line),
ls as (select r, sum(k) as n_lines, sum(k - 1) as n_dup_lines from l group by r),
m as (
  select doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
    coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(hit.n, 0) as n_repeat_words,
    coalesce(n_distinct, 0) as n_distinct, coalesce(n_bare_words, 0) as n_bare_words,
    len(regexp_extract_all(text, '[^\\p{{L}}\\p{{M}}\\p{{N}}{ws}]')) as n_marks, len(regexp_extract_all(text, '\\p{{Lu}}')) as n_upper, len(regexp_extract_all(text, '!')) as n_bangs
  from texts left join per using (r) left join ls using (r) left join hit using (r)),
voted as (select *, {BASE_FAILED} as base_failed, {votes} from m),
patterns as (select {', '.join(names)}, count(*) as n from voted group by {', '.join(names)}),
{chain},
verdict as ({post(ITERATIONS)})
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
  cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed, not base_failed and g >= 0.5 as kept
from voted join verdict using ({', '.join(names)})"""


@query("op3_quality_rules", _sql())
def op3(spark, sf_dir) -> DataFrame:
    out = judged(table(spark, sf_dir, "documents"), "doc_id")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
