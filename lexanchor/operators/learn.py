"""Learned decision profiles, their drift, and proposals that pass the membrane."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from lexanchor.operators.keyed import first_per_key
from lexanchor.operators.signals import MEASURES, active, judgments

PROFILE_KEYS = {
    "relator": ["relator"], "orgao": ["decision_body"], "relator_orgao": ["relator", "decision_body"],
    "relator_environment": ["relator", "adjudication_environment"], "orgao_environment": ["decision_body", "adjudication_environment"],
}
RATES = {"procedencia_rate": "procedente", "modulacao_rate": "modulated", "contencao_rate": "contained", "expansao_rate": "expansive"}

#: Months of a period; a week has seven days instead.
MONTHS = {"month": 1, "quarter": 3, "year": 12}


def learn_profiles(ev: DataFrame, e: DataFrame, period: str = "month") -> DataFrame:
    """Profile rows of the five kinds per target and period: sample size and rates."""
    j = judgments(ev).groupBy(
        F.col("aggregate_id").alias("case_id"), F.trunc("occurred_at", period).alias("period_start"), "decision_body", "adjudication_environment",
    ).agg(*[F.count_if(F.expr(c)).alias(m) for m, c in MEASURES.items()])
    ruled = active(e.filter(F.col("type_slug") == "relator_de")).groupBy(F.col("target_id").alias("case_id")).agg(F.min("source_id").alias("relator"))
    # no fact is repeated: the facts are summed once over the five keys, then each kind reads the sums
    facts = j.join(ruled, "case_id", "left").groupBy("period_start", "relator", "decision_body", "adjudication_environment").agg(
        *[F.sum(m).alias(m) for m in MEASURES])
    kinds = F.array(*[
        F.when(F.array_size(F.array_compact(F.array(*keys))) == len(keys), F.struct(F.lit(kind).alias("profile_type"), F.concat_ws("/", *keys).alias("target_slug")))
        for kind, keys in PROFILE_KEYS.items()
    ])
    x = facts.select("period_start", *MEASURES, F.explode(F.array_compact(kinds)).alias("k"))
    p = x.groupBy("k.profile_type", "k.target_slug", "period_start").agg(*[F.sum(m).alias(m) for m in MEASURES])
    rates = {r: F.round(F.col(m) / F.col("n"), 6) for r, m in RATES.items()}
    return p.select(
        F.md5(F.concat_ws("|", "profile_type", "target_slug", F.col("period_start").cast("string"))).alias("profile_id"), "profile_type", "target_slug",
        "period_start", (F.date_sub(F.add_months("period_start", MONTHS[period]), 1) if period in MONTHS else F.date_add("period_start", 6)).alias("period_end"),
        F.col("n").alias("sample_size"), *[c.alias(r) for r, c in rates.items()], F.lit("proposed").alias("status"))


#: Sample size at which a profile is trusted by half.
HALF_TRUST = 10


def back_test(profiles: DataFrame, half_trust: int = HALF_TRUST) -> DataFrame:
    """Confidence, stability and gain of each profile row, from how well the past predicted its period.

    The prediction of a target's rate is its mean over all earlier periods, weighted by their
    samples; the plain one is the same mean over all targets of the kind. Stability is one less
    the mean error of the prediction over the rates, gain how much smaller that error is than
    the plain one's; both are null in a target's first period. Confidence grows with the sample
    so far. Rates are added as decimals, so that the order of rows does not matter.
    """
    exact = {f"__{r}": F.col(r).cast("decimal(10,6)") * F.col("sample_size").cast("decimal(18,0)") for r in RATES}
    x = profiles.withColumns(exact)
    kind = x.groupBy("profile_type", "period_start").agg(F.sum("sample_size").alias("__all"), *[F.sum(c).alias(f"{c}_all") for c in exact])
    past = lambda *keys: W.partitionBy(*keys).orderBy("period_start").rowsBetween(W.unboundedPreceding, -1)
    before = past("profile_type")  # one row for each kind and period
    kind = kind.select("profile_type", "period_start", *[(F.sum(f"{c}_all").over(before).cast("double") / F.sum("__all").over(before)).alias(f"{c}_plain") for c in exact])
    own = past("profile_type", "target_slug")
    x = x.withColumn("__n", F.sum("sample_size").over(own)).withColumns({f"{c}_own": F.sum(c).over(own).cast("double") / F.col("__n") for c in exact})
    x = x.join(kind, ["profile_type", "period_start"])
    mean = lambda suffix: sum(F.abs(F.col(r) - F.col(f"__{r}{suffix}")) for r in RATES) / len(RATES)
    total = F.coalesce("__n", F.lit(0)) + F.col("sample_size")
    return x.select(
        *profiles.columns, (total / (total + half_trust)).alias("confidence_score"), (1 - mean("_own")).alias("stability_score"),
        (mean("_plain") - mean("_own")).alias("predictive_gain"))


def with_payload(profiles: DataFrame) -> DataFrame:
    """Profile rows with the rates as one JSON document, six digits each."""
    rates = F.struct(*[F.col(r).cast("decimal(10,6)").alias(r) for r in RATES])
    return profiles.withColumn("profile_payload", F.to_json(rates)).drop(*RATES)


def profile_drift(profiles: DataFrame) -> DataFrame:
    """Change of each rate since the previous period of the same target (one row per target and period)."""
    w = W.partitionBy("profile_type", "target_slug").orderBy("period_start")
    out = profiles
    for r in RATES:
        out = out.withColumn(f"{r}_drift", F.round(F.col(r) - F.lag(r).over(w), 6))
    return out


KIND_OF = {
    "relator": "new_relator_pattern", "orgao": "new_body_pattern", "relator_orgao": "new_decision_pattern",
    "relator_environment": "new_environment_pattern", "orgao_environment": "new_environment_pattern",
}


def propose(drift: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Proposals from drifts that recur in one direction.

    Scores (their formulas are parameters of the method, not fixed by it): stability is
    the share of periods that move that way, gain the mean size of the move,
    compatibility the share of periods with more than one judgment.
    """
    stack = ", ".join(f"'{r}', {r}_drift" for r in RATES)
    x = drift.selectExpr("profile_type", "target_slug", "sample_size", f"stack({len(RATES)}, {stack}) as (measure, move)").filter("move is not null")
    g = x.groupBy("profile_type", "target_slug", "measure").agg(
        F.count("*").alias("periods"), F.count_if(F.col("move") >= threshold).alias("up"), F.count_if(F.col("move") <= -threshold).alias("down"),
        F.avg(F.abs("move")).alias("gain"), F.avg((F.col("sample_size") > 1).cast("double")).alias("fit"))
    kind = F.create_map(*[F.lit(v) for kv in KIND_OF.items() for v in kv])
    n = F.greatest("up", "down")
    return g.filter(n > 0).select(
        F.md5(F.concat_ws("|", "profile_type", "target_slug", "measure")).alias("proposal_id"), F.element_at(kind, F.col("profile_type")).alias("proposal_type"),
        F.concat_ws(" ", "target_slug", "measure", F.when(F.col("up") >= F.col("down"), "up").otherwise("down")).alias("description"),
        n.alias("recurrence_count"), F.round(n / F.col("periods"), 6).alias("stability_score"), F.round("gain", 6).alias("predictive_gain"),
        F.round("fit", 6).alias("compatibility_score"), F.lit("pending").alias("status"))


def membrane(props: DataFrame, recurrence: int = 2, stability: float = 0.5, gain: float = 0.05, compatibility: float = 0.5) -> DataFrame:
    """Proposals that meet every threshold become validated, the others rejected."""
    ok = (
        (F.col("recurrence_count") >= recurrence) & (F.col("stability_score") >= stability) & (F.col("predictive_gain") >= gain)
        & (F.col("compatibility_score") >= compatibility)
    )
    return props.withColumn("status", F.when(ok, "validated").otherwise("rejected"))


def emerging_patterns(props: DataFrame) -> DataFrame:
    return props.select(
        F.col("proposal_id").alias("pattern_id"), F.col("proposal_type").alias("pattern_type"), "description",
        F.col("recurrence_count").alias("recurrence"), F.col("stability_score").alias("stability"), "predictive_gain", "status")


def supersede(profiles: DataFrame) -> DataFrame:
    """Older profiles of a target give way to the newest."""
    newest = first_per_key(profiles.select("profile_type", "target_slug", "period_start"), ["profile_type", "target_slug"], [F.col("period_start").desc()])
    x = profiles.join(newest.withColumnRenamed("period_start", "__new"), ["profile_type", "target_slug"])
    return x.withColumn("status", F.when(F.col("period_start") < F.col("__new"), "superseded").otherwise(F.col("status"))).drop("__new")
