"""Decision signals and the profiles, rates and process indices built on them.

Judgments are parsed once. Profiles count judgments per case before any join
(``case_tallies``), so a case with millions of judgments joins as a few rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lexanchor import vocab as V
from lexanchor.functions.text import jget
from lexanchor.operators.core import active
from lexanchor.operators.keyed import bounded_segments, segmented_scan, time_segment, with_rate

PAYLOAD = (
    "outcome string, outcome_polarity string, decision_direction string, decision_unanimity string, "
    "uses_modulation boolean, reasoning_style string, fiscal_effect string, deference_level string, "
    "decision_body string, adjudication_environment string, collegiality_mode string, session_format string, "
    "oral_argument_present boolean, public_debate_intensity string, panel_size int, votes_present int, "
    "destaque_present boolean, vista_present boolean, divergence_present boolean"
)
ENVIRONMENT = [
    "decision_body", "collegiality_mode", "adjudication_environment", "session_format", "oral_argument_present",
    "public_debate_intensity", "panel_size", "votes_present",
]
SIGNALS = [
    "decision_body", "adjudication_environment", "collegiality_mode", "panel_size", "votes_present",
    "oral_argument_present", "outcome", "outcome_polarity", "decision_direction", "decision_unanimity",
    "uses_modulation", "reasoning_style", "fiscal_effect", "deference_level",
]


def judgments(ev: DataFrame) -> DataFrame:
    """Judgment events with their payload typed, one JSON parse per row."""
    j = ev.filter(F.col("type_slug") == "julgamento").withColumn("p", F.from_json("payload", PAYLOAD))
    return j.select("event_id", "aggregate_id", "actor_id", "occurred_at", "p.*")


def judgment_environment(ev: DataFrame) -> DataFrame:
    return judgments(ev).select("event_id", "aggregate_id", "occurred_at", *ENVIRONMENT)


def _cases(o: DataFrame, ot: DataFrame) -> DataFrame:
    t = F.broadcast(ot.select("type_slug", "domain_slug"))  # closed vocabulary
    return o.join(t, "type_slug").select(
        F.col("id").alias("case_id"), F.col("slug").alias("case_slug"), "domain_slug", F.col("type_slug").alias("class_code"))


def decision_signals(ev: DataFrame, o: DataFrame, ot: DataFrame) -> DataFrame:
    """One row per judgment of a known case."""
    j = judgments(ev).select(
        F.col("aggregate_id").alias("case_id"), "event_id", *SIGNALS, F.col("occurred_at").alias("judgment_date"))
    return j.join(_cases(o, ot), "case_id")


def judgment_ecology(ev: DataFrame, o: DataFrame, e: DataFrame | None = None) -> DataFrame:
    """Judgments with panel and votes known. Given edges, also requires rapporteur, body and environment."""
    j = judgments(ev).filter(F.col("panel_size").isNotNull() & F.col("votes_present").isNotNull())
    if e is not None:
        ruled = active(e.filter(F.col("type_slug") == "relator_de")).select(F.col("target_id").alias("aggregate_id"))
        j = j.filter(F.col("decision_body").isNotNull() & F.col("adjudication_environment").isNotNull())
        j = j.join(ruled, "aggregate_id", "left_semi")
    cases = o.select(F.col("id").alias("aggregate_id"), F.col("slug").alias("caso_slug"))
    return j.join(cases, "aggregate_id").select(
        F.col("event_id").alias("julgamento_id"), F.col("aggregate_id").alias("caso_id"), "caso_slug", "decision_body",
        "adjudication_environment", "panel_size", "votes_present", "outcome", F.col("decision_direction").alias("direction"),
        "uses_modulation", "reasoning_style", "fiscal_effect", "occurred_at",
    )


def predictive_features(signals: DataFrame) -> DataFrame:
    return signals.select(
        "case_id", "case_slug", "class_code", "decision_body", "adjudication_environment", "panel_size", "votes_present",
        "judgment_date", F.col("outcome").alias("outcome_label"), F.col("decision_direction").alias("direction_label"),
        F.col("uses_modulation").alias("modulation_label"), F.col("fiscal_effect").alias("fiscal_effect_label"),
        "reasoning_style", "deference_level",
    )


def slice_decisions(signals: DataFrame, since=None, until=None, **equal) -> DataFrame:
    """Signals restricted by any column (value or list of values) and by period."""
    conds: list[Column] = [
        F.col(c).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(c) == v for c, v in equal.items()
    ]
    if since is not None:
        conds.append(F.col("judgment_date") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        conds.append(F.col("judgment_date") < F.lit(until).cast("timestamp_ntz"))
    return signals.filter(reduce(lambda a, b: a & b, conds)) if conds else signals


def decision_nature(signals: DataFrame) -> DataFrame:
    """Monocratic, collegiate, or collegiate only in form (virtual session)."""
    mode, env = F.col("collegiality_mode"), F.col("adjudication_environment")
    return signals.withColumn(
        "decision_nature",
        F.when(mode == "monocratico", "monocratica").when((mode == "colegiado") & (env == "virtual"), "colegiada_formal")
        .when(mode == "colegiado", "colegiada"))


# ------------------------------------------------------------------- profiles
MEASURES = {
    "n": "true", "procedente": "outcome = 'procedente'", "modulated": "uses_modulation",
    "contained": "fiscal_effect = 'contencao'", "fiscal": "fiscal_effect in ('contencao', 'expansivo')",
    "expansive": "decision_direction = 'expansiva'", "restrictive": "decision_direction = 'restritiva'",
    "virtual": "adjudication_environment = 'virtual'",
}


def case_tallies(ev: DataFrame, o: DataFrame, ot: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Judgment counts per case and dimension values, for cases of a known type."""
    t = judgments(ev).groupBy(F.col("aggregate_id").alias("case_id"), *dims).agg(
        *[F.count_if(F.expr(c)).alias(m) for m, c in MEASURES.items()])
    return t.join(_cases(o, ot), "case_id")


def profile(tallies: DataFrame, keys: Sequence[str], mode_of: str | None = None) -> DataFrame:
    """Sums of the tallies per key; with ``mode_of`` also the most frequent value, lowest on ties."""
    sums = [F.sum(m).alias(m) for m in MEASURES]
    if mode_of is None:
        return tallies.groupBy(*keys).agg(*sums)
    by_value = tallies.groupBy(*keys, mode_of).agg(*sums)
    rank = F.when(F.col(mode_of).isNotNull(), F.struct(-F.col("n"), F.col(mode_of)))
    return by_value.groupBy(*keys).agg(*sums, F.min_by(mode_of, rank).alias("mode"))


def mode_of(df: DataFrame, keys: Sequence[str], col: str, alias: str = "mode") -> DataFrame:
    """Most frequent non-null value per key, lowest value on ties."""
    n = df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count("*").alias("__n"))
    return n.groupBy(*keys).agg(F.min_by(col, F.struct(-F.col("__n"), F.col(col))).alias(alias))


def _by_rapporteur(e: DataFrame, tallies: DataFrame, dims: Sequence[str]) -> DataFrame:
    ruled = active(e.filter(F.col("type_slug") == "relator_de")).select("source_id", F.col("target_id").alias("case_id"))
    return ruled.join(tallies, "case_id").groupBy("source_id", *dims).agg(*[F.sum(m).alias(m) for m in MEASURES])


def _named(a: DataFrame, p: DataFrame, actor_type: str = "ministro_stf") -> DataFrame:
    actors = a.filter(F.col("type_slug") == actor_type).select(F.col("id").alias("source_id"), F.col("slug").alias("actor_slug"))
    return p.join(actors, "source_id").withColumnRenamed("source_id", "actor_id")


def relator_signals(a: DataFrame, e: DataFrame, signals: DataFrame) -> DataFrame:
    """Signals of each rapporteur's cases, through active relator_de edges."""
    ruled = active(e.filter(F.col("type_slug") == "relator_de")).select("source_id", F.col("target_id").alias("case_id"))
    actors = a.filter(F.col("type_slug") == "ministro_stf").select(
        F.col("id").alias("source_id"), F.col("slug").alias("actor_slug"))
    return ruled.join(actors, "source_id").join(signals, "case_id").withColumnRenamed("source_id", "actor_id")


def subject_signals(o: DataFrame, e: DataFrame, signals: DataFrame) -> DataFrame:
    """Signals of the cases about each subject, through active sobre edges."""
    about = active(e.filter(F.col("type_slug") == "sobre")).select(F.col("source_id").alias("case_id"), "target_id")
    subj = o.filter(F.col("type_slug") == "subject").select(F.col("id").alias("target_id"), F.col("slug").alias("subject_slug"))
    return about.join(subj, "target_id").join(signals, "case_id").withColumnRenamed("target_id", "subject_id")


def relator_profile(a: DataFrame, e: DataFrame, ev: DataFrame, o: DataFrame, ot: DataFrame) -> DataFrame:
    t = _by_rapporteur(e, case_tallies(ev, o, ot, ["reasoning_style"]), ["reasoning_style"])
    return _named(a, profile(t, ["source_id"], "reasoning_style")).select(
        "actor_id", "actor_slug", F.col("n").alias("total_decisions"), F.col("procedente").alias("procedente_count"),
        F.col("modulated").alias("modulacao_count"), F.col("contained").alias("contencao_count"),
        with_rate("procedente", "n").alias("procedencia_rate"), with_rate("modulated", "n").alias("modulacao_rate"),
        with_rate("contained", "n").alias("contencao_fiscal_rate"), F.col("mode").alias("dominant_reasoning_style"),
    )


def relator_environment_profile(a, e, ev, o, ot) -> DataFrame:
    dims = ["adjudication_environment"]
    t = case_tallies(ev, o, ot, dims).filter(F.col("adjudication_environment").isNotNull())
    return _named(a, _by_rapporteur(e, t, dims)).select(
        "actor_id", "actor_slug", F.col("adjudication_environment").alias("environment"), F.col("n").alias("total_decisions"),
        with_rate("procedente", "n").alias("procedencia_rate_env"), with_rate("modulated", "n").alias("modulacao_rate_env"),
        with_rate("contained", "n").alias("contencao_rate_env"),
    )


def body_profile(ev, o, ot) -> DataFrame:
    t = case_tallies(ev, o, ot, ["decision_body", "reasoning_style"]).filter(F.col("decision_body").isNotNull())
    return profile(t, ["decision_body"], "reasoning_style").select(
        "decision_body", F.col("n").alias("total_decisions"), with_rate("procedente", "n").alias("procedencia_rate"),
        with_rate("modulated", "n").alias("modulacao_rate"), with_rate("contained", "n").alias("contencao_rate"),
        F.col("mode").alias("dominant_reasoning_style"),
    )


def body_environment_profile(ev, o, ot) -> DataFrame:
    dims = ["decision_body", "adjudication_environment"]
    t = case_tallies(ev, o, ot, dims).dropna(subset=dims)
    return profile(t, dims).select(
        "decision_body", F.col("adjudication_environment").alias("environment"), F.col("n").alias("total_decisions"),
        with_rate("procedente", "n").alias("procedencia_rate"), with_rate("modulated", "n").alias("modulacao_rate"),
    )


def relator_body_profile(a, e, ev, o, ot) -> DataFrame:
    t = case_tallies(ev, o, ot, ["decision_body"]).filter(F.col("decision_body").isNotNull())
    p = _named(a, _by_rapporteur(e, t, ["decision_body"]))
    return profile(p, ["actor_slug", "decision_body"]).select(
        "actor_slug", "decision_body", F.col("n").alias("total_decisions"),
        with_rate("procedente", "n").alias("procedencia_rate"), with_rate("modulated", "n").alias("modulacao_rate"),
    )


def subject_environment_profile(o, e, ev, ot) -> DataFrame:
    dims = ["adjudication_environment", "decision_direction"]
    t = case_tallies(ev, o, ot, dims).filter(F.col("adjudication_environment").isNotNull())
    about = active(e.filter(F.col("type_slug") == "sobre")).groupBy(F.col("source_id").alias("case_id"), "target_id").agg(
        F.count("*").alias("links"))
    weighted = about.join(t, "case_id").groupBy("target_id", *dims).agg(
        *[F.sum(F.col(m) * F.col("links")).alias(m) for m in MEASURES])
    subj = o.filter(F.col("type_slug") == "subject").select(F.col("id").alias("target_id"), F.col("slug").alias("subject_slug"))
    p = profile(weighted.join(subj, "target_id"), ["subject_slug", "adjudication_environment"], "decision_direction")
    return p.select(
        "subject_slug", F.col("adjudication_environment").alias("environment"), F.col("n").alias("total_decisions"),
        with_rate("procedente", "n").alias("procedencia_rate"), F.col("mode").alias("dominant_direction"),
    )


def norm_profile(o, e, ev, ot, via: str = "interpreta") -> DataFrame:
    """How the decisions that reach a norm node behave."""
    t = case_tallies(ev, o, ot, []).drop("case_slug", "domain_slug")
    reach = active(e.filter(F.col("type_slug") == via)).select(F.col("source_id").alias("case_id"), "target_id")
    by = reach.join(t, "case_id").groupBy("target_id", "class_code").agg(*[F.sum(m).alias(m) for m in MEASURES])
    p = by.groupBy("target_id").agg(
        *[F.sum(m).alias(m) for m in MEASURES], F.array_sort(F.collect_set("class_code")).alias("associated_classes"))
    nodes = o.select(F.col("id").alias("target_id"), F.col("slug").alias("node_slug"))
    return p.join(nodes, "target_id").select(
        F.col("target_id").alias("node_id"), "node_slug", F.col("n").alias("activation_count"), "associated_classes",
        with_rate("procedente", "n").alias("procedencia_rate"), with_rate("expansive", "n").alias("expansion_rate"),
        with_rate("restrictive", "n").alias("restriction_rate"), with_rate("contained", "n").alias("containment_rate"),
    )


def actor_profile(a, e, ev, o, ot) -> DataFrame:
    """Rapporteur profile with the deference pattern and the dominant style of reasoning."""
    dims = ["deference_level", "reasoning_style"]
    t = _by_rapporteur(e, case_tallies(ev, o, ot, dims), dims)  # a few rows for each rapporteur
    style = profile(t, ["source_id"], "reasoning_style").select("source_id", F.col("mode").alias("dominant_reasoning_style"))
    return _named(a, profile(t, ["source_id"], "deference_level").join(style, "source_id")).select(
        "actor_id", "actor_slug", F.col("n").alias("total_decisions"), with_rate("procedente", "n").alias("procedencia_rate"),
        with_rate("modulated", "n").alias("modulacao_rate"), with_rate("contained", "n").alias("contencao_fiscal_rate"),
        F.col("mode").alias("deference_pattern"), "dominant_reasoning_style",
    )


def actor_environment_interactions(ev: DataFrame, a: DataFrame) -> DataFrame:
    """Participation of an actor in each environment and its correlation with outcome and modulation.

    Each correlation is between two 0/1 marks over all judgments of the
    environment, taken from the four cell counts.
    """
    j = judgments(ev).filter(F.col("adjudication_environment").isNotNull())
    cells = j.groupBy("actor_id", "adjudication_environment").agg(
        F.count("*").alias("n"), F.count_if(F.col("outcome") == "procedente").alias("p"), F.count_if("uses_modulation").alias("m"))
    env = cells.groupBy("adjudication_environment").agg(F.sum("n").alias("env_n"), F.sum("p").alias("env_p"), F.sum("m").alias("env_m"))

    def phi(joint: str, margin: str) -> Column:
        n, c, k, t = (F.col(x).cast("double") for x in ("n", joint, margin, "env_n"))
        return F.round((t * c - n * k) / F.nullif(F.sqrt(n * (t - n) * k * (t - k)), F.lit(0.0)), 6)

    named = a.select(F.col("id").alias("actor_id"), F.col("slug").alias("actor_slug"), F.col("type_slug").alias("actor_type"))
    return cells.join(F.broadcast(env), "adjudication_environment").join(named, "actor_id", "left").select(  # one row per environment
        "actor_id", "actor_slug", "actor_type", F.col("adjudication_environment").alias("environment"), with_rate("n", "env_n", 6).alias("participation_rate"),
        phi("p", "env_p").alias("correlation_with_outcome"), phi("m", "env_m").alias("correlation_with_modulation"))


def axis_crosstab(facts: DataFrame, pairs: Sequence[tuple[str, str]] = tuple(V.AXIS_PAIRS)) -> DataFrame:
    """Counts for every pair of axes in one pass over the facts.

    ``facts`` carries one column per axis and ``n``. Facts are summed over the axes first.
    """
    axes = sorted({x for p in pairs for x in p})
    cells = F.array(*[
        F.struct(F.lit(a).alias("axis_a"), F.lit(b).alias("axis_b"), F.col(a).alias("value_a"), F.col(b).alias("value_b"))
        for a, b in pairs
    ])
    small = facts.groupBy(*axes).agg(F.sum("n").alias("n"))
    c = small.select("n", F.explode(cells).alias("c")).select("c.*", "n").dropna(subset=["value_a", "value_b"])
    return c.groupBy("axis_a", "axis_b", "value_a", "value_b").agg(F.sum("n").alias("n"))


def axis_facts(ev: DataFrame, o: DataFrame, e: DataFrame, ot: DataFrame) -> DataFrame:
    """Judgment counts by every axis: rapporteur and subject come from edges, actor from the event."""
    j = judgments(ev).groupBy(
        F.col("aggregate_id").alias("case_id"), F.date_format("occurred_at", "yyyy-MM").alias("period"),
        F.col("adjudication_environment").alias("environment"), F.col("decision_body").alias("body"), F.col("actor_id").alias("actor"),
        "outcome", F.col("decision_direction").alias("direction"), F.col("uses_modulation").cast("string").alias("modulation"),
        F.col("fiscal_effect").alias("fiscal"),
    ).agg(F.count("*").alias("n"))
    ruled = active(e.filter(F.col("type_slug") == "relator_de")).groupBy(F.col("target_id").alias("case_id")).agg(
        F.min("source_id").alias("relator"))
    return j.join(_cases(o, ot).select("case_id", F.col("class_code").alias("class")), "case_id").join(ruled, "case_id", "left")


def conditional_rate(signals: DataFrame, label: str, given: Sequence[str]) -> DataFrame:
    """P(label | given): share of each label value inside its condition."""
    n = signals.groupBy(*given, label).agg(F.count("*").alias("n"))
    total = n.groupBy(*[F.col(g).alias(f"__{g}") for g in given]).agg(F.sum("n").alias("given_n"))
    cond = reduce(lambda x, y: x & y, [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in given])
    return n.join(total, cond).select(*given, label, "n", "given_n", with_rate("n", "given_n", 6).alias("probability"))


def judgment_environment_profile(ev, o, e, ot, a) -> DataFrame:
    """Signals per judgment with its session and the rapporteur; the subjects of a case are ``case_subjects``."""
    s = decision_signals(ev, o, ot).join(judgment_environment(ev).select("event_id", "session_format"), "event_id")
    ruled = active(e.filter(F.col("type_slug") == "relator_de")).groupBy(F.col("target_id").alias("case_id")).agg(F.min("source_id").alias("relator"))
    named = a.select(F.col("id").alias("relator"), F.col("slug").alias("relator_slug"))
    return s.join(ruled, "case_id", "left").join(named, "relator", "left").select(
        "case_id", "case_slug", "relator", "relator_slug", "event_id", "decision_body", "adjudication_environment", "session_format", "outcome",
        "decision_direction", "uses_modulation", "fiscal_effect")


def case_subjects(e: DataFrame) -> DataFrame:
    """(case_id, subject) once each: joined to judgments on demand, not copied onto every judgment."""
    return active(e.filter(F.col("type_slug") == "sobre")).select(F.col("source_id").alias("case_id"), F.col("target_id").alias("subject")).distinct()


def collegial_dynamics(ev: DataFrame, segment: Column | None = None) -> DataFrame:
    """Each judgment: whether vista, destaque or divergence occurred, and whether it left the environment of the one before in its case.

    Who sat in the case is ``case_members``.
    """
    rows = judgments(ev).select("event_id", "aggregate_id", "occurred_at", "adjudication_environment", "vista_present", "destaque_present", "divergence_present")
    key, order = ["aggregate_id"], ["occurred_at", "event_id"]
    rows = bounded_segments(rows, key, order, time_segment("occurred_at") if segment is None else segment)
    x = segmented_scan(rows, key, order, "__seg", prev={"__before": F.col("adjudication_environment")})
    return x.select(
        F.col("event_id").alias("julgamento_id"), "aggregate_id", F.col("vista_present").alias("vista_presente"), F.col("destaque_present").alias("destaque_presente"),
        F.col("divergence_present").alias("divergencia_presente"),
        F.coalesce(F.col("__before") != F.col("adjudication_environment"), F.lit(False)).alias("migracao_ambiente"))


def case_members(roles: DataFrame) -> DataFrame:
    """(aggregate_id, member, role) once each, of those who sat in a case."""
    return roles.filter(F.col("type_slug") == "exerce_papel").select(
        F.col("target_id").alias("aggregate_id"), F.col("source_id").alias("member"), F.get_json_object("payload", "$.role").alias("role")).distinct()


def co_participation(e: DataFrame, roles: DataFrame) -> DataFrame:
    """Rapporteur x other participants: cases and appearances together.

    A case has one active rapporteur, so every participation meets one row and
    the result grows with the participations, not with their pairs.
    """
    seats = roles.filter(F.col("type_slug") == "exerce_papel").groupBy("target_id", F.col("source_id").alias("other")).agg(
        F.count("*").alias("n"))
    ruled = active(e.filter(F.col("type_slug") == "relator_de")).select("target_id", F.col("source_id").alias("relator")).distinct()
    both = seats.join(ruled, "target_id").filter(F.col("relator") != F.col("other"))
    return both.groupBy("relator", "other").agg(F.count("*").alias("cases"), F.sum("n").alias("appearances"))


# ------------------------------------------------------------- process life
def process_lifecycle(o: DataFrame, ot: DataFrame, ev: DataFrame) -> DataFrame:
    """First and last event, duration and event count of each active process."""
    n = ev.groupBy(F.col("aggregate_id").alias("id")).agg(
        F.min("occurred_at").alias("data_nascimento"), F.max("occurred_at").alias("evento_mais_recente"),
        F.count("event_id").alias("numero_eventos"))
    kinds = F.broadcast(ot.filter(F.col("ontological_class") == "processual").select("type_slug"))
    cases = active(o).join(kinds, "type_slug").select("id", "slug", "type_slug")
    return cases.join(n, "id").select(
        F.col("id").alias("processo_id"), F.col("slug").alias("processo_slug"), "type_slug", "data_nascimento",
        "evento_mais_recente", (F.col("evento_mais_recente") - F.col("data_nascimento")).alias("duracao_total"),
        F.timestamp_diff("SECOND", F.col("data_nascimento"), F.col("evento_mais_recente")).alias("duracao_segundos"), "numero_eventos")


def time_between(ev: DataFrame, segment: Column | None = None) -> DataFrame:
    """Seconds since the previous event of the same aggregate."""
    rows = ev.select("aggregate_id", "event_id", "type_slug", "occurred_at")
    key, order = ["aggregate_id"], ["occurred_at", "event_id"]
    rows = bounded_segments(rows, key, order, time_segment("occurred_at") if segment is None else segment)
    out = segmented_scan(rows, key, order, "__seg", prev={"previous_at": F.col("occurred_at")}).drop("__seg")
    return out.withColumn("tem_seconds", F.timestamp_diff("SECOND", F.col("previous_at"), F.col("occurred_at")))


def trajectory(ev: DataFrame, segment: Column | None = None) -> DataFrame:
    """Milestones of each aggregate as numbered steps."""
    rows = ev.select("aggregate_id", "event_id", F.col("type_slug").alias("milestone"), "occurred_at")
    key, order = ["aggregate_id"], ["occurred_at", "event_id"]
    rows = bounded_segments(rows, key, order, time_segment("occurred_at") if segment is None else segment)
    return segmented_scan(rows, key, order, "__seg", counts={"step": F.lit(True)}).drop("__seg")


def case_patterns(steps: DataFrame) -> DataFrame:
    """Pattern fingerprint, length and duration of each aggregate.

    The fingerprint adds 2 x 60 bits of MD5 over (step, milestone), so equal
    sequences meet without collecting any of them.
    """
    h = F.md5(F.concat_ws("|", F.col("step").cast("string"), "milestone"))
    part = [F.conv(F.substring(h, s, 13), 16, 10).cast("decimal(20,0)") for s in (1, 14)]
    return steps.groupBy("aggregate_id").agg(
        F.count("*").alias("length"), F.sum(part[0]).alias("__a"), F.sum(part[1]).alias("__b"),
        F.min("occurred_at").alias("__from"), F.max("occurred_at").alias("__to"),
    ).select(
        "aggregate_id", "length", F.md5(F.concat_ws("|", "length", "__a", "__b")).alias("pattern_id"),
        F.timestamp_diff("SECOND", F.col("__from"), F.col("__to")).alias("duration_seconds"))


def trajectory_patterns(steps: DataFrame) -> DataFrame:
    """Frequency and mean duration of every milestone sequence, with the case that shows it."""
    return case_patterns(steps).groupBy("pattern_id", "length").agg(
        F.count("*").alias("frequencia"), F.round(F.avg("duration_seconds"), 3).alias("duracao_media"),
        F.min("aggregate_id").alias("example"))


def pattern_steps(steps: DataFrame) -> DataFrame:
    """The sequence of every pattern as rows."""
    p = trajectory_patterns(steps).select("pattern_id", F.col("example").alias("aggregate_id"))
    return steps.join(p, "aggregate_id").select("pattern_id", "step", "milestone")


def process_indices(ev: DataFrame, suspensive: Sequence[str] = ("mudanca_estado",)) -> DataFrame:
    """Per case: life duration, interruption, complexity, virtual conversion and time between environments."""
    p = F.from_json("payload", "adjudication_environment string, destaque_present boolean")
    base = ev.withColumn("p", F.when(F.col("type_slug") == "julgamento", p)).select(
        "aggregate_id", "event_id", "type_slug", "causation_id", "occurred_at", "p.*")
    virtual, present = (F.col("adjudication_environment") == v for v in ("virtual", "presencial"))
    children = ev.filter(F.col("causation_id").isNotNull()).groupBy("causation_id").agg(F.count("*").alias("c")).filter("c > 1")
    forks = ev.select("aggregate_id", F.col("event_id").alias("causation_id")).join(children, "causation_id", "left_semi").groupBy(
        "aggregate_id").agg(F.count("*").alias("bifurcacoes"))
    agg = base.groupBy("aggregate_id").agg(
        F.count("*").alias("total"), F.count_distinct("type_slug").alias("kinds"), F.min("occurred_at").alias("first_at"),
        F.max("occurred_at").alias("last_at"), F.min(F.when(F.col("type_slug") == "distribuicao", F.col("occurred_at"))).alias("distributed_at"),
        F.count_if(F.col("type_slug").isin(*suspensive)).alias("suspensive"), F.count_if(virtual).alias("virtual"),
        F.count_if(F.col("destaque_present") & F.col("adjudication_environment").isNotNull()).alias("destaque"),
        F.min(F.when(virtual, F.col("occurred_at"))).alias("virtual_at"), F.min(F.when(present, F.col("occurred_at"))).alias("present_at"))

    def sec(a, b):
        return F.timestamp_diff("SECOND", F.col(a), F.col(b))

    return agg.join(forks, "aggregate_id", "left").select(
        "aggregate_id", sec("distributed_at", "last_at").alias("dvp_seconds"), with_rate("suspensive", "total", 6).alias("iip"),
        (F.col("kinds") * sec("first_at", "last_at") * F.coalesce("bifurcacoes", F.lit(0))).alias("ict"),
        with_rate("destaque", "virtual", 6).alias("tcvp"), sec("virtual_at", "present_at").alias("tm_seconds"))


def virtual_index(a, e, ev, o, ot) -> DataFrame:
    """Share of virtual judgments by rapporteur."""
    return _named(a, _by_rapporteur(e, case_tallies(ev, o, ot, []), [])).select(
        "actor_id", "actor_slug", "n", with_rate("virtual", "n", 6).alias("ivr"))


def decision_indices(ev, o, ot) -> DataFrame:
    """Containment (ICF) and expansiveness (IED) per decision body."""
    return profile(case_tallies(ev, o, ot, ["decision_body"]), ["decision_body"]).select(
        "decision_body", with_rate("contained", "fiscal", 6).alias("icf"), with_rate("expansive", "n", 6).alias("ied"))


def stability_index(e: DataFrame) -> DataFrame:
    """IEI per precedent: confirmations over confirmations, overrulings and contradictions."""
    t = F.col("type_slug")
    n = e.filter(t.isin("confirma", "supera", "contradiz")).groupBy(F.col("target_id").alias("precedent")).agg(
        F.count_if(t == "confirma").alias("confirma"), F.count("*").alias("total"))
    return n.select("precedent", "confirma", "total", with_rate("confirma", "total", 6).alias("iei"))


# ------------------------------------------------------------------- fiscal
def fiscal_exposure(impacts: DataFrame, decisions: DataFrame) -> DataFrame:
    """EFR, ICF%, IDT and IDC per decision and entity.

    Impacts booked after the decision count as risk after it, the others as before.
    """
    d = decisions.select("decision", "decided_at", "recognised")
    after = F.col("booked_at") > F.col("decided_at")
    zero = F.lit(0).cast("decimal(20,4)")
    x = impacts.join(d, "decision").groupBy("decision", "entity").agg(
        F.sum(F.when(after, F.col("effective")).otherwise(zero)).alias("risk_after"),
        F.sum(F.when(~after, F.col("effective")).otherwise(zero)).alias("risk_before"),
        F.sum("potential").alias("potential"), F.sum("effective").alias("effective"), F.min("booked_at").alias("booked_at"),
        F.min("decided_at").alias("decided_at"), F.min("recognised").alias("recognised"))

    def money(c):
        return F.round(c, 2).cast("double")

    return x.select(
        "decision", "entity", money(F.col("risk_after") - F.col("risk_before")).alias("efr"),
        F.round(1 - F.col("effective").cast("double") / F.nullif(F.col("potential").cast("double"), F.lit(0.0)), 6).alias("icf_pct"),
        F.datediff("booked_at", "decided_at").alias("idt_days"), money(F.col("recognised") - F.col("effective")).alias("idc"))


def fiscal_impact_index(impacts: DataFrame, retroactive_factor: float = 1.5, horizon_factors: dict[str, float] | None = None) -> DataFrame:
    """IIFD per decision: confidence-weighted estimates times retroactivity and horizon factors (parameters)."""
    factors = horizon_factors or {"imediato": 1.0, "curto": 0.9, "medio": 0.75, "longo": 0.5}

    def dec(v: float, kind: str) -> Column:
        return F.lit(v).cast(kind)

    table = F.create_map(*[x for k, v in factors.items() for x in (F.lit(k), dec(v, "decimal(3,2)"))])
    value = F.col("potential") * F.col("confidence") * F.when(F.col("retroactive"), dec(retroactive_factor, "decimal(2,1)")).otherwise(dec(1.0, "decimal(2,1)"))
    value = value * F.coalesce(F.element_at(table, F.col("horizon")), dec(1.0, "decimal(3,2)"))
    return impacts.groupBy("decision").agg(F.round(F.sum(value), 2).cast("double").alias("iifd"), F.count("*").alias("estimates"))
