"""Decision signals, profiles, process life and formulas."""

from pyspark.sql import functions as F

from lexanchor import vocab as V
from lexanchor.operators import signals as S
from lexanchor.plans.registry import query, ts

_STR = ["outcome", "outcome_polarity", "decision_direction", "decision_unanimity", "reasoning_style", "fiscal_effect",
        "deference_level", "decision_body", "adjudication_environment", "collegiality_mode", "session_format", "public_debate_intensity"]
_BOOL = ["uses_modulation", "oral_argument_present", "destaque_present", "vista_present", "divergence_present"]
_INT = ["panel_size", "votes_present"]
JUDGMENTS = "jg as (select event_id, aggregate_id, actor_id, occurred_at, " + ", ".join(
    [f"json_extract_string(payload,'$.{c}') as {c}" for c in _STR]
    + [f"try_cast(json_extract_string(payload,'$.{c}') as boolean) as {c}" for c in _BOOL]
    + [f"try_cast(json_extract_string(payload,'$.{c}') as int) as {c}" for c in _INT]
) + " from fx_log where type_slug = 'julgamento')"
SIGNALS = JUDGMENTS + """,
ds as (select j.aggregate_id as case_id, o.slug as case_slug, t.domain_slug, o.type_slug as class_code, j.* exclude (aggregate_id, occurred_at), j.occurred_at as judgment_date
 from jg j join fx_objects o on o.id = j.aggregate_id join fx_object_types t on t.type_slug = o.type_slug)"""
RELATOR = SIGNALS + """,
rs as (select a.id as actor_id, a.slug as actor_slug, d.* exclude (actor_id) from fx_actors a join fx_edges e on e.source_id = a.id and e.type_slug = 'relator_de' and e.valid_to is null
 join ds d on d.case_id = e.target_id where a.type_slug = 'ministro_stf')"""
NEEDS = ("log", "objects", "object_types")
NEEDS_E = NEEDS + ("edges",)
NEEDS_A = NEEDS_E + ("actors",)


def rate(cond: str, n: str = "count(*)", digits: int = 3) -> str:
    return f"round(count(*) filter (where {cond})::double / nullif({n},0), {digits})"


def mode(source: str, keys: str, value: str) -> str:
    return (f"(select {keys}, {value} as mode_value from (select {keys}, {value}, row_number() over (partition by {keys} order by count(*) desc, {value}) as rn "
            f"from {source} where {value} is not null group by {keys}, {value}) where rn = 1)")


def signals(x):
    return S.decision_signals(x.log, x.objects, x.object_types)


@query("prj4_judgment_environment", needs=("log",), ctes=JUDGMENTS, sql=f"""
select event_id, aggregate_id, {ts('occurred_at')} as occurred_at, {', '.join(S.ENVIRONMENT)} from jg""")
def _(x):
    return S.judgment_environment(x.log)


@query("jn4_decision_signals", needs=NEEDS, ctes=SIGNALS, sql=f"""
select case_id, case_slug, domain_slug, class_code, event_id, {', '.join(S.SIGNALS)}, {ts('judgment_date')} as judgment_date from ds""")
def _(x):
    return signals(x)


ECOLOGY = """select j.event_id as julgamento_id, j.aggregate_id as caso_id, o.slug as caso_slug, decision_body, adjudication_environment, panel_size,
 votes_present, outcome, decision_direction as direction, uses_modulation, reasoning_style, fiscal_effect, {when} as occurred_at
from jg j join fx_objects o on o.id = j.aggregate_id where panel_size is not null and votes_present is not null"""


@query("jn5_judgment_ecology", needs=NEEDS, ctes=JUDGMENTS, sql=ECOLOGY.format(when=ts("occurred_at")))
def _(x):
    return S.judgment_ecology(x.log, x.objects)


@query("jn5_judgment_ecology_strict", needs=NEEDS_E, ctes=JUDGMENTS, sql=ECOLOGY.format(when=ts("occurred_at")) + """
 and decision_body is not null and adjudication_environment is not null
 and exists (select 1 from fx_edges e where e.type_slug = 'relator_de' and e.valid_to is null and e.target_id = j.aggregate_id)""")
def _(x):
    return S.judgment_ecology(x.log, x.objects, x.edges)


@query("jn7_relator_signals", needs=NEEDS_A, ctes=RELATOR, sql="select actor_id, actor_slug, case_id, event_id, outcome from rs")
def _(x):
    return S.relator_signals(x.actors, x.edges, signals(x)).select("actor_id", "actor_slug", "case_id", "event_id", "outcome")


SUBJECT = SIGNALS + """,
ss as (select s.id as subject_id, s.slug as subject_slug, d.* from fx_objects s join fx_edges e on e.target_id = s.id and e.type_slug = 'sobre' and e.valid_to is null
 join ds d on d.case_id = e.source_id where s.type_slug = 'subject')"""


@query("jn8_subject_signals", needs=NEEDS_E, ctes=SUBJECT, sql="select subject_id, subject_slug, case_id, event_id, outcome from ss")
def _(x):
    return S.subject_signals(x.objects, x.edges, signals(x)).select("subject_id", "subject_slug", "case_id", "event_id", "outcome")


@query("prj7_predictive_features", needs=NEEDS, ctes=SIGNALS, sql=f"""
select case_id, case_slug, class_code, decision_body, adjudication_environment, panel_size, votes_present, {ts('judgment_date')} as judgment_date,
 outcome as outcome_label, decision_direction as direction_label, uses_modulation as modulation_label, fiscal_effect as fiscal_effect_label,
 reasoning_style, deference_level from ds""")
def _(x):
    return S.predictive_features(signals(x))


@query("prj10_slice_decisions", needs=NEEDS, ctes=SIGNALS, sql="""
select event_id, case_id, decision_body, outcome from ds where decision_body in ('plenario','primeira_turma') and adjudication_environment = 'virtual'
 and judgment_date >= timestamp '2024-01-05' and judgment_date < timestamp '2024-01-25'""")
def _(x):
    s = S.slice_decisions(signals(x), "2024-01-05 00:00:00", "2024-01-25 00:00:00",
                          decision_body=["plenario", "primeira_turma"], adjudication_environment="virtual")
    return s.select("event_id", "case_id", "decision_body", "outcome")


@query("prj11_decision_nature", needs=NEEDS, ctes=SIGNALS, sql="""
select event_id, case when collegiality_mode='monocratico' then 'monocratica' when collegiality_mode='colegiado' and adjudication_environment='virtual' then 'colegiada_formal'
 when collegiality_mode='colegiado' then 'colegiada' end as decision_nature from ds""")
def _(x):
    return S.decision_nature(signals(x)).select("event_id", "decision_nature")


@query("agg3_relator_profile", needs=NEEDS_A, ctes=RELATOR, sql=f"""
select r.actor_id, r.actor_slug, count(*) as total_decisions, count(*) filter (where outcome='procedente') as procedente_count,
 count(*) filter (where uses_modulation) as modulacao_count, count(*) filter (where fiscal_effect='contencao') as contencao_count,
 {rate("outcome='procedente'")} as procedencia_rate, {rate('uses_modulation')} as modulacao_rate, {rate("fiscal_effect='contencao'")} as contencao_fiscal_rate,
 any_value(m.mode_value) as dominant_reasoning_style
from rs r left join {mode('rs', 'actor_id', 'reasoning_style')} m on r.actor_id = m.actor_id group by r.actor_id, r.actor_slug""")
def _(x):
    return S.relator_profile(x.actors, x.edges, x.log, x.objects, x.object_types)


@query("agg4_relator_environment_profile", needs=NEEDS_A, ctes=RELATOR, sql=f"""
select actor_id, actor_slug, adjudication_environment as environment, count(*) as total_decisions, {rate("outcome='procedente'")} as procedencia_rate_env,
 {rate('uses_modulation')} as modulacao_rate_env, {rate("fiscal_effect='contencao'")} as contencao_rate_env
from rs where adjudication_environment is not null group by actor_id, actor_slug, adjudication_environment""")
def _(x):
    return S.relator_environment_profile(x.actors, x.edges, x.log, x.objects, x.object_types)


@query("agg5_body_profile", needs=NEEDS, ctes=SIGNALS, sql=f"""
select d.decision_body, count(*) as total_decisions, {rate("outcome='procedente'")} as procedencia_rate, {rate('uses_modulation')} as modulacao_rate,
 {rate("fiscal_effect='contencao'")} as contencao_rate, any_value(m.mode_value) as dominant_reasoning_style
from ds d left join {mode('ds', 'decision_body', 'reasoning_style')} m on d.decision_body = m.decision_body where d.decision_body is not null group by d.decision_body""")
def _(x):
    return S.body_profile(x.log, x.objects, x.object_types)


@query("agg6_body_environment_profile", needs=NEEDS, ctes=SIGNALS, sql=f"""
select decision_body, adjudication_environment as environment, count(*) as total_decisions, {rate("outcome='procedente'")} as procedencia_rate,
 {rate('uses_modulation')} as modulacao_rate from ds where decision_body is not null and adjudication_environment is not null group by all""")
def _(x):
    return S.body_environment_profile(x.log, x.objects, x.object_types)


@query("agg7_relator_body_profile", needs=NEEDS_A, ctes=RELATOR, sql=f"""
select actor_slug, decision_body, count(*) as total_decisions, {rate("outcome='procedente'")} as procedencia_rate, {rate('uses_modulation')} as modulacao_rate
from rs where decision_body is not null group by actor_slug, decision_body""")
def _(x):
    return S.relator_body_profile(x.actors, x.edges, x.log, x.objects, x.object_types)


@query("agg8_subject_environment_profile", needs=NEEDS_E, ctes=SUBJECT, sql=f"""
select s.subject_slug, s.adjudication_environment as environment, count(*) as total_decisions, {rate("outcome='procedente'")} as procedencia_rate,
 any_value(m.mode_value) as dominant_direction from ss s left join {mode('ss', 'subject_slug, adjudication_environment', 'decision_direction')} m
 on m.subject_slug = s.subject_slug and m.adjudication_environment = s.adjudication_environment
where s.adjudication_environment is not null group by s.subject_slug, s.adjudication_environment""")
def _(x):
    return S.subject_environment_profile(x.objects, x.edges, x.log, x.object_types)


@query("agg10_mode_of", needs=NEEDS, ctes=SIGNALS, sql=f"""
select case_id, mode_value as mode from {mode('ds', 'case_id', 'outcome_polarity')}""")
def _(x):
    return S.mode_of(signals(x), ["case_id"], "outcome_polarity")


@query("agg2_process_lifecycle", needs=NEEDS, sql=f"""
select o.id as processo_id, o.slug as processo_slug, o.type_slug, {ts('min(ev.occurred_at)')} as data_nascimento, {ts('max(ev.occurred_at)')} as evento_mais_recente,
 epoch_us(max(ev.occurred_at)) // 1000000 - epoch_us(min(ev.occurred_at)) // 1000000 as approx, count(*) as numero_eventos
from fx_objects o join fx_object_types t on o.type_slug = t.type_slug join fx_log ev on ev.aggregate_id = o.id
where t.ontological_class = 'processual' and o.valid_to is null group by o.id, o.slug, o.type_slug""")
def _(x):
    p = S.process_lifecycle(x.objects, x.object_types, x.log)
    sec = [F.unix_seconds(F.col(c).cast("timestamp")) for c in ("evento_mais_recente", "data_nascimento")]
    return p.withColumn("approx", sec[0] - sec[1]).drop("duracao_total", "duracao_segundos")


@query("frm1_process_duration_seconds", needs=NEEDS, sql="""
select o.id as processo_id, (epoch_us(max(ev.occurred_at)) - epoch_us(min(ev.occurred_at))) // 1000000 as duracao_segundos
from fx_objects o join fx_object_types t on o.type_slug = t.type_slug join fx_log ev on ev.aggregate_id = o.id
where t.ontological_class = 'processual' and o.valid_to is null group by o.id""")
def _(x):
    return S.process_lifecycle(x.objects, x.object_types, x.log).select("processo_id", "duracao_segundos")


@query("agg32_norm_profile", needs=NEEDS_E, ctes=SIGNALS, sql=f"""
select n.id as node_id, n.slug as node_slug, count(*) as activation_count, string_agg(distinct d.class_code, ',' order by d.class_code) as associated_classes,
 {rate("outcome='procedente'")} as procedencia_rate, {rate("decision_direction='expansiva'")} as expansion_rate,
 {rate("decision_direction='restritiva'")} as restriction_rate, {rate("fiscal_effect='contencao'")} as containment_rate
from fx_edges e join ds d on d.case_id = e.source_id join fx_objects n on n.id = e.target_id
where e.type_slug = 'interpreta' and e.valid_to is null group by n.id, n.slug""")
def _(x):
    p = S.norm_profile(x.objects, x.edges, x.log, x.object_types)
    return p.withColumn("associated_classes", F.array_join("associated_classes", ","))


@query("agg33_actor_profile", needs=NEEDS_A, ctes=RELATOR, sql=f"""
select r.actor_id, r.actor_slug, count(*) as total_decisions, {rate("outcome='procedente'")} as procedencia_rate, {rate('uses_modulation')} as modulacao_rate,
 {rate("fiscal_effect='contencao'")} as contencao_fiscal_rate, any_value(m.mode_value) as deference_pattern,
 any_value(s.mode_value) as dominant_reasoning_style
from rs r left join {mode('rs', 'actor_id', 'deference_level')} m on m.actor_id = r.actor_id left join {mode('rs', 'actor_id', 'reasoning_style')} s on s.actor_id = r.actor_id group by r.actor_id, r.actor_slug""")
def _(x):
    return S.actor_profile(x.actors, x.edges, x.log, x.objects, x.object_types)


@query("agg34_actor_environment_interactions", needs=("log", "actors"), ctes=JUDGMENTS, sql="""
select c.actor_id, a.slug as actor_slug, a.type_slug as actor_type, c.environment, round(c.n::double / t.n, 6) as participation_rate,
 (select nullif(round(corr((j.actor_id = c.actor_id)::int, (j.outcome = 'procedente')::int), 6), 'nan'::double) from jg j where j.adjudication_environment = c.environment) as correlation_with_outcome,
 (select nullif(round(corr((j.actor_id = c.actor_id)::int, j.uses_modulation::int), 6), 'nan'::double) from jg j where j.adjudication_environment = c.environment) as correlation_with_modulation
from (select actor_id, adjudication_environment as environment, count(*) as n from jg group by all) c
join (select adjudication_environment as environment, count(*) as n from jg group by all) t on t.environment = c.environment
left join fx_actors a on a.id = c.actor_id""")
def _(x):
    return S.actor_environment_interactions(x.log, x.actors)


_PAIR_SQL = {"relator": "relator", "body": "decision_body", "environment": "adjudication_environment", "period": "strftime(judgment_date, '%Y-%m')",
             "actor": "actor_id", "class": "class_code", "outcome": "outcome", "direction": "decision_direction",
             "modulation": "uses_modulation::varchar", "fiscal": "fiscal_effect", "subject": "subject"}


def _pairs_sql():
    out = []
    for a, b in V.AXIS_PAIRS:
        src = "fs" if "subject" in (a, b) else "fa"
        out.append(f"select '{a}' as axis_a, '{b}' as axis_b, {_PAIR_SQL[a]} as value_a, {_PAIR_SQL[b]} as value_b, count(*) as n from {src} "
                   f"where {_PAIR_SQL[a]} is not null and {_PAIR_SQL[b]} is not null group by all")
    return " union all ".join(out)


@query("agg35_axis_crosstab", needs=NEEDS_E, sql=_pairs_sql(), ctes=SIGNALS + """,
fa as (select d.*, r.relator from ds d left join (select target_id, min(source_id) as relator from fx_edges where type_slug='relator_de' and valid_to is null group by 1) r on r.target_id = d.case_id),
fs as (select d.*, e.target_id as subject from ds d join fx_edges e on e.source_id = d.case_id and e.type_slug='sobre' and e.valid_to is null)""")
def _(x):
    facts = S.axis_facts(x.log, x.objects, x.edges, x.object_types)
    by_case = [p for p in V.AXIS_PAIRS if "subject" not in p]
    by_subject = [p for p in V.AXIS_PAIRS if "subject" in p]
    about = S.active(x.edges.filter(F.col("type_slug") == "sobre")).groupBy(F.col("source_id").alias("case_id"), F.col("target_id").alias("subject")).agg(
        F.count("*").alias("links"))
    case_facts = facts.groupBy("case_id", "environment", "actor").agg(F.sum("n").alias("n"))
    weighted = case_facts.join(about, "case_id").withColumn("n", F.col("n") * F.col("links"))
    return S.axis_crosstab(facts, by_case).unionByName(S.axis_crosstab(weighted, by_subject))


@query("agg36_conditional_rate", needs=NEEDS, ctes=SIGNALS, sql="""
select *, (sum(n) over w)::bigint as given_n, round(n::double / sum(n) over w, 6) as probability
from (select class_code, decision_body, adjudication_environment, outcome, count(*) as n from ds group by all)
window w as (partition by class_code, decision_body, adjudication_environment)""")
def _(x):
    return S.conditional_rate(signals(x), "outcome", ["class_code", "decision_body", "adjudication_environment"])


@query("agg37_judgment_environment_profile", needs=NEEDS_A, ctes=SIGNALS, sql="""
select d.case_id, d.case_slug, r.relator, a.slug as relator_slug, d.event_id, d.decision_body, d.adjudication_environment, d.session_format, d.outcome, d.decision_direction, d.uses_modulation, d.fiscal_effect
from ds d left join (select target_id, min(source_id) as relator from fx_edges where type_slug='relator_de' and valid_to is null group by 1) r on r.target_id = d.case_id
left join fx_actors a on a.id = r.relator""")
def _(x):
    return S.judgment_environment_profile(x.log, x.objects, x.edges, x.object_types, x.actors)


@query("agg37_case_subjects", needs=("edges",), sql="select distinct source_id as case_id, target_id as subject from fx_edges where type_slug='sobre' and valid_to is null")
def _(x):
    return S.case_subjects(x.edges)


@query("agg38_collegial_dynamics", needs=("log",), ctes=JUDGMENTS, sql="""
select event_id as julgamento_id, aggregate_id, vista_present as vista_presente, destaque_present as destaque_presente, divergence_present as divergencia_presente,
 coalesce(lag(adjudication_environment) over (partition by aggregate_id order by occurred_at, event_id) <> adjudication_environment, false) as migracao_ambiente from jg""")
def _(x):
    return S.collegial_dynamics(x.log)


@query("agg38_case_members", needs=("roles",), sql="""
select distinct target_id as aggregate_id, source_id as member, json_extract_string(payload,'$.role') as role from fx_roles where type_slug='exerce_papel'""")
def _(x):
    return S.case_members(x.roles)


@query("jn18_co_participation", needs=("edges", "roles"), sql="""
select r.source_id as relator, p.source_id as other, count(distinct p.target_id) as cases, count(*) as appearances
from fx_roles p join (select distinct source_id, target_id from fx_edges where type_slug='relator_de' and valid_to is null) r on r.target_id = p.target_id
where r.source_id <> p.source_id group by 1, 2""")
def _(x):
    return S.co_participation(x.edges, x.roles)


ORDERED = "row_number() over (partition by aggregate_id order by occurred_at, event_id)"


@query("win5_time_between", needs=("log",), sql=f"""
select aggregate_id, event_id, type_slug, {ts('occurred_at')} as occurred_at, {ts('p')} as previous_at, (epoch_us(occurred_at) - epoch_us(p)) // 1000000 as tem_seconds
from (select *, lag(occurred_at) over (partition by aggregate_id order by occurred_at, event_id) as p from fx_log)""")
def _(x):
    return S.time_between(x.log)


@query("win6_trajectory", needs=("log",), sql=f"select aggregate_id, event_id, type_slug as milestone, {ORDERED} as step from fx_log")
def _(x):
    return S.trajectory(x.log).drop("occurred_at")


TRAJ = """tr as (select aggregate_id, string_agg(type_slug, '>' order by occurred_at, event_id) as seq, count(*) as length,
 (epoch_us(max(occurred_at)) - epoch_us(min(occurred_at))) // 1000000 as dur from fx_log group by 1)"""


@query("win6_trajectory_patterns", needs=("log",), ctes=TRAJ, sql="""
select length, count(*) as frequencia, round(avg(dur), 3) as duracao_media, min(aggregate_id) as example from tr group by seq, length""")
def _(x):
    return S.trajectory_patterns(S.trajectory(x.log)).drop("pattern_id")


@query("win6_pattern_steps", needs=("log",), ctes=TRAJ, sql=f"""
select example, step, milestone from (select seq, min(aggregate_id) as example from tr group by seq) p
join (select aggregate_id, {ORDERED} as step, type_slug as milestone from fx_log) l on l.aggregate_id = p.example""")
def _(x):
    steps = S.trajectory(x.log)
    p = S.trajectory_patterns(steps).select("pattern_id", "example")
    return S.pattern_steps(steps).join(p, "pattern_id").drop("pattern_id")


@query("frm1_frm5_process_indices", needs=("log",), ctes=JUDGMENTS, sql="""
select aggregate_id, (epoch_us(last_at) - epoch_us(dist_at)) // 1000000 as dvp_seconds, round(susp::double / total, 6) as iip,
 kinds * ((epoch_us(last_at) - epoch_us(first_at)) // 1000000) * forks as ict, round(destaque::double / nullif(virt, 0), 6) as tcvp,
 trunc((epoch_us(present_at) - epoch_us(virtual_at)) / 1000000)::bigint as tm_seconds
from (select l.aggregate_id, count(*) as total, count(distinct l.type_slug) as kinds, min(l.occurred_at) as first_at, max(l.occurred_at) as last_at,
  min(l.occurred_at) filter (where l.type_slug = 'distribuicao') as dist_at, count(*) filter (where l.type_slug = 'mudanca_estado') as susp,
  count(*) filter (where j.adjudication_environment = 'virtual') as virt, count(*) filter (where j.destaque_present) as destaque,
  min(l.occurred_at) filter (where j.adjudication_environment = 'virtual') as virtual_at,
  min(l.occurred_at) filter (where j.adjudication_environment = 'presencial') as present_at,
  count(*) filter (where l.event_id in (select causation_id from fx_log where causation_id is not null group by 1 having count(*) > 1)) as forks
 from fx_log l left join jg j on j.event_id = l.event_id group by l.aggregate_id)""")
def _(x):
    return S.process_indices(x.log)


@query("frm6_virtual_index", needs=NEEDS_A, ctes=RELATOR, sql=f"""
select actor_id, actor_slug, count(*) as n, {rate("adjudication_environment='virtual'", digits=6)} as ivr from rs group by 1, 2""")
def _(x):
    return S.virtual_index(x.actors, x.edges, x.log, x.objects, x.object_types)


@query("frm8_frm12_decision_indices", needs=NEEDS, ctes=SIGNALS, sql="""
select decision_body, round(count(*) filter (where fiscal_effect='contencao')::double / nullif(count(*) filter (where fiscal_effect in ('contencao','expansivo')), 0), 6) as icf,
 round(count(*) filter (where decision_direction='expansiva')::double / count(*), 6) as ied from ds group by 1""")
def _(x):
    return S.decision_indices(x.log, x.objects, x.object_types)


@query("frm13_stability_index", needs=("argument_edges",), sql="""
select target_id as precedent, count(*) filter (where type_slug='confirma') as confirma, count(*) as total,
 round(count(*) filter (where type_slug='confirma')::double / count(*), 6) as iei from fx_argument_edges group by 1""")
def _(x):
    return S.stability_index(x.argument_edges)


@query("frm7_frm11_fiscal_exposure", needs=("fiscal", "decisions"), sql="""
select f.decision, f.entity, round(sum(case when booked_at > decided_at then effective else 0 end) - sum(case when booked_at > decided_at then 0 else effective end), 2)::double as efr,
 round(1 - sum(effective)::double / nullif(sum(potential)::double, 0), 6) as icf_pct, date_diff('day', min(decided_at), min(booked_at)) as idt_days, round(min(recognised) - sum(effective), 2)::double as idc
from fx_fiscal f join fx_decisions d on d.decision = f.decision group by f.decision, f.entity""")
def _(x):
    return S.fiscal_exposure(x.fiscal, x.decisions)


@query("frm10_fiscal_impact_index", needs=("fiscal",), sql="""
select decision, round(sum(potential * confidence * (case when retroactive then 1.5::decimal(2,1) else 1.0::decimal(2,1) end)
 * (case horizon when 'imediato' then 1.00::decimal(3,2) when 'curto' then 0.90::decimal(3,2) when 'medio' then 0.75::decimal(3,2) when 'longo' then 0.50::decimal(3,2) end)), 2)::double as iifd, count(*) as estimates
from fx_fiscal group by 1""")
def _(x):
    return S.fiscal_impact_index(x.fiscal)
