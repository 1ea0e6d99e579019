"""Views over objects, actors, events and edges; temporal reconstruction."""

from pyspark.sql import functions as F

from lexanchor.operators import core as C, versions as VS
from lexanchor.plans.registry import query, ts


@query("jn1_objects_readable", needs=("objects", "object_types"), sql=f"""
select o.id, o.slug, o.type_slug, t.domain_slug, t.ontological_class, t.label as type_label, o.payload, o.hash_content,
 {ts('o.valid_from')} as valid_from, {ts('o.valid_to')} as valid_to, {ts('o.recorded_at')} as recorded_at
from fx_objects o join fx_object_types t on o.type_slug = t.type_slug""")
def _(x):
    return C.objects_readable(x.objects, x.object_types)


EDGE_SQL = """
select e.edge_id, e.type_slug, t.epistemic_class, t.label as type_label, e.source_id, s.slug as source_slug, e.target_id,
 g.slug as target_slug, e.weight
from fx_edges e join fx_edge_types t on e.type_slug = t.type_slug left join {ends} s on e.source_id = s.id
left join {ends} g on e.target_id = g.id"""
EDGE_COLS = ["edge_id", "type_slug", "epistemic_class", "type_label", "source_id", "source_slug", "target_id", "target_slug", "weight"]


@query("jn2_edges_readable", needs=("edges", "edge_types", "objects"), sql=EDGE_SQL.format(ends="fx_objects"))
def _(x):
    return C.edges_readable(x.edges, x.edge_types, x.objects).select(*EDGE_COLS)


@query("jn2_edges_readable_all_endpoints", needs=("edges", "edge_types", "objects", "actors"),
       ctes="ends as (select id, slug from fx_objects union all select id, slug from fx_actors)",
       sql=EDGE_SQL.format(ends="ends"))
def _(x):
    return C.edges_readable(x.edges, x.edge_types, x.objects, x.actors).select(*EDGE_COLS)


STATES = """st as (select * from (select *, json_extract_string(payload,'$.to_state') as to_state,
  row_number() over (partition by aggregate_id order by occurred_at desc, event_id) as rn
  from fx_log where list_contains(json_keys(payload), 'to_state')) where rn = 1),
cur as (select s.aggregate_id as id, coalesce(o.slug, a.slug) as slug, coalesce(o.type_slug, a.type_slug) as type_slug,
  coalesce(t.domain_slug, aty.domain_slug) as domain_slug, s.to_state as current_state, s.occurred_at as last_event_at
  from st s left join fx_objects o on s.aggregate_id = o.id left join fx_actors a on s.aggregate_id = a.id
  left join fx_object_types t on o.type_slug = t.type_slug left join fx_actor_types aty on a.type_slug = aty.type_slug)"""
STATE_NEEDS = ("log", "objects", "actors", "object_types", "actor_types")


def current(x):
    return C.current_state(x.log, x.objects, x.actors, x.object_types, x.actor_types)


@query("win1_current_state", needs=STATE_NEEDS, ctes=STATES,
       sql=f"select id, slug, type_slug, domain_slug, current_state, {ts('last_event_at')} as last_event_at from cur")
def _(x):
    return current(x)


@query("tmp4_terminal_states", needs=STATE_NEEDS + ("state_types",), ctes=STATES, sql="""
select c.id, c.current_state, c.type_slug, coalesce(s.terminal, false) as terminal from cur c
left join fx_state_types s on s.type_slug = c.current_state and s.object_type_slug = c.type_slug""")
def _(x):
    return C.with_terminal(current(x), x.state_types).select("id", "current_state", "type_slug", "terminal")


@query("prj2_json_key_exists", needs=("log",), sql="""
select event_id, list_contains(json_keys(payload), 'to_state') as has_state, json_extract_string(payload,'$.to_state') as to_state
from fx_log""")
def _(x):
    return x.log.select("event_id", C.jhas("payload", "to_state").alias("has_state"), C.jget("payload", "to_state").alias("to_state"))


@query("jn3_tree_nodes", needs=("objects", "object_types", "edges"), sql="""
select c.id, c.slug, c.type_slug, t.domain_slug, e.source_id as parent_id, p.slug as parent_slug,
 json_extract_string(c.payload,'$.path_slug') as path_slug, try_cast(json_extract_string(c.payload,'$.depth_level') as int) as depth_level,
 try_cast(json_extract_string(c.payload,'$.sibling_order') as int) as sibling_order
from fx_objects c join fx_object_types t on c.type_slug = t.type_slug
left join fx_edges e on e.target_id = c.id and e.type_slug = 'parent_of' and e.valid_to is null
left join fx_objects p on e.source_id = p.id where c.valid_to is null""")
def _(x):
    return C.tree_nodes(x.objects, x.object_types, x.edges)


DECIDABILITY = """dec as (select o.id as node_id, o.slug as node_slug, t.domain_slug, e.type_slug as edge_type, count(*) as edge_count
from fx_objects o join fx_object_types t on o.type_slug = t.type_slug join fx_edges e on e.target_id = o.id and e.valid_to is null
where t.domain_slug = 'normativo' and o.valid_to is null group by all)"""


@query("agg1_decidability_index", needs=("objects", "object_types", "edges"), ctes=DECIDABILITY, sql="select * from dec")
def _(x):
    return C.decidability_index(x.objects, x.object_types, x.edges)


@query("agg1_decidability_totals", needs=("objects", "object_types", "edges"), ctes=DECIDABILITY, sql="""
select node_id, sum(edge_count)::bigint as total_edges, string_agg(edge_type||'='||edge_count, ',' order by edge_type) as by_type
from dec group by node_id""")
def _(x):
    t = C.decidability_totals(C.decidability_index(x.objects, x.object_types, x.edges))
    pairs = F.transform(F.map_entries("edge_count_by_type"), lambda p: F.concat(p["key"], F.lit("="), p["value"].cast("string")))
    return t.select("node_id", "total_edges", F.array_join(pairs, ",").alias("by_type"))


AT = "2000-01-01 00:00:00"


def _as_of_sql(at: str) -> str:
    alive = f"(valid_from is null or valid_from <= timestamp '{at}') and (valid_to is null or valid_to > timestamp '{at}')"
    return f"""select '{at}' as at, 'objects' as part, type_slug, count(*) as n from fx_objects where {alive} group by type_slug
union all select '{at}', 'events', type_slug, count(*) from fx_log where occurred_at <= timestamp '{at}' group by type_slug
union all select '{at}', 'edges', type_slug, count(*) from fx_edges where {alive} group by type_slug"""


#: A time before all events and one amid them.
AS_OF = (AT, "2024-01-15 12:00:00")


@query("tmp1_as_of", needs=("objects", "log", "edges"), sql=" union all ".join(map(_as_of_sql, AS_OF)))
def _(x):
    out = None
    for at in AS_OF:
        for part, d in zip(("objects", "events", "edges"), C.as_of(x.objects, x.log, x.edges, at), strict=True):
            n = d.groupBy("type_slug").agg(F.count("*").alias("n")).select(F.lit(at).alias("at"), F.lit(part).alias("part"), "type_slug", "n")
            out = n if out is None else out.unionByName(n)
    return out


@query("tmp2_known_at", needs=("log",), sql="""
select event_id, type_slug, aggregate_id from fx_log where recorded_at <= timestamp '2024-01-20 00:00:00'""")
def _(x):
    return C.known_at(x.log, "2024-01-20 00:00:00").select("event_id", "type_slug", "aggregate_id")


@query("tmp3_state_intervals", needs=("log",), sql=f"""
select aggregate_id, event_id, json_extract_string(payload,'$.to_state') as state, {ts('occurred_at')} as from_at,
 {ts('lead(occurred_at) over (partition by aggregate_id order by occurred_at, event_id)')} as to_at
from fx_log where list_contains(json_keys(payload), 'to_state')""")
def _(x):
    return C.state_intervals(x.log)


@query("tmp5_close_entities", needs=("objects",), sql="""
select o.id, '2002-01-01 00:00:00' as valid_to, 'ev-'||md5('anulacao|'||o.id) as event_id, 'anulacao' as type_slug,
 '{"reason":"encerrado","hash_anulado":"'||o.hash_content||'"}' as payload from fx_objects o where o.valid_to is null and o.type_slug = 'acao_direta'""")
def _(x):
    closed, events = C.close_entities(x.objects.filter(F.col("type_slug") == "acao_direta"), "2002-01-01 00:00:00", "encerrado", "sistema-pipeline")
    return closed.select("id", "valid_to").join(
        events.select(F.col("aggregate_id").alias("id"), "event_id", "type_slug", "payload"), "id")


@query("tmp6_corrections", needs=("objects",), sql="""
select 'ev-'||md5('correcao|'||slug||'|'||md5(payload||'x')) as event_id, 'correcao' as type_slug, id as aggregate_id,
 '{"hash_anterior":"'||hash_content||'"}' as payload from fx_objects where length(payload)%3=0""")
def _(x):
    changed = F.length("payload") % 3 == 0
    new = x.objects.withColumn("hash_content", F.when(changed, F.md5(F.concat("payload", F.lit("x")))).otherwise(F.col("hash_content")))
    return C.corrections(x.objects, new)


VERSIONED = """told as (select json_extract_string(payload,'$.emenda_slug') as amendment, json_extract_string(payload,'$.node_afetado') as node, occurred_at, event_id,
 json_extract_string(payload,'$.action') as action from fx_norm_events where type_slug = 'emenda_aplicada'),
am as (select * from told union all select source_id, target_id, valid_from, edge_id, null from fx_amend_edges e where type_slug = 'amends'
 and not exists (select 1 from told t where t.amendment = e.source_id and t.node = e.target_id))"""


@query("tmp7_version_changes", needs=("norm_events", "amend_edges", "objects"), ctes=VERSIONED, sql=f"""
select a.amendment, {ts('a.occurred_at')} as occurred_at, a.node, o.slug as node_slug, o.type_slug, a.action,
 coalesce(a.action, '') like 'adicionou%' as added, coalesce(a.action, '') = 'revogou' as repealed from am a join fx_objects o on a.node = o.id""")
def _(x):
    return VS.version_changes(x.norm_events, x.amend_edges, x.objects)


@query("tmp7_version_summary", needs=("norm_events", "amend_edges", "objects"), ctes=VERSIONED, sql=f"""
select a.*, e.source_id as version, e.target_id as work from (
 select amendment, {ts('min(occurred_at)')} as occurred_at, count(*) filter (where action like 'adicionou%') as nodes_added,
  count(*) filter (where action is null or action not like 'adicionou%' and action <> 'revogou') as nodes_changed, count(*) filter (where action = 'revogou') as nodes_repealed
 from am join fx_objects o on node = o.id group by 1) a
left join fx_amend_edges e on e.type_slug = 'version_of' and substr(e.source_id, 3) = a.amendment""")
def _(x):
    marks = VS.version_marks(x.amend_edges, F.substring("source_id", 3, 100))
    return VS.version_summary(VS.version_changes(x.norm_events, x.amend_edges, x.objects), marks)


INTERVALS = VERSIONED + """,
vr as (select node, occurred_at, event_id, amendment, action from am union all select aggregate_id, occurred_at, event_id, null, 'anulou' from fx_norm_events where type_slug = 'anulacao'),
vi as (select node, count(*) filter (where action is distinct from 'anulou') over w as version, amendment, action,
 case action when 'anulou' then 'anulada' when 'revogou' then 'revogada' else 'vigente' end as state, occurred_at as from_at, lead(occurred_at) over v as to_at
 from vr window w as (partition by node order by occurred_at, event_id rows between unbounded preceding and current row), v as (partition by node order by occurred_at, event_id))"""


@query("tmp7_node_versions", needs=("norm_events", "amend_edges"), ctes=INTERVALS, sql=f"select * replace ({ts('from_at')} as from_at, {ts('to_at')} as to_at) from vi")
def _(x):
    return VS.node_versions(x.norm_events, x.amend_edges)


@query("tmp7_versions_at", needs=("norm_events", "amend_edges"), ctes=INTERVALS, sql="""
select node, version, state from vi where from_at <= timestamp '1992-06-01 00:00:00' and (to_at is null or to_at > timestamp '1992-06-01 00:00:00')""")
def _(x):
    return VS.versions_at(VS.node_versions(x.norm_events, x.amend_edges), "1992-06-01 00:00:00").select("node", "version", "state")
