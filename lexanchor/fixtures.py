"""Mapping of the given tables onto the corpus model.

Each mapping is one SQL text that Spark and DuckDB both accept, so the checks of
the operators start from the same rows on both sides. ``@name@`` marks a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from lexanchor import vocab as V

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]
ROMAN_1_20 = "I II III IV V VI VII VIII IX X XI XII XIII XIV XV XVI XVII XVIII XIX XX".split()
NAMES = [
    "Marco Aurelio", "Roberto Barroso", "Cármen Lúcia", "Dias Tofolli", "Rosa Weber", "Luiz Fux", "Celso de Mello",
    "Eros Gr", "Nelson", "Gilmar Mendes",
]
MARKERS = [
    "sumula_vinculante", "controle_concentrado", "repercussao_geral", "julgados_correlatos", "sem_categoria", "",
]


def pick(index: str, values: list[str], start: int = 0) -> str:
    """SQL choosing the index-th text of a list."""
    arms = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values, start))
    return f"case {index} {arms} end"


def values_sql(cols: list[str], rows: list[tuple]) -> str:
    """Inline constant table."""

    def lit(x):
        if x is None:
            return "cast(null as string)"
        if isinstance(x, (bool, int, float)):
            return str(x).lower()
        return "'" + x.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)
    return f"select * from (values {body}) as t({', '.join(cols)})"


def _rows(source: str, cols: str, exprs: list[str], dialect: str) -> str:
    """One output row (i, text) per non-null expression."""
    if dialect == "spark":
        return (
            f"select {cols}, i, text from ({source}) s lateral view posexplode(array({', '.join(exprs)})) x as i, text "
            "where text is not null"
        )
    idx = ", ".join(str(i) for i in range(len(exprs)))
    return (
        f"select * from (select {cols}, unnest([{idx}]) as i, unnest([{', '.join(exprs)}]) as text from ({source}) s) u "
        "where text is not null"
    )


_K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"
_JUDGMENT = (
    "'{\"outcome\":\"'||case event_type when 'purchase' then 'procedente' when 'click' then 'parcial' else 'improcedente' end"
    "||'\",\"outcome_polarity\":\"'||case k%4 when 0 then 'favor_autor' when 1 then 'favor_reu' when 2 then 'favor_estado' else 'misto' end"
    "||'\",\"decision_unanimity\":\"'||case k%3 when 0 then 'maioria' else 'unanime' end"
    "||'\",\"uses_modulation\":'||case when k%4=0 then 'true' else 'false' end"
    "||',\"fiscal_effect\":\"'||case when k%5=0 then 'contencao' when k%5=1 then 'expansivo' else 'neutro' end"
    "||'\",\"reasoning_style\":\"'||case k%3 when 0 then 'formalista' when 1 then 'pragmatica' else 'mista' end"
    "||'\",\"deference_level\":\"'||case k%3 when 0 then 'alto' when 1 then 'medio' else 'baixo' end"
    "||'\",\"decision_direction\":\"'||case k%2 when 0 then 'expansiva' else 'restritiva' end"
    "||'\",\"decision_body\":\"'||case k%3 when 0 then 'plenario' when 1 then 'primeira_turma' else 'segunda_turma' end"
    "||'\",\"adjudication_environment\":\"'||case k%2 when 0 then 'virtual' else 'presencial' end"
    "||'\",\"collegiality_mode\":\"'||case when k%9=0 then 'monocratico' else 'colegiado' end"
    "||'\",\"session_format\":\"'||case k%2 when 0 then 'assincrona' else 'sincrona' end"
    "||'\",\"oral_argument_present\":'||case when k%6=0 then 'true' else 'false' end"
    "||',\"destaque_present\":'||case when k%8=0 then 'true' else 'false' end"
    "||',\"vista_present\":'||case when k%12=0 then 'true' else 'false' end"
    "||',\"divergence_present\":'||case when k%7=0 then 'true' else 'false' end"
    "||',\"panel_size\":'||case when k%10=0 then 'null' else cast(5+k%7 as string) end"
    "||',\"votes_present\":'||cast(4+k%7 as string)"
    "||case when k%13=0 then ',\"relator\":\"x\"' else '' end"
    "||case when k%7=0 then '' else ',\"extraction_method\":\"automatico\",\"confidence_score\":0.'||cast(1+k%9 as string) end||'}'"
)

_ORDER_TEXT = {
    "n": "1 + o_custkey % 40",
    "cls": pick("o_custkey % 6", ["ADI", "RE", "HC", "MS", "ADPF", "ARE"]),
    "num": "'1.'||cast(100 + o_custkey % 300 as string)",
    "name": pick("o_custkey % 10", NAMES),
    "day": "cast(extract(day from o_orderdate) as string)",
    "month": "cast(extract(month from o_orderdate) as string)",
    "year": "cast(extract(year from o_orderdate) as string)",
    "marker": pick("o_orderkey % 6", MARKERS),
    "rom": pick("o_custkey % 20", ROMAN_1_20),
}
_META = (
    "'['||cls||' '||num||', rel. min. '||name||', j. '||day||'-'||month||'-'||year||', '||"
    "case when o_custkey%3=0 then 'P' else cast(1+o_custkey%2 as string)||'ª T' end||', DJE de '||day||'-'||month||'-'||year||"
    "case when o_custkey%5=0 then ', Tema '||cast(o_custkey%90 as string) else '' end||"
    "case when o_custkey%7=0 then ', com mérito julgado' else '' end||'.]'"
)
_TEXT = (
    "'Decisão '||cast(o_custkey as string)||' sobre o Art. '||cast(n as string)||'º'||case o_custkey%4 "
    "when 0 then ', inciso '||rom||', alínea a)' when 1 then ', § '||cast(1+o_custkey%3 as string)||'º' "
    "when 2 then ' da Constituição' else ' do ADCT' end||' e a jurisprudência consolidada do tribunal.'"
)
_ORDER_BASE = (
    "select o.*, cast(floor(o_orderkey / 400) as bigint) as doc, o_orderkey % 400 as k, "
    + ", ".join(f"{e} as {c}" for c, e in _ORDER_TEXT.items())
    + " from @orders@ o"
)


def _definitions(dialect: str) -> dict[str, str]:
    d: dict[str, str] = {}
    d["domains"] = values_sql(["domain_slug", "label", "parent_domain_slug"], V.DOMAINS)
    d["object_types"] = values_sql(["type_slug", "domain_slug", "ontological_class", "label"], V.OBJECT_TYPES)
    d["actor_types"] = values_sql(["type_slug", "domain_slug", "actor_class", "label"], V.ACTOR_TYPES)
    d["event_types"] = values_sql(["type_slug", "domain_slug", "event_class", "label"], V.EVENT_TYPES)
    d["edge_types"] = values_sql(
        ["type_slug", "source_domain_slug", "target_domain_slug", "epistemic_class", "label", "bidirectional",
         "allows_multiple", "weight_semantics", "weight_required"], V.EDGE_TYPES)
    d["state_types"] = values_sql(["type_slug", "object_type_slug", "domain_slug", "label", "terminal"], V.STATE_TYPES)

    d["objects"] = """
select id, id as slug, type_slug, payload, md5(payload) as hash_content, valid_from, valid_to, recorded_at from (
  select 'ord-'||cast(o_orderkey as string) as id, 'acao_direta' as type_slug,
    '{"process_number":"ADI '||cast(o_orderkey as string)||'","class_code":"ADI"'||
    case when o_orderkey%11=0 then '' else ',"court":"stf"' end||
    case when o_orderkey%17=0 then ',"current_state":"julgada"' else '' end||'}' as payload,
    o_orderdate as valid_from,
    case when o_orderstatus='F' then o_orderdate + interval 365 days end as valid_to, o_orderdate as recorded_at
  from @orders@
  union all
  select 'part-'||cast(p_partkey as string), 'subject', '{"label":"'||p_name||'","area":"'||p_brand||'"}',
    cast(null as timestamp@NTZ@), cast(null as timestamp@NTZ@), cast('1990-01-01 00:00:00' as timestamp@NTZ@) from @part@
  union all
  select 'reg-'||cast(r_regionkey as string), 'titulo',
    '{"text_content":"'||r_name||'","sibling_order":'||cast(r_regionkey as string)||',"numero_romano":"I","depth_level":"1","path_slug":"reg-'||cast(r_regionkey as string)||'"}',
    cast(null as timestamp@NTZ@), cast(null as timestamp@NTZ@), cast('1990-01-01 00:00:00' as timestamp@NTZ@) from @region@
  union all
  select 'nat-'||cast(n_nationkey as string), 'capitulo',
    '{"text_content":"'||n_name||'","sibling_order":'||cast(n_nationkey as string)||',"numero_romano":"II","depth_level":"2"}',
    cast(null as timestamp@NTZ@), cast(null as timestamp@NTZ@), cast('1990-01-01 00:00:00' as timestamp@NTZ@) from @nation@
  union all
  select 'cust-'||cast(c_custkey as string), 'artigo',
    '{"text_content":"'||c_name||'","sibling_order":'||cast(c_custkey as string)||',"depth_level":"3","numero_texto":"'||cast(c_custkey as string)||'"}',
    cast(null as timestamp@NTZ@), cast(null as timestamp@NTZ@), cast('1990-01-01 00:00:00' as timestamp@NTZ@) from @customer@
) x"""
    d["actors"] = """
select 'sup-'||cast(s_suppkey as string) as id, 'sup-'||cast(s_suppkey as string) as slug, 'ministro_stf' as type_slug,
  '{"name":"'||s_name||'"}' as payload, cast(null as string) as dedup_hash, cast(null as timestamp@NTZ@) as valid_from,
  cast(null as timestamp@NTZ@) as valid_to, cast('1990-01-01 00:00:00' as timestamp@NTZ@) as recorded_at from @supplier@"""
    d["edges"] = """
select 'rel-'||cast(l_orderkey as string) as edge_id, 'relator_de' as type_slug,
  'sup-'||cast(min(l_suppkey) as string) as source_id, 'ord-'||cast(l_orderkey as string) as target_id,
  cast(null as double) as weight, cast(null as string) as payload, cast(null as timestamp@NTZ@) as valid_from,
  cast(null as timestamp@NTZ@) as valid_to
  from @lineitem@ where l_linenumber = 1 group by l_orderkey
union all
select 'li-'||cast(l_orderkey as string)||'-'||cast(l_linenumber as string)||'-'||cast(l_partkey as string), 'sobre',
  'ord-'||cast(l_orderkey as string), 'part-'||cast(l_partkey as string), l_discount, cast(null as string),
  cast(null as timestamp@NTZ@), case when l_linestatus='F' then l_shipdate end from @lineitem@
union all
select 'int-'||cast(o_orderkey as string), 'interpreta', 'ord-'||cast(o_orderkey as string),
  'cust-'||cast(o_custkey as string), case when o_orderkey%23=0 then null else 0.5 end,
  case when o_orderkey%3=0 then '{"citation_text":"x"}' else '{"extraction_method":"manual"}' end, o_orderdate,
  cast(null as timestamp@NTZ@) from @orders@
union all
select 'pr-'||cast(n_nationkey as string), 'parent_of', 'reg-'||cast(n_regionkey as string),
  'nat-'||cast(n_nationkey as string), cast(null as double), cast(null as string), cast(null as timestamp@NTZ@),
  cast(null as timestamp@NTZ@) from @nation@
union all
select 'pn-'||cast(c_custkey as string), 'parent_of', 'nat-'||cast(c_nationkey as string),
  'cust-'||cast(c_custkey as string), cast(null as double), cast(null as string), cast(null as timestamp@NTZ@),
  cast(null as timestamp@NTZ@) from @customer@"""
    d["event_keys"] = f"select *, {_K} as k from @events@"
    d["log"] = f"""
select 'ev-'||cast(event_id as string) as event_id,
  case event_type when 'view' then 'mudanca_estado' when 'signup' then 'distribuicao' else 'julgamento' end as type_slug,
  'ord-'||cast(user_id as string) as aggregate_id, 'sup-'||cast(event_id % 10 as string) as actor_id,
  case event_type when 'view' then '{{"from_state":"distribuida","to_state":'||case when k%10=0 then 'null'
      when k%3=0 then '"pautada"' when k%3=1 then '"julgada"' else '"transitada"' end||'}}'
    when 'signup' then '{{}}' else {_JUDGMENT} end as payload,
  case when event_id%10=0 then null when event_id%47=5 then 'ev-lost-'||cast(event_id as string) else 'ev-'||cast(event_id - 1 - (event_id%10)%2 * (case when event_id%10>1 then 1 else 0 end) as string) end as causation_id,
  ts as occurred_at, ts + interval 1 days as recorded_at
from @event_keys@ e"""
    d["roles"] = f"""
select 'pap-'||cast(event_id as string) as edge_id, 'exerce_papel' as type_slug, 'sup-'||cast(event_id % 10 as string) as source_id,
  'ord-'||cast(user_id as string) as target_id, cast(null as double) as weight,
  '{{"role":"'||case k%4 when 0 then 'relator' when 1 then 'votante' when 2 then 'divergente' else 'presidente_sessao' end||'"}}' as payload,
  cast(null as timestamp@NTZ@) as valid_from, cast(null as timestamp@NTZ@) as valid_to
from @event_keys@ e where event_type in ('purchase','click','error')"""
    d["argument_edges"] = """
select 'arg-'||cast(o_orderkey as string) as edge_id,
  case o_orderkey%5 when 0 then 'supera' when 1 then 'contradiz' else 'confirma' end as type_slug,
  'ord-'||cast(o_orderkey as string) as source_id, 'ord-'||cast(cast(floor(o_orderkey / 7) as bigint) as string) as target_id,
  0.5 as weight, cast(null as string) as payload, cast(null as timestamp@NTZ@) as valid_from, cast(null as timestamp@NTZ@) as valid_to
from @orders@ where o_orderkey > 0"""
    d["succession_edges"] = """
select 'suc-'||cast(s_suppkey as string) as edge_id, 'sucede' as type_slug, 'sup-'||cast(s_suppkey as string) as source_id,
  'sup-'||cast(s_suppkey - 5 as string) as target_id, cast(null as double) as weight, cast(null as string) as payload,
  cast(null as timestamp@NTZ@) as valid_from, cast(null as timestamp@NTZ@) as valid_to
from @supplier@ where s_suppkey >= 5"""
    d["subject_edges"] = """
select 'sub-'||cast(p_partkey as string) as edge_id, 'parent_of' as type_slug,
  'part-'||cast(cast(floor(p_partkey / 10) as bigint) as string) as source_id, 'part-'||cast(p_partkey as string) as target_id
from @part@ where p_partkey > 0"""
    d["amend_edges"] = """
select 'am-'||cast(c_custkey as string) as edge_id, 'amends' as type_slug, 'ec-'||cast(c_nationkey as string) as source_id, 'cust-'||cast(c_custkey as string) as target_id,
  cast('1990-01-01 00:00:00' as timestamp@NTZ@) + interval 30 days * c_nationkey as valid_from, cast(null as timestamp@NTZ@) as valid_to from @customer@
union all
select 'vo-'||cast(n_nationkey as string), 'version_of', 'v-ec-'||cast(n_nationkey as string), 'reg-'||cast(n_regionkey as string),
  cast('1990-01-01 00:00:00' as timestamp@NTZ@) + interval 30 days * n_nationkey, cast(null as timestamp@NTZ@) from @nation@"""
    node = "'cust-'||cast(c_custkey as string)"
    applied = "'{\"emenda_slug\":\"ec-'||cast(%s as string)||'\",\"action\":\"'||%s||'\",\"node_afetado\":\"'||" + node + "||'\"}'"
    action = "case c_custkey%3 when 0 then 'adicionou_paragrafo' when 1 then 'alterou_texto' else 'revogou' end"
    start = "cast('1990-01-01 00:00:00' as timestamp@NTZ@) + interval 30 days * "
    event = "select '{0}-'||cast(c_custkey as string) as event_id, '{1}' as type_slug, " + node + " as aggregate_id, {2} as payload, {3} as occurred_at from @customer@ where {4}"
    d["norm_events"] = " union all ".join([
        event.format("ea", "emenda_aplicada", applied % ("c_nationkey", action), start + "c_nationkey", "c_custkey%5 <> 4"),
        event.format("eb", "emenda_aplicada", applied % ("25 + c_nationkey", "'alterou_texto'"), start + "(25 + c_nationkey)", "c_custkey%4 = 1"),
        event.format("mr", "mudanca_estado", "'{\"from_state\":\"vigente\",\"to_state\":\"revogada\"}'", start + "c_nationkey", "c_custkey%3 = 2"),
        event.format("mv", "mudanca_estado", "'{\"from_state\":\"revogada\",\"to_state\":\"vigente\"}'", start + "(60 + c_nationkey)", "c_custkey%12 = 2"),
        event.format("an", "anulacao", "'{\"reason\":\"duplicado\"}'", start + "(40 + c_nationkey)", "c_custkey%7 = 0"),
    ])
    d["provenance"] = """
select 'pv-'||cast(o_orderkey as string) as provenance_id, 'ord-'||cast(o_orderkey as string) as target_id,
  case when o_orderkey%50=7 then 'outra' else 'objects' end as target_table,
  case o_orderkey%4 when 0 then 'manual' when 1 then 'parsing' when 2 then 'ia' else case when o_orderkey%40=3 then 'rumor' else 'pipeline' end end as source_type,
  cast((o_orderkey%10)/10.0 as double) as confidence, o_orderdate as produced_at
from @orders@ where o_orderkey%9<>4
union all
select 'pw-'||cast(o_orderkey as string), 'ord-'||cast(o_orderkey as string), 'objects', 'manual', cast(0.95 as double), o_orderdate
from @orders@ where o_orderkey%30=0"""
    d["fiscal"] = """
select 'ord-'||cast(l_orderkey as string) as decision, 'ente-'||cast(l_suppkey % 27 as string) as entity,
  cast(l_extendedprice as decimal(14,2)) as potential, cast(l_extendedprice as decimal(14,2)) * (1 - cast(l_discount as decimal(4,2))) as effective, cast(l_tax as decimal(4,2)) as confidence,
  l_quantity > 25 as retroactive, case l_linenumber%4 when 0 then 'imediato' when 1 then 'curto' when 2 then 'medio' else 'longo' end as horizon,
  l_shipdate as booked_at, l_returnflag as valid_flag
from @lineitem@"""
    d["decisions"] = """
select 'ord-'||cast(o_orderkey as string) as decision, o_orderdate as decided_at, cast(o_totalprice as decimal(14,2)) as recognised from @orders@"""

    # ------------------------------------------------------------------ text
    d["blocks"] = f"""
select o_orderkey as block_id,
  case when o_orderkey%29=0 then '' when o_orderkey%4=3 then 'adct-art-'||cast(n as string)
    else 'cf-1988-art-'||cast(n as string)||case o_orderkey%4 when 0 then '-inc-'||lower(rom)||case when o_orderkey%8=0 then '-ali-a' else '' end
    when 1 then '-par-'||cast(1+o_orderkey%3 as string) else '' end end as anchor_slug,
  marker as editorial_marker, '' as editorial_label,
  case when o_orderkey%31=0 then '' else {_TEXT} end as block_text,
  case when o_orderkey%13=0 then '' else {_META} end as metadata_text,
  case when o_orderkey%19=0 then 'MI' else '' end as process_class,
  case when o_orderkey%19=0 then '77' else '' end as process_number,
  case o_orderkey%5 when 0 then 'exact' when 1 then 'adct' when 2 then 'parent' when 3 then 'unresolved' else '' end as anchor_quality,
  case o_orderkey%4 when 0 then 'hybrid' when 1 then 'position' when 2 then 'text' else 'unresolved' end as anchor_source,
  cast((o_orderkey%20)/20.0 as double) as anchor_confidence
from @order_texts@ o"""
    d["parser_anchors"] = f"""
select o_orderkey as block_id, case when o_orderkey%7=0 then '' else 'cf-art-'||cast(n as string)||case when o_orderkey%3=0 then '-inc-'||rom else '' end end as anchor_slug
from @order_texts@ o where o_orderkey%10<>9"""
    d["matcher_anchors"] = f"""
select o_orderkey as block_id, case when o_orderkey%11=0 then '' else 'cf-1988-art-'||cast(case when o_orderkey%13=0 then n*10 else n end as string)||case when o_orderkey%4=0 then '-par-2' else '' end end as anchor_slug,
  case when o_orderkey%11=0 then 'unresolved' else 'exact' end as anchor_quality, case when o_orderkey%3=0 then '0.950' else '' end as anchor_confidence
from @order_texts@ o where o_orderkey%10<>8"""
    d["norm_nodes"] = """
select slug, node_type, label, cast(null as string) as title, number_raw, number_norm, slug as path from (
  select distinct slug, node_type, label, number_raw, number_norm from (
    select case when o_orderkey%4=3 then 'adct-art-' else 'cf-1988-art-' end||cast(n as string) as slug, 'artigo' as node_type, 'Art. '||cast(n as string) as label,
      cast(n as string) as number_raw, cast(n as string) as number_norm from @order_texts@
    union all select 'cf-1988-art-'||cast(n as string)||'-inc-'||cast(1 + o_custkey%20 as string), 'inciso', rom, rom, cast(1 + o_custkey%20 as string) from @order_texts@
    union all select 'cf-1988-art-'||cast(n as string)||'-par-'||cast(1+o_orderkey%3 as string), 'paragrafo', '§ '||cast(1+o_orderkey%3 as string), cast(1+o_orderkey%3 as string), cast(1+o_orderkey%3 as string) from @order_texts@ where o_orderkey%7<>0
    union all select 'cf-1988-art-'||cast(n as string)||'-par-unico', 'paragrafo', 'Parágrafo único', 'único', 'unico' from @order_texts@ where n%5=0
    union all select 'cf-1988-art-'||cast(n as string)||'-inc-'||cast(1 + o_custkey%20 as string)||'-ali-a', 'alinea', 'a)', 'a', 'a' from @order_texts@ where o_orderkey%8=0
    union all select 'cf-1988-tit-'||cast(1 + o_custkey%20 as string), 'titulo', 'TÍTULO '||rom, rom, cast(1 + o_custkey%20 as string) from @order_texts@
  ) u) v"""
    d["order_texts"] = _ORDER_BASE
    line_exprs = [
        "case when k%8=0 then 'Art. '||cast(1 + cast(floor(k/8) as bigint)%40 as string)||'º Texto do artigo' end",
        "case k%5 when 0 then '§ '||cast(1+k%3 as string)||'º Texto do parágrafo' when 1 then rom||' - texto do inciso' "
        "when 2 then 'a) texto da alínea' else case when k%25=3 then 'Parágrafo único. Texto' end end",
        "case when k%4=0 then " + pick("o_custkey%6", [
            "Súmula Vinculante", "Controle concentrado de constitucionalidade", "Repercussão geral",
            "Julgados correlatos", "Súmula", "Controle de concentrado"]) + " end",
        "case when k%11=0 then 'Art. 10, § 5º da Lei 8.112' when k%13=0 then 'Art. 12 do Código Civil' end",
        _TEXT,
        "case when k%3=0 then 'Segundo parágrafo do comentário '||cast(o_orderkey as string) end",
        f"case when k%6<>5 then {_META} end",
    ]
    d["lines"] = (
        "select doc as doc_id, cast(k * 8 + i as bigint) as pos, text from ("
        + _rows("select * from @order_texts@", "doc, k", line_exprs, dialect) + ") z"
    )
    tree_exprs = [
        "case when k%200=0 then 'TÍTULO '||rom end", "case when k%200=0 then 'Dos Princípios '||cast(k as string) end",
        "case when k%50=0 then 'CAPÍTULO '||rom end", "case when k%100=50 then 'SEÇÃO '||rom end",
        "case when k%10=0 then 'Art. '||cast(1+cast(floor(k/10) as bigint) as string)||'º Caput do artigo' end",
        "case when k%10=4 then '§ '||cast(1+k%3 as string)||'º Texto do parágrafo' when k%40=7 then 'Parágrafo único. Texto' end",
        "case when k%2=1 then rom||' - texto do inciso' end", "case when k%4=1 then 'a) texto da alínea' end",
        "case when k%12=1 then '1. texto do item' end", "case when k%9=0 then 'texto livre '||cast(o_orderkey as string) end",
    ]
    d["norm_lines"] = (
        "select doc as doc_id, cast(k * 10 + i as bigint) as pos, text from ("
        + _rows("select * from @order_texts@", "doc, k", tree_exprs, dialect) + ") z"
    )
    d["comments"] = f"""
select o_orderkey as com_id, doc as doc_id, k as pos,
  case when k%17=0 then '<b>Julgados correlatos</b>' else
  case when k%9=0 then '<b>Repercussão geral</b> ' else '' end||'<p>'||{_TEXT}||' &ldquo;voto&rdquo;&nbsp;&sect; 1&ordm; &#65;&xyz; '||
  case when k%4=0 then '<a href="http://x.example.org/p?incidente='||cast(o_custkey as string)||'">RE '||cast(1000+o_custkey%77 as string)||'</a> ' else '' end||
  case when k%10=0 then '<a href="http://x.example.org/t?numeroTema='||cast(o_custkey%50 as string)||'&amp;PROCESSO=12&amp;CLASSE=ADI">tema</a> ' else '' end||
  case when k%21=0 then 'Súmula Vinculante 13 ' else '' end||case when k%6<>5 then {_META} else '' end||'</p>' end as html
from @order_texts@ o"""
    d["device_marks"] = """
select cast(floor(o_orderkey / 400) as bigint) as doc_id, o_orderkey%400 as pos, 'cf-1988-art-'||cast(1 + cast(floor((o_orderkey%400)/5) as bigint) as string) as device
from @orders@ where o_orderkey%5=2"""
    d["processes"] = """
select page_id, url, '<div class="processo-classe"> ADI </div><div class="processo-numero-unico">'||cast(page_id as string)||'</div><div class="processo-relator">Rel '||cast(page_id%7 as string)||'</div>'||
  case when page_id%3=0 then '' else '<div class="processo-autor">Autor '||cast(page_id as string)||'</div>' end||
  '<div class="andamento-item"><span class="data">1/2/2020</span><span class="descricao">Distribuído</span></div><div class="andamento-item"><span class="data">3/4/2020</span><span class="descricao">Julgado</span></div>'||html as html
from @pages@"""
    d["dedup_blocks"] = """
select doc_id as block_id, 'cf-1988-art-'||cast(1 + doc_id%3 as string) as anchor_slug, lang as editorial_marker, text as block_text from @documents@"""
    d["names"] = """
select p_partkey as name_id, case p_partkey%4 when 0 then p_name when 1 then translate(p_name, 'aeiou', 'áêíõü') when 2 then p_name||' '||p_type
  else upper(p_name)||' de '||translate(lower(p_brand), 'a#', 'ã ') end as name from @part@"""
    d["plates"] = "select vec_id, embedding from @embeddings@ where vec_id % 10 = 0"
    d["vectors"] = "select vec_id, embedding, label from @embeddings@ where vec_id % 10 <> 0"
    return d


_DEFS = {"spark": _definitions("spark"), "duck": _definitions("duck")}
_TOKEN = re.compile(r"@([a-z_]+)@")


def _dependencies(name: str) -> list[str]:
    found = [t for t in _TOKEN.findall(_DEFS["duck"][name]) if t in _DEFS["duck"]]
    out: list[str] = []
    for t in found:
        for x in _dependencies(t) + [t]:
            if x not in out:
                out.append(x)
    return out


def cte(*names: str) -> str:
    """DuckDB ``WITH`` clause defining the named mappings as ``fx_<name>``."""
    order: list[str] = []
    for n in names:
        for x in _dependencies(n) + [n]:
            if x not in order:
                order.append(x)
    parts = []
    for n in order:
        sql = _DEFS["duck"][n].replace("@NTZ@", "")
        parts.append(f"fx_{n} as (" + _TOKEN.sub(lambda m: ("fx_" if m[1] in _DEFS["duck"] else "") + m[1], sql) + ")")
    return "with " + ",\n".join(parts)


#: Text inputs that hold all their rows in few splits, as the small test files do.
TEXT_TABLES = {"order_texts", "event_keys", "documents", "pages"}
#: Session setting with the number of partitions text inputs are dealt to; unset, they stay as they are read.
TEXT_PARTITIONS = "spark.lexanchor.textPartitions"


class Corpus:
    """Lazy access to the base tables and the mapped tables of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in _DEFS["spark"]:
                sql = _DEFS["spark"][name].replace("@NTZ@", "_ntz").replace("{", "{{").replace("}", "}}")
                used = set(_TOKEN.findall(sql))
                sql = _TOKEN.sub(lambda m: "{" + m[1] + "}", sql)
                self._cache[name] = self.spark.sql(sql, **{u: self.table(u) for u in used})
            else:
                self._cache[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
            wanted = self.spark.conf.get(TEXT_PARTITIONS, "")
            if wanted and name in TEXT_TABLES:
                self._cache[name] = self._cache[name].repartition(int(wanted))
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES or name in _DEFS["spark"]:
            return self.table(name)
        raise AttributeError(name)
