"""Decision block resolution, anchors and reports."""

from pyspark.sql import functions as F

from lexanchor.operators import blocks as B
from lexanchor.functions import metadata as M, text as T
from lexanchor.plans.registry import query
from lexanchor.plans.sqltext import ARTICLE, RESOLVED, UNIFIED, UNIFIED_LOOSE, lower_slug, meta, norm_key, norm_spaces, rx, sub
from lexanchor import vocab as V

COLS = ["block_id", "anchor_slug", "process_class", "process_number", "process_key", "relator", "redator", "julgamento_data", "dje_data",
        "tema_rg", "sumula_num", "decision_unit_type", "block_hash", "namespace", "raw_signature"]
UNEEDS = ("blocks", "parser_anchors", "matcher_anchors")
art = ARTICLE.format


def resolved(x):
    return B.resolve_blocks(x.blocks)


def unified(x, **kw):
    return B.unify_anchors(resolved(x), x.parser_anchors, x.matcher_anchors, **kw)


@query("lnk13_resolve_blocks", needs=("blocks",), ctes=RESOLVED, sql=f"select {', '.join(COLS)} from rb")
def _(x):
    return resolved(x).select(*COLS)


@query("txt11_extract_meta", needs=("blocks",), sql=f"select block_id, {meta('metadata_text', 'm')} from fx_blocks")
def _(x):
    m = M.extract_meta("metadata_text")
    return x.blocks.withColumn("m", m).select("block_id", *[F.col(f"m.{f}").alias(f"m_{f}") for f in M.FIELDS])


STRICT = f"""s0 as (select *, {norm_spaces("trim(block_text||chr(10)||metadata_text)")} as src from fx_blocks),
s1 as (select *, coalesce(nullif(process_class,''), upper({rx('src', V.P_PROC_STRICT)})) as pc, coalesce(nullif(process_number,''), {rx('src', V.P_PROC_STRICT, 2)}) as pn,
 trim({rx('src', V.P_REL_STRICT)}) as rel, trim({rx('src', V.P_JULG_STRICT)}) as jd, trim({rx('src', V.P_TEMA_STRICT)}) as tr, trim({rx('src', V.P_SV_STRICT)}) as sn,
 {norm_key("coalesce(nullif(editorial_marker,''), ' ')")} as ek from s0)"""


@query("lnk13_resolve_blocks_strict", needs=("blocks",), ctes=STRICT, sql=f"""
select block_id, pc as process_class, pn as process_number, rel as relator, jd as julgamento_data, tr as tema_rg, sn as sumula_num,
 case when pc <> '' and {sub('pn', '[^0-9]')} <> '' then upper(pc)||'_'||{sub('pn', '[^0-9]')} when sn <> '' then 'SUMULA_VINCULANTE_'||sn else '' end as process_key,
 case when sn <> '' or {norm_key('metadata_text')} like '%sumula vinculante%' or replace(ek,'_',' ') like '%sumula vinculante%' then 'sumula_vinculante'
  when tr <> '' or replace(ek,'_',' ') like '%repercussao geral%' then 'repercussao_geral'
  when replace(ek,'_',' ') like '%julgados correlatos%' or replace(ek,'_',' ') like '%julgado correlato%' then 'julgado_correlato'
  when replace(ek,'_',' ') like '%controle concentrado%' then case when pc in ('ADI','ADC','ADO','ADPF') then 'julgado_principal' else 'controle_concentrado' end
  when pc <> '' then 'julgado_principal' else 'comentario_editorial' end as decision_unit_type from s1""")
def _(x):
    return B.resolve_blocks_strict(x.blocks).select(
        "block_id", "process_class", "process_number", "relator", "julgamento_data", "tema_rg", "sumula_num", "process_key", "decision_unit_type")


UCOLS = "block_id, parser_slug, matcher_slug, anchor_source, anchor_slug_final, anchor_confidence_final"


@query("lnk10_unify_anchors", needs=UNEEDS, ctes=UNIFIED, sql=f"select {UCOLS} from un")
def _(x):
    return unified(x).select(*UCOLS.split(", "))


@query("lnk10_unify_anchors_plain_prefix", needs=UNEEDS, ctes=UNIFIED_LOOSE, sql=f"select {UCOLS} from un")
def _(x):
    return unified(x, segment_aware=False).select(*UCOLS.split(", "))


RECODE = """rc as (select *, case when trim(anchor_slug) = '' then 'unresolved' when anchor_quality in ('exact','adct') then anchor_quality
 when anchor_quality = 'parent' then 'contextual' when anchor_quality = 'unresolved' and anchor_source = 'position' then 'contextual'
 when anchor_quality = 'unresolved' and anchor_source in ('hybrid','text') then 'exact' else 'contextual' end as anchor_quality_recode from fx_blocks)"""


@query("lnk11_recode_quality", needs=("blocks",), ctes=RECODE, sql="""
select block_id, anchor_quality_recode, case when anchor_quality_recode = 'unresolved' then 'unresolved' else 'resolved' end as anchor_resolution_status,
 case anchor_source when 'text' then 'explicit' when 'hybrid' then 'hybrid' when 'position' then 'implicit' else '' end as decision_explicitness from rc""")
def _(x):
    return B.recode_quality(x.blocks).select("block_id", "anchor_quality_recode", "anchor_resolution_status", "decision_explicitness")


@query("lnk15_anchor_tier", needs=("blocks",), ctes=RECODE, sql="""
select tier as anchor_tier, count(*) as n from (select case when anchor_slug = '' then 'generica_nao_resolvida' when anchor_quality_recode = 'exact' then 'exata'
 when anchor_quality_recode = 'contextual' and regexp_matches(anchor_slug, '^(cf-1988|adct)-art-[0-9]+$') then 'generica_nao_resolvida'
 when anchor_quality_recode = 'contextual' then 'contextual' else 'inferida' end as tier from rc) group by 1""")
def _(x):
    return B.anchor_tier(B.recode_quality(x.blocks)).groupBy("anchor_tier").agg(F.count("*").alias("n"))


@query("lnk15_reanchor_queue", needs=("blocks",), ctes=RECODE, sql="""
select block_id from rc where anchor_slug = '' or (anchor_quality_recode = 'contextual' and regexp_matches(anchor_slug, '^(cf-1988|adct)-art-[0-9]+$'))""")
def _(x):
    return B.reanchor_queue(B.recode_quality(x.blocks)).select("block_id")


CO = """co as (select b.block_id, s.anchor_slug, 'secondary' as anchor_role, b.anchor_confidence as confidence, b.anchor_source as source
 from fx_blocks b join (select distinct block_text, anchor_slug from fx_blocks where block_text <> '' and anchor_slug <> '') s
 on s.block_text = b.block_text and s.anchor_slug <> b.anchor_slug),
ba as (select block_id, anchor_slug, 'primary' as anchor_role, anchor_confidence as confidence, anchor_source as source from fx_blocks where anchor_slug <> ''
 union all select c.* from co c where exists (select 1 from (select block_text from fx_blocks where block_text <> '' and anchor_slug <> '' group by 1 having count(distinct anchor_slug) > 1) g
  join fx_blocks x on x.block_text = g.block_text where x.block_id = c.block_id))"""


@query("set5_block_anchors", needs=("blocks",), ctes=CO, sql="select * from ba")
def _(x):
    return B.block_anchors(x.blocks)


@query("jn10_co_anchors", needs=("blocks",), ctes=CO, sql="select * from ba where anchor_role = 'secondary'")
def _(x):
    return B.co_anchors(x.blocks)


@query("agg19_block_anchor_summary", needs=("blocks",), ctes=CO, sql="""
select anchor_role, count(*) as total, count(distinct block_id) as unique_blocks, count(distinct anchor_slug) as unique_slugs from ba group by 1""")
def _(x):
    return B.block_anchor_summary(x.blocks)


def _counts(name, fn, keys, cond):
    query(name, needs=("blocks",), ctes=RESOLVED, sql=f"select {keys}, count(*) as n from rb where {cond} group by {keys}")(lambda x: fn(resolved(x)))


_counts("agg11_relator_anchor_distribution", B.relator_anchor_distribution, "relator, anchor_slug, decision_unit_type", "relator <> ''")
_counts("agg12_anchor_distribution", B.anchor_distribution, "anchor_slug, decision_unit_type", "anchor_slug <> ''")
_counts("agg13_process_occurrence_network", B.process_occurrence_network, "process_key, anchor_slug, editorial_marker", "process_key <> ''")
_counts("agg14_relator_process_network", B.relator_process_network, "relator, process_key, anchor_slug", "relator <> '' and process_key <> ''")


@query("agg15_anchor_source_distribution", needs=UNEEDS, ctes=UNIFIED, sql="""
select anchor_source, count(*) as blocks, round(count(*) * 100.0 / (select count(*) from un), 1)::double as pct from un group by 1""")
def _(x):
    return B.distribution(unified(x), "anchor_source", digits=1)


@query("agg16_anchor_source_by_relator", needs=UNEEDS, ctes=UNIFIED, sql="select relator, anchor_source, count(*) as blocks from un where relator <> '' group by 1, 2")
def _(x):
    return B.anchor_source_by_relator(unified(x))


@query("agg17_relator_anchor_unified", needs=UNEEDS, ctes=UNIFIED, sql="""
select relator, anchor_slug_final, decision_unit_type, anchor_source, count(*) as blocks, count(distinct process_key) as distinct_procs,
 ((2 * sum(round(anchor_confidence_final * 1000)::bigint) + count(*)) // (2 * count(*)))::double / 1000 as avg_confidence from un where relator <> '' and anchor_slug_final <> '' group by 1, 2, 3, 4""")
def _(x):
    return B.relator_anchor_unified(unified(x))


@query("agg18_process_network_unified", needs=UNEEDS, ctes=UNIFIED, sql="""
select process_key, process_class, relator, anchor_source, count(*) as blocks, count(distinct anchor_slug_final) as distinct_anchors,
 string_agg(distinct anchor_slug_final, ',' order by anchor_slug_final) as anchor_slugs from un where process_key <> '' group by 1, 2, 3, 4""")
def _(x):
    return B.process_network_unified(unified(x))


@query("agg20_distribution", needs=("blocks",), ctes=RESOLVED, sql="""
select decision_unit_type, count(*) as blocks, round(count(*) * 100.0 / (select count(*) from rb), 2)::double as pct from rb group by 1""")
def _(x):
    return B.distribution(resolved(x), "decision_unit_type")


@query("win2_percent_of_total", needs=("blocks",), ctes=RECODE, sql="""
select anchor_quality_recode, count(*) as blocks, round(count(*) * 100.0 / (select count(*) from rc), 2)::double as pct from rc group by 1""")
def _(x):
    return B.distribution(B.recode_quality(x.blocks), "anchor_quality_recode")


COVER = ["relator", "process_class", "julgamento_data", "tema_rg", "sumula_num", "block_text"]


@query("agg21_field_coverage", needs=("blocks",), ctes=RESOLVED, sql=" union all ".join(
    f"select '{c}' as field, count(*) as total, count(*) filter (where {c} <> '') as filled, round(count(*) filter (where {c} <> '') * 100.0 / count(*), 1)::double as pct from rb" for c in COVER))
def _(x):
    return B.field_coverage(resolved(x), COVER)


@query("agg22_confidence_stats", needs=("blocks",), sql="""
select anchor_source, grouping(anchor_source)::int as overall, count(anchor_confidence) as n, round(avg(anchor_confidence), 3) as avg_confidence,
 min(anchor_confidence) as min_confidence, max(anchor_confidence) as max_confidence from fx_blocks group by rollup(anchor_source)""")
def _(x):
    return B.confidence_stats(x.blocks)


@query("agg23_branches_per_article", needs=("blocks",), sql=f"""
select {art(c='anchor_slug')} as article, count(distinct anchor_slug) as branches, count(*) as blocks from fx_blocks where {art(c='anchor_slug')} is not null group by 1""")
def _(x):
    return B.branches_per_article(x.blocks)


@query("agg24_editorial_counts", needs=("blocks",), sql=f"select {art(c='anchor_slug')} as article, editorial_marker, count(*) as n from fx_blocks group by 1, 2")
def _(x):
    return B.editorial_counts(x.blocks)


PIVOT = ("sumula_vinculante", "sumula", "controle_concentrado", "repercussao_geral", "julgados_correlatos")


@query("agg24_editorial_pivot", needs=("blocks",), sql=f"""
select {art(c='anchor_slug')} as article, {', '.join(f"count(*) filter (where editorial_marker = '{m}') as {m}" for m in PIVOT)} from fx_blocks group by 1""")
def _(x):
    return B.editorial_pivot(x.blocks)


@query("agg25_subdevice_counts", needs=("blocks",), sql=f"""
select {art(c='s')} as article, sum(n)::bigint as total_blocks, {', '.join(f"count(*) filter (where s like '%-{t}-%') as {t}" for t in ('inc', 'par', 'ali'))}
from (select anchor_slug as s, count(*) as n from fx_blocks where anchor_slug like 'cf-1988-art-%' group by 1) group by 1""")
def _(x):
    return B.subdevice_counts(x.blocks)


@query("agg30_text_volume", needs=("blocks",), sql="""
select count(*) as total, sum(length(block_text))::bigint as total_chars, count(*) filter (where block_text = '') as empty_blocks from fx_blocks""")
def _(x):
    return B.text_volume(x.blocks)


@query("agg31_blocks_by_slug", needs=("blocks",), sql="""
select anchor_slug, (rn - 1) // 50 as page, string_agg(block_id::varchar, ',' order by block_id) as ids from
 (select *, row_number() over (partition by anchor_slug order by block_id) as rn from fx_blocks) group by 1, 2""")
def _(x):
    p = B.blocks_by_slug(resolved(x), page_size=50, segment_size=512)
    return p.select("anchor_slug", "page", F.array_join(F.transform("blocks", lambda b: b["block_id"].cast("string")), ",").alias("ids"))


@query("prj5_first_nonempty", needs=("blocks",), sql="""
select block_id, coalesce(nullif(process_class,''), nullif(editorial_marker,''), nullif(anchor_quality,''), '') as value from fx_blocks""")
def _(x):
    return x.blocks.select("block_id", F.coalesce(T.first_nonempty("process_class", "editorial_marker", "anchor_quality"), F.lit("")).alias("value"))


@query("prj6_slug_filter", needs=("blocks",), sql="select block_id, anchor_slug from fx_blocks where anchor_slug like 'cf-1988-%' and anchor_slug like '%-inc-%'")
def _(x):
    return B.slug_filter(x.blocks, "cf-1988-", "-inc-").select("block_id", "anchor_slug")


@query("prj8_audit_rows", needs=("blocks",), ctes=RESOLVED, sql="""
select block_id, anchor_slug, decision_unit_type, editorial_marker, process_key, relator, namespace, length(block_text) as text_len, substr(block_text, 1, 120) as preview from rb""")
def _(x):
    return B.audit_rows(resolved(x))


RANK = "case decision_unit_type " + " ".join(f"when '{k}' then {v}" for k, v in V.UNIT_RANK.items()) + f" else {V.UNIT_RANK_DEFAULT} end"


@query("srt1_editorial_order", needs=("blocks",), ctes=RESOLVED, sql=f"select anchor_slug, {RANK} as rank, block_id from rb order by 1, 2, 3")
def _(x):
    return B.editorial_order(resolved(x)).select("anchor_slug", "rank", "block_id")


@query("srt2_top_groups", needs=("blocks",), sql="select anchor_slug, count(*) as n from fx_blocks where anchor_slug <> '' group by 1 order by 2 desc, 1 limit 20")
def _(x):
    return B.top_groups(x.blocks, "anchor_slug", 20)


@query("srt3_sample_n", needs=("blocks",), sql="select block_id, anchor_slug from fx_blocks order by md5(block_id||'|42'), block_id limit 100")
def _(x):
    return B.sample_n(x.blocks, 100, 42).select("block_id", "anchor_slug")


@query("srt9_stratified_sample", needs=("blocks",), sql="""
select editorial_marker, block_id from (select *, row_number() over (partition by editorial_marker order by md5(block_id||'|7'), block_id) as rn from fx_blocks) where rn <= 10""")
def _(x):
    return B.stratified_sample(x.blocks, "editorial_marker", 10, 7).select("editorial_marker", "block_id")


@query("win4_renumber", needs=("blocks",), sql="select block_id, row_number() over (order by block_id) as row_id from fx_blocks")
def _(x):
    return B.renumber(x.blocks.select("block_id"), ["block_id"], B.position_segment("block_id", 1000))


MRANK = "case editorial_marker " + " ".join(f"when '{k}' then {v}" for k, v in V.MARKER_RANK.items()) + f" else {V.MARKER_RANK_DEFAULT} end"
MIRROR = f"""nodes as (select s as node_slug, row_number() over (order by s) as node_order, 'No '||s as label from (select distinct anchor_slug as s from fx_blocks where anchor_slug <> '')),
mb as (select n.node_order, n.node_slug, b.block_id, {MRANK} as rank, b.editorial_marker as marker, b.block_text as content,
 lag(b.editorial_marker) over (partition by n.node_order order by {MRANK}, b.block_id) as before from fx_blocks b join nodes n on n.node_slug = b.anchor_slug)"""


@query("srt8_mirror", needs=("blocks",), ctes=MIRROR, sql="""
select node_order, node_slug, 0 as kind, 0 as rank, 0 as block_id, label as content, null as marker from nodes
union all select node_order, node_slug, 2, rank, block_id, content, marker from mb
union all select node_order, node_slug, 1, rank, block_id, upper(replace(marker, '_', ' ')), marker from mb
 where marker <> '' and marker <> 'sem_categoria' and coalesce(before, '') <> marker""")
def _(x):
    slugs = x.blocks.filter("anchor_slug <> ''").select(F.col("anchor_slug").alias("node_slug")).distinct()
    # nodes are numbered in slug order; the opening characters of a slug cut the segments
    nodes = B.renumber(slugs, ["node_slug"], F.conv(F.hex(F.rpad(F.substring("node_slug", 1, 7), 7, " ")), 16, 10).cast("decimal(20,0)"), "node_order")
    return B.mirror(nodes.withColumn("label", F.concat(F.lit("No "), F.col("node_slug"))), x.blocks)


DEVICES = "select 'cf-1988-art-'||v as device_slug, 'Art. '||v as label, 'cf' as namespace, 'Texto '||v as normative_text from range(1, 61) t(v)"


@query("jn12_attach_decisions", needs=("blocks",), ctes=RESOLVED + f", dv as ({DEVICES})", sql="""
select d.device_slug, b.block_id, coalesce(b.anchor_slug, d.device_slug) as anchor_slug, case when b.block_id is null then 'dispositivo_normativo' else b.decision_unit_type end as decision_unit_type,
 case when b.block_id is null then 'normativo' else b.anchor_quality end as anchor_quality, case when b.block_id is null then 'planalto' else b.anchor_source end as anchor_source,
 case when b.block_id is null then 1.0::double else b.anchor_confidence end as anchor_confidence,
 case when b.block_id is null then substr(md5(d.device_slug||'|normativo|'||substr(d.normative_text,1,100)), 1, 16) else b.block_hash end as block_hash
from dv d left join rb b on regexp_extract(b.anchor_slug, '^((?:cf-1988|adct)-art-[0-9]+)', 1) = d.device_slug""")
def _(x):
    v = F.col("id").cast("string")
    devices = x.spark.range(1, 61).select(
        F.concat(F.lit("cf-1988-art-"), v).alias("device_slug"), F.concat(F.lit("Art. "), v).alias("label"), F.lit("cf").alias("namespace"),
        F.concat(F.lit("Texto "), v).alias("normative_text"))
    return B.attach_decisions(devices, resolved(x)).drop("label", "namespace", "block_text", "normative_text")


@query("jn13_enrich", needs=("blocks",), ctes=RESOLVED, sql="""
select b.block_id, coalesce(nullif(r.process_class,''), b.process_class) as process_class, coalesce(nullif(r.relator,''), null) as relator from fx_blocks b
left join (select * from rb where block_id%2 = 0) r on r.block_id = b.block_id""")
def _(x):
    meta_rows = resolved(x).filter("block_id % 2 = 0")
    return B.enrich(x.blocks, meta_rows, "block_id", ["process_class", "relator"]).select("block_id", "process_class", "relator")


@query("jn14_recover", needs=("blocks",), ctes=RESOLVED, sql="""
select b.block_id, coalesce(nullif(b.process_number,''), nullif(r.process_number,'')) as process_number from fx_blocks b left join rb r on r.block_id = b.block_id""")
def _(x):
    return B.recover(x.blocks, resolved(x), "block_id", "process_number").select("block_id", "process_number")


PREFIXES = "|".join(V.EDITORIAL_PREFIXES)


@query("jn15_recover_text", needs=("blocks",), ctes=f"""src as (select block_id, regexp_replace('Repercussão geral '||'Texto '||block_id||' fim [ADI 1.'||block_id||', rel. min. X Y]', '^(?:{PREFIXES})\\s*', '') as t from fx_blocks where block_id%2 = 1)""", sql=r"""
select b.block_id, case when b.block_text = '' and s.t is not null then trim(regexp_replace(s.t, '\[([^\]]{10,})\]\s*$', '')) else b.block_text end as block_text,
 case when b.block_text = '' and s.t is not null then coalesce(nullif(b.metadata_text,''), trim(regexp_extract(s.t, '\[([^\]]{10,})\]\s*$', 1))) else b.metadata_text end as metadata_text
from fx_blocks b left join src s on s.block_id = b.block_id""")
def _(x):
    i = F.col("block_id").cast("string")
    src = x.blocks.filter("block_id % 2 = 1").select(
        "block_id", F.concat(F.lit("Repercussão geral Texto "), i, F.lit(" fim [ADI 1."), i, F.lit(", rel. min. X Y]")).alias("text"))
    return B.recover_text(x.blocks, src, "block_id").select("block_id", "block_text", "metadata_text")


@query("txt19_fill_missing_meta", needs=("blocks",), ctes=f"""f0 as (select b.*, {meta("metadata_text||' '||block_text", 'm')} from fx_blocks b),
f1 as (select *, case when process_class = '' and block_text <> '' then true else false end as need from f0)""", sql="""
select block_id, case when need and (m_process_class <> '' or m_relator <> '') then m_process_class else process_class end as process_class,
 case when need and (m_process_class <> '' or m_relator <> '') then m_process_number else process_number end as process_number,
 case when need and (m_process_class <> '' or m_relator <> '') then m_relator else '' end as relator from f1""")
def _(x):
    b = x.blocks.withColumns({"relator": F.lit(""), "tema_rg": F.lit(""), "process_key": F.lit(None).cast("string")})
    return B.fill_missing_meta(b).select("block_id", "process_class", "process_number", "relator")


@query("lnk14_reclassify", needs=("blocks",), sql=f"""
select block_id, case when anchor_slug like 'cf%' and {art(c='anchor_slug')} = 7 then 'adct' else anchor_slug end as anchor_slug from fx_blocks""")
def _(x):
    return B.correct_metadata(x.blocks, {7: "adct"}).select("block_id", "anchor_slug")


JN6 = """rec as (select 'rj-'||block_id as id, 'rj-'||block_id as slug, block_id, anchor_slug, block_text, metadata_text, editorial_marker from fx_blocks where anchor_slug <> ''),
mt as (select block_id as com_id, process_class as classe, process_number as numero, relator, julgamento_data as data_julgamento, '' as turma, case when block_id%2=0 then metadata_text else '' end as referencia from rb)"""


@query("jn6_anchored_decisions", needs=("blocks",), ctes=RESOLVED + ", " + JN6, sql="""
select anchor_slug as dispositivo, slug as decisao_slug, coalesce(classe,'') as classe, coalesce(numero,'') as numero, coalesce(relator,'') as relator,
 coalesce(data_julgamento,'') as data_julgamento, coalesce(turma,'') as turma, coalesce(nullif(referencia,''), 'rotulo '||block_id) as referencia,
 '' as tipo, editorial_marker as camada, 'conteudo '||block_id as conteudo, (block_id % 9)::int as ordem from rec left join mt on mt.com_id = rec.block_id""")
def _(x):
    b = x.blocks.filter("anchor_slug <> ''")
    i = F.col("block_id").cast("string")
    payload = F.to_json(F.struct(
        F.concat(F.lit("rotulo "), i).alias("rotulo_final"), F.col("editorial_marker").alias("camada_editorial"), F.concat(F.lit("conteudo "), i).alias("conteudo"),
        i.alias("stf_com_id"), (F.col("block_id") % 9).cast("string").alias("ordem_editorial")))
    rec = b.select(F.concat(F.lit("rj-"), i).alias("id"), F.concat(F.lit("rj-"), i).alias("slug"), F.lit("registro_jurisprudencial").alias("type_slug"), payload.alias("payload"))
    dev = b.select(F.col("anchor_slug").alias("id"), F.col("anchor_slug").alias("slug")).distinct().select(
        "id", "slug", F.lit("artigo").alias("type_slug"), F.lit("{}").alias("payload"))
    edges = b.select(F.lit("ancora_normativa").alias("type_slug"), F.concat(F.lit("rj-"), i).alias("source_id"), F.col("anchor_slug").alias("target_id"))
    r = resolved(x)
    m = r.select(F.col("block_id").alias("com_id"), F.col("process_class").alias("classe"), F.col("process_number").alias("numero"), "relator",
                 F.col("julgamento_data").alias("data_julgamento"), F.lit("").alias("turma"), F.when(F.col("block_id") % 2 == 0, F.col("metadata_text")).otherwise("").alias("referencia"))
    return B.ordered_anchors(B.anchored_decisions(edges, rec.unionByName(dev), m))


@query("srt4_ordered_anchors", needs=("blocks",), sql="select anchor_slug as dispositivo, (block_id % 9)::int as ordem, block_id as decisao_slug from fx_blocks order by 1, 2, 3")
def _(x):
    v = x.blocks.select(F.col("anchor_slug").alias("dispositivo"), (F.col("block_id") % 9).cast("int").alias("ordem"), F.col("block_id").alias("decisao_slug"))
    return B.ordered_anchors(v)


@query("prj9_drop_markers", needs=("comments",), sql="""
select com_id from (select com_id, trim(regexp_replace(html, '<[^>]+>', ' ', 'g')) as t from fx_comments) where not (length(t) < 80 and regexp_matches(lower(t), 'controle|repercuss|julgado|súmula|sumula|correlato'))""")
def _(x):
    c = x.comments.select("com_id", F.trim(F.regexp_replace("html", "<[^>]+>", " ")).alias("t"))
    return B.drop_markers(c, "t").select("com_id")
