"""Variant index, matching, citations, metadata and function checks."""

from pyspark.sql import functions as F

from lexanchor import vocab as V
from lexanchor.functions import metadata as M, text as T
from lexanchor.operators import blocks as B, citations as C, linkage as L
from lexanchor.operators.keyed import compute_once
from lexanchor.plans.integrity import ASCII, WORD_CUT
from lexanchor.plans.registry import query
from lexanchor.session import cut
from lexanchor.plans.sqltext import RESOLVED, has, lit, norm_key, norm_spaces, rx, sub

# ------------------------------------------------------------------ variant index
_HEADS = ("titulo", "capitulo", "secao", "subsecao")


def _variant_sql():
    out = ["select *, 'label' as origin, 100 as priority, 0 as seq, label as v from nz", "select *, 'title', 70, 1, title from nz"]
    seq = 2
    cond = {"paragrafo_unico": "node_type='paragrafo' and number_norm='unico'", "paragrafo": "node_type='paragrafo' and number_norm<>'unico'",
            "artigo_adct": "node_type='artigo' and namespace='adct'"}
    for kind, ts in V.VARIANTS.items():
        for t, src, origin, prio in ts:
            val = {"L": "lower(number_norm)", "R": "number_raw" if kind in _HEADS else "upper(number_raw)", "N": "number_norm" if kind in _HEADS else "try_cast(number_norm as bigint)::varchar", "": "''"}[src]
            cond_sql = cond.get(kind, f"node_type='{kind}'")
            out.append(f"select *, '{origin}', {prio}, {seq}, replace({lit(t)}, '%s', {val}) from nz where {cond_sql}")
            seq += 1
    return " union all ".join(out)


INDEX = f"""nz as (select *, case when slug like '%adct%' then 'adct' else 'cf' end as namespace from fx_norm_nodes),
va as (select {norm_key('v')} as anchor_text_norm, slug, label, title, node_type, namespace, origin as variant_origin, priority as match_priority, seq from ({_variant_sql()}) where v is not null and v <> ''),
ix as (select * exclude (rn, seq) from (select *, row_number() over (partition by anchor_text_norm, slug order by seq) as rn from va
 where anchor_text_norm not in ({', '.join(lit(a) for a in V.AMBIGUOUS)}) and not regexp_matches(anchor_text_norm, '^([0-9]+|[a-z])$')) where rn = 1)"""


@query("lnk1_anchor_variants", needs=("norm_nodes",), ctes=INDEX, sql="select anchor_text_norm, slug, variant_origin, match_priority from va")
def _(x):
    return L.anchor_variants(x.norm_nodes).select("anchor_text_norm", "slug", "variant_origin", "match_priority")


@query("lnk2_drop_ambiguous", needs=("norm_nodes",), ctes=INDEX, sql=f"""
select anchor_text_norm, count(*) as n from va where anchor_text_norm not in ({', '.join(lit(a) for a in V.AMBIGUOUS)}) and not regexp_matches(anchor_text_norm, '^([0-9]+|[a-z])$') group by 1""")
def _(x):
    return L.drop_ambiguous(L.anchor_variants(x.norm_nodes)).groupBy("anchor_text_norm").agg(F.count("*").alias("n"))


@query("lnk3_variant_index", needs=("norm_nodes",), ctes=INDEX, sql="select anchor_text_norm, slug, label, node_type, namespace, variant_origin, match_priority from ix")
def _(x):
    return L.variant_index(x.norm_nodes).drop("title")


_ROMANS = "I II III IV V VI VII VIII IX X XI XII XIII XIV XV XVI XVII XVIII XIX XX".split()
EXP_ROM = "case n " + " ".join(f"when '{i}' then '{r.lower()}'" for i, r in enumerate(_ROMANS, 1)) + " end"


def _expand_sql():
    kinds = {"inciso": "kind='inciso'", "paragrafo_unico": "kind='paragrafo' and n='unico'", "paragrafo": "kind='paragrafo' and n<>'unico'", "alinea": "kind='alinea'"}
    out = []
    for k, c in kinds.items():
        for i, t in enumerate(V.EXPANSION[k]):
            out.append(f"select slug, replace(replace({lit(t)}, '{{n}}', n), '{{r}}', coalesce(r, '')) as key from ex where {c}")
    return " union all ".join(out)


@query("lnk4_expand_index", needs=("norm_nodes",), ctes=f"""
ex0 as (select slug, label, node_type as kind, lower(trim(label)) as key, case node_type when 'inciso' then regexp_extract(slug, '-inc-([0-9]+)$', 1) when 'paragrafo' then regexp_extract(slug, '-par-([0-9a-z]+)$', 1)
  when 'alinea' then regexp_extract(slug, '-ali-([a-z])$', 1) end as n from fx_norm_nodes),
ex as (select *, {EXP_ROM} as r from ex0 where n <> ''),
og as (select key, max(slug) as slug from ex0 group by 1), ad as (select key, min(slug) as slug from ({_expand_sql()}) group by 1)""",
       sql="select key as anchor_text_norm, slug from og union all select key, slug from ad where key not in (select key from og)")
def _(x):
    idx = x.norm_nodes.withColumn("anchor_text_norm", F.col("label"))
    return L.expand_index(idx).select("anchor_text_norm", "slug")


# ------------------------------------------------------------------- matching
def _cand_sql():
    parts = []
    for p, mode, ts in V.CANDIDATE_RULES:
        if mode == "C":
            parts += [f"select block_id, expected, {lit(t)} as candidate from cb where {has('merged', p)}" for t in ts]
        else:
            m = {"U": "upper(m)", "L": "lower(m)", "": "m"}[mode]
            src = f"(select block_id, expected, unnest(list_distinct(regexp_extract_all(merged, {lit(p)}, 1))) as m from cb)"
            parts += [f"select block_id, expected, replace({lit(t)}, '%s', {m}) as candidate from {src}" for t in ts]
    return " union ".join(parts)


CAND = f"""cb as (select block_id, trim(block_text||chr(10)||metadata_text) as merged, case when {has("trim(block_text||chr(10)||metadata_text)", V.P_ADCT)} then 'adct' else 'cf' end as expected from fx_blocks),
cd as (select *, {norm_key('candidate')} as norm from ({_cand_sql()}))"""
SPEC = "case i.node_type " + " ".join(f"when '{k}' then {v}" for k, v in V.SPECIFICITY.items()) + " else 0 end"
BONUS = "case node_type " + " ".join(f"when '{k}' then {v}" for k, v in V.TYPE_BONUS.items()) + " else 0 end"


@query("lnk5_candidates", needs=("blocks",), ctes=CAND, sql="select distinct block_id, expected, norm from cd")
def _(x):
    return L.candidates(x.blocks).filter("candidate is not null").select("block_id", "expected", "norm")


LOOK = f"""sl as (select anchor_text_norm as norm, expected, slug, node_type, namespace, match_priority, score from (select i.*, e.expected,
  i.match_priority + {SPEC} + case when i.namespace = e.expected then 50 else -20 end as score from ix i, (values ('cf'), ('adct')) e(expected))
 qualify row_number() over (partition by anchor_text_norm, expected order by score desc, match_priority desc, slug) = 1)"""


@query("lnk6_score_candidates", needs=("norm_nodes",), ctes=INDEX + ", " + LOOK, sql="select norm, expected, slug, match_priority, score from sl")
def _(x):
    return L.score_lookup(L.variant_index(x.norm_nodes)).select("norm", "expected", "hit.slug", "hit.match_priority", "hit.score")


@query("lnk7_match_blocks", needs=("blocks", "norm_nodes"), ctes=INDEX + ", " + CAND + f""",
jn as (select c.block_id, c.expected, i.slug, i.node_type, i.namespace, i.match_priority, i.match_priority + {SPEC} + case when i.namespace = c.expected then 50 else -20 end as score
 from cd c join ix i on i.anchor_text_norm = c.norm),
bs as (select * from jn qualify row_number() over (partition by block_id order by score desc, match_priority desc, slug) = 1)""", sql=f"""
select b.block_id, coalesce(j.slug, '') as anchor_slug, coalesce(j.node_type, '') as anchor_node_type, coalesce(j.namespace, b.expected) as anchor_namespace,
 case when j.slug is null then 'unresolved' when j.namespace = j.expected then 'exact' else 'adct' end as anchor_quality, j.score as match_score, j.match_priority,
 case when j.slug is not null then round(least(0.90::double + case when j.namespace = j.expected then 0.05 else 0 end + {BONUS} + case when match_priority >= 100 then 0.03 when match_priority >= 90 then 0.02 when match_priority >= 80 then 0.01 else 0 end, 1.0)::double, 3) end as anchor_confidence
from cb b left join bs j on j.block_id = b.block_id""")
def _(x):
    m = L.match_blocks(x.blocks, cut(L.variant_index(x.norm_nodes)))
    return m.select("block_id", "anchor_slug", "anchor_node_type", "anchor_namespace", "anchor_quality", "match_score", "match_priority", "anchor_confidence")


@query("srt5_best_candidate", needs=("blocks", "norm_nodes"), ctes=INDEX + ", " + CAND + f""",
jn as (select c.block_id, i.slug, i.match_priority, i.match_priority + {SPEC} + case when i.namespace = c.expected then 50 else -20 end as score from cd c join ix i on i.anchor_text_norm = c.norm)""", sql="""
select block_id, slug as anchor_slug from jn qualify row_number() over (partition by block_id order by score desc, match_priority desc, slug) = 1""")
def _(x):
    m = L.match_blocks(x.blocks, cut(L.variant_index(x.norm_nodes)))
    return m.filter("anchor_quality in ('exact', 'adct')").select("block_id", "anchor_slug")


@query("lnk8_match_confidence", needs=("norm_nodes",), ctes=INDEX, sql=f"""
select slug, anchor_text_norm, round(least(0.90::double + case when namespace='cf' then 0.05 else 0 end + {BONUS} + case when match_priority >= 100 then 0.03 when match_priority >= 90 then 0.02 when match_priority >= 80 then 0.01 else 0 end, 1.0)::double, 3) as confidence from ix""")
def _(x):
    i = L.variant_index(x.norm_nodes)
    return i.select("slug", "anchor_text_norm", L.match_confidence(F.col("node_type"), F.col("match_priority"), F.col("namespace") == "cf").alias("confidence"))


ROM_INT = "case upper(regexp_extract(anchor_slug, '-inc-([ivxlcdm]+)', 1)) " + " ".join(f"when '{r}' then '{i}'" for i, r in enumerate(_ROMANS, 1)) + " end"


@query("lnk9_nearest_ancestor", needs=("blocks", "norm_nodes"), ctes=f"""
ns as (select block_id, coalesce(regexp_replace(anchor_slug, '-inc-[ivxlcdm]+', '-inc-'||{ROM_INT}), anchor_slug) as slug_norm from fx_blocks),
tr as (select block_id, slug_norm, array_to_string(string_split(slug_norm, '-')[1:i], '-') as slug from ns, range(4, 20) r(i) where i <= len(string_split(slug_norm, '-'))
 union select block_id, slug_norm, slug_norm from ns),
ht as (select t.block_id, max_by(t.slug, length(t.slug)) as hit from tr t where t.slug in (select slug from fx_norm_nodes) and t.slug_norm <> '' group by 1)""", sql="""
select n.block_id, n.slug_norm, h.hit as matched, case when h.hit = n.slug_norm then 'exact' when h.hit is not null then 'parent' else 'none' end as match_type from ns n left join ht h on h.block_id = n.block_id""")
def _(x):
    return L.nearest_ancestor(x.blocks, x.norm_nodes)


# ------------------------------------------------------------------- citations
CITE = f"""ci as (select block_id as doc_id, block_text||' '||metadata_text as text from fx_blocks),
c0 as (select doc_id, unnest(range(0, len(regexp_extract_all(text, {lit(V.P_CITED)}, 1)))) as n, trim(unnest(regexp_extract_all(text, {lit(V.P_CITED)}, 1))) as ref from ci),
c1 as (select doc_id, n, {rx('ref', V.CITED_HEAD)} as classe, {rx('ref', V.CITED_HEAD, 2)} as numero, trim({rx('ref', V.CITED_REL)}) as relator, trim({rx('ref', V.CITED_DATE)}) as data_julgamento,
 trim({rx('ref', V.CITED_BODY)}) as orgao, {rx('ref', V.P_TEMA)} as tema_rg, trim({rx('ref', V.P_DJE.replace('(?i)', ''))}) as dje from c0 where {has('ref', V.CITED_HEAD)})"""


def _cited(x):
    return C.extract_citations(x.blocks.select(F.col("block_id").alias("doc_id"), F.concat_ws(" ", "block_text", "metadata_text").alias("text")))


@query("txt10_extract_citations", needs=("blocks",), ctes=CITE, sql="select * from c1")
def _(x):
    return _cited(x)


@query("txt10_unique_citations", needs=("blocks",), ctes=CITE, sql="select * from c1 qualify row_number() over (partition by classe, numero order by doc_id, n) = 1")
def _(x):
    return C.unique_citations(_cited(x))


@query("txt13_panel_and_merit", needs=("blocks",), sql=f"""
select block_id, case when {rx('metadata_text', V.P_TURMA, 1)} <> '' then {rx('metadata_text', V.P_TURMA, 1)}||'ª T' when lower({rx('metadata_text', V.P_TURMA, 0)}) like '%plen%' then 'Plenário'
 when {rx('metadata_text', V.P_TURMA, 0)} <> '' then 'P' else '' end as turma, case when {has('metadata_text', V.P_MERITO)} then 'julgado' when {has('metadata_text', V.P_PENDENTE)} then 'pendente' else '' end as merito from fx_blocks""")
def _(x):
    return x.blocks.select("block_id", M.panel_of("metadata_text").alias("turma"), M.merit_of("metadata_text").alias("merito"))


@query("txt15_unit_type", needs=("blocks",), ctes=RESOLVED, sql="select decision_unit_type, editorial_marker, count(*) as n from rb group by 1, 2")
def _(x):
    return B.resolve_blocks(x.blocks).groupBy("decision_unit_type", "editorial_marker").agg(F.count("*").alias("n"))


def _strip_sql(src):
    out = sub(src, "<[^>]+>", " ")
    for e, c in V.ENTITIES:
        out = f"replace({out}, {lit(e)}, {lit(c)})"
    return norm_spaces(f"replace({sub(out, '&[a-z]+;')}, '&#65;', 'A')")


COMM = f"""h0 as (select *, {_strip_sql('html')} as text from fx_comments),
h1 as (select *, regexp_extract_all(text, {lit(V.P_BRACKET)}, 1) as refs, regexp_extract_all(html, 'href="([^"]+)"', 1) as urls from h0
 where not (length(text) < 80 and regexp_matches(lower(text), 'controle|repercuss|julgado|súmula|sumula|correlato'))),
h2 as (select *, coalesce(refs[1], '') as ref, {rx(_strip_sql("array_to_string(regexp_extract_all(html, '<a[^>]*>(.*?)</a>', 1), ' ')"), V.P_PROC_LINKS)} as lc,
 {rx(_strip_sql("array_to_string(regexp_extract_all(html, '<a[^>]*>(.*?)</a>', 1), ' ')"), V.P_PROC_LINKS, 2)} as ln from h1)"""
_NAME = f"regexp_replace(trim({rx('ref', V.P_REL)}), '[.,;)-]+$', '')"
_ALIASED = f"case {_NAME} " + " ".join(f"when {lit(k)} then {lit(v)}" for k, v in V.EXTRACT_ALIASES.items()) + f" else {_NAME} end"


@query("txt12_confirmed_metadata", needs=("comments",), ctes=COMM, sql=f"""
select com_id, coalesce(nullif(upper({rx('ref', V.P_PROC_LINKS)}), ''), upper(lc)) as process_class, coalesce(nullif({sub(rx('ref', V.P_PROC_LINKS, 2), '[.,]')}, ''), {sub('ln', '[.,]')}) as process_number,
 case when length({_ALIASED}) >= 4 then {_ALIASED} else '' end as relator, trim({rx('ref', V.P_JULG_LINKS)}) as julgamento_data,
 coalesce(nullif({rx('ref', V.P_TEMA)}, ''), nullif(regexp_extract(array_to_string(urls, ' '), 'numeroTema=([0-9]+)', 1), ''), {rx('text', V.P_TEMA)}) as tema_rg,
 case when {rx('text', V.P_SV)} <> '' then {rx('text', V.P_SV)} else '' end as sumula_num, regexp_extract(array_to_string(urls, ' '), 'incidente=([0-9]+)', 1) as stf_incidente,
 coalesce(urls[1], '') as url_principal, array_to_string(urls, ' | ') as urls_todas, array_to_string(refs, '; ') as referencia, case when {rx('ref', V.P_PROC_LINKS)} <> '' then 'ref' when lc <> '' then 'link' else '' end as fonte_processo from h2""")
def _(x):
    return C.confirmed_metadata(x.comments.select("com_id", "html")).select(
        "com_id", "process_class", "process_number", "relator", "julgamento_data", "tema_rg", "sumula_num", "stf_incidente", "url_principal", "urls_todas", "referencia", "fonte_processo")


@query("agg21_confirmed_coverage", needs=("comments",), ctes=COMM, sql=f"""
select 'url_principal' as field, count(*) as total, count(*) filter (where len(urls) > 0) as filled, round(count(*) filter (where len(urls) > 0) * 100.0 / count(*), 1)::double as pct from h2
union all select 'stf_incidente', count(*), count(*) filter (where html like '%incidente=%'), round(count(*) filter (where html like '%incidente=%') * 100.0 / count(*), 1)::double from h2""")
def _(x):
    return B.field_coverage(C.confirmed_metadata(x.comments.select("com_id", "html")), ["url_principal", "stf_incidente"])


@query("fn6_strip_html", needs=("comments",), ctes=COMM, sql="select com_id, text from h0")
def _(x):
    return x.comments.select("com_id", T.strip_html("html").alias("text"))


PRE = "|".join(V.EDITORIAL_PREFIXES)


@query("fn23_fn24_comment_blocks", needs=("comments",), ctes=COMM + f""", k0 as (select *, regexp_replace(text, '^(?:{PRE})\\s*', '') as body from h0)""", sql=f"""
select com_id, doc_id, pos, trim(regexp_replace(body, {lit(V.P_BRACKET_END)}, '')) as block_text, trim({rx('body', V.P_BRACKET_END)}) as metadata_text,
 case {' '.join(f"when {' or '.join(f'contains(lower(text), {lit(w)})' for w in ws)} then '{m}'" for ws, m in V.MARKER_WORDS)} end as marker from k0""")
def _(x):
    return C.comment_blocks(x.comments)


@query("txt16_url_mentions", needs=("comments",), ctes=r"""
u0 as (select com_id, html, regexp_extract_all(html, 'https?://[^\s"<>)]+', 0) as u, regexp_split_to_array(html, 'https?://[^\s"<>)]+') as p from fx_comments),
u1 as (select com_id, html, u[i] as url, i as numero, length(array_to_string(p[1:i], '')) + length(array_to_string(u[1:i-1], '')) as st from u0, range(1, 10) r(i) where i <= len(u))""", sql=f"""
select com_id, numero, url, substr(html, greatest(st - 49, 1), least(st, 50))||url||substr(html, st + length(url) + 1, 50) as context,
 coalesce(regexp_extract_all(substr(html, 1, st), {lit(V.P_PROC)}, 0)[-1], '') as acao_referente from u1""")
def _(x):
    return C.url_mentions(x.comments, "com_id", "html")


@query("fn25_process_links", needs=("comments",), ctes="""
w0 as (select com_id, unnest(range(0, len(regexp_extract_all(html, 'href="([^"]+)"', 1)))) as n, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) as url from fx_comments),
w1 as (select *, regexp_extract(replace(url, '&amp;', '&'), 'PROCESSO=([0-9]+)', 1) as processo, regexp_extract(replace(url, '&amp;', '&'), 'CLASSE=([^&]+)', 1) as classe, regexp_extract(url, 'incidente=([0-9]+)', 1) as incidente from w0)""", sql="""
select com_id, n, url, processo, classe, incidente from w1 where processo <> '' or incidente <> '' qualify row_number() over (partition by processo, classe, incidente order by com_id, n) = 1""")
def _(x):
    return C.process_links(x.comments, "com_id").select("com_id", "n", "url", "processo", "classe", "incidente")


@query("txt17_process_details", needs=("processes",), sql="""
select url as link, 'ADI' as classe_processo, page_id::varchar as numero_unico, 'Rel '||page_id%7 as relator, case when page_id%3<>0 then 'Autor '||page_id end as autor,
 '1/2/2020: Distribuído | 3/4/2020: Julgado' as andamentos, 'tipo_acao,origem,apenso,'||case when page_id%3=0 then 'autor,' else '' end||'advogado,reu' as erro from fx_processes""")
def _(x):
    return C.process_details(x.processes).select("link", "classe_processo", "numero_unico", "relator", "autor", "andamentos", "erro")


@query("txt18_infer_granular", needs=("blocks",), ctes=f"""
g0 as (select block_id, anchor_slug as own, unnest(regexp_extract_all(block_text, {lit(V.GRANULAR_INC)}, 1)) as a, unnest(regexp_extract_all(block_text, {lit(V.GRANULAR_INC)}, 2)) as i,
  unnest(regexp_extract_all(block_text, {lit(V.GRANULAR_INC)}, 3)) as l from fx_blocks),
q0 as (select block_id, anchor_slug as own, unnest(regexp_extract_all(block_text, {lit(V.GRANULAR_PAR)}, 1)) as a, unnest(regexp_extract_all(block_text, {lit(V.GRANULAR_PAR)}, 2)) as p from fx_blocks),
gg as (select distinct block_id, own, 'cf-1988-art-'||a||'-inc-'||lower(i)||case when l <> '' then '-ali-'||l else '' end as s from g0 union select distinct block_id, own, 'cf-1988-art-'||a||'-par-'||p from q0)""", sql="""
select block_id, anchor_slug, 'formal' as anchor_origin from fx_blocks where anchor_slug <> ''
union all select block_id, s, 'inferida' from gg where own <> s""")
def _(x):
    return C.infer_granular(x.blocks)


# ------------------------------------------------------------------- functions
@query("fn1_fn5_text_keys", sql=f"""
select doc_id, md5({norm_spaces('text')}) as spaces, md5({norm_key('text')}) as norm, {ASCII} as ascii_key, md5({WORD_CUT}) as words from documents""")
def _(x):
    d = compute_once(x.documents.select("doc_id", "text"), {"spaces": T.norm_spaces("text"), "folded": T.folded_text("text")})
    return d.select("doc_id", F.md5("spaces").alias("spaces"), F.md5(T.norm_key("spaces", collapsed=True)).alias("norm"), T.ascii_key("folded", folded=True).alias("ascii_key"),
                    F.md5(T.word_key("folded", folded=True)).alias("words"))


@query("fn7_fn8_roman", sql="""
select o_orderkey, n, case n """ + " ".join(f"when {i} then '{r}'" for i, r in enumerate(_ROMANS, 1)) + """ end as roman, n as back from (select o_orderkey, (1 + o_orderkey % 20)::int as n from orders)""")
def _(x):
    n = (1 + F.col("o_orderkey") % 20).cast("int")
    return x.orders.select("o_orderkey", n.alias("n"), T.int_to_roman(n).alias("roman")).withColumn("back", T.roman_to_int("roman"))


@query("fn9_fn12_slugs", needs=("blocks",), sql=f"""
select block_id, coalesce(regexp_replace(anchor_slug, '-inc-[ivxlcdm]+', '-inc-'||{ROM_INT}), anchor_slug) as norm, try_cast(nullif(regexp_extract(anchor_slug, '-?art-([0-9]+)', 1), '') as int) as article,
 case when anchor_slug like '%-ali-%' then 'alinea' when anchor_slug like '%-inc-%' then 'inciso' when anchor_slug like '%-par-%' then 'paragrafo' when anchor_slug <> '' then 'artigo' else 'outro' end as depth,
 'cf-1988-art-9'||regexp_replace(anchor_slug, '^cf-1988-art-[0-9]+', '') as moved from fx_blocks""")
def _(x):
    p = T.parse_slug("anchor_slug")
    return x.blocks.select("block_id", T.norm_slug("anchor_slug").alias("norm"), p["article"].alias("article"), p["depth"].alias("depth"), T.move_slug("anchor_slug", F.lit(9)).alias("moved"))


@query("fn10_build_slug", sql="""
select o_orderkey, case when o_orderkey%5=0 then 'adct' else 'cf-1988' end||'-art-'||(o_custkey%40)||case when o_orderkey%2=0 then '-par-2' else '' end||case when o_orderkey%3=0 then '-inc-iv' else '' end as slug from orders""")
def _(x):
    k = F.col("o_orderkey")
    return x.orders.select("o_orderkey", T.build_slug(F.when(k % 5 == 0, "adct").otherwise("cf"), F.col("o_custkey") % 40, F.when(k % 2 == 0, "2"), F.when(k % 3 == 0, "iv")).alias("slug"))


@query("fn13_fn14_dates", needs=("blocks",), ctes=RESOLVED, sql=f"""
select block_id, case when d is not null and d between 1 and 31 and m between 1 and 12 and y between 1988 and 2026 then printf('%04d-%02d-%02d', y, m, d) end as iso, try_cast(nullif({rx('metadata_text', V.P_YEAR)}, '') as int) as year
from (select *, try_cast(nullif(regexp_extract(julgamento_data, '^([0-9]+)-([0-9]+)-([0-9]+)$', 1), '') as int) as d, try_cast(nullif(regexp_extract(julgamento_data, '^([0-9]+)-([0-9]+)-([0-9]+)$', 2), '') as int) as m,
 try_cast(nullif(regexp_extract(julgamento_data, '^([0-9]+)-([0-9]+)-([0-9]+)$', 3), '') as int) as y from rb)""")
def _(x):
    return B.resolve_blocks(x.blocks).select("block_id", T.norm_date("julgamento_data").alias("iso"), T.judgment_year("metadata_text").alias("year"))


@query("fn15_fn20_keys", needs=("blocks",), ctes=RESOLVED, sql=f"""
select block_id, {sub('process_number', '[^0-9]')} as digits, process_key, block_hash, sha256({norm_spaces('anchor_slug')}||'||'||{norm_spaces('block_text')}) as sha, raw_signature from rb""")
def _(x):
    return B.resolve_blocks(x.blocks).select("block_id", T.digits("process_number").alias("digits"), "process_key", "block_hash", T.block_hash_sha("anchor_slug", "block_text").alias("sha"), "raw_signature")


@query("fn19_marker_label", needs=("blocks",), sql="""
select editorial_marker, case editorial_marker when 'sumula_vinculante' then 'Sumula Vinculante' when 'controle_concentrado' then 'Controle Concentrado' when 'repercussao_geral' then 'Repercussao Geral'
 when 'julgados_correlatos' then 'Julgados Correlatos' when 'sem_categoria' then 'Sem Categoria' else '' end as label, count(*) as n from fx_blocks group by 1, 2""")
def _(x):
    return x.blocks.groupBy("editorial_marker", T.marker_label("editorial_marker").alias("label")).agg(F.count("*").alias("n"))


@query("fn21_clean_name", needs=("blocks",), ctes=RESOLVED, sql="""
select distinct relator, case relator when 'Roberto Barroso' then 'Luís Roberto Barroso' when 'Marco Aurelio' then 'Marco Aurélio' when 'Dias Tofolli' then 'Dias Toffoli' else case when length(relator) >= 4 then relator else '' end end as cleaned from rb""")
def _(x):
    return B.resolve_blocks(x.blocks).select("relator", T.clean_name("relator").alias("cleaned")).distinct()


@query("fn26_link_summary", needs=("comments",), ctes=COMM, sql="select com_id, coalesce(urls[1], '') as first, array_to_string(urls, ' | ') as all_links from h1")
def _(x):
    s = T.link_summary("html")
    return B.drop_markers(compute_once(x.comments.select("com_id", "html"), {"t": T.strip_html("html")}), "t").select("com_id", s["first"].alias("first"), s["all"].alias("all_links"))


@query("fn28_truncate_for_model", sql="""
select doc_id, greatest(1, ceil(length(text) / 24000.0))::int as pieces, md5(text) as text_hash, ceil(length(text) / 4.0)::int as tokens from documents""")
def _(x):
    """Inputs a model accepts: consecutive pieces that give the text when joined."""
    p = x.documents.select("doc_id", T.pieces_for_model("text").alias("p"), T.token_estimate("text").alias("tokens"))
    return p.select("doc_id", F.size("p").alias("pieces"), F.md5(F.array_join("p", "")).alias("text_hash"), "tokens")


@query("fn29_vector_literal", sql="select vec_id, '['||array_to_string(list_transform(embedding, lambda v: printf('%.7f', v::double)), ',')||']' as literal from embeddings")
def _(x):
    return x.embeddings.select("vec_id", T.vector_literal("embedding").alias("literal"))


@query("src11_split_by_class", needs=("lines",), sql=f"""
select case when {has('text', '^(Art|§|[IVXLC]+ -|[a-z]' + chr(92) + ')|Par)')} then 'A_normativo' when {has('text', '^(S[uú]mula|Controle|Repercuss|Julgados)')} then 'B_editorial'
 when {has('text', '^' + chr(92) + '[')} then 'D_metadados' else 'C_textual' end as block_type, count(*) as n from fx_lines group by 1""")
def _(x):
    from lexanchor.sources.tables import split_by_class

    t = x.lines.withColumn("block_type", F.when(F.col("text").rlike(r"^(Art|§|[IVXLC]+ -|[a-z]\)|Par)"), "A_normativo").when(
        F.col("text").rlike("^(S[uú]mula|Controle|Repercuss|Julgados)"), "B_editorial").when(F.col("text").rlike(r"^\["), "D_metadados").otherwise("C_textual"))
    parts = [d.groupBy("block_type").agg(F.count("*").alias("n")) for d in split_by_class(t).values()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
