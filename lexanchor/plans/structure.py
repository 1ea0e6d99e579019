"""Lines, norm trees, carried context and block segmentation."""

from pyspark.sql import functions as F

from lexanchor import vocab as V
from lexanchor.operators import structure as X
from lexanchor.plans.registry import query
from lexanchor.plans.sqltext import has, lit, norm_spaces, rx, sub
from lexanchor.session import cut

TAIL = f"substr(regexp_replace(text, {lit(V.P_ART_LINE)}, ''), 1, 120)"
CROSS = "(?i)" + "|".join(f"(?:{p})" for p in V.CROSS_REFERENCE_TAILS)
OWN = f"coalesce(try_cast(nullif({rx('text', V.P_ART_LINE)}, '') as int) between 1 and 250, false) and not {has(TAIL, CROSS)}"
MARK = "case " + " ".join(f"when {has('text', p)} then '{m}'" for p, m in V.MARKER_LINES) + " end"
META = f"({has('text', V.P_META_LINE)} or {has('text', V.P_META_LINE2)} or {has('text', V.P_SUM_LINE)})"
KIND = f"""case when {OWN} then 'art' when {has('text', V.P_PAR_LINE)} and length(text) < 300 then 'par' when {has('text', V.P_PAR_UNICO_LINE)} and length(text) < 300 then 'par'
 when {has('text', V.P_INC_LINE)} and length(text) < 200 then 'inc' when {has('text', V.P_ALI_LINE)} and length(text) < 200 then 'ali'
 when {MARK} is not null then 'marker' when {META} then 'meta' else 'text' end"""
F0 = f"f0 as (select doc_id, pos, text, {KIND} as kind from fx_lines)"
FEATURES = F0 + f""",
f1 as (select *, case kind when 'art' then {rx('text', V.P_ART_LINE)} when 'par' then case when {has('text', V.P_PAR_LINE)} then translate(lower({rx('text', V.P_PAR_LINE)}), 'ú', 'u') else 'unico' end
 when 'inc' then {rx('text', V.P_INC_LINE)} when 'ali' then {rx('text', V.P_ALI_LINE)} when 'marker' then {MARK} end as value from f0),
zn as (select doc_id, max(pos) as zone_start from (select *, row_number() over (partition by doc_id order by pos) as rn from f1 where kind='art' and value='1') where rn <= 2 group by 1 having count(*) = 2),
ar as (select f.*, case when f.pos >= z.zone_start then 'adct' else 'cf' end as namespace from f1 f left join zn z on z.doc_id = f.doc_id where kind='art'),
ac as (select * exclude (rn) from (select *, row_number() over (partition by doc_id, namespace, value order by pos) as rn from ar) where rn = 1)"""


def context(valid: str = "", reset: str = "article") -> str:
    """Context subqueries; ``valid`` is a condition a sub-device row must meet."""
    highest = {"article": "art_pos", "device": "greatest(art_pos, coalesce(par_pos, -1), coalesce(inc_pos, -1), coalesce(ali_pos, -1))", "none": "-1"}[reset]

    def lastv(k, col="value"):
        return f"last_value(case when kind='{k}' then {col} end ignore nulls) over w"

    keep = f"where kind not in ('par','inc','ali') or (art_pos is not null {valid})"
    return FEATURES + f""",
m1 as (select doc_id, pos, kind, value, null as namespace from f1 where kind not in ('art','text') union all select doc_id, pos, kind, value, namespace from ac),
m2 as (select * from (select *, {lastv('art', 'pos')} as art_pos, {lastv('art')} as art, {lastv('art', 'namespace')} as ns from m1 window w as (partition by doc_id order by pos)) {keep}),
m3 as (select *, {', '.join(f"{lastv(k, 'pos')} as {k}_pos, {lastv(k)} as {k}" for k in ('par', 'inc', 'ali', 'marker'))}, count(*) over w as separator
 from m2 window w as (partition by doc_id order by pos)),
m4 as (select doc_id, pos, kind, ns as namespace, art::int as article, separator, case when par_pos > art_pos then par end as par,
 case when inc_pos > greatest(art_pos, coalesce(par_pos, -1)) then lower(inc) end as inc, case when ali_pos > greatest(art_pos, coalesce(par_pos, -1), coalesce(inc_pos, -1)) then ali end as ali,
 case when marker_pos > coalesce({highest}, -1) then marker else 'sem_categoria' end as editorial_marker from m3),
ctx as (select *, case when namespace='adct' then 'adct' else 'cf-1988' end||'-art-'||article||coalesce('-par-'||par, '')||coalesce('-inc-'||inc, '')||coalesce('-ali-'||ali, '') as anchor_slug from m4)"""


BLOCKS = """,
lx as (select l.doc_id, l.pos, l.text, c.* exclude (doc_id, pos), coalesce(c.pos = l.pos, false) as itself from fx_lines l asof left join ctx c on l.doc_id = c.doc_id and l.pos >= c.pos),
ly as (select *, itself and kind='meta' as is_meta, coalesce(separator, 0) - (case when itself and kind='meta' then 1 else 0 end) as block_no from lx where not itself or kind='meta'),
sb as (select doc_id, block_no, first(anchor_slug) as anchor_slug, coalesce(first(editorial_marker), 'sem_categoria') as editorial_marker, coalesce(string_agg(case when not is_meta then text end, ' ' order by pos), '') as block_text,
 coalesce(string_agg(case when is_meta then text end, ' ' order by pos), '') as metadata_text, min(pos) as paragraph_start, max(pos) as paragraph_end from ly group by 1, 2)"""
BCOLS = ["doc_id", "block_no", "anchor_slug", "editorial_marker", "block_text", "metadata_text", "paragraph_start", "paragraph_end"]
CCOLS = ["doc_id", "pos", "kind", "namespace", "article", "par", "inc", "ali", "editorial_marker", "anchor_slug"]


@query("txt1_explode_lines", sql="""
select doc_id, i - 1 as pos, trim(l) as text from (select doc_id, unnest(string_split(text, chr(10))) as l, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents) where trim(l) <> ''""")
def _(x):
    return X.explode_lines(x.documents)


@query("txt1_explode_paragraphs", sql="""
select page_id, count(*) as paragraphs from (select page_id, unnest(regexp_extract_all(html, '(?is)<p[^>]*>(.*?)</p>', 1)) as raw from pages) where trim(regexp_replace(regexp_replace(raw, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) <> '' group by 1""")
def _(x):
    return X.explode_paragraphs(x.pages).groupBy("page_id").agg(F.count("*").alias("paragraphs"))


@query("txt3_classify_abcd", needs=("lines",), ctes=F0, sql="""
select doc_id, pos, case when kind in ('art','par','inc','ali') then 'A' when kind='marker' then 'B' when kind='meta' then 'D' else 'C' end as line_class from f0""")
def _(x):
    return x.lines.select("doc_id", "pos", X.classify_abcd("text").alias("line_class"))


@query("txt4_own_articles", needs=("lines",), sql=f"select doc_id, pos, {OWN} as own from fx_lines")
def _(x):
    return x.lines.select("doc_id", "pos", X.is_own_article("text").alias("own"))


@query("txt14_marker_lines", needs=("lines",), sql=f"select doc_id, pos, {MARK} as marker from fx_lines where {MARK} is not null")
def _(x):
    return x.lines.select("doc_id", "pos", X.M.marker_line("text").alias("marker")).filter("marker is not null")


@query("win10_namespace_of", needs=("lines",), ctes=FEATURES, sql="select doc_id, pos, value, namespace from ar")
def _(x):
    return X.namespace_of(cut(X.structural_marks(x.lines))).select("doc_id", "pos", "value", "namespace")


@query("win11_accept_first", needs=("lines",), ctes=FEATURES, sql="select doc_id, pos, value, namespace from ac")
def _(x):
    return X.accept_first(cut(X.structural_marks(x.lines))).select("doc_id", "pos", "value", "namespace")


@query("win7_carry_context", needs=("lines",), ctes=context(), sql=f"select {', '.join(CCOLS)} from ctx")
def _(x):
    return X.carry_context(X.structural_marks(x.lines), size=512).select(*CCOLS)


@query("win8_carry_editorial_article", needs=("lines",), ctes=context(), sql="select doc_id, pos, kind, editorial_marker from ctx")
def _(x):
    return X.carry_editorial(X.structural_marks(x.lines))


@query("win8_carry_editorial_device", needs=("lines",), ctes=context(reset="device"), sql="select doc_id, pos, kind, editorial_marker from ctx")
def _(x):
    return X.carry_editorial(X.structural_marks(x.lines), "device")


VALID = "and not (kind = 'par' and art::int % 2 = 0 and value <> '1')"


@query("txt5_validate_subnode", needs=("lines",), ctes=context(VALID), sql=f"select {', '.join(CCOLS)} from ctx")
def _(x):
    # even articles of the norm have a single paragraph, numbered 1
    valid = x.spark.range(1, 126).select((F.col("id") * 2).cast("int").alias("article"), F.lit("par").alias("kind"), F.lit("1").alias("value"))
    return X.carry_context(X.structural_marks(x.lines), valid).select(*CCOLS)


@query("win9_segment_blocks", needs=("lines",), ctes=context() + BLOCKS, sql=f"select {', '.join(BCOLS)} from sb")
def _(x):
    return X.segment_blocks(x.lines, size=512).select(*BCOLS)


@query("txt9_anchor_positions", needs=("lines",), sql=f"""
select doc_id, article, coalesce(e, a) as pos, e is not null as exact from (select doc_id, article, min(pos) filter (where fp <> '' and (contains(rest, substr(fp,1,10)) or contains(fp, substr(rest,1,10)))) as e,
 min(pos) filter (where plain) as a from (select l.doc_id, l.pos, t.v as article, lower({sub("substr(trim(regexp_replace(l.text, " + lit(V.P_ART_LINE) + ", '')), 1, 20)", chr(92) + "s+", " ")}) as rest,
 {has('l.text', V.P_ART_LINE + chr(92) + "s")} or {has('l.text', V.P_ART_LINE + "[" + chr(92) + ".]")} as plain, case when t.v%3=0 then 'outro corpo' else 'texto do artigo' end as fp
 from fx_lines l join range(1, 61) t(v) on try_cast(nullif({rx('l.text', V.P_ART_LINE)}, '') as int) = t.v) group by 1, 2) where coalesce(e, a) is not null""")
def _(x):
    tree = x.spark.range(1, 61).select(F.col("id").cast("int").alias("article"), F.when(F.col("id") % 3 == 0, "Outro corpo").otherwise("Texto do artigo").alias("body"))
    return X.anchor_positions(x.lines, tree)


@query("jn17_attach_preceding", needs=("comments", "device_marks"), sql="""
select c.doc_id, c.com_id, d.device from fx_comments c asof left join fx_device_marks d on c.doc_id = d.doc_id and c.pos >= d.pos""")
def _(x):
    return X.attach_preceding(x.device_marks, x.comments.select("doc_id", "pos", "com_id"), size=100).select("doc_id", "com_id", "device")


@query("win7_conversations_carry", sql="""
select conv_id, turn, last_value(case when role='user' then turn end ignore nulls) over (partition by conv_id order by turn) as last_user_turn from conversations""")
def _(x):
    c = x.conversations.groupBy("conv_id", "turn", "role").agg(F.count("*").alias("n"))
    users = c.filter("role = 'user'").select("conv_id", F.col("turn").alias("pos"), F.col("turn").alias("device"))
    rows = x.conversations.select("conv_id", F.col("turn").alias("pos"), "role")
    return X.attach_preceding(users, rows, keys=("conv_id",)).select("conv_id", F.col("pos").alias("turn"), F.col("device").alias("last_user_turn"))


# --------------------------------------------------------------------- norm tree
NS = norm_spaces("text")


def _tree_fields():
    kind, num, label, raw, txt = [], [], [], [], []
    for k, p, n, t in V.TREE_LINES:
        c = f"when {has(NS, p)}"
        kind.append(f"{c} then '{'paragrafo' if k == 'paragrafo_unico' else k}'")
        r = rx(NS, p, n) if n else "null"
        raw.append(f"{c} then " + ("'único'" if k == "paragrafo_unico" else f"upper({r})" if k in ("titulo", "capitulo", "secao", "subsecao", "inciso") else f"lower({r})" if k == "alinea" else r))
        label.append(f"{c} then " + {"artigo": f"'Art. '||{r}", "paragrafo": f"'§ '||{r}", "item": f"{r}||'.'", "inciso": f"upper({r})", "alinea": f"lower({r})||')'",
                                     "paragrafo_unico": "'Parágrafo único'", "preambulo": "'PREÂMBULO'"}.get(k, NS))
        txt.append(f"{c} then " + (f"trim({rx(NS, p, t)})" if t else "''"))
    return (f"case {' '.join(kind)} else 'texto_livre' end as node_type, case {' '.join(label)} end as label, case {' '.join(raw)} end as number_raw, "
            f"case {' '.join(txt)} else {NS} end as text")


_ROM = {}
for _i, _n in enumerate("I II III IV V VI VII VIII IX X XI XII XIII XIV XV XVI XVII XVIII XIX XX".split(), 1):
    _ROM[_n] = _i
NODES = f"""t0 as (select doc_id, pos, {_tree_fields()} from fx_norm_lines),
tn as (select *, case when node_type in ('titulo','capitulo','secao','subsecao','inciso') then (case number_raw {' '.join(f"when '{k}' then '{v}'" for k, v in _ROM.items())} end)
 when node_type in ('artigo','paragrafo','item') then case when number_raw='único' then 'unico' else number_raw end when node_type='alinea' then number_raw end as number_norm from t0)"""
VALID_SQL = "case node_type " + " ".join(f"when '{k}' then [{', '.join(lit(v) for v in vs)}]" for k, vs in V.TREE_PARENTS.items()) + " end"
PARENTS = NODES + f""",
nn as (select doc_id, pos, node_type, row_number() over (partition by doc_id order by pos) as rn, {VALID_SQL} as valid from tn where node_type <> 'texto_livre'),
st as (select doc_id, 0::bigint as rn, null::bigint as pos, null::bigint as parent_pos, [{{'t': 'root', 'p': -1::bigint}}] as stack from (select distinct doc_id from nn)
 union all select doc_id, rn, pos, case when idx = 1 then null else stack[idx].p end, list_append(stack[1:idx], {{'t': node_type, 'p': pos}}) from (
  select n.doc_id, n.rn, n.pos, n.node_type, s.stack, coalesce(list_max(list_filter(range(1, len(s.stack) + 1), lambda i: list_contains(n.valid, s.stack[i].t))), 1) as idx
  from st s join nn n on n.doc_id = s.doc_id and n.rn = s.rn + 1)),
pp as (select doc_id, pos, parent_pos from st where rn > 0)"""
PARENTS_REC = PARENTS


@query("txt2_classify_line", needs=("norm_lines",), ctes=NODES, sql="select doc_id, pos, node_type, label, number_raw, number_norm, text from tn")
def _(x):
    return X.classify_lines(x.norm_lines)


def _nodes(x):
    return X.classify_lines(x.norm_lines).filter("node_type <> 'texto_livre'")


@query("txt6_assign_parents", needs=("norm_lines",), ctes=PARENTS_REC, recursive=True, sql="select doc_id, pos, parent_pos from pp")
def _(x):
    return X.assign_parents(_nodes(x), size=512).select("doc_id", "pos", "parent_pos")


SEGMENT = "case node_type " + " ".join(f"when '{k}' then '{v}'" for k, v in V.TREE_SEGMENT.items()) + " end"
PATHS = PARENTS_REC + f""",
nd as (select t.*, p.parent_pos from tn t join pp p on p.doc_id = t.doc_id and p.pos = t.pos),
pa as (select doc_id, pos, 'cf-1988-'||case when node_type='preambulo' then 'preambulo' else {SEGMENT}||'-'||number_norm end as slug, label as path, 1 as depth from nd where parent_pos is null
 union all select n.doc_id, n.pos, case when node_type in ('titulo','artigo') then 'cf-1988' else pa.slug end||'-'||{SEGMENT}||'-'||number_norm, pa.path||' > '||n.label, pa.depth + 1
 from nd n join pa on pa.doc_id = n.doc_id and pa.pos = n.parent_pos)"""


@query("txt7_node_paths", needs=("norm_lines",), ctes=PATHS, recursive=True, sql="select doc_id, pos, slug, path, depth from pa")
def _(x):
    nodes = _nodes(x)
    a = X.node_paths(nodes, X.assign_parents(nodes))
    return a.select("doc_id", "pos", "slug", "path", "depth")


@query("txt8_attach_text", needs=("norm_lines",), ctes=NODES + """,
ow as (select *, last_value(case when node_type <> 'texto_livre' then pos end ignore nulls) over w as owner, last_value(case when node_type <> 'texto_livre' then node_type end ignore nulls) over w as otype from tn
 window w as (partition by doc_id order by pos)),
ti as (select doc_id, owner, min(pos) as tpos from ow where owner is not null and otype in ('titulo','capitulo','secao','subsecao') and node_type='texto_livre' and length(text) < 180 group by 1, 2)""", sql="""
select o.doc_id, o.owner as pos, max(case when o.pos = t.tpos then o.text end) as title, coalesce(string_agg(case when o.text <> '' and o.pos is distinct from t.tpos then o.text end, chr(10) order by o.pos), '') as text
from ow o left join ti t on t.doc_id = o.doc_id and t.owner = o.owner where o.owner is not null group by 1, 2""")
def _(x):
    return X.attach_text(X.classify_lines(x.norm_lines), size=512)


@query("agg39_tree_summary", needs=("norm_lines",), ctes=NODES, sql="""
select doc_id, node_type, count(*) as nodes, max(case when node_type='artigo' then number_norm::int end) as last_article from tn where node_type <> 'texto_livre' group by 1, 2""")
def _(x):
    return X.tree_summary(_nodes(x))


@query("agg39_article_gaps", needs=("lines",), ctes=FEATURES + ", ag as (select doc_id, value::int + value::int // 3 as a from f1 where kind='art')", sql="""
select doc_id, v as article from (select doc_id, unnest(range(1, m + 1)) as v from (select doc_id, max(a) as m from ag group by 1)) where (doc_id, v) not in (select doc_id, a from ag)""")
def _(x):
    """Article numbers are stretched, so that every fourth is missing."""
    m = X.structural_marks(x.lines).filter("kind = 'art'")
    number = F.expr("cast(cast(value as int) + cast(value as int) div 3 as string)")
    return X.article_gaps(m.select("doc_id", F.lit("artigo").alias("node_type"), number.alias("number_norm")))


@query("src12_export_tree", needs=("norm_lines",), ctes=PATHS, recursive=True, sql="""
select p.doc_id, t.node_type, t.label, p.path, p.pos as line_start from pa p join tn t on t.doc_id = p.doc_id and t.pos = p.pos""")
def _(x):
    nodes = _nodes(x)
    return X.label_paths(nodes, X.assign_parents(nodes)).select("doc_id", "node_type", "label", "path", F.col("pos").alias("line_start"))


# -------------------------------------------------------------- document reports
@query("agg26_document_profile", sql=r"""
select doc_id, len(ls) as lines, len(fs) as filled_lines, length(text) as chars, len(regexp_extract_all(text, '\S+')) as words,
 len(list_filter(fs, lambda s: contains(s, chr(65533)))) as encoding_errors, len(list_filter(fs, lambda s: length(trim(s)) < 3)) as short_lines, len(list_filter(fs, lambda s: length(trim(s)) > 2000)) as long_lines
from (select *, list_filter(ls, lambda s: trim(s) <> '') as fs from (select doc_id, text, string_split(text, chr(10)) as ls from documents))""")
def _(x):
    return X.document_profile(x.documents)


CLASS = f"""case when kind in ('art','par','inc','ali') or {has('text', '(?i)^(T[IÍ]TULO|CAP[IÍ]TULO|SE[CÇ][AÃ]O)' + chr(92) + 's+[IVXLCDM]+')} then 'norma'
 when {has('text', V.P_CITED)} then 'decisao' when kind='marker' then 'editorial' else 'outro' end"""


@query("agg27_line_class_share", needs=("lines",), ctes=F0, sql=f"""
select line_class, n, round(n * 100.0 / sum(n) over (), 1)::double as pct from (select {CLASS} as line_class, count(*) as n from f0 group by 1)""")
def _(x):
    return X.line_class_share(x.lines)


@query("agg28_decisions_per_article", needs=("lines",), ctes=f"""
d0 as (select doc_id, pos, try_cast(nullif(regexp_extract(text, '(?i)^Art\\.\\s*(\\d+)[^0-9]', 1), '') as int) as number,
 len(list_filter(regexp_extract_all(text, {lit(V.P_CITED)}, 1), lambda b: regexp_matches(trim(b), {lit('^(' + V.CLASSES_CITED + ')' + chr(92) + 's*[-n.]*' + chr(92) + 's*[0-9.]+')}))) as n from fx_lines),
d1 as (select *, last_value(number ignore nulls) over (partition by doc_id order by pos) as article from d0)""",
       sql="select doc_id, article, sum(n)::bigint as decisions from d1 where n > 0 and article is not null group by 1, 2")
def _(x):
    return X.decisions_per_article(x.lines, size=512)
