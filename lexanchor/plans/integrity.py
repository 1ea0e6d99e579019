"""Integrity, contract, deduplication, reconciliation, set operations and table maintenance."""

from pyspark.sql import functions as F

from lexanchor import vocab as V
from lexanchor.functions import text as T
from lexanchor.operators import blocks as B, integrity as I, reconcile as R
from lexanchor.plans.registry import query, ts
from lexanchor.plans.sqltext import RESOLVED, lit, norm_key, strip_accents, sub
from lexanchor.session import scratch
from lexanchor.sources import in_place as P, tables as S


# -------------------------------------------------------------------- integrity
@query("val1_check_slugs", needs=("objects", "actors"), sql="""
select slug, sum(o)::bigint as in_objects, sum(1-o)::bigint as in_actors from (select case when type_slug='subject' and id like '%7' then 'part-7' else slug end as slug, 1 as o from fx_objects
 union all select replace(slug, 'sup-1', 'reg-1'), 0 from fx_actors) group by 1 having count(*) > 1""")
def _(x):
    o = x.objects.withColumn("slug", F.when((F.col("type_slug") == "subject") & F.col("id").endswith("7"), "part-7").otherwise(F.col("slug")))
    return I.check_slugs(o, x.actors.withColumn("slug", F.replace("slug", F.lit("sup-1"), F.lit("reg-1"))))


@query("set6_slug_collisions", needs=("objects", "actors"), sql="select slug from fx_objects intersect select replace(slug, 'sup-', 'part-') from fx_actors")
def _(x):
    return I.slug_collisions(x.objects, x.actors.withColumn("slug", F.replace("slug", F.lit("sup-"), F.lit("part-"))))


@query("val1_duplicate_edge_ids", needs=("edges",), sql="select edge_id, count(*) as n from fx_edges group by 1 having count(*) > 1")
def _(x):
    return I.duplicate_ids(x.edges, "edge_id")


@query("val2_check_multiplicity", needs=("edges", "edge_types"), sql="""
select type_slug, source_id, target_id, count(*) as n from (select replace(e.type_slug, 'sobre', 'relator_de') as type_slug, source_id, target_id, valid_to from fx_edges e)
where valid_to is null and type_slug in (select type_slug from fx_edge_types where not allows_multiple) group by 1, 2, 3 having count(*) > 1""")
def _(x):
    e = x.edges.withColumn("type_slug", F.replace("type_slug", F.lit("sobre"), F.lit("relator_de")))
    return I.check_multiplicity(e, x.edge_types)


@query("val3_check_weight", needs=("edges", "edge_types"), sql="""
select edge_id, type_slug, source_id, target_id from fx_edges where weight is null and type_slug in (select type_slug from fx_edge_types where weight_required)""")
def _(x):
    return I.check_weight(x.edges, x.edge_types)


@query("val4_check_append_only", sql="""
select o_orderkey, case when o_orderkey%10=1 then 'removed' else 'changed' end as violation from orders where o_orderkey%10<>0 and (o_orderkey%10=1 or o_orderkey%50=2)""")
def _(x):
    cols = x.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    new = cols.filter("o_orderkey % 10 <> 1").withColumn("o_custkey", F.col("o_custkey") + F.when(F.col("o_orderkey") % 50 == 2, 1).otherwise(0))
    return I.check_append_only(cols.filter("o_orderkey % 10 <> 0"), new, "o_orderkey")


@query("val5_check_refs", needs=("objects", "actors", "log", "edges", "object_types", "actor_types", "event_types", "edge_types"), sql="""
select 'events.aggregate_id' as "check", event_id as id, aggregate_id as reference from fx_log where aggregate_id not in (select id from fx_objects where id not like '%3')
union all select 'events.causation_id', event_id, causation_id from fx_log where causation_id is not null and causation_id not in (select event_id from fx_log)
union all select 'events.actor_id', event_id, actor_id from fx_log where actor_id not in (select id from fx_actors)
union all select 'objects.type_slug', id, type_slug from fx_objects where id not like '%3' and type_slug not in (select type_slug from fx_object_types)
union all select 'edges.type_slug', edge_id, type_slug from fx_edges where type_slug not in (select type_slug from fx_edge_types)""")
def _(x):
    o = x.objects.filter(~F.col("id").endswith("3"))
    return I.check_refs(o, x.actors, x.log, x.edges, x.object_types, x.actor_types, x.event_types, x.edge_types)


@query("val6_check_enums", needs=("provenance",), sql="""
select provenance_id, 'target_table' as "column", target_table as value from fx_provenance where target_table not in ('objects','actors','events','edges')
union all select provenance_id, 'source_type', source_type from fx_provenance where source_type not in ('manual','scraping','parsing','pipeline','ia')""")
def _(x):
    return I.check_enums(x.provenance, I.PROVENANCE_RULES, "provenance_id")


def _contract_sql(kind: str, source: str, ident: str, keys: str) -> str:
    rows = []
    for (k, t), spec in V.CONTRACT.items():
        if k != kind:
            continue
        for level, fields in spec.items():
            rows += [f"({lit(t)}, {lit(level)}, {lit(f)})" for f in fields.split()]
    return f"""select {ident}, type_slug, field, rule, severity from (
 select r.{ident}, r.type_slug, c.field, case c.level when 'PRO' then 'PRO present' when 'EXT' then 'EXT unsigned' when 'REC' then 'REC missing' when 'INF' then 'INF missing' else 'OBR missing' end as rule,
  case when c.level in ('REC','INF') then 'warning' else 'reject' end as severity,
  case when c.level = 'PRO' then list_contains(r.ks, c.field)
   when c.level = 'EXT' then list_contains(r.ks, c.field) and not (list_contains(r.ks, 'extraction_method') and list_contains(r.ks, 'confidence_score'))
   when c.level = 'COL' then r.mode = 'colegiado' and not list_contains(r.ks, c.field) else not list_contains(r.ks, c.field) end as bad
 from (select *, {keys} as ks, json_extract_string(payload, '$.collegiality_mode') as mode from {source}) r
 join (values {', '.join(rows)}) c(type_slug, level, field) on c.type_slug = r.type_slug) where bad"""


@query("val7_contract_events", needs=("log",), sql=_contract_sql("events", "fx_log", "event_id", "json_keys(payload)"))
def _(x):
    return I.validate_contract(x.log, "events", "event_id")


@query("val7_contract_objects", needs=("objects",), sql="select type_slug, severity, rule, field, count(*) as n from (" + _contract_sql("objects", "fx_objects", "id", "json_keys(payload)") + ") group by 1, 2, 3, 4")
def _(x):
    return I.contract_summary(I.validate_contract(x.objects, "objects", "id"))


@query("val11_contract_edges", needs=("edges",), sql=_contract_sql(
    "edges", "fx_edges", "edge_id", "list_concat(coalesce(json_keys(payload), []), case when weight is not null then ['weight'] else [] end, case when payload is not null then ['payload'] else [] end)"))
def _(x):
    return I.validate_contract(x.edges, "edges", "edge_id")


@query("val8_complete_judgments", needs=("log", "edges", "roles"), sql="""
select event_id, aggregate_id from fx_log l where type_slug = 'julgamento' and json_extract_string(payload,'$.collegiality_mode') = 'colegiado' and """
       + " and ".join(f"json_extract_string(payload,'$.{f}') is not null" for f in V.COMPLETE_JUDGMENT) + """
 and aggregate_id in (select target_id from fx_edges where type_slug='relator_de' and valid_to is null)
 and aggregate_id in (select target_id from fx_roles where json_extract_string(payload,'$.role') = 'relator')""")
def _(x):
    return I.complete_judgments(x.log, x.edges, x.roles)


@query("val9_missing_provenance", needs=("objects", "provenance"), sql="select id, type_slug from fx_objects where id not in (select target_id from fx_provenance where target_table = 'objects')")
def _(x):
    return I.missing_provenance(x.objects, x.provenance, "objects").select("id", "type_slug")


@query("val10_best_by_confidence", needs=("provenance",), sql="""
select target_table, target_id, provenance_id, confidence from (select *, row_number() over (partition by target_table, target_id order by confidence desc, produced_at desc, provenance_id) as rn from fx_provenance) where rn = 1""")
def _(x):
    return I.best_by_confidence(x.provenance).select("target_table", "target_id", "provenance_id", "confidence")


# ---------------------------------------------------------------- deduplication
def _dedup(expr):
    return f"""select block_id, anchor_slug from (select *, row_number() over (partition by {expr}, anchor_slug order by block_id) as rn from fx_dedup_blocks) where rn = 1"""


@query("ddp1_dedup_prefix", needs=("dedup_blocks",), sql=_dedup("trim(block_text)"))
def _(x):
    return R.dedup_prefix(x.dedup_blocks).select("block_id", "anchor_slug")


@query("ddp2_dedup_exact", needs=("dedup_blocks",), sql=_dedup("block_text"))
def _(x):
    return R.dedup_exact(x.dedup_blocks).select("block_id", "anchor_slug")


@query("win3_keep_first", needs=("blocks",), sql="""
select block_id, block_text, anchor_slug from (select *, row_number() over (partition by block_text, anchor_slug order by block_id) as rn from fx_blocks) where rn = 1""")
def _(x):
    return R.dedup_exact(x.blocks).select("block_id", "block_text", "anchor_slug")


@query("ddp1_removed_count", needs=("dedup_blocks",), sql="""
select count(*) as total, count(*) - count(distinct (trim(block_text), anchor_slug)) as removed from fx_dedup_blocks""")
def _(x):
    return R.removed_count(x.dedup_blocks, R.dedup_prefix(x.dedup_blocks))


@query("ddp3_split_processes", needs=("blocks",), ctes=RESOLVED, sql="""
select process_key, 'stf-'||replace(lower(process_key), '_', '-') as process_slug, min_by(process_class, block_id) as process_class, min_by(process_number, block_id) as process_number,
 min_by(relator, block_id) as relator, min_by(julgamento_data, block_id) as julgamento_data, count(*) as records from rb where process_key <> '' group by 1""")
def _(x):
    return R.split_processes(B.resolve_blocks(x.blocks))[0].select(
        "process_key", "process_slug", "process_class", "process_number", "relator", "julgamento_data", "records")


ALIAS = "case relator " + " ".join(f"when {lit(k)} then {lit(v)}" for k, v in V.NAME_ALIASES.items()) + " else relator end"


@query("ddp4_dedup_actors", needs=("blocks",), ctes=RESOLVED, sql=f"""
select dedup_hash, id, name from (select *, row_number() over (partition by dedup_hash order by id) as rn from
 (select md5({norm_key(ALIAS)}) as dedup_hash, 'act-'||block_id as id, relator as name from rb where relator <> '')) where rn = 1""")
def _(x):
    a = B.resolve_blocks(x.blocks).filter("relator <> ''").select(F.concat(F.lit("act-"), F.col("block_id").cast("string")).alias("id"), F.col("relator").alias("name"))
    return R.dedup_actors(a).select("dedup_hash", "id", "name")


@query("fn22_canonical_names", needs=("blocks",), ctes=RESOLVED, sql=f"select relator, {ALIAS} as canonical, count(*) as n from rb where relator <> '' group by 1, 2")
def _(x):
    b = B.resolve_blocks(x.blocks).filter("relator <> ''").groupBy("relator").agg(F.count("*").alias("n"))
    return b.select("relator", T.canonical_name("relator").alias("canonical"), "n")


# ---------------------------------------------------------------- reconciliation
def _markup(src):
    return sub(sub(src, "<[^>]+>", " "), r"&[a-z]+;|&#\d+;", " ")


WORD = "trim(" + sub(sub(f"lower({strip_accents(_markup('text'))})", r"[^\p{L}\p{N}_]", " "), r"\s+", " ") + ")"
WORD_CUT = sub(WORD, "^" + "".join(f"(?:{p} ?)?" for p in V.WORD_KEY_PREFIXES))
ASCII = "substr(" + sub(sub(f"trim(lower({strip_accents(_markup('text'))}))", V.ASCII_KEY_PREFIX), "[^a-z0-9]") + ", 1, 80)"
BOUND = f"lower(trim({sub(_markup('text'), chr(92) + 's+', ' ')}))"


def _rec_sql(key, lengths, min_len, full, last=False, short=False, truth_min=None):
    agg = "max_by" if last else "min_by"
    top = max(lengths)
    parts = [f"""ks as (select *, substr({key}, 1, {top}) as key from (select *, text from documents)),
tk as (select key, min(doc_id) as first_pos, {agg}((doc_id % 40 + 1)::int, doc_id) as article from ks where doc_id % 2 = 0 and length(key) >= {truth_min or min_len} group by key),
ours as (select doc_id as block_id, ((doc_id // 2) % 40 + 1)::int as our_article, text, key from ks where doc_id % 2 = 1)"""]
    picks = []
    for i, n in enumerate(lengths):
        cond = f"length(key) >= {n}" if full else "true"
        parts.append(f"l{i} as (select substr(key, 1, {n}) as p, min_by(article, first_pos) as a from tk where {cond} group by 1)")
        picks.append(f"(select a from l{i} where p = substr(o.key, 1, {n}){f' and length(o.key) >= {n}' if full else ''})")
    if short:
        picks.append("(select min_by(article, first_pos) from tk where length(o.key) < 60 and starts_with(tk.key, o.key))")
    sql = f"""select block_id, our_article, ta as truth_article, case when ta is null then 'unmatched' when ta <> our_article then 'fixed' else 'correct' end as status
 from (select o.*, case when text <> '' and length(o.key) >= {min_len} then coalesce({', '.join(picks)}, null) end as ta from ours o)"""
    return ", ".join(parts), sql


def _rec(name, fn, *spec, **kw):
    ctes, sql = _rec_sql(*spec, **kw)

    @query(name, ctes=ctes, sql=sql)
    def _(x):
        d = x.documents
        truth = d.filter("doc_id % 2 = 0").select(F.col("doc_id").alias("pos"), (F.col("doc_id") % 40 + 1).cast("int").alias("article"), "text")
        slug = F.concat(F.lit("cf-1988-art-"), (F.floor(F.col("doc_id") / 2) % 40 + 1).cast("string"), F.lit("-inc-i"))
        ours = d.filter("doc_id % 2 = 1").select(F.col("doc_id").alias("block_id"), slug.alias("anchor_slug"), F.col("text").alias("block_text"))
        return fn(ours, truth).select("block_id", "our_article", "truth_article", "status")


_rec("rec1_reconcile_80_50", R.reconcile_80_50, WORD, [80, 50], 21, False)
_rec("rec2_reconcile_cascade", R.reconcile_cascade, WORD_CUT, [100, 80, 60, 40], 1, True)
_rec("rec3_reconcile_ascii", R.reconcile_ascii, ASCII, [80, 60, 40], 30, False)
_rec("rec4_fix_boundaries", R.fix_boundaries, BOUND, [100, 60], 20, False, last=True, short=True, truth_min=21)


def _sides(x):
    o = x.orders.select((F.col("o_custkey") % 97).alias("article"), "o_orderkey")
    return o.filter("o_orderkey % 10 <> 0"), o.filter("o_orderkey % 9 <> 1 and article <> 5")


CMP = """cmp as (select coalesce(o.article, t.article) as article, coalesce(ours, 0) as ours, coalesce(truth, 0) as truth, coalesce(ours,0) - coalesce(truth,0) as diff
 from (select o_custkey % 97 as article, count(*) as ours from orders where o_orderkey%10<>0 group by 1) o
 full join (select o_custkey % 97 as article, count(*) as truth from orders where o_orderkey%9<>1 and o_custkey%97<>5 group by 1) t on o.article = t.article),
cc as (select *, case when truth > 0 then round(diff * 100.0 / truth, 1)::double when ours > 0 then 100.0::double else 0.0::double end as pct_diff,
 case when diff = 0 then 'perfect' when abs(diff) <= 2 or (truth > 0 and abs(diff::double / truth) <= 0.1) then 'ok' else 'diverge' end as match_class,
 case when abs(diff) <= 2 or (truth > 0 and abs(diff::double / truth) <= 0.1) then 'OK' when diff < 0 then 'DEFICIT' else 'EXCESSO' end as status from cmp)"""


@query("rec5_set2_compare_counts", ctes=CMP, sql="select * from cc")
def _(x):
    return R.compare_counts(*_sides(x), "article")


@query("srt7_top_divergence", ctes=CMP, sql="select article, diff from cc where match_class = 'diverge' order by abs(diff) desc, article limit 20")
def _(x):
    return R.top_divergence(R.compare_counts(*_sides(x), "article"), "article").select("article", "diff")


@query("rec5_comparison_summary", ctes=CMP, sql="""
select count(*) as keys, count(*) filter (where match_class='perfect') as perfect, count(*) filter (where status='OK') as ok,
 count(*) filter (where match_class='diverge') as diverge, sum(ours)::bigint as ours, sum(truth)::bigint as truth from cc""")
def _(x):
    return R.comparison_summary(R.compare_counts(*_sides(x), "article"))


@query("rec6_expect_count", needs=("blocks",), sql="select 'blocks' as \"check\", count(*) as actual, 8903::bigint as expected, count(*) = 8903 as ok from fx_blocks")
def _(x):
    return R.expect_count(x.blocks, 8903, "blocks")


@query("set1_str1_snapshot_diff", sql="""
select coalesce(o.o_orderkey, n.o_orderkey) as o_orderkey, case when o.o_orderkey is null then 'new' when n.o_orderkey is null then 'removed' else 'kept' end as status
from (select o_orderkey from orders where o_orderkey%10<>0) o full join (select o_orderkey from orders where o_orderkey%10<>1) n on o.o_orderkey = n.o_orderkey""")
def _(x):
    return R.snapshot_diff(x.orders.filter("o_orderkey % 10 <> 0"), x.orders.filter("o_orderkey % 10 <> 1"), "o_orderkey")


@query("set4_union_namespaces", needs=("blocks",), ctes=RESOLVED, sql="select namespace, block_id, anchor_slug from rb")
def _(x):
    b = B.resolve_blocks(x.blocks).select("namespace", "block_id", "anchor_slug")
    return R.union_namespaces(b.filter("namespace = 'cf'"), b.filter("namespace = 'adct'"))


@query("jn16_missing_keys", needs=("blocks",), sql="""
select v as article from range(1, 251) t(v) where v not in (select coalesce(try_cast(nullif(regexp_extract(anchor_slug, '^cf-1988-art-([0-9]+)', 1), '') as int), 0) from fx_blocks)""")
def _(x):
    spine = x.spark.range(1, 251).select(F.col("id").alias("article"))
    return R.missing_keys(spine, x.blocks.select(T.article_of("anchor_slug").cast("bigint").alias("article")), "article")


PARENT = """pa as (select block_id, case when block_id%3=0 then 'exact' when block_id%3=1 then 'parent' when block_id%9=2 then 'adct' else 'none' end as match_type, anchor_slug as anchor_slug_norm,
 case when block_id%3=1 then regexp_replace(anchor_slug, '-(inc|par|ali)-.*$', '') else anchor_slug end as anchor_slug from fx_blocks)"""


def _audit(x):
    m = F.col("block_id")
    b = x.blocks.select(
        "block_id", F.when(m % 3 == 0, "exact").when(m % 3 == 1, "parent").when(m % 9 == 2, "adct").otherwise("none").alias("match_type"),
        F.col("anchor_slug").alias("anchor_slug_norm"),
        F.when(m % 3 == 1, F.regexp_replace("anchor_slug", "-(inc|par|ali)-.*$", "")).otherwise(F.col("anchor_slug")).alias("anchor_slug"))
    return R.parent_audit(b)


LOST = """case when anchor_slug_norm like '%-ali-%' and anchor_slug not like '%-ali-%' then {0} when anchor_slug_norm like '%-inc-%' and anchor_slug not like '%-inc-%' then {1}
 when anchor_slug_norm like '%-par-%' and anchor_slug not like '%-par-%' then {2} else {3} end"""


@query("lnk12_parent_audit", needs=("blocks",), ctes=PARENT, sql=f"""
select block_id, case when match_type='parent' then {LOST.format("'alinea->pai'", "'inciso->art'", "'paragrafo->art'", "'outro'")} end as lost_level,
 case when match_type='none' then 'unresolved' else match_type end as anchor_quality,
 case match_type when 'exact' then 1.0 when 'parent' then {LOST.format(0.5, 0.6, 0.7, 0.8)} when 'adct' then 0.3 else 0.0 end::double as anchor_confidence from pa""")
def _(x):
    return _audit(x).select("block_id", "lost_level", "anchor_quality", "anchor_confidence")


@query("lnk12_lost_level_report", needs=("blocks",), ctes=PARENT, sql=f"""
select lost_level, n, round(n::double / sum(n) over (), 3) as share from (select {LOST.format("'alinea->pai'", "'inciso->art'", "'paragrafo->art'", "'outro'")} as lost_level, count(*) as n
 from pa where match_type = 'parent' group by 1)""")
def _(x):
    return R.lost_level_report(_audit(x))


# ------------------------------------------------------------- table maintenance
@query("src7_append_new", sql="select o_orderkey, case when o_orderkey%2=0 then o_custkey else -o_custkey end as o_custkey from orders")
def _(x):
    """A table of half the orders takes all orders, twice: rows that are there stay, the second run adds nothing."""
    o = x.orders.select("o_orderkey", "o_custkey")
    path = scratch(x.spark, "append-new")
    o.filter("o_orderkey % 2 = 0").write.parquet(path)
    for _ in range(2):
        S.append_new(o.withColumn("o_custkey", -F.col("o_custkey")), path, ["o_orderkey"])
    return x.spark.read.parquet(path)


@query("src8_upsert", sql="select o_orderkey, case when o_orderkey%3<>1 then 'Z' else o_orderstatus end as o_orderstatus from orders")
def _(x):
    o = x.orders.select("o_orderkey", "o_orderstatus")
    return S.upsert(o.filter("o_orderkey % 3 <> 1").withColumn("o_orderstatus", F.lit("Z")), o.filter("o_orderkey % 3 <> 2"), ["o_orderkey"])


# --------------------------------------------------------------- readers and writers
@query("src1_read_tsv", sql="select cast(c_custkey as varchar) as c_custkey, c_name, c_mktsegment, cast(c_nationkey as varchar) as c_nationkey from customer")
def _(x):
    """Written with a byte order mark in front of the first column name, as some exports have it."""
    path = scratch(x.spark, "tsv")
    S.write_tsv(x.customer.select(F.col("c_custkey").alias("\ufeffc_custkey"), "c_name", "c_mktsegment", "c_nationkey"), path)
    return S.read_tsv(x.spark, path, multiline=False)


@query("src2_write_tsv", sql="""
select cast(s_suppkey as varchar) as key, s_name as name, cast(null as varchar) as segment from supplier
 union all select cast(c_custkey as varchar), null, c_mktsegment from customer""")
def _(x):
    """Rows with different columns in one file; what a row lacks is written as '' and read as missing."""
    path = scratch(x.spark, "tsv")
    S.write_tsv(S.union_all_columns(x.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")),
                                    x.customer.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"))), path)
    return S.read_tsv(x.spark, path, multiline=False)


@query("src3_read_blocks_json", needs=("blocks",), sql="select block_id, nullif(anchor_slug, '') as anchor_slug, md5(block_text) as text_hash from fx_blocks")
def _(x):
    """Blocks written as JSON arrays, one array per file, and read back with the fixed schema."""
    path = scratch(x.spark, "blocks-json")
    b = x.blocks.select("block_id", F.nullif("anchor_slug", F.lit("")).alias("anchor_slug"), "block_text")
    arrays = b.groupBy(F.floor(F.col("block_id") / 500).alias("file")).agg(F.to_json(F.collect_list(F.struct("block_id", "anchor_slug", "block_text"))).alias("value"))
    arrays.repartition("file").write.partitionBy("file").text(path)
    return S.read_blocks_json(x.spark, path).select("block_id", "anchor_slug", F.md5("block_text").alias("text_hash"))


@query("src5_read_pages", sql="select page_id, url, md5(html) as html_hash from pages")
def _(x):
    """Pages kept as ISO-8859-1 bytes and decoded; other characters are kept as references."""
    path = scratch(x.spark, "pages")
    latin = F.encode(F.regexp_replace("html", "[^\\x00-\u00ff]", "?"), "ISO-8859-1")
    x.pages.select("page_id", "url", "html", latin.alias("raw")).write.parquet(path)
    p = S.read_pages(x.spark, path)
    plain = ~F.col("html").rlike("[^\\x00-\u00ff]")
    return p.select("page_id", "url", F.md5(F.when(plain, S.latin1_text("raw")).otherwise(F.col("html"))).alias("html_hash"))


@query("src9_materialize_distribution", sql="select o_orderpriority, o_orderstatus, count(*) as n from orders group by 1, 2")
def _(x):
    n = x.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))
    return S.materialize(n, scratch(x.spark, "distribution"), "by_status", ["o_orderstatus"]).select("o_orderpriority", "o_orderstatus", "n")


@query("src8_upsert_in_place", sql="select o_orderkey, case when o_orderkey%3<>1 then 'Z' else o_orderstatus end as o_orderstatus, 0 as rewritten_again from orders")
def _(x):
    """The upsert into a table kept in buckets, run twice; the second run writes no bucket."""
    o, path = x.orders.select("o_orderkey", "o_orderstatus"), scratch(x.spark, "bucketed")
    P.create_bucketed(o.filter("o_orderkey % 3 <> 2"), path, ["o_orderkey"], 16)
    come = o.filter("o_orderkey % 3 <> 1").withColumn("o_orderstatus", F.lit("Z"))
    _first, again = [P.upsert_in_place(come, path, ["o_orderkey"], 16) for _ in range(2)]
    return x.spark.read.parquet(path).select("o_orderkey", "o_orderstatus", F.lit(again).alias("rewritten_again"))


@query("src9_refresh_in_place", sql="""
select o_orderpriority, o_orderstatus, count(*) as n, (select count(distinct o_orderstatus) from orders where o_orderstatus <> 'P') as written, 1 as removed from orders where o_orderstatus <> 'P' group by 1, 2""")
def _(x):
    """A distribution by status made of some orders, then brought up to date: changed partitions are written, the one that is gone is removed."""
    path = scratch(x.spark, "refreshed")
    old = x.orders.withColumn("o_orderkey", F.when(F.col("o_orderstatus") == "P", 1).otherwise(0))
    count = lambda o, n: o.groupBy("o_orderpriority", "o_orderstatus").agg(n.alias("n"))
    P.refresh_in_place(count(old, F.sum("o_orderkey")), path, "o_orderstatus")
    written, removed = P.refresh_in_place(count(x.orders.filter("o_orderstatus <> 'P'"), F.count("*")), path, "o_orderstatus")
    return x.spark.read.parquet(path).select("o_orderpriority", "o_orderstatus", "n", F.lit(written).alias("written"), F.lit(removed).alias("removed"))


@query("src13_changed_only", needs=("objects",), sql="select id, hash_content from fx_objects where length(payload)%3=0 or id like '%9'")
def _(x):
    prev = x.objects.filter(~F.col("id").endswith("9")).withColumn(
        "hash_content", F.when(F.length("payload") % 3 == 0, F.lit("old")).otherwise(F.col("hash_content")))
    return S.changed_only(x.objects, prev, "id", "hash_content").select("id", "hash_content")


@query("src10_publish_objects", needs=("objects",), sql="""
select slug, '{"slug":"'||slug||'","type_slug":"'||type_slug||'","hash_content":"'||hash_content||'"}' as payload_json,
 sha256('{"slug":"'||slug||'","type_slug":"'||type_slug||'","hash_content":"'||hash_content||'"}') as payload_hash from fx_objects""")
def _(x):
    return S.publish_objects(x.objects, ("slug", "type_slug", "hash_content"))


@query("src6_taxonomies", needs=("object_types", "edge_types", "objects"), sql="""
select t.type_slug, t.domain_slug, t.ontological_class, count(o.id) as objects from fx_object_types t left join fx_objects o on o.type_slug = t.type_slug group by 1, 2, 3""")
def _(x):
    t = S.taxonomies(x.spark)["object_types"]
    n = x.objects.groupBy("type_slug").agg(F.count("*").alias("objects"))
    return t.join(n, "type_slug", "left").select("type_slug", "domain_slug", "ontological_class", F.coalesce("objects", F.lit(0)).alias("objects"))
