"""Trees, chains, vectors, learned profiles and streams."""

import uuid

from pyspark.sql import functions as F

from lexanchor.fixtures import Corpus
from lexanchor.operators import blocks as B, graph as G, learn as LN, nearest as NE, search as SE, vectors as VE
from lexanchor.plans.core import STATE_NEEDS, VERSIONED
from lexanchor.plans.integrity import WORD
from lexanchor.plans.registry import query
from lexanchor.plans.signals import JUDGMENTS
from lexanchor.plans.sqltext import RESOLVED, norm_key
from lexanchor.session import cut, scratch
from lexanchor.streaming import changes as CH, state as ST

CLOSE = """lk as (select target_id as node, source_id as parent from fx_edges where type_slug='parent_of' and valid_to is null),
cl as (select node, parent as ancestor, 1 as distance from lk union all select c.node, l.parent, c.distance + 1 from cl c join lk l on l.node = c.ancestor)"""


@query("gr1_ancestor_closure", needs=("edges",), ctes=CLOSE, recursive=True, sql="select * from cl")
def _(x):
    return G.ancestor_closure(G.parent_links(x.edges))


TREE = CLOSE + """, tc as (select o.id, o.slug, coalesce(d.depth, 0) as depth, coalesce(d.root, o.id) as root, o.id not in (select parent from lk) as is_leaf, coalesce(d.up||'/', '')||o.id as path
 from fx_objects o left join (select node, max(distance) as depth, max_by(ancestor, distance) as root, string_agg(ancestor, '/' order by distance desc) as up from cl group by 1) d on d.node = o.id where o.valid_to is null)"""


@query("gr1_tree_closure", needs=("edges", "objects"), ctes=TREE, recursive=True, sql="select * from tc")
def _(x):
    return G.tree_closure(x.objects, x.edges)


@query("gr2_rollup_to_ancestors", needs=("edges",), ctes=CLOSE, recursive=True, sql="""
select node, sum(own)::bigint as own, sum(t)::bigint as total from (select target_id as node, 1 as own, 1 as t from fx_edges where type_slug='interpreta'
 union all select c.ancestor, 0, 1 from fx_edges e join cl c on c.node = e.target_id where e.type_slug='interpreta') group by 1""")
def _(x):
    n = x.edges.filter("type_slug = 'interpreta'").groupBy(F.col("target_id").alias("node")).agg(F.count("*").alias("n"))
    return G.rollup_by_levels(n, G.parent_links(x.edges))


@query("gr4_subject_rollup", needs=("edges", "subject_edges"), ctes="""
sl as (select target_id as node, source_id as parent from fx_subject_edges),
sc as (select node, parent as ancestor from sl union all select c.node, l.parent from sc c join sl l on l.node = c.ancestor),
sn as (select target_id as node, count(*) as n from fx_edges where type_slug='sobre' and valid_to is null group by 1)""", recursive=True, sql="""
select node, sum(own)::bigint as own, sum(t)::bigint as total from (select node, n as own, n as t from sn union all select c.ancestor, 0, s.n from sn s join sc c on c.node = s.node) group by 1""")
def _(x):
    return G.subject_rollup(x.edges, x.subject_edges)


@query("gr3_cross_edges", needs=("edges", "objects", "object_types"), ctes="dm as (select o.id, t.domain_slug as d from fx_objects o join fx_object_types t on t.type_slug = o.type_slug)", sql="""
select e.edge_id, e.type_slug, e.source_id, e.target_id, s.d as source_domain, g.d as target_domain from fx_edges e join dm s on s.id = e.source_id join dm g on g.id = e.target_id where s.d <> g.d""")
def _(x):
    return G.cross_edges(x.edges, x.objects, x.object_types)


@query("gr5_causation_chain", needs=("log",), recursive=True, ctes="""
ch as (select event_id, event_id as root, 0 as steps from fx_log where causation_id is null or causation_id not in (select event_id from fx_log)
 union all select l.event_id, c.root, c.steps + 1 from fx_log l join ch c on c.event_id = l.causation_id)""", sql="select event_id, root, steps from ch")
def _(x):
    return G.causation_chain(x.log)


@query("gr9_succession", needs=("succession_edges",), recursive=True, ctes="""
su as (select distinct target_id as actor, target_id as root, 0 as rank from fx_succession_edges where target_id not in (select source_id from fx_succession_edges)
 union all select e.source_id, s.root, s.rank + 1 from fx_succession_edges e join su s on s.actor = e.target_id)""", sql="select * from su")
def _(x):
    return G.succession(x.succession_edges)


@query("gr8_derive_caches", needs=("edges", "objects", "norm_events", "amend_edges"), recursive=True, ctes=TREE + """,
""" + VERSIONED.replace("am as", "am0 as") + """,
am as (select node, count(*) as n from am0 group by 1),
rp as (select aggregate_id as id, json_extract_string(payload,'$.to_state') = 'revogada' as r from fx_norm_events where list_contains(json_keys(payload), 'to_state') qualify row_number() over (partition by aggregate_id order by occurred_at desc, event_id) = 1)""", sql=f"""
select t.id, t.depth, t.is_leaf, coalesce(r.r, false) as is_repealed, {norm_key("json_extract_string(o.payload, '$.text_content')")} as normalized_text, coalesce(a.n, 0) as total_amendments
from tc t join fx_objects o on o.id = t.id left join rp r on r.id = t.id left join am a on a.node = t.id""")
def _(x):
    return G.derive_caches(x.objects, x.edges, x.norm_events, x.amend_edges)


REC = """rc as (select *, 'stf-'||replace(lower(process_key), '_', '-') as process_slug, row_number() over (partition by process_key order by block_id) as n from rb where process_key <> ''),
rr as (select *, process_slug||'-rj-'||n as record_slug from rc)"""


@query("win14_record_slugs", needs=("blocks",), ctes=RESOLVED + ", " + REC, sql="select block_id, process_slug, record_slug from rr")
def _(x):
    return G.record_slugs(B.resolve_blocks(x.blocks), size=512)


GRAPH = RESOLVED + ", " + REC + """,
sa as (select r.record_slug as source, s.anchor_slug as target from rr r join (select distinct block_text, anchor_slug from rb where block_text <> '' and anchor_slug <> '') s
  on s.block_text = r.block_text and s.anchor_slug <> r.anchor_slug where r.block_text <> ''),
ge as (select 'ancora_normativa' as type_slug, record_slug as source, anchor_slug as target from rr where anchor_slug <> '' union all
 select 'ancora_normativa', sa.source, sa.target from sa join rr r on r.record_slug = sa.source where r.block_text in (select block_text from rb where block_text <> '' and anchor_slug <> '' group by 1 having count(distinct anchor_slug) > 1)
 union all select 'ancora_processual', record_slug, process_slug from rr
 union all select 'relator_de', 'min-'||replace(NK, ' ', '-'), process_slug from (select process_slug, min_by(relator, block_id) as rel from rr group by 1) where rel <> '')""".replace("NK", norm_key("rel"))


@query("gr6_blocks_to_graph_edges", needs=("blocks",), ctes=GRAPH, sql="select type_slug, source, target from ge")
def _(x):
    return G.expand_co_anchors(G.blocks_to_graph(B.resolve_blocks(x.blocks))[1]).select("type_slug", "source", "target")


@query("gr6_shared_text_edges", needs=("blocks",), ctes=RESOLVED + ", " + REC + """,
tk as (select *, md5(block_text)||'-'||length(block_text) as text_key from rb where block_text <> ''),
sv as (select text_key from tk where anchor_slug <> '' group by 1 having count(distinct anchor_slug) > 1)""", sql="""
select 'mesmo_texto' as type_slug, record_slug as source, 'txt-'||text_key as target from rr join tk using (block_id) join sv using (text_key)
union all select distinct 'ancora_normativa', 'txt-'||text_key, tk.anchor_slug from tk join sv using (text_key) where tk.anchor_slug <> ''""")
def _(x):
    """The co-anchors as they are kept: records tied to texts, texts anchored to devices."""
    e = G.blocks_to_graph(B.resolve_blocks(x.blocks))[1].select("type_slug", "source", "target")
    return e.filter((F.col("type_slug") == "mesmo_texto") | F.startswith("source", F.lit("txt-")))


@query("gr1_interval_labels", needs=("edges",), ctes=CLOSE, recursive=True, sql="""
select node, (count(*) filter (where distance > 0))::bigint as descendants, max(depth)::bigint as depth from (
 select ancestor as node, distance, 0 as depth from cl union all select node, 0, distance from cl union all select parent, 0, 0 from lk) group by 1""")
def _(x):
    """Descendants of each node, half the positions inside its interval, and its depth by pointer jumping."""
    links = G.parent_links(x.edges)
    labels = G.interval_labels(links)
    up = G.chain_roots(links.unionByName(links.select(F.col("parent").alias("node")).distinct().join(links.select("node"), "node", "left_anti")
                                         .withColumn("parent", F.lit(None).cast("string"))), "node", "parent")
    return labels.join(up, "node").select("node", F.expr("(leave - enter - 1) div 2").alias("descendants"), F.col("links").cast("long").alias("depth"))


@query("gr6_blocks_to_graph_objects", needs=("blocks",), ctes=RESOLVED + ", " + REC, sql="""
select distinct process_slug as slug, 'processo' as type_slug from rr union all select record_slug, 'registro_jurisprudencial' from rr""")
def _(x):
    return G.blocks_to_graph(B.resolve_blocks(x.blocks))[0].select("slug", "type_slug")


@query("gr7_anchor_degree", needs=("blocks",), ctes=GRAPH + """,
pd as (select distinct p.target as process, d.target as device from ge d join ge p on p.source = d.source and p.type_slug='ancora_processual' where d.type_slug='ancora_normativa')""", sql="""
select 'process' as kind, process as slug, count(*) as degree from pd group by 2 union all select 'device', device, count(*) from pd group by 2""")
def _(x):
    return G.anchor_degree(G.blocks_to_graph(B.resolve_blocks(x.blocks))[1])


# --------------------------------------------------------------------- vectors
@query("vec1_build_chunks", needs=("blocks",), ctes=RESOLVED + """,
ck0 as (select *, try_cast(nullif(regexp_extract(julgamento_data, '^([0-9]+)-([0-9]+)-([0-9]+)$', 3), '') as int) as y, regexp_extract(julgamento_data, '^([0-9]+)-([0-9]+)-([0-9]+)$', 2) as m, regexp_extract(julgamento_data, '^([0-9]+)-([0-9]+)-([0-9]+)$', 1) as d from rb where anchor_slug <> '' and block_text <> ''),
ck1 as (select *, case when y between 1988 and 2026 then y||'-'||lpad(m, 2, '0')||'-'||lpad(d, 2, '0') else '9999-99-99' end as iso from ck0),
ck2 as (select *, (sum(length(block_text) + 1) over (partition by anchor_slug order by iso, block_id) - length(block_text) - 1) // 4000 as ix from ck1)""", sql="""
select anchor_slug||'/'||ix as chunk_slug, anchor_slug, ix as chunk_index, count(*) as units, min(case when iso < '9999' then iso end) as first_date, md5(string_agg(block_text, chr(10) order by iso, block_id)) as hash_chunk,
 ceil(length(string_agg(block_text, chr(10) order by iso, block_id)) / 4.0)::int as token_estimate from ck2 group by 2, 3""")
def _(x):
    return VE.build_chunks(B.judgment_dates(x.blocks), page_chars=4000).select("chunk_slug", "anchor_slug", "chunk_index", "units", "first_date", "hash_chunk", "token_estimate")


def _chunks(x):
    d = x.documents
    chunks = d.select(F.concat(F.lit("c-"), F.col("doc_id").cast("string")).alias("chunk_slug"), F.col("text").alias("chunk_text"), F.ceil(F.length("text") / 4).cast("int").alias("token_estimate"))
    emb = d.filter("doc_id % 3 = 0").select(F.concat(F.lit("c-"), F.col("doc_id").cast("string")).alias("chunk_slug"), F.when(F.col("doc_id") % 2 == 0, "m1").otherwise("m2").alias("embedding_model"))
    return chunks, emb


@query("jn9_pending_chunks", sql="select 'c-'||doc_id as chunk_slug from documents where text <> '' and not (doc_id%3=0 and doc_id%2=0)")
def _(x):
    c, e = _chunks(x)
    return VE.pending_chunks(c, e, "m1").select("chunk_slug")


@query("vec2_embedding_worklist", sql="""
select chunk_slug, piece, md5(substr(text, piece * 24000 + 1, 24000)) as input, ceil(length(substr(text, piece * 24000 + 1, 24000)) / 4.0)::int as token_estimate
from (select 'c-'||doc_id as chunk_slug, text, unnest(range(0, ceil(length(text) / 24000.0)::bigint))::int as piece from documents where text <> '' and not (doc_id%3=0 and doc_id%2=0))""")
def _(x):
    c, e = _chunks(x)
    return VE.embedding_worklist(c, e, "m1").withColumn("input", F.md5("input"))


@query("vec2_accept_vectors", sql="select 'v-'||vec_id as chunk_slug from embeddings where label%2=0 and vec_id%5<>0")
def _(x):
    k = F.concat(F.lit("v-"), F.col("vec_id").cast("string")).alias("chunk_slug")
    v = x.embeddings.select("label", "vec_id", k, F.lit("m1").alias("embedding_model"), F.when(F.col("label") % 2 == 0, F.col("embedding")).otherwise(F.slice("embedding", 1, 10)).alias("vector_ref"))
    return VE.accept_vectors(v.drop("label", "vec_id"), v.filter("vec_id % 5 = 0").drop("label", "vec_id"), 64).select("chunk_slug")


@query("agg29_embedding_budget", sql="select count(*) as chunks, sum(ceil(length(text) / 4.0)::int)::bigint as tokens, round(sum(ceil(length(text) / 4.0)::int)::double / 1000000 * 0.02, 6) as cost from documents")
def _(x):
    return VE.embedding_budget(_chunks(x)[0])


COS = """cs as (select d.vec_id, p.vec_id as plate, round(list_cosine_similarity(d.embedding::double[], p.embedding::double[]), 9) as score from fx_vectors d, fx_plates p),
nr as (select *, row_number() over (partition by vec_id order by score desc, plate) as rank from cs qualify rank <= 5)"""


@query("vec3_nearest_plates", needs=("vectors", "plates"), ctes=COS, sql="select vec_id, plate, round(score, 6) as score, rank from nr")
def _(x):
    return VE.nearest_plates(x.vectors, x.plates).withColumn("score", F.round("score", 6))


@query("vec3_nearest_plates_tiled", needs=("vectors", "plates"), ctes=COS, sql="select vec_id, plate, round(score, 6) as score, rank from nr")
def _(x):
    return VE.nearest_plates(x.vectors, x.plates, tile_bytes=64 * 8 * 20).withColumn("score", F.round("score", 6))


@query("vec3_nearest_plates_pruned", needs=("vectors", "plates"), ctes=COS, sql="select vec_id, plate, round(score, 6) as score, rank from nr")
def _(x):
    """Small tiles, so that there is something to prune."""
    return NE.nearest(x.vectors, x.plates, tile_rows=64).rows.withColumn("score", F.round("score", 6))


@query("vec3_allocate", needs=("vectors", "plates"), ctes=COS, sql="select vec_id, plate, rank from nr where score >= 0.3")
def _(x):
    return VE.allocate(x.vectors, x.plates, tau=0.3)[0].select("vec_id", "plate", "rank")


@query("vec3_queue", needs=("vectors", "plates"), ctes=COS, sql="""
select vec_id, case when vec_id % 7 <> 3 then round(score, 6) end as best_score, case when vec_id % 7 = 3 then 'no vector' else 'below threshold' end as reason
from nr where rank = 1 and (score < 0.3 or vec_id % 7 = 3)""")
def _(x):
    """Every seventh decision has no vector."""
    v = x.vectors.withColumn("embedding", F.when(F.col("vec_id") % 7 != 3, F.col("embedding")))
    return VE.allocate(v, x.plates, tau=0.3)[1].withColumn("best_score", F.round("best_score", 6))


PROBE = [round(((i * 37) % 19 - 9) / 10, 1) for i in range(64)]


@query("vec4_search", sql=f"""
select vec_id, label, round(list_cosine_similarity(embedding::double[], {PROBE}::double[]), 6) as score from embeddings where label in (1, 3, 5)
order by round(list_cosine_similarity(embedding::double[], {PROBE}::double[]), 9) desc, vec_id limit 20""")
def _(x):
    return VE.search(x.embeddings, PROBE, 20, where=F.col("label").isin(1, 3, 5)).select("vec_id", "label", F.round("score", 6).alias("score"))


@query("vec5_text_search", ctes=f"wk as (select doc_id, list_distinct(string_split({WORD}, ' ')) as w from documents)", sql="""
select doc_id, n as matched from (select doc_id, len(list_intersect(w, ['the', 'para', 'que', 'nicht'])) as n from wk) where n > 0""")
def _(x):
    return VE.text_search(x.documents, ["The", "pará", "que", "nicht"], "doc_id", "text")


def _trigrams(src: str) -> str:
    return (f"list_distinct(flatten(list_transform(list_filter(string_split({WORD.replace('text', src)}, ' '), lambda w: w <> ''), "
            "lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  '||w||' ', i, 3)))))")


@query("vec5_trigram_similarity", needs=("names",), sql=f"""
select name_id, round(len(list_intersect(a, b))::double / len(list_distinct(list_concat(a, b))), 6) as similarity
from (select name_id, {_trigrams('name')} as a, {_trigrams('p_name')} as b from fx_names join part on p_partkey = name_id)""")
def _(x):
    p = x.names.join(x.part, F.col("p_partkey") == F.col("name_id"))
    return p.select("name_id", VE.trigram_similarity("name", "p_name").alias("similarity"))


TERMS = ["The", "pará", "que", "nicht", "émentle"]
_TERMS_KEY = "['the', 'para', 'que', 'nicht', 'ementle']"
POSTED = f"""wk as (select doc_id, unnest(list_filter(string_split({WORD}, ' '), lambda w: w <> '')) as term from DOCS),
ps as (select term, doc_id, count(*) as n from wk group by 1, 2)"""


def _index(x) -> SE.TextIndex:
    return SE.TextIndex(x.spark, scratch(x.spark, "index"), "doc_id")


@query("vec5_index_search", ctes=POSTED.replace("DOCS", "documents"), sql=f"""
select doc_id, count(*) as matched, sum(n)::bigint as hits, round(sum((1 + ln(n)) * ln(1 + (select count(*) from documents)::double / df)), 6) as score
from ps join (select term, count(*) as df from ps group by 1) using (term) where list_contains({_TERMS_KEY}, term) group by 1""")
def _(x):
    index = _index(x)
    index.update(x.documents, "text")
    return index.search(TERMS).withColumn("score", F.round("score", 6))


@query("vec5_index_update", ctes="next as (select doc_id, case when doc_id % 5 = 0 then coalesce(text, '')||' emenda nóva' else text end as text from documents where doc_id % 11 <> 3),\n"
       + POSTED.replace("DOCS", "next"), sql="select term, count(*) as documents, sum(n)::bigint as occurrences from ps group by 1")
def _(x):
    """The table changes between two updates: texts grow and documents go."""
    index = _index(x)
    index.update(x.documents, "text")
    text = F.when(F.col("doc_id") % 5 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit(" emenda nóva"))).otherwise(F.col("text"))
    index.update(x.documents.filter("doc_id % 11 <> 3").select("doc_id", text.alias("text")), "text")
    return index.frequencies()


NAME_CLASSES = f"""ts as (select name_id, list_sort({_trigrams('name')}) as tg from fx_names),
nc as (select name_id, tg, min(name_id) over (partition by tg) as class from ts where len(tg) > 0),
nk as (select distinct class, tg from nc)"""


@query("vec5_similar_names", needs=("names",), ctes=NAME_CLASSES, sql="""
select a, b, round(shared / united, 6) as similarity from (select x.class as a, y.class as b, len(list_intersect(x.tg, y.tg))::double as shared,
  len(list_distinct(list_concat(x.tg, y.tg))) as united from nk x join nk y on x.class < y.class) where 10 * shared >= 6 * united""")
def _(x):
    return SE.similar_names(x.names, "name_id", "name", 60)[1]


@query("vec5_name_classes", needs=("names",), ctes=NAME_CLASSES, sql="select name_id, class from nc")
def _(x):
    return SE.similar_names(x.names, "name_id", "name", 60)[0]


MISSPELT = ["tionement", "quepala", "nichtt", "thretion", "éauxmant"]


@query("vec5_similar_terms", ctes=POSTED.replace("DOCS", "documents") + f""",
vt as (select term, {_trigrams('term')} as tg from (select distinct term from ps)),
qt as (select term as query, {_trigrams('term')} as qg from (select unnest({MISSPELT}) as term))""", sql="""
select query, term, round(shared / united, 6) as similarity from (select query, term, len(list_intersect(tg, qg))::double as shared,
  len(list_distinct(list_concat(tg, qg))) as united from vt, qt) where 100 * shared >= 45 * united""")
def _(x):
    return SE.similar_terms(MISSPELT, SE.vocabulary(x.documents, "text"), 45)


@query("vec6_decision_lines", needs=("vectors", "plates"), ctes=COS, sql="""
select vec_id, plate, round(score, 6) as score, rank, (vec_id * 7) % 100 as decided_at, row_number() over (partition by plate order by (vec_id * 7) % 100, vec_id) as line_position, 'cosine' as method from nr""")
def _(x):
    dates = x.vectors.select("vec_id", ((F.col("vec_id") * 7) % 100).alias("decided_at"))
    seg = F.floor(F.col("decided_at") / 10)
    return VE.decision_lines(VE.nearest_plates(x.vectors, x.plates), dates, segment=seg).withColumn("score", F.round("score", 6)).select(
        "vec_id", "plate", "score", "rank", "decided_at", "line_position", "method")


@query("win15_line_positions", sql="select label, vec_id, row_number() over (partition by label order by vec_id) as line_position from embeddings")
def _(x):
    return VE.line_positions(x.embeddings.select("label", "vec_id"), "label", ["vec_id"], F.floor(F.col("vec_id") / 100))


@query("win12_turning_points", ctes="""
tl as (select *, row_number() over (partition by label order by vec_id) as n from embeddings),
td as (select b.label, b.n + 1 as turn, min(x.vec_id) as vec_id, min(1 - list_cosine_similarity(x.embedding::double[], b.embedding::double[])) as dv, count(*) as w
 from tl b join tl x on x.label = b.label and x.n between b.n + 1 and b.n + 3 group by 1, 2)""", sql="select label, vec_id, turn as line_position, round(dv, 6) as least_divergence from td where w = 3 and round(dv, 6) >= 0.4")
def _(x):
    return VE.turning_points(x.embeddings, 0.4, 2)


@query("vec7_similarity_check", needs=("vectors", "plates"), ctes=COS, sql="""
select vec_id, plate, round(score, 6) as score, rank from nr where rank = 1 and vec_id in (select vec_id from fx_vectors order by md5(vec_id||'|5'), vec_id limit 50)""")
def _(x):
    return VE.similarity_check(x.vectors, x.plates, 50, 5).withColumn("score", F.round("score", 6))


# --------------------------------------------------------------------- learning
_M = {"procedencia_rate": "outcome='procedente'", "modulacao_rate": "uses_modulation", "contencao_rate": "fiscal_effect='contencao'", "expansao_rate": "decision_direction='expansiva'"}
_T = {"relator": "relator", "orgao": "decision_body", "relator_orgao": "relator||'/'||decision_body", "relator_environment": "relator||'/'||adjudication_environment",
      "orgao_environment": "decision_body||'/'||adjudication_environment"}


def profiles_sql(period: str) -> str:
    kinds = " union all ".join(
        f"select '{k}' as profile_type, {t} as target_slug, date_trunc('{period}', occurred_at)::date as period_start, count(*) as sample_size, "
        + ", ".join(f"round(count(*) filter (where {c})::double / count(*), 6) as {r}" for r, c in _M.items()) + f" from lj where {t} is not null group by 2, 3" for k, t in _T.items())
    return JUDGMENTS + f""",
lj as (select j.*, r.relator from jg j left join (select target_id, min(source_id) as relator from fx_edges where type_slug='relator_de' and valid_to is null group by 1) r on r.target_id = j.aggregate_id),
pf as ({kinds}), df as (select *, {', '.join(f"round({r} - lag({r}) over w, 6) as {r}_drift" for r in _M)} from pf window w as (partition by profile_type, target_slug order by period_start))"""


RCOLS = ", ".join(_M)


@query("lrn1_learn_profiles", needs=("log", "edges"), ctes=profiles_sql("month"), sql=f"""
select md5(profile_type||'|'||target_slug||'|'||period_start) as profile_id, profile_type, target_slug, strftime(period_start, '%Y-%m-%d') as period_start, strftime(last_day(period_start), '%Y-%m-%d') as period_end, sample_size, {RCOLS}, 'proposed' as status from pf""")
def _(x):
    return LN.learn_profiles(x.log, x.edges)


@query("lrn1_learn_profiles_week", needs=("log", "edges"), ctes=profiles_sql("week"), sql=f"""
select profile_type, target_slug, strftime(period_start, '%Y-%m-%d') as period_start, strftime(period_start + interval 6 days, '%Y-%m-%d') as period_end, sample_size, {RCOLS} from pf""")
def _(x):
    return LN.learn_profiles(x.log, x.edges, "week").select("profile_type", "target_slug", "period_start", "period_end", "sample_size", *_M)


_X = {r: f"cast({r} as decimal(10,6)) * sample_size" for r in _M}
_OWN = {r: f"(sum({x}) over own / sum(sample_size) over own)" for r, x in _X.items()}
_PLAIN = {r: f"(sum({r}_all) over kind / sum(n_all) over kind)" for r in _M}
BACK = profiles_sql("week") + f""",
kd0 as (select profile_type, period_start, sum(sample_size) as n_all, {', '.join(f'sum({x}) as {r}_all' for r, x in _X.items())} from pf group by 1, 2),
kd as (select profile_type, period_start, {', '.join(f'{p}::double as {r}_plain' for r, p in _PLAIN.items())} from kd0
 window kind as (partition by profile_type order by period_start rows between unbounded preceding and 1 preceding)),
bo as (select *, coalesce(sum(sample_size) over own, 0) + sample_size as seen, {', '.join(f'{o}::double as {r}_own' for r, o in _OWN.items())} from pf
 window own as (partition by profile_type, target_slug order by period_start rows between unbounded preceding and 1 preceding)),
bt as (select *, ({' + '.join(f'abs({r} - {r}_own)' for r in _M)}) / {len(_M)} as e_own, ({' + '.join(f'abs({r} - {r}_plain)' for r in _M)}) / {len(_M)} as e_plain
 from bo join kd using (profile_type, period_start))"""


@query("lrn1_back_test", needs=("log", "edges"), ctes=BACK, sql=f"""
select profile_type, target_slug, strftime(period_start, '%Y-%m-%d') as period_start, sample_size,
 '{{' || {" || ',' || ".join(f"""'"{r}":' || cast({r} as decimal(10,6))::varchar""" for r in _M)} || '}}' as profile_payload,
 round(seen::double / (seen + {LN.HALF_TRUST}) + 1e-9, 4) as confidence_score, round(1 - e_own + 1e-9, 4) as stability_score, round(e_plain - e_own + 1e-9, 4) as predictive_gain from bt""")
def _(x):
    p = LN.with_payload(LN.back_test(LN.learn_profiles(x.log, x.edges, "week")))
    scores = [F.round(F.col(c) + 1e-9, 4).alias(c) for c in ("confidence_score", "stability_score", "predictive_gain")]  # no ties at the last digit
    return p.select("profile_type", "target_slug", "period_start", "sample_size", "profile_payload", *scores)


@query("win13_profile_drift", needs=("log", "edges"), ctes=profiles_sql("week"), sql=f"select profile_type, target_slug, strftime(period_start, '%Y-%m-%d') as period_start, {', '.join(r + '_drift' for r in _M)} from df")
def _(x):
    return LN.profile_drift(LN.learn_profiles(x.log, x.edges, "week")).select("profile_type", "target_slug", "period_start", *[f"{r}_drift" for r in _M])


PROPS = profiles_sql("week") + ", mv as (" + " union all ".join(f"select profile_type, target_slug, sample_size, '{r}' as measure, {r}_drift as move from df where {r}_drift is not null" for r in _M) + """),
pg as (select profile_type, target_slug, measure, count(*) as periods, count(*) filter (where move >= 0.05) as up, count(*) filter (where move <= -0.05) as down, avg(abs(move)) as gain, avg((sample_size > 1)::int::double) as fit from mv group by 1, 2, 3),
pr as (select md5(profile_type||'|'||target_slug||'|'||measure) as proposal_id, case profile_type when 'relator' then 'new_relator_pattern' when 'orgao' then 'new_body_pattern' when 'relator_orgao' then 'new_decision_pattern' else 'new_environment_pattern' end as proposal_type,
 target_slug||' '||measure||' '||case when up >= down then 'up' else 'down' end as description, greatest(up, down) as recurrence_count, round(greatest(up, down)::double / periods, 6) as stability_score,
 round(gain, 6) as predictive_gain, round(fit, 6) as compatibility_score from pg where greatest(up, down) > 0)"""


def _props(x):
    return LN.propose(LN.profile_drift(LN.learn_profiles(x.log, x.edges, "week")))


@query("lrn2_propose", needs=("log", "edges"), ctes=PROPS, sql="select proposal_id, proposal_type, description, recurrence_count, round(stability_score, 4) as stability_score, round(compatibility_score, 4) as compatibility_score from pr")
def _(x):
    return _props(x).select("proposal_id", "proposal_type", "description", "recurrence_count", F.round("stability_score", 4).alias("stability_score"), F.round("compatibility_score", 4).alias("compatibility_score"))


@query("lrn2_lrn3_emerging_patterns", needs=("log", "edges"), ctes=PROPS, sql="""
select proposal_id as pattern_id, proposal_type as pattern_type, description, recurrence_count as recurrence,
 case when recurrence_count >= 2 and stability_score >= 0.5 and predictive_gain >= 0.05 and compatibility_score >= 0.5 then 'validated' else 'rejected' end as status from pr""")
def _(x):
    return LN.emerging_patterns(LN.membrane(_props(x))).drop("stability", "predictive_gain")


@query("lrn4_supersede", needs=("log", "edges"), ctes=profiles_sql("week"), sql="""
select profile_type, target_slug, strftime(period_start, '%Y-%m-%d') as period_start, case when period_start < max(period_start) over (partition by profile_type, target_slug) then 'superseded' else 'proposed' end as status from pf""")
def _(x):
    return LN.supersede(LN.learn_profiles(x.log, x.edges, "week")).select("profile_type", "target_slug", "period_start", "status")


# --------------------------------------------------------------------- streaming
def _shared(spark) -> str:
    cut(spark.range(1))  # makes sure a shared checkpoint folder is set
    return f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"


def _streamed(x, name: str):
    """The corpus with one table read as a stream; a table is a file or a folder of files."""
    stream = Corpus(x.spark, x.dir)
    # as a pattern, the path may name a file
    stream._cache[name] = x.spark.readStream.schema(x.table(name).schema).parquet(f"{x.dir}/{name}.parque[t]")
    return stream


@query("str2_current_state_stream", needs=("log",), sql="""
select aggregate_id, event_id, json_extract_string(payload,'$.to_state') as to_state, strftime(occurred_at, '%Y-%m-%d %H:%M:%S') as occurred_at from fx_log
where list_contains(json_keys(payload), 'to_state') qualify row_number() over (partition by aggregate_id order by occurred_at desc, event_id) = 1""")
def _(x):
    stream = _streamed(x, "events")
    base = _shared(x.spark)
    q = ST.current_state_stream(stream.log, f"{base}/state", f"{base}/progress")
    q.awaitTermination()
    return ST.read_current_state(x.spark, f"{base}/state")


@query("str3_worklist_stream", sql="select 'c-'||doc_id as chunk_slug, ceil(length(text) / 4.0)::int as token_estimate from documents where text <> '' and not (doc_id%3=0 and doc_id%2=0)")
def _(x):
    stream = _streamed(x, "documents")
    base = _shared(x.spark)
    _chunks(x)[1].write.parquet(f"{base}/emb")
    ST.worklist_stream(_chunks(stream)[0], f"{base}/emb", "m1", f"{base}/work", f"{base}/progress").awaitTermination()
    return x.spark.read.parquet(f"{base}/work/batch=*").select("chunk_slug", "token_estimate")


@query("str2_state_changes", needs=("log",), sql="""
select aggregate_id, event_id, json_extract_string(payload,'$.to_state') as to_state, strftime(occurred_at, '%Y-%m-%d %H:%M:%S') as occurred_at from fx_log
where list_contains(json_keys(payload), 'to_state') qualify row_number() over (partition by aggregate_id order by occurred_at desc, event_id) = 1""")
def _(x):
    """Transitions from a stateful stream over the whole log; the last of each aggregate is its state."""
    stream = _streamed(x, "events")
    base = _shared(x.spark)
    CH.state_change_stream(stream.log, f"{base}/changes", f"{base}/progress").awaitTermination()
    return CH.read_newest(x.spark, f"{base}/changes").select(
        F.col("key").alias("aggregate_id"), F.col("tie").alias("event_id"), F.col("value").alias("to_state"), F.timestamp_micros("at").alias("occurred_at"))


@query("str1_poll_changes", needs=("log",), sql="""
select aggregate_id, case when type_slug <> 'distribuicao' then md5(payload) end as content_hash from fx_log
where occurred_at is not null qualify row_number() over (partition by aggregate_id order by occurred_at desc, event_id) = 1""")
def _(x):
    """Every event is a look at its aggregate (gone, where it is a distribution); afternoons come first, the stream stops, and mornings come late."""
    base = _shared(x.spark)
    rows = CH.observations(x.log, "aggregate_id", "occurred_at", "event_id", F.when(F.col("type_slug") != "distribuicao", F.md5("payload")))
    for half in (1, 0):
        rows.filter(F.col("at") / 43_200_000_000 % 2 >= 1 if half else F.col("at") / 43_200_000_000 % 2 < 1).write.mode("append").parquet(f"{base}/polls")
        polls = x.spark.readStream.schema(CH.ROWS).parquet(f"{base}/polls")
        CH.poll_stream(polls, f"{base}/changes", f"{base}/progress").awaitTermination()
    return CH.read_newest(x.spark, f"{base}/changes").select(F.col("key").alias("aggregate_id"), F.col("value").alias("content_hash"))
