"""Decision blocks: resolution, anchors, consensus, recoding and the block reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lexanchor import vocab as V
from lexanchor.functions import metadata as M, text as T
from lexanchor.operators.keyed import compute_once, first_per_key, position_segment, segmented_scan


def filled(c) -> Column:
    """Neither NULL nor ''."""
    return F.coalesce(T.col(c), F.lit("")) != ""


def ranked(c, table: dict[str, int], default: int) -> Column:
    out = None
    for k, v in table.items():
        out = F.when(T.col(c) == k, v) if out is None else out.when(T.col(c) == k, v)
    return out.otherwise(default)


def unit_rank(c="decision_unit_type") -> Column:
    return ranked(c, V.UNIT_RANK, V.UNIT_RANK_DEFAULT)


def marker_rank(c="editorial_marker") -> Column:
    return ranked(F.coalesce(T.col(c), F.lit("")), V.MARKER_RANK, V.MARKER_RANK_DEFAULT)


# ----------------------------------------------------------------- resolution
def _opening(c: str, size: int | None) -> Column:
    """The whole text, or its first ``size`` characters."""
    text = F.coalesce(F.col(c), F.lit(""))
    return text if size is None else F.substring(text, 1, size)


def resolve_blocks(b: DataFrame, text_head: int | None = None) -> DataFrame:
    """Decision blocks with case metadata, key, unit kind, signature and hash.

    Metadata comes from the metadata text; when that names no rapporteur, from the block
    (its first ``text_head`` characters, if given). Values already on the row fill gaps.
    """
    head = _opening("block_text", text_head)
    x = compute_once(b, {"__m": M.extract_meta("metadata_text")})
    x = compute_once(x, {"__t": F.when(F.col("__m.relator") == "", M.extract_meta(head))})
    x = x.withColumn("__x", F.when(F.col("__m.relator") != "", F.col("__m")).otherwise(F.col("__t")))
    x = x.withColumns({
        "process_class": F.coalesce(T.first_nonempty("__x.process_class", "process_class"), F.lit("")),
        "process_number": F.coalesce(T.first_nonempty("__x.process_number", "process_number"), F.lit("")),
        **{f: F.col(f"__x.{f}") for f in M.FIELDS[2:]},
    }).drop("__m", "__t", "__x")
    return x.withColumns({
        "process_key": T.process_key("process_class", "process_number"),
        "decision_unit_type": M.unit_type("editorial_marker", "metadata_text", "process_class", "tema_rg"),
        "block_hash": T.block_hash_md5("anchor_slug", "editorial_marker", "block_text", "metadata_text"),
        "namespace": F.when(F.col("anchor_slug").startswith("adct"), "adct").otherwise("cf"),
        "context_relation": F.col("editorial_marker"), "editorial_label": T.marker_label("editorial_marker"),
        "raw_signature": T.raw_signature("process_class", "process_number", "relator"),
    })


def judgment_dates(b: DataFrame, text_head: int | None = None) -> DataFrame:
    """The blocks with their ``julgamento_data`` as ``resolve_blocks`` finds it, without the costlier fields."""
    meta, head = F.coalesce(F.col("metadata_text"), F.lit("")), _opening("block_text", text_head)
    named = M.rapporteur_of(meta) != ""
    return compute_once(b, {"julgamento_data": M.judged_on(F.when(named, meta).otherwise(head))})


def resolve_blocks_strict(b: DataFrame) -> DataFrame:
    """Variant that reads text and metadata together and lets row values win."""
    x = compute_once(b, {"__m": M.extract_meta_strict(F.trim(F.concat_ws("\n", "block_text", "metadata_text")))})
    x = x.withColumns({
        f: F.coalesce(T.first_nonempty(f, F.col(f"__m.{f}")), F.lit("")) if f in b.columns else F.col(f"__m.{f}")
        for f in ["process_class", "process_number", "relator", "julgamento_data", "dje_data", "tema_rg", "sumula_num"]
    }).drop("__m")
    x = x.withColumns({
        "process_key": T.process_key_with_sumula("process_class", "process_number", "sumula_num"),
        "decision_unit_type": M.unit_type_main("editorial_marker", "editorial_label", "metadata_text", "process_class", "tema_rg", "sumula_num"),
    })
    return x.withColumn("block_hash", T.block_hash_sha(
        "anchor_slug", "editorial_marker", "editorial_label", "block_text", "metadata_text", "process_key", "relator", "julgamento_data"))


def fill_missing_meta(b: DataFrame, text_head: int | None = None) -> DataFrame:
    """Reads class, number, rapporteur and theme again where the class is missing and there is text."""
    source = F.concat(F.coalesce("metadata_text", F.lit("")), F.lit(" "), _opening("block_text", text_head))
    x = compute_once(b, {"__m": F.when(~filled("process_class") & filled("block_text"), M.extract_meta(source))})
    rel = F.when(F.length("__m.relator") > 30, F.trim(F.regexp_extract("__m.relator", V.P_NAME_HEAD, 1))).otherwise(F.col("__m.relator"))
    x = x.withColumn("__rel", rel)
    hit = filled("__m.process_class") | filled("__rel")

    def put(new, old):
        return F.when(hit, new).otherwise(F.col(old))

    return x.withColumns({
        "process_class": put(F.col("__m.process_class"), "process_class"), "process_number": put(F.col("__m.process_number"), "process_number"),
        "relator": put(F.coalesce(T.first_nonempty("relator", "__rel"), F.lit("")), "relator"),
        "tema_rg": put(F.coalesce(T.first_nonempty("tema_rg", "__m.tema_rg"), F.lit("")), "tema_rg"), "__hit": F.coalesce(hit, F.lit(False)),
    }).withColumn("process_key", F.when(
        F.col("__hit"), F.when(filled("process_class") & filled("process_number"), F.concat_ws("_", "process_class", "process_number"))
    ).otherwise(F.col("process_key"))).drop("__m", "__rel", "__hit")


def correct_metadata(b: DataFrame, rules: dict[int, str] | None = None) -> DataFrame:
    """Moves the listed articles to another anchor (default: article 233 belongs to the transitional act)."""
    rules = rules or {233: "adct"}
    art = T.parse_slug("anchor_slug")["article"]
    moved = ranked(art.cast("string"), {str(k): v for k, v in rules.items()}, None)  # type: ignore[arg-type]
    return b.withColumn("anchor_slug", F.when(F.col("anchor_slug").startswith("cf"), F.coalesce(moved, F.col("anchor_slug"))).otherwise(F.col("anchor_slug")))


# -------------------------------------------------------------------- anchors
def agrees(a, b, segment_aware: bool = True) -> Column:
    """One slug equals or extends the other; by whole segments unless told otherwise."""
    a, b = T.col(a), T.col(b)
    if not segment_aware:
        return a.startswith(b) | b.startswith(a)
    return (a == b) | F.startswith(a, F.concat(b, F.lit("-"))) | F.startswith(b, F.concat(a, F.lit("-")))


def unify_anchors(resolved: DataFrame, parser: DataFrame, matcher: DataFrame, segment_aware: bool = True) -> DataFrame:
    """Consensus of the position anchor and the text anchor of each block, with source and confidence."""
    p = parser.select("block_id", T.lower_slug("anchor_slug").alias("parser_slug"))
    m = matcher.select(
        "block_id", T.lower_slug("anchor_slug").alias("matcher_slug"), F.col("anchor_quality").alias("__q"),
        F.coalesce(F.col("anchor_confidence").try_cast("double"), F.lit(0.95)).alias("__c"))
    x = resolved.join(p, "block_id", "left").join(m, "block_id", "left").fillna("", ["parser_slug", "matcher_slug", "__q"])
    both = filled("parser_slug") & filled("matcher_slug")
    same = agrees("matcher_slug", "parser_slug", segment_aware)
    text = filled("matcher_slug") & (F.col("__q") != "unresolved")
    x = x.withColumn("anchor_source", F.when(both & same, "hybrid").when(both, "position").when(text, "text")
                     .when(filled("parser_slug"), "position").otherwise("unresolved"))
    longer = F.when(F.length("matcher_slug") >= F.length("parser_slug"), F.col("matcher_slug")).otherwise(F.col("parser_slug"))
    src = F.col("anchor_source")
    return x.withColumns({
        "anchor_slug_final": F.when(src == "hybrid", longer).when(src == "text", F.col("matcher_slug"))
        .when(src == "position", F.col("parser_slug")).otherwise(""),
        "anchor_confidence_final": F.round(F.when(src == "hybrid", 1.0).when(both, 0.85).when(src == "text", F.col("__c"))
                                           .when(src == "position", 0.87).otherwise(0.0), 3),
    }).drop("__q", "__c")


def recode_quality(b: DataFrame) -> DataFrame:
    """Recoded quality, resolution status and explicitness of each anchor."""
    slug = F.trim(F.coalesce("anchor_slug", F.lit("")))
    q, s = (F.lower(F.trim(F.coalesce(c, F.lit("")))) for c in ("anchor_quality", "anchor_source"))
    code = (
        F.when(slug == "", "unresolved").when(q.isin("exact", "adct"), q)
        .when((q == "unresolved") & s.isin("hybrid", "text"), "exact").otherwise("contextual")
    )
    x = b.withColumn("anchor_quality_recode", code)
    return x.withColumns({
        "anchor_resolution_status": F.when(F.col("anchor_quality_recode") == "unresolved", "unresolved").otherwise("resolved"),
        "decision_explicitness": F.when(s == "text", "explicit").when(s == "hybrid", "hybrid").when(s == "position", "implicit").otherwise(""),
    })


def anchor_tier(b: DataFrame) -> DataFrame:
    """Quality tier of an anchor; article-only anchors without an exact source are generic."""
    depth = T.parse_slug("anchor_slug")["depth"]
    q = F.col("anchor_quality_recode")
    return b.withColumn("anchor_tier", F.when(~filled("anchor_slug"), "generica_nao_resolvida")
                        .when(q == "exact", "exata").when((depth == "artigo") & (q == "contextual"), "generica_nao_resolvida")
                        .when(q == "contextual", "contextual").otherwise("inferida"))


def reanchor_queue(b: DataFrame) -> DataFrame:
    return anchor_tier(b).filter(F.col("anchor_tier") == "generica_nao_resolvida")


def with_text_key(b: DataFrame) -> DataFrame:
    """Adds a key that is equal for equal texts and '' without text, unless it is there."""
    if "text_key" in b.columns:
        return b
    key = F.when(filled("block_text"), F.concat_ws("-", F.md5("block_text"), F.length("block_text"))).otherwise("")
    return b.withColumn("text_key", key)


def anchor_factors(b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The co-anchor relation in factors: (text_key, anchor_slug, n) of texts with several slugs, and their blocks.

    Blocks meet the slugs of their text through its key, so that a text with many blocks and
    many slugs has as many rows as it has blocks and slugs, not their product. ``n`` counts the
    blocks of a text under a slug, an empty slug included.
    """
    x = with_text_key(b).filter(filled("text_key")).withColumn("anchor_slug", F.coalesce("anchor_slug", F.lit("")))
    pairs = x.groupBy("text_key", "anchor_slug").agg(F.count("*").alias("n"))
    several = pairs.filter(filled("anchor_slug")).groupBy("text_key").agg(F.count("*").alias("slugs")).filter("slugs > 1")
    members = x.join(several.select("text_key"), "text_key", "left_semi")
    return pairs.join(several, "text_key"), members.select("block_id", "text_key", "anchor_slug", "anchor_confidence", "anchor_source")


def co_anchors(b: DataFrame) -> DataFrame:
    """Secondary anchors: for each block, the other slugs of its text. Expands the factors; only on demand."""
    pairs, members = anchor_factors(b)
    slugs = pairs.filter(filled("anchor_slug")).select("text_key", F.col("anchor_slug").alias("other"))
    return members.join(slugs, "text_key").filter(F.col("other") != F.col("anchor_slug")).select(
        "block_id", F.col("other").alias("anchor_slug"), F.lit("secondary").alias("anchor_role"),
        F.col("anchor_confidence").alias("confidence"), F.col("anchor_source").alias("source"))


def block_anchors(b: DataFrame) -> DataFrame:
    """Primary anchors and co-anchors in one table."""
    primary = b.filter(filled("anchor_slug")).select(
        "block_id", "anchor_slug", F.lit("primary").alias("anchor_role"), F.col("anchor_confidence").alias("confidence"),
        F.col("anchor_source").alias("source"))
    return primary.unionByName(co_anchors(b))


# --------------------------------------------------------------- joins on blocks
def attach_decisions(devices: DataFrame, b: DataFrame) -> DataFrame:
    """Device spine with its decisions; a device without any gets one placeholder row.

    ``devices``: device_slug, label, namespace, normative_text.
    """
    keyed = b.withColumn("device_slug", F.regexp_extract("anchor_slug", r"^((?:cf-1988|adct)-art-\d+)", 1))
    x = devices.join(keyed.drop("namespace", "label"), "device_slug", "left")
    bare = F.col("block_id").isNull()
    place = F.substring(F.md5(F.concat(F.col("device_slug"), F.lit("|normativo|"), F.col("normative_text"))), 1, 16)
    return x.select(
        "device_slug", "label", "namespace", "block_id", F.when(bare, F.col("device_slug")).otherwise(F.col("anchor_slug")).alias("anchor_slug"),
        F.when(bare, "dispositivo_normativo").otherwise(F.col("decision_unit_type")).alias("decision_unit_type"),
        F.when(bare, "normativo").otherwise(F.col("anchor_quality")).alias("anchor_quality"),
        F.when(bare, "planalto").otherwise(F.col("anchor_source")).alias("anchor_source"),
        F.when(bare, 1.0).otherwise(F.col("anchor_confidence")).alias("anchor_confidence"),
        F.when(bare, place).otherwise(F.col("block_hash")).alias("block_hash"),
        F.coalesce("block_text", F.lit("")).alias("block_text"), "normative_text")


def enrich(df: DataFrame, meta: DataFrame, on: str, cols: Sequence[str]) -> DataFrame:
    """Non-empty values of ``meta`` replace the values of ``df``; the rest stays."""
    new = meta.select(on, *[F.col(c).alias(f"__{c}") for c in cols])
    x = df.join(new, on, "left")
    keep = [
        (T.first_nonempty(f"__{c}", F.col(c)) if c in df.columns else F.nullif(F.col(f"__{c}"), F.lit(""))) for c in cols
    ]
    put = {c: (F.coalesce(k, F.col(c)) if c in df.columns else k) for c, k in zip(cols, keep)}
    return x.withColumns(put).drop(*[f"__{c}" for c in cols])


def recover(df: DataFrame, backup: DataFrame, key: str, col: str) -> DataFrame:
    """Missing values of one column taken from a second source."""
    b = backup.select(key, F.col(col).alias("__b")).filter(filled("__b"))
    return df.join(b, key, "left").withColumn(col, T.first_nonempty(col, "__b")).drop("__b")


def recover_text(b: DataFrame, source: DataFrame, key: str = "com_id") -> DataFrame:
    """Empty block texts taken from the source by id, editorial prefix and trailing metadata split off."""
    s = compute_once(source, {"__p": T.split_metadata(T.strip_prefix("text"))}).select(
        key, F.col("__p.text").alias("__text"), F.col("__p.meta").alias("__meta"))
    x = b.join(s, key, "left")
    take = ~filled("block_text") & filled("__text")
    return x.withColumns({
        "metadata_text": F.when(take, F.coalesce(T.first_nonempty("metadata_text", "__meta"), F.lit(""))).otherwise(F.col("metadata_text")),
        "block_text": F.when(take, F.col("__text")).otherwise(F.col("block_text")),
    }).drop("__text", "__meta")


def anchored_decisions(e: DataFrame, o: DataFrame, meta: DataFrame) -> DataFrame:
    """Decision records per device with their confirmed metadata; missing text is ''."""
    rec = o.filter(F.col("type_slug") == "registro_jurisprudencial").select(
        F.col("id").alias("source_id"), F.col("slug").alias("decisao_slug"), F.from_json(
            "payload", "rotulo_final string, tipo_decisorio string, camada_editorial string, conteudo string, stf_com_id string, ordem_editorial string").alias("p"))
    dev = o.select(F.col("id").alias("target_id"), F.col("slug").alias("dispositivo"))
    links = e.filter(F.col("type_slug") == "ancora_normativa").select("source_id", "target_id")
    x = links.join(rec, "source_id").join(dev, "target_id").withColumn("com_id", F.col("p.stf_com_id").try_cast("bigint"))
    x = x.join(meta, "com_id", "left")

    def text(*cols):
        return F.coalesce(T.first_nonempty(*cols), F.lit(""))

    return x.select(
        "dispositivo", "decisao_slug", *[text(c).alias(c) for c in ("classe", "numero", "relator", "data_julgamento", "turma")],
        F.coalesce(F.nullif("referencia", F.lit("")), F.col("p.rotulo_final"), F.lit("")).alias("referencia"),
        text("p.tipo_decisorio").alias("tipo"), text("p.camada_editorial").alias("camada"), F.col("p.conteudo").alias("conteudo"),
        F.col("p.ordem_editorial").try_cast("int").alias("ordem"))


# --------------------------------------------------------------------- reports
def counts(b: DataFrame, *keys: str, required: Sequence[str] = ()) -> DataFrame:
    for c in required:
        b = b.filter(filled(c))
    return b.groupBy(*keys).agg(F.count("*").alias("n"))


def relator_anchor_distribution(b):
    return counts(b, "relator", "anchor_slug", "decision_unit_type", required=["relator"])


def anchor_distribution(b):
    return counts(b, "anchor_slug", "decision_unit_type", required=["anchor_slug"])


def process_occurrence_network(b):
    return counts(b, "process_key", "anchor_slug", "editorial_marker", required=["process_key"])


def relator_process_network(b):
    return counts(b, "relator", "process_key", "anchor_slug", required=["relator", "process_key"])


def distribution(df: DataFrame, *cols: str, digits: int = 2) -> DataFrame:
    """Rows per value with the percent of the total."""
    g = df.groupBy(*cols).agg(F.count("*").alias("blocks"))
    total = g.agg(F.sum("blocks")).scalar()
    return g.withColumn("pct", F.round(F.col("blocks") * 100.0 / total, digits).cast("double"))


def anchor_source_by_relator(b):
    return b.filter(filled("relator")).groupBy("relator", "anchor_source").agg(F.count("*").alias("blocks")).orderBy(
        "relator", F.desc("blocks"), "anchor_source")


def relator_anchor_unified(b):
    return b.filter(filled("relator") & filled("anchor_slug_final")).groupBy(
        "relator", "anchor_slug_final", "decision_unit_type", "anchor_source").agg(
        F.count("*").alias("blocks"), F.count_distinct("process_key").alias("distinct_procs"),
        F.round(F.avg(F.col("anchor_confidence_final").cast("decimal(5,3)")), 3).cast("double").alias("avg_confidence"))


def process_network_unified(b):
    """Blocks and distinct anchors per process; anchors are made distinct before they are listed."""
    keys = ["process_key", "process_class", "relator", "anchor_source"]
    per = b.filter(filled("process_key")).groupBy(*keys, "anchor_slug_final").agg(F.count("*").alias("n"))
    return per.groupBy(*keys).agg(
        F.sum("n").alias("blocks"), F.count("anchor_slug_final").alias("distinct_anchors"),
        F.array_join(F.array_sort(F.collect_list("anchor_slug_final")), ",").alias("anchor_slugs"))


def block_anchor_summary(b: DataFrame) -> DataFrame:
    """Anchors, blocks and slugs of either role, counted on the factors."""
    pairs, members = anchor_factors(b)
    role = lambda name: F.lit(name).alias("anchor_role")
    main = b.filter(filled("anchor_slug")).agg(F.count("*").alias("total"), F.count_distinct("block_id").alias("unique_blocks"), F.count_distinct("anchor_slug").alias("unique_slugs"))
    # a block has all slugs of its text but its own, and each slug is another one for some block
    others = F.col("slugs") - filled("anchor_slug").cast("int")
    more = pairs.agg(F.sum(F.col("n") * others).alias("total"), F.count_distinct(F.when(filled("anchor_slug"), F.col("anchor_slug"))).alias("unique_slugs"))
    seen = members.agg(F.count_distinct("block_id").alias("unique_blocks"))
    parts = main.select(role("primary"), "*").unionByName(more.select(role("secondary"), "*"), allowMissingColumns=True).unionByName(
        seen.select(role("secondary"), "*"), allowMissingColumns=True)  # three rows
    out = parts.groupBy("anchor_role").agg(*[F.max(c).alias(c) for c in ("total", "unique_blocks", "unique_slugs")])
    return out.filter("total > 0")


def field_coverage(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-empty count and percent per field, from one aggregation."""
    one = df.agg(F.count("*").alias("total"), *[F.count_if(filled(F.col(c).cast("string"))).alias(f"f_{c}") for c in cols])
    stack = ", ".join(f"'{c}', f_{c}" for c in cols)
    return one.selectExpr("total", f"stack({len(cols)}, {stack}) as (field, filled)").withColumn(
        "pct", F.round(F.col("filled") * 100.0 / F.nullif("total", F.lit(0)), 1).cast("double"))


def confidence_stats(b: DataFrame, key: str = "anchor_source", value: str = "anchor_confidence") -> DataFrame:
    """Average, least and greatest confidence per group and overall (group NULL)."""
    return b.rollup(key).agg(
        F.grouping(key).cast("int").alias("overall"), F.count(value).alias("n"), F.round(F.avg(value), 3).alias("avg_confidence"),
        F.min(value).alias("min_confidence"), F.max(value).alias("max_confidence"))


def branches_per_article(b):
    return b.withColumn("article", T.parse_slug("anchor_slug")["article"]).filter(F.col("article").isNotNull()).groupBy("article").agg(
        F.count_distinct("anchor_slug").alias("branches"), F.count("*").alias("blocks"))


def editorial_counts(b):
    return b.withColumn("article", T.parse_slug("anchor_slug")["article"]).groupBy("article", "editorial_marker").agg(F.count("*").alias("n"))


def editorial_pivot(b, markers: Sequence[str] = ("sumula_vinculante", "sumula", "controle_concentrado", "repercussao_geral", "julgados_correlatos")):
    return b.withColumn("article", T.parse_slug("anchor_slug")["article"]).groupBy("article").pivot("editorial_marker", list(markers)).agg(
        F.count(F.lit(1))).na.fill(0, list(markers))


def subdevice_counts(b):
    slugs = b.groupBy("anchor_slug").agg(F.count("*").alias("n")).filter(F.col("anchor_slug").startswith("cf-1988-art-"))
    s = F.col("anchor_slug")
    return slugs.withColumn("article", T.article_of("anchor_slug")).groupBy("article").agg(
        F.sum("n").alias("total_blocks"), *[F.count_if(s.contains(f"-{t}-")).alias(t) for t in ("inc", "par", "ali")])


def text_volume(b):
    return b.agg(F.count("*").alias("total"), F.sum(F.length("block_text")).alias("total_chars"), F.count_if(~filled("block_text")).alias("empty_blocks"))


def audit_rows(b: DataFrame, preview: int = 120) -> DataFrame:
    """Audit columns with text length and a short preview."""
    return b.select(
        "block_id", "anchor_slug", "decision_unit_type", "editorial_marker", "process_key", "relator", "namespace",
        F.length("block_text").alias("text_len"), F.substring("block_text", 1, preview).alias("preview"))


def editorial_order(b):
    """Blocks in display order: slug, editorial rank, block id."""
    return b.withColumn("rank", unit_rank()).orderBy("anchor_slug", "rank", "block_id")


def ordered_anchors(view: DataFrame) -> DataFrame:
    return view.orderBy("dispositivo", "ordem", "decisao_slug")


def top_groups(df: DataFrame, col: str, k: int) -> DataFrame:
    return df.filter(filled(F.col(col).cast("string"))).groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col).limit(k)


def _draw(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))


def sample_n(df: DataFrame, n: int, seed: int, key: str = "block_id") -> DataFrame:
    """Repeatable random sample: the n lowest hashes of the id."""
    return df.orderBy(_draw(key, seed), key).limit(n)


def stratified_sample(df: DataFrame, by: str, n: int, seed: int, key: str = "block_id") -> DataFrame:
    return first_per_key(df, [by], [_draw(key, seed).asc(), F.col(key).asc()], n)


def renumber(df: DataFrame, order: Sequence[str], segment: Column, name: str = "row_id") -> DataFrame:
    """Consecutive numbers in a total order, counted per order segment with prefix sums over the segments."""
    return segmented_scan(df, [], order, segment, counts={name: F.lit(True)})


def blocks_by_slug(b: DataFrame, page_size: int = 2000, segment_size: int = 4096) -> DataFrame:
    """Blocks of each slug as arrays of at most ``page_size`` structs, in block order; a busy slug has several pages."""
    b = b.fillna("", ["anchor_slug"])
    x = segmented_scan(b, ["anchor_slug"], ["block_id"], position_segment("block_id", segment_size), counts={"__i": F.lit(True)})
    x = x.withColumn("page", F.floor((F.col("__i") - 1) / page_size).cast("int"))
    item = F.struct("block_id", "decision_unit_type", "editorial_marker", "process_key", "relator", "block_text")
    return x.groupBy("anchor_slug", "page").agg(F.array_sort(F.collect_list(item)).alias("blocks"))


def mirror(nodes: DataFrame, b: DataFrame) -> DataFrame:
    """Norm rows in tree order, each followed by its blocks in editorial order, with a row where the marker changes.

    ``nodes``: node_order, node_slug, label. Blocks join their exact node.
    """
    n = nodes.select("node_order", "node_slug", F.lit(0).alias("kind"), F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("block_id"),
                     F.col("label").alias("content"), F.lit(None).cast("string").alias("marker"))
    blk = b.select(F.col("anchor_slug").alias("node_slug"), "block_id", marker_rank().alias("rank"), F.col("editorial_marker").alias("marker"),
                   F.col("block_text").alias("content")).join(nodes.select("node_slug", "node_order"), "node_slug")
    seg = F.col("rank") * F.lit(2**40) + F.floor(F.col("block_id") / 4096)
    blk = segmented_scan(blk, ["node_order"], ["rank", "block_id"], seg, prev={"__before": F.col("marker")})
    turned = filled("marker") & (F.col("marker") != "sem_categoria") & (F.coalesce("__before", F.lit("")) != F.col("marker"))
    line = F.struct(F.lit(2).alias("kind"), F.col("content").alias("content"))
    head = F.struct(F.lit(1).alias("kind"), F.upper(F.replace("marker", F.lit("_"), F.lit(" "))).alias("content"))
    out = blk.withColumn("r", F.explode(F.when(turned, F.array(head, line)).otherwise(F.array(line)))).select(
        "node_order", "node_slug", F.col("r.kind").alias("kind"), "rank", "block_id", F.col("r.content").alias("content"), "marker")
    return n.unionByName(out).orderBy("node_order", F.when(F.col("kind") == 0, 0).otherwise(1), "rank", "block_id", "kind")


def drop_markers(b: DataFrame, text: str = "block_text") -> DataFrame:
    return b.filter(~F.coalesce(M.is_marker_text(text), F.lit(False)))


def slug_filter(df: DataFrame, prefix: str | None = None, infix: str | None = None, col: str = "anchor_slug") -> DataFrame:
    if prefix:
        df = df.filter(F.col(col).startswith(prefix))
    return df.filter(F.col(col).contains(infix)) if infix else df
