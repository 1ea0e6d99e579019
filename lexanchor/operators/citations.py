"""Citations, links and case metadata found in texts and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexanchor import vocab as V
from lexanchor.functions import metadata as M, text as T
from lexanchor.operators.keyed import compute_once, first_per_key


def extract_citations(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per bracketed decision of each text."""
    found = F.regexp_extract_all(F.col(text), F.lit(V.P_CITED), F.lit(1))
    x = docs.select(key, F.posexplode(found).alias("n", "ref")).withColumn("ref", F.trim("ref")).filter(F.col("ref").rlike(V.CITED_HEAD))

    def get(p, i=1):
        return F.regexp_extract("ref", p, i)

    return x.select(
        key, "n", get(V.CITED_HEAD).alias("classe"), get(V.CITED_HEAD, 2).alias("numero"), F.trim(get(V.CITED_REL)).alias("relator"),
        F.trim(get(V.CITED_DATE)).alias("data_julgamento"), F.trim(get(V.CITED_BODY)).alias("orgao"), get(V.P_TEMA).alias("tema_rg"),
        F.trim(F.regexp_extract("ref", V.P_DJE.replace("(?i)", ""), 1)).alias("dje"))


def unique_citations(c: DataFrame, key: str = "doc_id") -> DataFrame:
    """First mention of each class and number."""
    return first_per_key(c, ["classe", "numero"], [F.col(key).asc(), F.col("n").asc()])


def confirmed_metadata(comments: DataFrame) -> DataFrame:
    """Metadata per comment: bracket references first, then links, then safe text patterns, with the source of two fields.

    ``comments``: com_id, html, and any columns to keep. Editorial marker comments are left out.
    """
    x = compute_once(comments, {"text": T.strip_html("html")})
    x = x.filter(~M.is_marker_text("text"))
    refs = F.regexp_extract_all(F.col("text"), F.lit(V.P_BRACKET), F.lit(1))
    x = compute_once(x, {"refs": refs})
    sum_ = M.sumula_of("text", F.col("text"))
    x = compute_once(x, {
        "__r": F.transform("refs", M.reference_meta), "__l": M.link_meta("html"), "__s": T.link_summary("html"),
        "__t": F.struct(T.capture("text", V.P_TEMA).alias("tema_rg"), sum_["num"].alias("sumula_num"), sum_["kind"].alias("sumula_tipo"))})
    sources = {"__l": ("process_class", "process_number", "tema_rg", "stf_incidente"), "__t": ("tema_rg", "sumula_num", "sumula_tipo")}
    no_ref = {"stf_incidente"}

    def value(f: str) -> Column:
        parts = [] if f in no_ref else [M.first_in("__r", f)]
        parts += [F.col(f"{s}.{f}") for s, fields in sources.items() if f in fields]
        return F.coalesce(T.first_nonempty(*parts), F.lit(""))

    fields = list(dict.fromkeys(M.REFERENCE_FIELDS))
    x = compute_once(x, {f: value(f) for f in fields} | {
        "fonte_relator": F.when(M.first_in("__r", "relator") != "", "ref").otherwise(""),
        "fonte_processo": F.when(M.first_in("__r", "process_class") != "", "ref").when(F.col("__l.process_class") != "", "link").otherwise("")})
    keep = [c for c in comments.columns if c != "html"]
    return x.select(
        *keep, *fields, F.when((F.col("process_class") != "") & (F.col("process_number") != ""), F.concat_ws("_", "process_class", "process_number")).otherwise("").alias("process_key"),
        F.col("__s.first").alias("url_principal"), F.col("__s.all").alias("urls_todas"), F.col("__s.labels").alias("link_labels"),
        F.array_join("refs", "; ").alias("referencia"), "fonte_relator", "fonte_processo")


def comment_blocks(comments: DataFrame, marker_head: int | None = None) -> DataFrame:
    """Block text, metadata and marker of each comment of a page; the marker is read from the whole text, or its opening."""
    opening = F.col("raw") if marker_head is None else F.substring("raw", 1, marker_head)
    x = compute_once(comments, {"raw": T.strip_html("html")})
    x = compute_once(x, {"s": T.split_metadata(T.strip_prefix("raw")), "marker": M.detect_editorial(opening)})
    return x.select(*[c for c in comments.columns if c != "html"], F.col("s.text").alias("block_text"), F.col("s.meta").alias("metadata_text"), "marker")


URL = r"https?://[^\s\"<>)]+"


def url_mentions(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 50) -> DataFrame:
    """Every link with the text around it and the last decision named before it.

    Links and decisions are found once per text, decisions only where there is a link; only short structs are exploded.
    """
    process = F.lit(T.pat(V.P_PROC))
    x = docs.select(key, F.col(text).alias("__text")).filter(F.contains("__text", F.lit("://")))
    x = compute_once(x, {"__u": F.regexp_extract_all("__text", F.lit(URL), F.lit(0))}).filter(F.size("__u") > 0)
    x = compute_once(x, {
        "__p": F.split("__text", URL, -1), "__m": F.regexp_extract_all("__text", process, F.lit(0)), "__q": F.split("__text", T.pat(V.P_PROC), -1)})
    size = lambda arr, n: f"aggregate(slice({arr}, 1, {n}), 0, (a, t) -> a + length(t))"
    x = compute_once(x, {
        "__urls": F.expr(f"transform(__u, (u, i) -> struct(i + 1 as numero, u as url, {size('__p', 'i + 1')} + {size('__u', 'i')} as start))"),
        "__named": F.expr(f"transform(__m, (m, i) -> struct(m, {size('__q', 'i + 1')} + {size('__m', 'i + 1')} as until))")})
    around = (f"concat(substr(__text, greatest(u.start - {window - 1}, 1), least(u.start, {window})), u.url, "
              f"substr(__text, u.start + length(u.url) + 1, {window}))")
    last = "coalesce(try_element_at(filter(__named, m -> m.until <= u.start), -1).m, '')"
    return x.select(key, F.expr(f"inline(transform(__urls, u -> struct(u.numero as numero, u.url as url, {around} as context, {last} as acao_referente)))"))


PROCESS_FIELDS = {
    "classe_processo": "processo-classe", "numero_unico": "processo-numero-unico", "tipo_acao": "processo-tipo", "origem": "processo-origem",
    "relator": "processo-relator", "apenso": "processo-apenso", "autor": "processo-autor", "advogado": "processo-advogado", "reu": "processo-reu",
}


def process_details(pages: DataFrame) -> DataFrame:
    """Parties and joined movement list of a process page; absent fields are named in ``erro``."""
    def field(css):
        return F.nullif(T.strip_html(F.regexp_extract("html", rf'(?s)<div class="{css}"[^>]*>(.*?)</div>', 1)), F.lit(""))

    item = r'(?s)<div class="andamento-item">\s*<span class="data">(.*?)</span>\s*<span class="descricao">(.*?)</span>'
    dates, texts = (F.regexp_extract_all(F.col("html"), F.lit(item), F.lit(i)) for i in (1, 2))
    moves = F.array_join(F.zip_with(dates, texts, lambda d, t: F.concat(F.trim(d), F.lit(": "), F.trim(t))), " | ")
    x = compute_once(pages, {**{n: field(c) for n, c in PROCESS_FIELDS.items()}, "andamentos": moves})
    absent = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in PROCESS_FIELDS]))
    return x.select(F.col("url").alias("link"), *PROCESS_FIELDS, "andamentos", F.nullif(F.array_join(absent, ","), F.lit("")).alias("erro"))


def process_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Process, incident and document links of pages, one per distinct target."""
    x = pages.select(key, F.posexplode(T.links(html)).alias("n", "url")).withColumn("p", T.url_params("url")).filter(F.col("p.kind") != "")
    x = x.select(key, "n", "url", "p.*")
    return first_per_key(x, ["processo", "classe", "incidente", "peca"], [F.col(key).asc(), F.col("n").asc()])


def infer_granular(b: DataFrame) -> DataFrame:
    """Formal anchors plus inferred ones for the sub-devices a text names ("art. 55, VI")."""
    def all_(p, i):
        return F.regexp_extract_all(F.col("block_text"), F.lit(p), F.lit(i))

    inc = F.transform(F.arrays_zip(all_(V.GRANULAR_INC, 1).alias("a"), all_(V.GRANULAR_INC, 2).alias("i"), all_(V.GRANULAR_INC, 3).alias("l")), lambda m: F.concat(
        F.lit("cf-1988-art-"), m["a"], F.lit("-inc-"), F.lower(m["i"]), F.when(m["l"] != "", F.concat(F.lit("-ali-"), m["l"])).otherwise("")))
    par = F.transform(F.arrays_zip(all_(V.GRANULAR_PAR, 1).alias("a"), all_(V.GRANULAR_PAR, 2).alias("p")), lambda m: F.concat(
        F.lit("cf-1988-art-"), m["a"], F.lit("-par-"), m["p"]))
    formal = b.filter(F.coalesce("anchor_slug", F.lit("")) != "").select("block_id", "anchor_slug", F.lit("formal").alias("anchor_origin"))
    found = b.filter(F.col("block_text") != "").select("block_id", F.col("anchor_slug").alias("own"), F.explode(F.array_distinct(F.concat(inc, par))).alias("anchor_slug"))
    return formal.unionByName(found.filter(~F.col("own").eqNullSafe(F.col("anchor_slug"))).select(
        "block_id", "anchor_slug", F.lit("inferida").alias("anchor_origin")))
