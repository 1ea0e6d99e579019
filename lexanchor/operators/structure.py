"""Documents to structure: lines, norm trees, carried context and anchored blocks.

Structural rows (headings, devices, markers, bracket lines) are few and narrow.
They are found in one pass over the text and kept as a checkpointed table; all
context logic runs on that table, and the texts pick their context up in one
segmented fill. Nothing is ordered per whole document on a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexanchor import vocab as V
from lexanchor.functions import metadata as M, text as T
from lexanchor.operators.keyed import compute_once, first_per_key, position_segment, segmented_scan
from lexanchor.session import cut

KEY = ["doc_id"]


# ---------------------------------------------------------------------- lines
def explode_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """Positioned non-blank lines of each document."""
    parts = docs.select("doc_id", F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    return parts.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.trim("line").alias("text")).filter(F.col("text") != "")


def explode_paragraphs(pages: DataFrame, html: str = "html") -> DataFrame:
    """Positioned texts of the paragraph elements of each page."""
    found = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<p[^>]*>(.*?)</p>"), F.lit(1))
    parts = pages.select("page_id", F.posexplode(found).alias("pos", "raw"))
    return parts.select("page_id", "pos", T.strip_html("raw").alias("text")).filter(F.col("text") != "")


def is_own_article(c) -> Column:
    """A line that opens an article of this norm and does not cite another statute."""
    c = T.col(c)
    tail = F.substring(F.regexp_replace(c, V.P_ART_LINE, ""), 1, 120)
    cross = "|".join(f"(?:{p})" for p in V.CROSS_REFERENCE_TAILS)
    number = T.capture(c, V.P_ART_LINE).try_cast("int")
    return F.coalesce(number.between(1, 250), F.lit(False)) & ~tail.rlike("(?iu)" + cross)


def _line_cases(c, say) -> Column:
    """One chain over the line kinds in trial order; ``say(kind, value)`` gives the result of each.

    Every pattern appears once, so the chain costs the same whatever it returns.
    """
    c = T.col(c)
    n = F.length(c)
    out = (
        F.when(is_own_article(c), say("art", T.capture(c, V.P_ART_LINE)))
        .when(T.like(c, V.P_PAR_LINE) & (n < 300), say("par", F.translate(F.lower(T.capture(c, V.P_PAR_LINE)), "ú", "u")))
        .when(T.like(c, V.P_PAR_UNICO_LINE) & (n < 300), say("par", F.lit("unico")))
        .when(c.rlike(V.P_INC_LINE) & (n < 200), say("inc", F.regexp_extract(c, V.P_INC_LINE, 1)))
        .when(c.rlike(V.P_ALI_LINE) & (n < 200), say("ali", F.regexp_extract(c, V.P_ALI_LINE, 1)))
    )
    for p, marker in V.MARKER_LINES:
        out = out.when(T.like(c, p), say("marker", F.lit(marker)))
    meta = T.like(c, V.P_META_LINE2) | T.like(c, V.P_SUM_LINE) | T.like(c, V.P_META_LINE)  # cheap patterns first
    none = F.lit(None).cast("string")
    return out.when(meta, say("meta", none)).otherwise(say("text", none))


def line_kind(c) -> Column:
    """struct(kind, value): art, par, inc, ali, marker, meta, or text."""
    return _line_cases(c, lambda k, v: F.struct(F.lit(k).alias("kind"), v.alias("value")))


LETTER = {"art": "A", "par": "A", "inc": "A", "ali": "A", "marker": "B", "meta": "D", "text": "C"}


def classify_abcd(c) -> Column:
    """A norm anchor, B editorial marker, D bracket metadata, C text."""
    return _line_cases(c, lambda k, v: F.lit(LETTER[k]))


def structural_marks(lines: DataFrame) -> DataFrame:
    """The rows that carry structure: doc_id, pos, kind, value (no text)."""
    x = compute_once(lines, {"k": line_kind("text")}).select("doc_id", "pos", "k.kind", "k.value")
    return x.filter(F.col("kind") != "text")


# ------------------------------------------------------------- article acceptance
def zone_starts(marks: DataFrame) -> DataFrame:
    """Position of the second "Art. 1" of a document, where the transitional act begins."""
    ones = first_per_key(marks.filter((F.col("kind") == "art") & (F.col("value") == "1")), KEY, [F.col("pos").asc()], 2)
    return ones.groupBy(*KEY).agg(F.max("pos").alias("zone_start"), F.count("*").alias("n")).filter(F.col("n") == 2).drop("n")


def namespace_of(marks: DataFrame) -> DataFrame:
    """Article rows with their namespace."""
    art = marks.filter(F.col("kind") == "art")
    x = art.join(zone_starts(marks), KEY, "left")
    return x.withColumn("namespace", F.when(F.col("pos") >= F.col("zone_start"), "adct").otherwise("cf")).drop("zone_start")


def accept_first(marks: DataFrame) -> DataFrame:
    """First row of each article number per document and namespace."""
    return first_per_key(namespace_of(marks), [*KEY, "namespace", "value"], [F.col("pos").asc()])


def anchor_positions(lines: DataFrame, tree: DataFrame) -> DataFrame:
    """Where each article starts: the first line whose body matches the canonical body, else the first with its number.

    ``tree``: article (int), body.
    """
    rest = F.lower(F.regexp_replace(F.substring(F.trim(F.regexp_replace("text", V.P_ART_LINE, "")), 1, 20), r"\s+", " "))
    art = lines.filter(F.col("text").rlike(V.P_ART_LINE)).select(
        "doc_id", "pos", T.capture("text", V.P_ART_LINE).try_cast("int").alias("article"), rest.alias("rest"),
        F.col("text").rlike(V.P_ART_LINE + r"[\s\.]").alias("plain"))
    t = tree.select("article", F.lower(F.regexp_replace(F.trim(F.substring("body", 1, 20)), r"\s+", " ")).alias("fp"))
    x = art.join(t, "article")
    same = F.contains("rest", F.substring("fp", 1, 10)) | F.contains("fp", F.substring("rest", 1, 10))
    exact = F.min(F.when((F.col("fp") != "") & same, F.col("pos")))
    return x.groupBy("doc_id", "article").agg(exact.alias("exact_pos"), F.min(F.when(F.col("plain"), F.col("pos"))).alias("any_pos")).select(
        "doc_id", "article", F.coalesce("exact_pos", "any_pos").alias("pos"), F.col("exact_pos").isNotNull().alias("exact")).filter(
        F.col("pos").isNotNull())


# ----------------------------------------------------------------------- context
def _after(level: str, *higher: str) -> Column:
    """Value of a level that no higher level has reset since."""
    ok = F.col(level).isNotNull()
    for h in higher:
        ok = ok & (F.col(h).isNull() | (F.col(level)["pos"] > F.col(h)["pos"]))
    return F.when(ok, F.col(level)["value"])


MARKER_RESETS = {"article": ("art",), "device": ("art", "par", "inc", "ali"), "none": ()}


def carry_context(marks: DataFrame, valid: DataFrame | None = None, reset: str = "article", size: int = 4096) -> DataFrame:
    """Context in force after each structural row.

    An article closes paragraph, inciso and alínea; a paragraph closes inciso and
    alínea; an inciso closes alínea. The editorial marker ends as ``reset`` says.
    Repeated article numbers, devices outside any article, and devices that ``valid``
    (article, kind, value) rules out for their article are not structure and drop out.
    """
    marks = cut(marks)  # narrow and read several times
    seg = position_segment("pos", size)
    acc = accept_first(marks)
    rows = marks.filter(F.col("kind") != "art").withColumn("namespace", F.lit(None).cast("string")).unionByName(
        acc.select("doc_id", "pos", "kind", "value", "namespace")).withColumn("seg", seg)
    at = F.struct("pos", "value", "namespace")
    x = segmented_scan(rows, KEY, ["pos"], "seg", fills={"art": F.when(F.col("kind") == "art", at)})
    sub = F.col("kind").isin("par", "inc", "ali")
    x = x.filter(~sub | F.col("art").isNotNull())
    if valid is not None:
        x = x.withColumn("article", F.col("art.value").try_cast("int"))
        known = valid.select("article", "kind", "value", F.lit(True).alias("__known")).distinct()
        any_ = valid.select("article", "kind", F.lit(True).alias("__any")).distinct()
        x = x.join(any_, ["article", "kind"], "left").join(known, ["article", "kind", "value"], "left")
        x = x.filter(~sub | F.col("__known") | F.col("__any").isNull()).select("doc_id", "pos", "kind", "value", "seg", "art")
    lv = F.struct("pos", "value")
    x = segmented_scan(
        x, KEY, ["pos"], "seg", fills={k: F.when(F.col("kind") == k, lv) for k in ("par", "inc", "ali", "marker")},
        counts={"separator": F.lit(True)})
    out = x.select(
        "doc_id", "pos", "kind", F.col("art.namespace").alias("namespace"), F.col("art.value").try_cast("int").alias("article"),
        _after("par", "art").alias("par"), F.lower(_after("inc", "art", "par")).alias("inc"), _after("ali", "art", "par", "inc").alias("ali"),
        F.coalesce(_after("marker", *MARKER_RESETS[reset]), F.lit("sem_categoria")).alias("editorial_marker"), "separator")
    return out.withColumn("anchor_slug", T.build_slug("namespace", "article", "par", "inc", "ali"))


def carry_editorial(marks: DataFrame, reset: str = "article") -> DataFrame:
    return carry_context(marks, reset=reset).select("doc_id", "pos", "kind", "editorial_marker")


def attach_preceding(devices: DataFrame, rows: DataFrame, keys=("doc_id",), size: int = 4096) -> DataFrame:
    """Each row with the last device before it (as-of attach without a range join).

    ``devices``: keys, pos, device. A device at the same position counts.
    """
    extra = [c for c in rows.columns if c not in (*keys, "pos")]
    u = devices.select(*keys, "pos", F.lit(0).alias("__row"), "device").unionByName(
        rows.select(*keys, "pos", F.lit(1).alias("__row"), F.struct(*extra).alias("__x")), allowMissingColumns=True)
    x = segmented_scan(u, list(keys), ["pos", "__row"], position_segment("pos", size), fills={"attached": F.col("device")})
    return x.filter(F.col("__row") == 1).select(*keys, "pos", "__x.*", F.col("attached").alias("device"))


def segment_blocks(lines: DataFrame, valid: DataFrame | None = None, reset: str = "article", size: int = 4096) -> DataFrame:
    """Commentary blocks: lines accumulate, a bracket line closes the block, anchors and markers end it."""
    ctx = cut(carry_context(structural_marks(lines), valid, reset, size))
    at = F.struct(*[c for c in ctx.columns if c != "doc_id"])
    marks = ctx.select("doc_id", "pos", F.lit(0).alias("row"), at.alias("at"))
    u = marks.unionByName(lines.select("doc_id", "pos", F.lit(1).alias("row"), "text"), allowMissingColumns=True)
    x = segmented_scan(u, KEY, ["pos", "row"], position_segment("pos", size), fills={"ctx": F.col("at")}).filter(F.col("row") == 1)
    itself = F.coalesce(F.col("ctx.pos") == F.col("pos"), F.lit(False))
    meta = itself & (F.col("ctx.kind") == "meta")
    x = x.filter(~itself | meta).withColumns({
        "block_no": F.coalesce("ctx.separator", F.lit(0)) - meta.cast("int"), "is_meta": meta})

    def text(cond):
        rows = F.array_sort(F.collect_list(F.when(cond, F.struct("pos", "text"))))
        return F.array_join(F.transform(rows, lambda r: r["text"]), " ")

    keep = ["namespace", "anchor_slug", "article", "par", "inc", "ali", "editorial_marker"]
    return x.groupBy("doc_id", "block_no").agg(
        *[F.first(f"ctx.{c}").alias(c) for c in keep], text(~F.col("is_meta")).alias("block_text"), text(F.col("is_meta")).alias("metadata_text"),
        F.min("pos").alias("paragraph_start"), F.max("pos").alias("paragraph_end")).withColumn(
        "editorial_marker", F.coalesce("editorial_marker", F.lit("sem_categoria")))


# --------------------------------------------------------------------- norm tree
def line_type(c) -> Column:
    """Node type of a norm line; texto_livre when nothing fits."""
    c = T.col(c)
    out = None
    for kind, p, _, _ in V.TREE_LINES:
        out = F.when(T.like(c, p), kind) if out is None else out.when(T.like(c, p), kind)
    return out.otherwise("texto_livre")


def classify_lines(lines: DataFrame) -> DataFrame:
    """Lines as node rows: doc_id, pos, node_type, label, number_raw, number_norm, text.

    Type first, then its captures, then the number: each pattern runs once per line.
    """
    x = compute_once(lines.select("doc_id", "pos", T.norm_spaces("text").alias("line")), {"kind": line_type("line")})
    raw = trail = None
    for kind, p, num, txt in V.TREE_LINES:
        hit = F.col("kind") == kind
        if num:
            raw = (F if raw is None else raw).when(hit, T.capture("line", p, num))
        if txt:
            trail = (F if trail is None else trail).when(hit, F.trim(T.capture("line", p, txt)))
    free = F.col("kind") == "texto_livre"
    x = compute_once(x, {"raw": raw, "trail": trail.when(free, F.col("line")).otherwise("")})
    roman = F.col("kind").isin("titulo", "capitulo", "secao", "subsecao", "inciso")
    x = compute_once(x, {
        "number_raw": F.when(roman, F.upper("raw")).when(F.col("kind") == "alinea", F.lower("raw")).when(F.col("kind") == "paragrafo_unico", "único")
        .otherwise(F.col("raw"))})
    r, k = F.col("number_raw"), F.col("kind")
    norm = (
        F.when(k == "paragrafo_unico", "unico").when(k == "alinea", r).when(roman, T.roman_to_int("number_raw").cast("string"))
        .otherwise(r.try_cast("bigint").cast("string"))
    )
    label = (
        F.when(k == "preambulo", "PREÂMBULO").when(k == "artigo", F.concat(F.lit("Art. "), r)).when(k == "paragrafo", F.concat(F.lit("§ "), r))
        .when(k == "paragrafo_unico", "Parágrafo único").when(k == "inciso", r).when(k == "alinea", F.concat(r, F.lit(")")))
        .when(k == "item", F.concat(r, F.lit("."))).when(~free, F.col("line"))
    )
    kind = F.when(k == "paragrafo_unico", "paragrafo").otherwise(k)
    return x.select("doc_id", "pos", kind.alias("node_type"), label.alias("label"), "number_raw", norm.alias("number_norm"), F.col("trail").alias("text"))


HEADINGS = ["titulo", "capitulo", "secao", "subsecao"]


def assign_parents(nodes: DataFrame, size: int = 4096) -> DataFrame:
    """Parent position of each node (NULL = root) under the allowed-parent table.

    Equal to keeping a stack of open nodes, unrolled into fills:

    * a node below the article looks only inside its stretch (from an article or
      heading to the next). The article stays open there unless an alínea or item
      comes before the first paragraph or inciso: such a row hangs on the root and
      closes everything.
    * a chapter, section or subsection hangs on the last heading of another kind, an
      article on the last heading, as long as no row has gone to the root since.
    """
    t = F.col("node_type")
    x = cut(nodes.select("doc_id", "pos", "node_type")).withColumn("seg", position_segment("pos", size))
    opens = t.isin("artigo", "preambulo", *HEADINGS)
    x = segmented_scan(x, KEY, ["pos"], "seg", counts={"grp": opens}, fills={
        "art": F.when(opens, F.struct("pos", (t == "artigo").alias("is_art"))),
        "p": F.when(t == "paragrafo", F.col("pos")), "i": F.when(t == "inciso", F.col("pos")), "a": F.when(t == "alinea", F.col("pos"))})
    first = x.groupBy("doc_id", "grp").agg(
        F.min(F.when(t.isin("paragrafo", "inciso"), F.col("pos"))).alias("first_pi"),
        F.min(F.when(t.isin("alinea", "item"), F.col("pos"))).alias("first_lt"))
    x = x.join(first, ["doc_id", "grp"])
    start = F.coalesce("art.pos", F.lit(-1))
    art = F.when(F.col("art.is_art") & (F.col("first_lt").isNull() | (F.col("first_pi") < F.col("first_lt"))), F.col("art.pos"))
    p = F.when((F.col("p") > start), F.col("p"))
    i = F.when((F.col("i") > start) & (p.isNull() | (F.col("i") > p)), F.col("i"))
    a = F.when((F.col("a") > start) & (p.isNull() | (F.col("a") > p)) & (F.col("i").isNull() | (F.col("a") > F.col("i"))), F.col("a"))
    sub = (
        F.when(t == "paragrafo", art).when(t == "inciso", F.coalesce(p, art)).when(t == "alinea", F.coalesce(i, p))
        .when(t == "item", F.coalesce(a, i, p))
    )
    below = t.isin("paragrafo", "inciso", "alinea", "item")
    x = cut(x.select("doc_id", "pos", "node_type", "seg", sub.alias("sub_parent"), below.alias("below")))
    reset = (F.col("below") & F.col("sub_parent").isNull()) | (t == "preambulo")
    x = segmented_scan(x, KEY, ["pos"], "seg", fills={
        "reset": F.when(reset, F.col("pos")), "pre": F.when(t == "preambulo", F.col("pos")),
        **{h: F.when(t == h, F.col("pos")) for h in HEADINGS}})

    def last(*kinds):
        best = F.greatest(*[F.col(k) for k in kinds]) if len(kinds) > 1 else F.col(kinds[0])
        return F.when(F.col("reset").isNull() | (best > F.col("reset")), best)

    parent = F.when(F.col("below"), F.col("sub_parent")).when(t == "artigo", last(*HEADINGS))
    for h in HEADINGS[1:]:
        parent = parent.when(t == h, last(*[k for k in HEADINGS if k != h]))
    x = cut(x.select("doc_id", "pos", "node_type", "seg", "pre", parent.alias("parent_pos")))
    rooted = F.col("parent_pos").isNull() & ~t.isin("titulo", "preambulo")
    x = segmented_scan(x, KEY, ["pos"], "seg", fills={"rooted": F.when(rooted, F.col("pos"))})
    titled = F.when((t == "titulo") & F.col("pre").isNotNull() & (F.col("rooted").isNull() | (F.col("pre") > F.col("rooted"))), F.col("pre"))
    return x.select("doc_id", "pos", "node_type", F.coalesce("parent_pos", titled).alias("parent_pos"))


def resolve_chains(nodes: DataFrame, key: list[str], parent: str, joined: dict[str, str]) -> DataFrame:
    """Follows parent links to the end by pointer jumping.

    ``nodes``: key columns, the parent pointer (last key part), and text columns.
    Each column in ``joined`` becomes its values from the root down, joined by the
    given separator; ``depth`` counts the nodes on the way. Every round doubles the
    distance covered and only rows that still point somewhere are joined. A cycle is
    an error: it shows when the distance covered exceeds the number of nodes.
    """
    *scope, ident = key
    done = None
    live = nodes.withColumn("depth", F.lit(1))
    cols = [*scope, ident, parent, "depth", *joined]
    live = cut(live.select(*cols))
    table, covered, total = live, 1, live.count()
    while True:
        ended = live.filter(F.col(parent).isNull())
        done = ended if done is None else done.unionByName(ended)
        open_ = live.filter(F.col(parent).isNotNull())
        if open_.isEmpty():
            return done.drop(parent)
        if covered > total:
            raise ValueError("parent links form a cycle")
        covered *= 2
        up = table.select(*scope, F.col(ident).alias(parent), F.col(parent).alias("__next"), F.col("depth").alias("__d"),
                          *[F.col(c).alias(f"__{c}") for c in joined])
        step = open_.join(up, [*scope, parent], "left").select(
            *scope, ident, F.col("__next").alias(parent), (F.col("depth") + F.coalesce("__d", F.lit(0))).alias("depth"),
            *[F.concat_ws(s, f"__{c}", c).alias(c) for c, s in joined.items()])
        live = cut(step)
        table = live.unionByName(done.select(*cols))


def node_paths(nodes: DataFrame, parents: DataFrame, prefix: str = "cf-1988") -> DataFrame:
    """Slug, label path and depth of every node.

    Titles and articles have slugs of their own; every other node extends the slug of its parent.
    """
    seg = F.create_map(*[F.lit(v) for kv in V.TREE_SEGMENT.items() for v in kv])
    own = F.when(F.col("node_type") == "preambulo", "preambulo").otherwise(
        F.concat(F.element_at(seg, F.col("node_type")), F.lit("-"), F.col("number_norm")))
    x = cut(nodes.select("doc_id", "pos", "node_type", "label", "number_norm").join(parents.select("doc_id", "pos", "parent_pos"), ["doc_id", "pos"]))
    absolute = F.col("node_type").isin("preambulo", "titulo", "artigo")
    s = resolve_chains(x.select("doc_id", "pos", F.when(~absolute, F.col("parent_pos")).alias("up"), own.alias("slug")),
                       ["doc_id", "pos"], "up", {"slug": "-"}).select("doc_id", "pos", F.concat(F.lit(prefix + "-"), "slug").alias("slug"))
    return x.join(s, ["doc_id", "pos"]).join(_label_paths(x), ["doc_id", "pos"])


def _label_paths(x: DataFrame) -> DataFrame:
    return resolve_chains(x.select("doc_id", "pos", F.col("parent_pos").alias("up"), F.col("label").alias("path")), ["doc_id", "pos"], "up", {"path": " > "})


def label_paths(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """Label path and depth of every node, as ``node_paths``, without the slugs."""
    x = cut(nodes.select("doc_id", "pos", "node_type", "label").join(parents.select("doc_id", "pos", "parent_pos"), ["doc_id", "pos"]))
    return x.join(_label_paths(x), ["doc_id", "pos"])


def attach_text(rows: DataFrame, size: int = 4096) -> DataFrame:
    """Free lines joined to the node open before them; a heading takes its first short line as title.

    ``rows``: output of ``classify_lines``.
    """
    node = F.col("node_type") != "texto_livre"
    x = segmented_scan(rows, KEY, ["pos"], position_segment("pos", size), fills={"owner": F.when(node, F.struct("pos", "node_type"))})
    x = x.filter(F.col("owner").isNotNull())
    heading = F.col("owner.node_type").isin(*HEADINGS)
    can = heading & ~node & (F.length("text") < V.TITLE_MAX)
    x = x.withColumn("can_title", can)
    parts = x.groupBy("doc_id", F.col("owner.pos").alias("node_pos")).agg(
        F.min(F.when(F.col("can_title"), F.struct("pos", "text"))).alias("t"),
        F.array_sort(F.collect_list(F.when(F.col("text") != "", F.struct("pos", "text")))).alias("lines"))
    rest = F.transform(F.filter("lines", lambda r: F.col("t").isNull() | (r["pos"] != F.col("t.pos"))), lambda r: r["text"])
    return parts.select("doc_id", F.col("node_pos").alias("pos"), F.col("t.text").alias("title"), F.array_join(rest, "\n").alias("text"))


def tree_summary(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("doc_id", "node_type").agg(F.count("*").alias("nodes"), F.max(F.when(
        F.col("node_type") == "artigo", F.col("number_norm").try_cast("int"))).alias("last_article"))


def article_gaps(nodes: DataFrame) -> DataFrame:
    """Article numbers missing between 1 and the last article of each document."""
    art = nodes.filter(F.col("node_type") == "artigo").select("doc_id", F.col("number_norm").try_cast("int").alias("article")).distinct()
    last = art.groupBy("doc_id").agg(F.max("article").alias("m"))
    spine = last.select("doc_id", F.explode(F.sequence(F.lit(1), F.col("m"))).alias("article"))
    return spine.join(art, ["doc_id", "article"], "left_anti")


# ---------------------------------------------------------------- document reports
def document_profile(docs: DataFrame, text: str = "text") -> DataFrame:
    """Lines, non-empty lines, characters, words, encoding errors, short and long lines per document."""
    lines = F.split(text, "\n")
    full = F.filter(lines, lambda s: F.trim(s) != "")

    def n(cond):
        return F.size(F.filter(full, cond))

    return docs.select(
        "doc_id", F.size(lines).alias("lines"), F.size(full).alias("filled_lines"), F.length(text).alias("chars"),
        F.regexp_count(text, F.lit(r"\S+")).alias("words"), n(lambda s: s.contains("�")).alias("encoding_errors"),
        n(lambda s: F.length(F.trim(s)) < 3).alias("short_lines"), n(lambda s: F.length(F.trim(s)) > 2000).alias("long_lines"))


def line_class(c) -> Column:
    """Norm, decision, editorial or other."""
    c = T.col(c)
    heading = c.rlike("(?iu)^(T[IÍ]TULO|CAP[IÍ]TULO|SE[CÇ][AÃ]O)\\s+[IVXLCDM]+")
    rest = F.when(heading, "norma").when(c.rlike(V.P_CITED), "decisao")
    say = {"marker": rest.otherwise("editorial"), "meta": rest.otherwise("outro"), "text": rest.otherwise("outro")}
    return _line_cases(c, lambda k, v: say.get(k, F.lit("norma")))


def line_class_share(lines: DataFrame) -> DataFrame:
    g = compute_once(lines, {"line_class": line_class("text")}).groupBy("line_class").agg(F.count("*").alias("n"))
    return g.withColumn("pct", F.round(F.col("n") * 100.0 / g.agg(F.sum("n")).scalar(), 1).cast("double"))


def decisions_per_article(lines: DataFrame, size: int = 4096) -> DataFrame:
    """Bracketed decisions between one article line and the next, per document and article."""
    cited = F.regexp_extract_all("text", F.lit(V.P_CITED), F.lit(1))
    n = F.size(F.filter(cited, lambda b: F.trim(b).rlike(rf"^({V.CLASSES_CITED})\s*[-n.]*\s*([\d.]+(?:[-/]\d+)?)")))
    number = F.nullif(F.regexp_extract("text", r"(?i)^Art\.\s*(\d+)[^0-9]", 1), F.lit(""))
    x = compute_once(lines, {"n": n, "number": number}).select("doc_id", "pos", "n", "number")
    x = segmented_scan(x, KEY, ["pos"], position_segment("pos", size), fills={"article": F.col("number").try_cast("int")})
    return x.filter((F.col("n") > 0) & F.col("article").isNotNull()).groupBy("doc_id", "article").agg(F.sum("n").alias("decisions"))
