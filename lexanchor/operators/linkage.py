"""Linking texts to norm nodes: variant index, candidates, scored matching and ancestors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexanchor import vocab as V
from lexanchor.functions import text as T
from lexanchor.operators.keyed import compute_once, first_per_key


def _fill(template: str, value: Column) -> Column:
    if "%s" not in template:
        return F.lit(template)
    head, tail = template.split("%s")
    return F.concat(F.lit(head), value, F.lit(tail))


def _written(templates: list[str]):
    return lambda m: F.array(*[_fill(t, m) for t in templates])


def anchor_variants(nodes: DataFrame) -> DataFrame:
    """Every way a node may be written: normalized text, origin, priority and order of generation.

    ``nodes``: slug, node_type, label, title, number_raw, number_norm, path.
    """
    n = F.col("number_norm").try_cast("bigint").cast("string")
    raw = F.nullif(F.col("number_raw"), F.lit(""))
    adct = T.norm_key(F.coalesce("path", F.lit(""))).contains("adct") | F.col("slug").contains("adct")
    heads = ("titulo", "capitulo", "secao", "subsecao")

    def value(kind: str, source: str) -> Column:
        if source == "L":
            return F.lower(F.trim(T.first_nonempty("number_norm", "number_raw")))
        if source == "R":
            return raw if kind in heads else F.upper(F.trim(raw))
        return F.nullif(F.col("number_norm"), F.lit("")) if kind in heads else n

    t = F.col("node_type")
    when = {
        "paragrafo_unico": (t == "paragrafo") & (F.col("number_norm") == "unico"), "paragrafo": (t == "paragrafo") & (F.col("number_norm") != "unico"),
        "artigo_adct": (t == "artigo") & adct,
    }
    rows = [F.struct(F.col("label").alias("v"), F.lit("label").alias("origin"), F.lit(100).alias("priority"), F.lit(0).alias("seq")),
            F.struct(F.col("title").alias("v"), F.lit("title").alias("origin"), F.lit(70).alias("priority"), F.lit(1).alias("seq"))]
    seq = 2
    for kind, templates in V.VARIANTS.items():
        cond = when.get(kind, t == kind)
        for template, source, origin, priority in templates:
            v = F.when(cond, _fill(template, value(kind, source)))
            rows.append(F.struct(v.alias("v"), F.lit(origin).alias("origin"), F.lit(priority).alias("priority"), F.lit(seq).alias("seq")))
            seq += 1
    ns = F.when(adct, "adct").otherwise("cf")
    x = nodes.select("slug", "label", "title", "node_type", ns.alias("namespace"), F.explode(F.array(*rows)).alias("x"))
    x = x.filter(F.col("x.v") != "").withColumn("norm", T.norm_key("x.v"))
    return x.filter(F.col("norm") != "").select(
        F.col("norm").alias("anchor_text_norm"), "slug", "label", "title", "node_type", "namespace", F.col("x.origin").alias("variant_origin"),
        F.col("x.priority").alias("match_priority"), F.col("x.seq").alias("seq"))


def drop_ambiguous(v: DataFrame) -> DataFrame:
    c = F.col("anchor_text_norm")
    return v.filter(~c.isin(V.AMBIGUOUS) & ~c.rlike(r"^(\d+|[a-z])$"))


def variant_index(nodes: DataFrame) -> DataFrame:
    """Unambiguous variants, one row per text and node (first generated wins)."""
    return first_per_key(drop_ambiguous(anchor_variants(nodes)), ["anchor_text_norm", "slug"], [F.col("seq").asc()]).drop("seq")


def expand_index(idx: DataFrame, order: str = "slug") -> DataFrame:
    """Index keyed by text alone: originals (last wins), then written-out variants of each node (first wins)."""
    body = F.struct("slug", "label", "node_type")
    base = idx.withColumn("key", F.lower(F.trim("anchor_text_norm")))
    originals = base.groupBy("key").agg(F.max_by(body, F.col(order)).alias("b"))
    inc, par, ali = (F.regexp_extract("slug", p, 1) for p in (r"-inc-(\d+)$", r"-par-(\w+)$", r"-ali-(\w)$"))
    roman = F.lower(T.int_to_roman(inc.try_cast("int")))

    def texts(kind, n, r=None):
        out = []
        for template in V.EXPANSION[kind]:
            piece = F.lit("")
            for part in template.replace("{", "|{").replace("}", "}|").split("|"):
                piece = F.concat(piece, n if part == "{n}" else (r if part == "{r}" else F.lit(part)))
            out.append(piece)
        return F.array(*out)

    t = F.col("node_type")
    variants = (
        F.when((t == "inciso") & (inc != ""), texts("inciso", inc, roman)).when((t == "paragrafo") & (par == "unico"), texts("paragrafo_unico", par))
        .when((t == "paragrafo") & (par != ""), texts("paragrafo", par)).when((t == "alinea") & (ali != ""), texts("alinea", ali))
    )
    more = base.select(F.col(order).alias("o"), body.alias("b"), F.posexplode(variants).alias("k", "key"))
    more = more.groupBy(F.trim("key").alias("key")).agg(F.min_by("b", F.struct("o", "k")).alias("b")).join(originals.select("key"), "key", "left_anti")
    return originals.unionByName(more).select(F.col("key").alias("anchor_text_norm"), "b.*")


# ------------------------------------------------------------------- matching
def candidates(b: DataFrame) -> DataFrame:
    """Possible anchor texts named by each block, in order, with the namespace it speaks of."""
    merged = F.trim(F.concat_ws("\n", "block_text", "metadata_text"))
    x = compute_once(b.select("block_id", merged.alias("merged")), {
        "expected": F.when(T.like("merged", V.P_ADCT), "adct").otherwise("cf"), "article": T.capture("merged", V.P_ART_MENTION)})
    groups = []
    for pattern, mode, templates in V.CANDIDATE_RULES:
        if mode == "C":
            fixed = F.array(*[F.lit(t) for t in templates])
            groups.append(F.when(T.like("merged", pattern), fixed).otherwise(F.array().cast("array<string>")))
            continue
        found = F.array_distinct(F.regexp_extract_all(F.col("merged"), F.lit(T.pat(pattern)), F.lit(1)))
        if mode:
            found = F.transform(found, F.upper if mode == "U" else F.lower)
        groups.append(F.flatten(F.transform(found, _written(templates))))
    x = x.select("block_id", "expected", "article", F.posexplode_outer(F.array_distinct(F.concat(*groups))).alias("ord", "candidate"))
    # texts that differ only in case or accents are one candidate, the first
    return first_per_key(x.withColumn("norm", T.norm_key("candidate")), ["block_id", "norm"], [F.col("ord").asc()])


def score_lookup(idx: DataFrame) -> DataFrame:
    """Best node per text for each expected namespace.

    The score depends on the index row and the expected namespace only, so every
    text keeps two rows, however many nodes share it.
    """
    spec = F.create_map(*[F.lit(v) for kv in V.SPECIFICITY.items() for v in kv])
    both = idx.withColumn("expected", F.explode(F.array(F.lit("cf"), F.lit("adct"))))
    score = F.col("match_priority") + F.coalesce(F.element_at(spec, F.col("node_type")), F.lit(0)) + F.when(
        F.col("namespace") == F.col("expected"), V.SAME_NAMESPACE).otherwise(V.OTHER_NAMESPACE)
    scored = both.withColumn("score", score)
    body = F.struct("slug", "label", "node_type", "namespace", "variant_origin", "match_priority", "score")
    best = F.struct(-F.col("score"), -F.col("match_priority"), F.col("slug"))
    return scored.groupBy(F.col("anchor_text_norm").alias("norm"), "expected").agg(F.min_by(body, best).alias("hit"))


def match_confidence(node_type: Column, priority: Column, same_namespace: Column, base: float = 0.90) -> Column:
    bonus = F.create_map(*[F.lit(v) for kv in V.TYPE_BONUS.items() for v in kv])
    total = (
        F.lit(base) + F.when(same_namespace, 0.05).otherwise(0.0) + F.coalesce(F.element_at(bonus, node_type), F.lit(0.0))
        + F.when(priority >= 100, 0.03).when(priority >= 90, 0.02).when(priority >= 80, 0.01).otherwise(0.0)
    )
    return F.round(F.least(total, F.lit(1.0)), 3)


def match_blocks(b: DataFrame, idx: DataFrame) -> DataFrame:
    """Best node of each block, its article as a fallback, or unresolved."""
    c = candidates(b)
    hits = c.join(score_lookup(idx), ["norm", "expected"], "left")
    rank = F.when(F.col("hit").isNotNull(), F.struct(-F.col("hit.score"), -F.col("hit.match_priority"), F.col("hit.slug"), F.col("ord")))
    best = hits.groupBy("block_id").agg(
        F.min_by(F.struct("hit", "candidate"), rank).alias("m"), F.first("expected").alias("expected"), F.first("article").alias("article"))
    articles = idx.filter(F.col("node_type") == "artigo").select(F.col("anchor_text_norm").alias("art_norm"), "slug", "label", "namespace", "variant_origin", "match_priority")
    both = articles.withColumn("expected", F.explode(F.array(F.lit("cf"), F.lit("adct"))))
    order = F.struct((F.col("namespace") != F.col("expected")).cast("int"), -F.col("match_priority"), F.col("slug"))
    parents = both.groupBy("art_norm", "expected").agg(F.min_by(F.struct("slug", "label", "namespace", "variant_origin", "match_priority"), order).alias("p"))
    x = best.withColumn("art_norm", F.when(F.col("m").isNull() & (F.col("article") != ""), T.norm_key(F.concat(F.lit("Art. "), "article", F.lit("º")))))
    x = x.join(parents, ["art_norm", "expected"], "left")
    h, p = F.col("m.hit"), F.col("p")
    same = F.col("m.hit.namespace") == F.col("expected")
    return x.select(
        "block_id", F.coalesce(h["slug"], p["slug"], F.lit("")).alias("anchor_slug"), F.coalesce(h["label"], p["label"], F.lit("")).alias("anchor_label"),
        F.coalesce(h["node_type"], F.when(p.isNotNull(), "artigo"), F.lit("")).alias("anchor_node_type"),
        F.coalesce(h["namespace"], p["namespace"], F.col("expected")).alias("anchor_namespace"),
        F.when(h.isNotNull(), F.when(same, "exact").otherwise("adct")).when(p.isNotNull(), "parent").otherwise("unresolved").alias("anchor_quality"),
        F.when(h.isNotNull(), match_confidence(h["node_type"], h["match_priority"], same)).when(p.isNotNull(), 0.8).alias("anchor_confidence"),
        F.coalesce(F.col("m.candidate"), F.when(p.isNotNull(), F.concat(F.lit("Art. "), "article", F.lit("º"))), F.lit("")).alias("matched_variant"),
        F.coalesce(h["variant_origin"], p["variant_origin"], F.lit("")).alias("variant_origin"),
        F.coalesce(h["match_priority"], p["match_priority"]).alias("match_priority"), h["score"].alias("match_score"))


def nearest_ancestor(b: DataFrame, slugs: DataFrame) -> DataFrame:
    """Closest existing node of each block's slug: exact, parent, adct or none."""
    parts = F.split("slug_norm", "-")
    x = b.select("block_id", T.norm_slug("anchor_slug").alias("slug_norm"))
    ups = F.transform(F.sequence(F.lit(4), F.greatest(F.size(parts), F.lit(4))), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "-"))
    tries = x.filter(F.coalesce("slug_norm", F.lit("")) != "").select("block_id", "slug_norm", F.explode(F.array_distinct(F.concat(F.array("slug_norm"), ups))).alias("slug"))
    hit = tries.join(slugs.select("slug").distinct(), "slug").groupBy("block_id").agg(F.max_by("slug", F.length("slug")).alias("hit"))
    x = x.join(hit, "block_id", "left")
    adct = F.coalesce(F.col("slug_norm") == "adct", F.lit(False))
    return x.select(
        "block_id", "slug_norm", F.when(adct, "adct").otherwise(F.col("hit")).alias("matched"),
        F.when(adct, "adct").when(F.col("hit") == F.col("slug_norm"), "exact").when(F.col("hit").isNotNull(), "parent").otherwise("none").alias("match_type"))
