"""Deduplication, comparison with an official source, and snapshot differences."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lexanchor.functions import text as T
from lexanchor.operators.blocks import filled
from lexanchor.operators.keyed import compute_once, first_per_key, with_rate


# -------------------------------------------------------------- deduplication
def _key(c) -> Column:
    return F.concat_ws("-", F.md5(c), F.length(c))


def dedup_prefix(b: DataFrame, order: str = "block_id", size: int | None = None) -> DataFrame:
    """First block per anchor and trimmed text, or its first ``size`` characters."""
    head = F.trim(F.coalesce("block_text", F.lit("")))
    head = head if size is None else F.substring(head, 1, size)
    return first_per_key(b, [_key(head), F.coalesce("anchor_slug", F.lit(""))], [F.col(order).asc()])


def dedup_exact(b: DataFrame, order: str = "block_id") -> DataFrame:
    """First block per anchor and whole text."""
    whole = F.coalesce("block_text", F.lit(""))
    return first_per_key(b, [_key(whole), F.coalesce("anchor_slug", F.lit(""))], [F.col(order).asc()])


def removed_count(before: DataFrame, after: DataFrame) -> DataFrame:
    n = before.agg(F.count("*").alias("n")).select(F.lit(1).alias("sign"), "n").unionByName(
        after.agg(F.count("*").alias("n")).select(F.lit(-1).alias("sign"), "n"))
    return n.agg(F.sum(F.when(F.col("sign") == 1, F.col("n"))).alias("total"), F.sum(F.col("sign") * F.col("n")).alias("removed"))


def split_processes(b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One process per key, described by its first block, and its records."""
    rec = b.filter(filled("process_key"))
    first = F.struct("process_class", "process_number", "relator", "redator", "julgamento_data", "dje_data", "tema_rg")
    slug = F.concat(F.lit("stf-"), F.replace(F.lower("process_key"), F.lit("_"), F.lit("-")))
    proc = rec.groupBy("process_key").agg(F.min_by(first, F.col("block_id")).alias("p"), F.count("*").alias("records")).select(
        "process_key", slug.alias("process_slug"), "p.*", "records")
    return proc, rec.select("block_id", "process_key", slug.alias("process_slug"))


def dedup_actors(a: DataFrame, name: str = "name") -> DataFrame:
    """One actor per normalized canonical name, with its hash."""
    h = F.md5(T.norm_key(T.canonical_name(name)))
    return first_per_key(a.withColumn("dedup_hash", h), ["dedup_hash"], [F.col("id").asc()])


# -------------------------------------------------------------- reconciliation
def truth_keys(truth: DataFrame, key: Callable, size: int, min_length: int, tie: str) -> DataFrame:
    """Key, first position and article of the official texts; ``tie`` picks among equal keys."""
    t = compute_once(truth, {"key": F.substring(key("text"), 1, size)}).filter(F.length("key") >= min_length)
    art = F.min_by("article", "pos") if tie == "first" else F.max_by("article", "pos")
    return t.groupBy("key").agg(F.min("pos").alias("first_pos"), art.alias("article"))


def reconcile_prefix(
    b: DataFrame, truth: DataFrame, lengths: Sequence[int], key: Callable = T.word_key, min_length: int = 1,
    full_prefix: bool = True, tie: str = "first", any_shorter: tuple[int, int] | None = None, truth_min: int | None = None,
) -> DataFrame:
    """Official article of each block by the longest shared key prefix, and the slug it implies.

    Every length is one lookup level, all joined at once on (level, prefix); the
    longest level wins. ``full_prefix`` asks keys to be as long as the level.
    ``any_shorter=(low, high)`` adds exact lookups for block keys of low..high-1
    characters that open a longer official key. ``truth_min`` is the least length of
    official keys where it is not that of block keys.
    """
    top = max(lengths)
    keys = truth_keys(truth, key, top, min_length if truth_min is None else truth_min, tie)

    def levels(df: DataFrame, *keep: str) -> DataFrame:
        rows = []
        for i, n in enumerate(sorted(lengths, reverse=True)):
            p = F.struct(F.lit(i).alias("level"), F.substring("key", 1, n).alias("prefix"))
            rows.append(F.when(F.length("key") >= n, p) if full_prefix else p)
        return df.select(*keep, F.explode(F.array_compact(F.array(*rows))).alias("l")).select(*keep, "l.*")

    look = levels(keys, "first_pos", "article")
    ours = b.select("block_id", "anchor_slug", T.article_of("anchor_slug").alias("our_article"), "block_text")
    usable = ours.filter(filled("block_text") & F.col("our_article").isNotNull())
    k = compute_once(usable, {"key": F.substring(key("block_text"), 1, top)}).select("block_id", "key").filter(F.length("key") >= min_length)
    probe = levels(k, "block_id")
    if any_shorter:
        low, high = any_shorter
        short_level = len(lengths) + F.length("key")
        probe = probe.unionByName(k.filter(F.length("key") < high).select("block_id", short_level.alias("level"), F.col("key").alias("prefix")))
        sizes = F.sequence(F.lit(low), F.least(F.length("key"), F.lit(high - 1)))
        look = look.unionByName(keys.filter(F.length("key") >= low).select("first_pos", "article", F.explode(sizes).alias("n"), "key").select(
            "first_pos", "article", (F.lit(len(lengths)) + F.col("n")).alias("level"), F.substr("key", F.lit(1), F.col("n")).alias("prefix")))
    look = look.groupBy("level", F.md5("prefix").alias("prefix")).agg(F.min_by("article", "first_pos").alias("truth_article"))
    hit = probe.select("block_id", "level", F.md5("prefix").alias("prefix")).join(look, ["level", "prefix"]).groupBy("block_id").agg(
        F.min("level").alias("level"), F.min_by("truth_article", "level").alias("truth_article"))
    x = ours.drop("block_text").join(hit, "block_id", "left")
    moved = F.col("truth_article") != F.col("our_article")
    return x.select(
        "block_id", "anchor_slug", "our_article", "truth_article", "level",
        F.when(F.col("truth_article").isNull(), "unmatched").when(moved, "fixed").otherwise("correct").alias("status"),
        F.when(moved, T.move_slug("anchor_slug", "truth_article")).otherwise(F.col("anchor_slug")).alias("new_slug"))


def reconcile_80_50(b, truth):
    return reconcile_prefix(b, truth, [80, 50], key=lambda c: T.word_key(c, prefixes=False), min_length=21, full_prefix=False)


def reconcile_cascade(b, truth):
    return reconcile_prefix(b, truth, [100, 80, 60, 40])


def reconcile_ascii(b, truth):
    return reconcile_prefix(b, truth, [80, 60, 40], key=T.ascii_key, min_length=30, full_prefix=False)


def fix_boundaries(b, truth):
    """Fix log on 100-character keys with a 60-character fallback; the last equal official key counts."""
    return reconcile_prefix(b, truth, [100, 60], key=T.boundary_key, min_length=20, tie="last", full_prefix=False, any_shorter=(20, 60), truth_min=21)


def fix_patterns(log: DataFrame) -> DataFrame:
    return log.filter(F.col("status") == "fixed").groupBy("our_article", "truth_article").agg(F.count("*").alias("n"))


def reconcile_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count("*").alias("n"))


def compare_counts(ours: DataFrame, truth: DataFrame, key: str, abs_tol: int = 2, rel_tol: float = 0.10) -> DataFrame:
    """Counts per key on both sides with difference, percent and tolerance class."""
    o = ours.groupBy(key).agg(F.count("*").alias("ours"))
    t = truth.groupBy(key).agg(F.count("*").alias("truth"))
    x = o.join(t, key, "full").na.fill(0, ["ours", "truth"])
    d = F.col("ours") - F.col("truth")
    near = (F.abs(d) <= abs_tol) | ((F.col("truth") > 0) & (F.abs(d / F.col("truth")) <= rel_tol))
    pct = F.when(F.col("truth") > 0, F.round(d * 100.0 / F.col("truth"), 1)).otherwise(F.when(F.col("ours") > 0, 100.0).otherwise(0.0))
    return x.select(
        key, "ours", "truth", d.alias("diff"), pct.cast("double").alias("pct_diff"),
        F.when(d == 0, "perfect").when(near, "ok").otherwise("diverge").alias("match_class"),
        F.when(near, "OK").when(d < 0, "DEFICIT").otherwise("EXCESSO").alias("status"))


def top_divergence(cmp: DataFrame, key: str, k: int = 20) -> DataFrame:
    return cmp.filter(F.col("match_class") == "diverge").orderBy(F.abs("diff").desc(), key).limit(k)


def comparison_summary(cmp: DataFrame) -> DataFrame:
    return cmp.agg(
        F.count("*").alias("keys"), F.count_if(F.col("match_class") == "perfect").alias("perfect"),
        F.count_if(F.col("status") == "OK").alias("ok"), F.count_if(F.col("match_class") == "diverge").alias("diverge"),
        F.sum("ours").alias("ours"), F.sum("truth").alias("truth"))


def expect_count(df: DataFrame, expected: int, name: str = "rows") -> DataFrame:
    return df.agg(F.count("*").alias("actual")).select(
        F.lit(name).alias("check"), "actual", F.lit(expected).cast("bigint").alias("expected"), (F.col("actual") == expected).alias("ok"))


# ------------------------------------------------------------------ snapshots
def snapshot_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Status of every key: new, removed or kept."""
    o, n = old.select(F.col(key), F.lit(True).alias("__o")), new.select(F.col(key), F.lit(True).alias("__n"))
    return o.join(n, key, "full").select(
        key, F.when(F.col("__o").isNull(), "new").when(F.col("__n").isNull(), "removed").otherwise("kept").alias("status"))


def missing_keys(spine: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return spine.join(b.select(key), key, "left_anti")


def union_namespaces(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


# -------------------------------------------------------------- parent anchors
def parent_audit(b: DataFrame) -> DataFrame:
    """Level lost by a parent match, and the confidence that loss leaves.

    Reads ``anchor_slug_norm`` (asked for) and ``anchor_slug`` (found).
    """
    def had(t):
        return F.coalesce("anchor_slug_norm", F.lit("")).contains(f"-{t}-") & ~F.coalesce("anchor_slug", F.lit("")).contains(f"-{t}-")

    lost = F.when(had("ali"), "alinea->pai").when(had("inc"), "inciso->art").when(had("par"), "paragrafo->art").otherwise("outro")
    conf = F.when(had("ali"), 0.5).when(had("inc"), 0.6).when(had("par"), 0.7).otherwise(0.8)
    m = F.col("match_type")
    return b.withColumns({
        "lost_level": F.when(m == "parent", lost),
        "anchor_quality": F.when(m.isin("exact", "parent", "adct"), m).otherwise("unresolved"),
        "anchor_confidence": F.when(m == "exact", 1.0).when(m == "parent", conf).when(m == "adct", 0.3).otherwise(0.0),
    })


def lost_level_report(audit: DataFrame) -> DataFrame:
    g = audit.filter(F.col("match_type") == "parent").groupBy("lost_level").agg(F.count("*").alias("n"))
    return g.withColumn("share", with_rate("n", g.agg(F.sum("n")).scalar(), 3))
