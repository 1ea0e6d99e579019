"""Integrity rules and the data contract as jobs that return violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexanchor import vocab as V
from lexanchor.functions.text import jget
from lexanchor.operators.core import active
from lexanchor.operators.keyed import first_per_key


def slug_collisions(o: DataFrame, a: DataFrame) -> DataFrame:
    """Slugs used by an object and by an actor."""
    return o.select("slug").intersect(a.select("slug"))


def check_slugs(o: DataFrame, a: DataFrame) -> DataFrame:
    """Slugs that occur more than once across objects and actors."""
    u = o.select("slug", F.lit(1).alias("o")).unionByName(a.select("slug", F.lit(0).alias("o")))
    return u.groupBy("slug").agg(F.sum("o").alias("in_objects"), F.sum(1 - F.col("o")).alias("in_actors")).filter(
        F.col("in_objects") + F.col("in_actors") > 1)


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def check_multiplicity(e: DataFrame, et: DataFrame) -> DataFrame:
    """Active edges repeated for a type that allows one per pair."""
    single = F.broadcast(et.filter(~F.col("allows_multiple")).select("type_slug"))  # closed vocabulary
    return active(e).join(single, "type_slug", "left_semi").groupBy("type_slug", "source_id", "target_id").agg(
        F.count("*").alias("n")).filter(F.col("n") > 1)


def check_weight(e: DataFrame, et: DataFrame) -> DataFrame:
    must = F.broadcast(et.filter(F.col("weight_required")).select("type_slug"))
    return e.filter(F.col("weight").isNull()).join(must, "type_slug", "left_semi").select("edge_id", "type_slug", "source_id", "target_id")


def row_hash(df: DataFrame, skip: tuple[str, ...] = ()) -> Column:
    cols = [c for c in df.columns if c not in skip]
    return F.md5(F.to_json(F.struct(*cols)))


def check_append_only(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of the old snapshot that disappeared or changed."""
    o = old.select(key, row_hash(old).alias("__o"))
    n = new.select(key, row_hash(new).alias("__n"))
    return o.join(n, key, "left").filter(F.col("__n").isNull() | (F.col("__n") != F.col("__o"))).select(
        key, F.when(F.col("__n").isNull(), "removed").otherwise("changed").alias("violation"))


def dangling(df: DataFrame, ref: str, target: DataFrame, key: str, check: str, ident: str) -> DataFrame:
    """Rows whose reference has no target; NULL references are fine."""
    t = target.select(F.col(key).alias(ref)).distinct()
    return df.filter(F.col(ref).isNotNull()).join(t, ref, "left_anti").select(
        F.lit(check).alias("check"), F.col(ident).alias("id"), F.col(ref).alias("reference"))


def check_refs(o, a, ev, e, ot, at, evt, et) -> DataFrame:
    """Every broken reference of the four primitives."""
    parts = [
        dangling(o, "type_slug", ot, "type_slug", "objects.type_slug", "id"),
        dangling(a, "type_slug", at, "type_slug", "actors.type_slug", "id"),
        dangling(ev, "type_slug", evt, "type_slug", "events.type_slug", "event_id"),
        dangling(ev, "actor_id", a, "id", "events.actor_id", "event_id"),
        dangling(ev, "causation_id", ev, "event_id", "events.causation_id", "event_id"),
        dangling(ev, "aggregate_id", o.select("id").unionByName(a.select("id")), "id", "events.aggregate_id", "event_id"),
        dangling(e, "type_slug", et, "type_slug", "edges.type_slug", "edge_id"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_enums(df: DataFrame, rules: dict[str, list[str]], ident: str) -> DataFrame:
    """Values outside the allowed lists."""
    bad = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull() & ~F.col(c).isin(allowed), F.struct(F.lit(c).alias("column"), F.col(c).alias("value")))
        for c, allowed in rules.items()
    ]))
    return df.select(ident, F.explode(bad).alias("b")).select(ident, "b.*")


PROVENANCE_RULES = {"target_table": V.TARGET_TABLES, "source_type": V.SOURCE_TYPES}
PROFILE_RULES = {"profile_type": V.PROFILE_TYPES, "status": V.PROFILE_STATUS}
PROPOSAL_RULES = {"proposal_type": V.PROPOSAL_TYPES, "status": V.PROPOSAL_STATUS}


def contract_table(kind: str) -> Column:
    """Literal map: type -> field lists per level."""
    levels = ["OBR", "REC", "INF", "PRO", "EXT", "COL"]

    def names(s: str) -> Column:
        return F.array(*[F.lit(x) for x in s.split()]).cast("array<string>")

    rows = []
    for (k, t), spec in V.CONTRACT.items():
        if k == kind:
            rows += [F.lit(t), F.struct(*[names(spec.get(lv, "")).alias(lv) for lv in levels])]
    return F.create_map(*rows)


def validate_contract(df: DataFrame, kind: str, ident: str) -> DataFrame:
    """Contract violations per row: id, type, rule, field and severity.

    For edges ``weight`` and ``payload`` count as fields when they are set.
    """
    keys = F.coalesce(F.json_object_keys("payload"), F.array().cast("array<string>"))
    if kind == "edges":
        own = [F.when(F.col(c).isNotNull(), F.lit(c)) for c in ("weight", "payload")]
        keys = F.concat(keys, F.array_compact(F.array(*own)))
    x = df.select(ident, "type_slug", keys.alias("keys"), F.element_at(contract_table(kind), F.col("type_slug")).alias("c"),
                  jget("payload", "collegiality_mode").alias("mode")).filter(F.col("c").isNotNull())
    signed = F.array_contains("keys", "extraction_method") & F.array_contains("keys", "confidence_score")
    none = F.array().cast("array<string>")

    def found(fields: Column, rule: str, severity: str) -> Column:
        return F.transform(fields, lambda f: F.struct(f.alias("field"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity")))

    all_ = F.concat(
        found(F.array_except("c.OBR", "keys"), "OBR missing", "reject"),
        found(F.array_intersect("c.PRO", "keys"), "PRO present", "reject"),
        found(F.when(signed, none).otherwise(F.array_intersect("c.EXT", "keys")), "EXT unsigned", "reject"),
        found(F.when(F.col("mode") == "colegiado", F.array_except("c.COL", "keys")).otherwise(none), "OBR missing", "reject"),
        found(F.array_except("c.REC", "keys"), "REC missing", "warning"),
        found(F.array_except("c.INF", "keys"), "INF missing", "warning"),
    )
    return x.select(ident, "type_slug", F.explode(all_).alias("v")).select(ident, "type_slug", "v.*")


def contract_summary(violations: DataFrame) -> DataFrame:
    return violations.groupBy("type_slug", "severity", "rule", "field").agg(F.count("*").alias("n"))


def complete_judgments(ev: DataFrame, e: DataFrame, roles: DataFrame) -> DataFrame:
    """Collegiate judgments with all required fields, a rapporteur edge and a rapporteur role.

    A payload is made and read once: ``json_tuple`` gives all its fields, and no filter copies the payload's expression.
    """
    fields = [f"__{f}" for f in V.COMPLETE_JUDGMENT]
    j = ev.filter(F.col("type_slug") == "julgamento").select(
        "event_id", "aggregate_id", F.json_tuple("payload", "collegiality_mode", *V.COMPLETE_JUDGMENT).alias("__mode", *fields))
    j = j.filter(F.col("__mode") == "colegiado").dropna(subset=fields).select("event_id", "aggregate_id")
    ruled = active(e.filter(F.col("type_slug") == "relator_de")).select(F.col("target_id").alias("aggregate_id"))
    seated = roles.filter(F.col("type_slug") == "exerce_papel").select(F.col("target_id").alias("aggregate_id"), F.json_tuple("payload", "role").alias("__role"))
    seated = seated.filter(F.col("__role") == "relator").select("aggregate_id")
    return j.join(ruled, "aggregate_id", "left_semi").join(seated, "aggregate_id", "left_semi").select("event_id", "aggregate_id")


def missing_provenance(df: DataFrame, pv: DataFrame, table: str, ident: str = "id") -> DataFrame:
    p = pv.filter(F.col("target_table") == table).select(F.col("target_id").alias(ident))
    return df.join(p, ident, "left_anti")


def best_by_confidence(pv: DataFrame) -> DataFrame:
    """The provenance row that wins for each target: highest confidence, then newest."""
    return first_per_key(pv, ["target_table", "target_id"],
                         [F.col("confidence").desc_nulls_last(), F.col("produced_at").desc(), F.col("provenance_id").asc()])
