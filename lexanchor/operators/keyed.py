"""Skew-safe building blocks used by the operators.

* ``first_per_key`` keeps one row per key. The rank filter lets Spark prune each
  map task to one row per key before the shuffle, so a key that holds a third of
  the table still sends at most one row per task.
* ``segmented_scan`` is a running computation over ordered rows (fill forward,
  running count, previous row) cut into order segments, so one huge document or
  case is spread over many tasks. Only one summary row per segment is ordered
  globally.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lexanchor.session import cut

SEGMENT = 4096


def first_per_key(df: DataFrame, keys: Sequence, order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of every key in the given order."""
    w = W.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k)
    return ranked.drop("__rn")


def compute_once(df: DataFrame, cols: Mapping[str, Column]) -> DataFrame:
    """Adds columns that are evaluated once per row.

    The one-element ``inline`` keeps later filters and projections from copying
    costly expressions (patterns over long texts) into every place that uses them.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def position_segment(pos, size: int = SEGMENT) -> Column:
    """Segment number of an integer position."""
    return F.floor((F.col(pos) if isinstance(pos, str) else pos) / size)


def time_segment(ts, seconds: int = 86400) -> Column:
    """Segment number of a timestamp."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_seconds(c.cast("timestamp")) / seconds)


def bounded_segments(df: DataFrame, keys: Sequence[str], order: Sequence[str], segment: Column, rows: int = SEGMENT) -> DataFrame:
    """Adds ``__seg``: the segment, cut again where a key has more than about ``rows`` rows in it.

    Only the rows of such segments are dealt to ranges of (keys, order), whose bounds Spark takes
    from a sample; a range never holds more than its share, so one busy day of one key is spread
    like any other rows. The others keep their segment as it is.
    """
    base = df.withColumn("__part", segment)
    sizes = cut(base.groupBy(*keys, "__part").agg(F.count("*").alias("__n")).filter(F.col("__n") > rows))
    crowded = sizes.agg(F.sum("__n")).first()[0]
    if crowded is None:
        return base.withColumn("__seg", F.struct("__part", F.lit(0).alias("__range"))).drop("__part")
    at = [*keys, "__part"]
    calm = base.join(sizes, at, "left_anti").withColumn("__range", F.lit(0))
    dealt = base.join(sizes, at, "left_semi").repartitionByRange(-(-crowded // rows) + 1, *keys, *order).withColumn("__range", F.spark_partition_id())
    both = calm.unionByName(cut(dealt))  # ranges stay what they were when a task runs again
    return both.withColumn("__seg", F.struct("__part", "__range")).drop("__part", "__range")


def segmented_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment: Column | str,
    fills: Mapping[str, Column] | None = None,
    counts: Mapping[str, Column] | None = None,
    prev: Mapping[str, Column] | None = None,
    descending: bool = False,
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Running values per key (keys must not be NULL).

    ``fills``: last non-null value up to and including the row; ``counts``: number of
    true flags up to and including the row; ``sums``: running totals of numbers; ``prev``: value
    on the row before.
    ``segment`` must not decrease along ``order``; the name of an existing column lets
    several scans in a row share one shuffle. With ``descending`` the scan runs
    backwards, which turns ``prev`` into "the row after".
    """
    fills, counts, prev, sums = fills or {}, counts or {}, prev or {}, sums or {}
    seg = segment if isinstance(segment, str) else "__seg"
    direct = {f"__v_{n}": c for n, c in {**fills, **counts, **sums}.items()}
    direct.update({f"__v_{n}": F.struct(c.alias("v")) for n, c in prev.items()})
    base = df.withColumns(direct if isinstance(segment, str) else {seg: segment, **direct})
    by = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    inner = W.partitionBy(*keys, seg).orderBy(*by)
    upto = inner.rowsBetween(W.unboundedPreceding, W.currentRow)

    pick = F.min_by if descending else F.max_by
    at = F.struct(*order)
    summary = base.groupBy(*keys, seg).agg(
        *[pick(f"__v_{n}", F.when(F.col(f"__v_{n}").isNotNull(), at)).alias(f"__c_{n}") for n in fills],
        *[F.count_if(F.col(f"__v_{n}")).alias(f"__c_{n}") for n in counts],
        *[F.sum(f"__v_{n}").alias(f"__c_{n}") for n in sums],
        *[pick(f"__v_{n}", at).alias(f"__c_{n}") for n in prev],
    )
    seg_order = F.col(seg).desc() if descending else F.col(seg).asc()
    before = W.partitionBy(*keys).orderBy(seg_order).rowsBetween(W.unboundedPreceding, -1)
    carry = summary.select(
        *keys, seg,
        *[F.last(f"__c_{n}", ignorenulls=True).over(before).alias(f"__c_{n}") for n in {**fills, **prev}],
        *[F.coalesce(F.sum(f"__c_{n}").over(before), F.lit(0)).alias(f"__c_{n}") for n in {**counts, **sums}],
    )
    local = base.withColumns({
        **{f"__l_{n}": F.last(f"__v_{n}", ignorenulls=True).over(upto) for n in fills},
        **{f"__l_{n}": F.count_if(F.col(f"__v_{n}")).over(upto) for n in counts},
        **{f"__l_{n}": F.coalesce(F.sum(f"__v_{n}").over(upto), F.lit(0)) for n in sums},
        **{f"__l_{n}": F.lag(f"__v_{n}").over(inner) for n in prev},
    })
    return local.join(carry, [*keys, seg], "left").select(
        *df.columns,
        *[F.coalesce(f"__l_{n}", f"__c_{n}").alias(n) for n in fills],
        *[(F.col(f"__l_{n}") + F.coalesce(f"__c_{n}", F.lit(0))).alias(n) for n in {**counts, **sums}],
        *[F.coalesce(f"__l_{n}", f"__c_{n}")["v"].alias(n) for n in prev],
    )


def with_rate(part, total, digits: int = 3) -> Column:
    """Rounded ratio, NULL over zero."""
    p, t = (F.col(x) if isinstance(x, str) else x for x in (part, total))
    return F.round(p.cast("double") / F.nullif(t.cast("double"), F.lit(0.0)), digits)
