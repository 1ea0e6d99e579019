"""Mixing sources to target weights.

The words of a source, document after document, form a stream that is cut into blocks of
a fixed length. Every source gets as many block slots as its target asks for, and each output
shard of a fixed number of slots draws how many of them go to each source: a multinomial
draw with the sources' shares as chances. A running sum of a source's draws numbers its
slots. What the draws give a source beyond its slots goes to sources that were drawn too
seldom, in the shards where that happened, so shards stay full and sources meet their targets.
Slot ``k`` of a source reads the block at index ``k`` of the source's own pseudorandom
permutation, one pass after the other; documents and slots meet by (source, block).
The last slot of a source takes only the words that are missing to its target, so a source
gives its target rounded to whole words, and no word is taken more than three times.

The permutations are swap-or-not shuffles: exact on any range, nothing to sort or store.

Null texts have no words; documents without words are returned with nothing taken. A null
source is a source of its own, after all others; null ids are ordinary rows, ordered by a
digest of their texts. One narrow row per source is ranked in one task: sources are what a mix sets weights for. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from lexanchor.llm.common import WORD, query, table, written
from lexanchor.operators.keyed import compute_once, position_segment, segmented_scan

BLOCK_WORDS = 256
SHARD_SLOTS = 1024
WEIGHTS = 3
MAX_REPEATS = 3
SEED = 20
ROUNDS = 12
#: Buckets that split the documents of one source.
BUCKETS = 4096
#: Slots that one task draws or writes out.
TASK_SLOTS = 65536
#: Parts of the range of slots by which a draw finds its source.
CELLS = 4096

_P = 2147483647


def _shuffle_round(r: int, x: str, n: str, key: str, back: bool = False, div: str = "div") -> str:
    """SQL of one swap-or-not round of ``x`` in the range of ``n``; ``key`` tells permutations apart."""
    r = ROUNDS - 1 - r if back else r
    seed = (r * 69621 + SEED * 16807 + 1) % _P
    one = f"((({key} * 48271 + {seed}) % {_P}) * 40692 % {_P})"
    two = f"(({one} * {one}) % {_P})"
    partner = f"((({two} * 2147483648 + {one}) % {n} - {x} + {n}) % {n})"
    top = f"greatest({x}, {partner})"
    h = f"(({top} % {_P} + ({top} {div} {_P}) * 7919 + {one}) % {_P})"
    return f"case when ((({h} * {h}) % {_P} * 48271 + {two}) % {_P} {div} 256) % 2 = 1 then {partner} else {x} end"


def _shuffled(df: DataFrame, out: str, x: str, n: str, key: str, back: bool = False) -> DataFrame:
    df = df.withColumn("__x", F.expr(x))
    for r in range(ROUNDS):
        df = df.withColumn("__x", F.expr(_shuffle_round(r, "__x", n, key, back)))
    # filters on the result must not be pushed below, where they would copy all rounds
    return compute_once(df, {out: F.col("__x")}).drop("__x")


def source_targets(sources: DataFrame) -> DataFrame:
    """Adds rank, weight and target to one row per (source, source_size).

    Sources whose cap is small for their weight are capped first; the rest share what is
    left by weight. That is where resharing the excess ends.
    """
    everything = W.partitionBy()
    ranked = sources.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())).cast("long"))
    ranked = ranked.withColumns({"weight": (F.col("rank") - 1) % WEIGHTS + 1, "cap": F.col("source_size") * MAX_REPEATS})
    before = W.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(W.unboundedPreceding, -1)
    ranked = ranked.withColumns({
        "left_words": F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "left_weight": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
    })
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    ranked = ranked.withColumn("capped", wide("cap") * wide("left_weight") <= wide("left_words") * wide("weight"))
    ranked = ranked.withColumns({
        "free_words": F.max(F.when(~F.col("capped"), F.col("left_words"))).over(everything),
        "free_weight": F.max(F.when(~F.col("capped"), F.col("left_weight"))).over(everything),
    })
    share = F.col("free_words").cast("double") * F.col("weight") / F.col("free_weight")
    return ranked.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share)).select(
        "source", "source_size", "rank", "weight", "target")


def _slot_counts(targets: DataFrame, block: int) -> DataFrame:
    """Per source: blocks, full passes, slots of the last pass and the words of its last slot."""
    t = targets.filter("source_size > 0").withColumns({"words": F.round("target").cast("long")}).withColumns({
        "blocks": F.expr(f"(source_size + {block - 1}) div {block}"),
        "passes": F.expr("words div source_size"),
        "rest": F.expr("words % source_size"),
    }).withColumn("short", F.expr(f"source_size - (blocks - 1) * {block}"))
    t = _shuffled(t, "short_at", "blocks - 1", "blocks", "rank", back=True)
    full = f"(rest + {block - 1}) div {block}"
    t = t.withColumn("extra", F.expr(f"case when short_at >= {full} then {full} else (rest + {block} - short + {block - 1}) div {block} end"))
    t = t.withColumns({
        "slots": F.expr("passes * blocks + extra"),
        "last_words": F.expr(f"rest - ((extra - 1) * {block} - case when extra - 1 > short_at then {block} - short else 0 end)"),
    })
    before = W.orderBy("rank").rowsBetween(W.unboundedPreceding, -1)
    return t.withColumns({"slot_base": F.coalesce(F.sum("slots").over(before), F.lit(0)), "all_slots": F.sum("slots").over(W.partitionBy())})


def _found(points: DataFrame, at: str, ranges: DataFrame, start: str, length: str, total: int) -> DataFrame:
    """Points with the range that holds them; ranges follow each other from 0 to ``total``. An equi-join on parts of the range."""
    wide = -(-total // CELLS)
    cells = ranges.filter(f"{length} > 0").withColumn("cell", F.explode(F.expr(f"sequence({start} div {wide}, ({start} + {length} - 1) div {wide})")))
    return points.withColumn("cell", F.expr(f"{at} div {wide}")).join(cells, "cell").filter(f"{at} >= {start} and {at} < {start} + {length}").drop("cell")


def draw_counts(counts: DataFrame, shard_slots: int, all_slots: int) -> DataFrame:
    """(shard, rank, n): a multinomial draw of sources for the slots of each shard, the last shard may be shorter.

    Counts, not slots, are what is kept: each slot's draw is a hash of its number.
    """
    spark = counts.sparkSession
    draws = spark.range(0, all_slots, 1, max(1, -(-all_slots // TASK_SLOTS))).select(
        F.expr(f"id div {shard_slots}").alias("shard"), F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(all_slots)).alias("at"))
    return _found(draws, "at", counts.select("rank", "slot_base", "slots"), "slot_base", "slots", all_slots).groupBy("shard", "rank").agg(F.count("*").alias("n"))


def draw_slots(targets: DataFrame, block: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """One row per slot of the output: shard, slot, rank (of the source), pass, block, words it takes."""
    counts = written(_slot_counts(targets, block), "slot-counts")  # a row a source
    all_slots = counts.agg(F.max("all_slots")).first()[0] or 0
    if not all_slots:
        return counts.limit(0).select(*[F.lit(0).cast("long").alias(c) for c in ("shard", "slot", "rank", "pass", "block", "words")])
    drawn = written(draw_counts(counts, shard_slots, all_slots), "drawn")
    # a source's slots are numbered along the shards
    base = segmented_scan(drawn, ["rank"], ["shard"], position_segment("shard"), sums={"until": F.col("n")})
    in_shard = F.sum("n").over(W.partitionBy("shard").orderBy("rank").rowsBetween(W.unboundedPreceding, -1))
    base = base.withColumn("in_shard", F.coalesce(in_shard, F.lit(0))).repartition(max(1, -(-all_slots // TASK_SLOTS)), "shard", "rank")
    slots = base.withColumn("i", F.explode(F.expr("sequence(1L, n)"))).select(
        "shard", (F.col("in_shard") + F.col("i") - 1).alias("place"), "rank", (F.col("until") - F.col("n") + F.col("i") - 1).alias("k"))
    # draws beyond a source's slots fill the sources that were drawn too seldom
    totals = drawn.groupBy("rank").agg(F.sum("n").alias("drawn"))
    gaps = counts.join(totals, "rank", "left").select("rank", "slots", F.coalesce("drawn", F.lit(0)).alias("drawn"))
    before = W.orderBy("rank").rowsBetween(W.unboundedPreceding, -1)  # a row a source
    gaps = written(gaps.withColumns({"over": F.expr("greatest(drawn - slots, 0L)"), "under": F.expr("greatest(slots - drawn, 0L)")}).withColumns({
        "over_base": F.coalesce(F.sum("over").over(before), F.lit(0)), "under_base": F.coalesce(F.sum("under").over(before), F.lit(0))}), "gaps")
    missing = gaps.agg(F.sum("under")).first()[0]
    slots = written(slots.join(gaps.select("rank", "slots", "over_base"), "rank"), "slots")  # read twice, and plans stay small
    kept = slots.filter("k < slots").select("shard", "place", "rank", "k")
    if missing:
        extra = slots.filter("k >= slots").select("shard", "place", F.expr("over_base + k - slots").alias("q"))
        extra = _found(extra, "q", gaps.select("rank", "drawn", "under", "under_base"), "under_base", "under", missing)
        kept = kept.unionByName(extra.select("shard", "place", "rank", F.expr("drawn + q - under_base").alias("k")))
    kept = kept.join(counts, "rank")
    kept = _shuffled(kept, "block", "k % blocks", "blocks", "rank")
    return kept.select(
        "shard", F.col("place").alias("slot"), "rank", F.expr("k div blocks").alias("pass"), "block",
        F.expr(f"case when k = slots - 1 and extra > 0 then last_words when block = blocks - 1 then short else {block} end").alias("words"))


def with_words(docs: DataFrame) -> DataFrame:
    """Adds the number of words, a digest of the text and a row number; to be written before it is used twice."""
    return docs.withColumns({"size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"), "digest": F.xxhash64("text"),
                             "row": F.monotonically_increasing_id()})


def mix(sized: DataFrame, block: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> tuple[DataFrame, DataFrame]:
    """Places and takes of documents given as (row, doc_id, source, size, digest).

    Returns the documents with source_size and target, and one row per piece of a document
    in a slot: row, shard, slot, pass, from, until (word numbers in the document).
    """
    bucket = F.expr(f"coalesce(((doc_id % {_P}) * 48271 % {_P}) % {BUCKETS} + {BUCKETS}, pmod(digest, {BUCKETS})) % {BUCKETS}")
    docs = sized.select("row", "doc_id", "source", "size", "digest", bucket.alias("bucket"))
    parts = docs.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    targets = written(source_targets(parts.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))), "targets")
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    bases = parts.withColumn("base", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    t = targets.withColumnRenamed("source", "__source")
    bases = bases.join(t, F.col("source").eqNullSafe(F.col("__source"))).drop("__source", "bucket_size").withColumnsRenamed({"source": "__source", "bucket": "__bucket"})
    inner = W.partitionBy("source", "bucket").orderBy("doc_id", "size", "digest", "row").rowsBetween(W.unboundedPreceding, -1)
    placed = docs.withColumn("start", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    placed = placed.join(bases, placed["source"].eqNullSafe(bases["__source"]) & (placed["bucket"] == bases["__bucket"]))
    placed = placed.withColumn("start", F.col("start") + F.col("base")).select(
        "row", "doc_id", "source", "size", "source_size", "target", "rank", "start")
    pieces = placed.filter("size > 0").withColumn("block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
    pieces = pieces.select("row", "rank", "block", "start", F.expr(f"greatest(start - block * {block}, 0)").alias("lo"),
                           F.expr(f"least(start + size - block * {block}, {block})").alias("hi"))
    # slots come from a few rows per source, so their size is underestimated: they must not be broadcast
    taken = pieces.join(draw_slots(targets, block, shard_slots).hint("merge"), ["rank", "block"]).filter("words > lo").select(
        "row", "shard", "slot", "pass", F.expr(f"block * {block} + lo - start").alias("from"),
        F.expr(f"block * {block} + least(hi, words) - start").alias("until"))
    return placed, taken


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: one row per document and pass, with the words that the pass takes.

    A pass that takes a whole document keeps its text as it is; otherwise the words taken
    keep the white space before them. n_chars is counted again where the column exists. A
    document stands where its first piece does: rows are in the order of shards, and of a hash within them.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d")
    kept = written(docs.select(whole, "doc_id", "source", "text").transform(with_words).drop("text"), "mixed")
    _, taken = mix(kept)
    ranges = taken.groupBy("row", "pass").agg(
        F.sum(F.expr("until - from")).alias("n"), F.sort_array(F.collect_list(F.struct("from", "until"))).alias("ranges"), F.min(F.struct("shard", F.xxhash64("shard", "slot"))).alias("first"))
    met = kept.select("row", "size", "d").join(ranges, "row")
    # the words of a document that is taken in part, found once
    words = F.when(F.col("n") < F.col("size"), F.expr(r"regexp_extract_all(d.text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+', 0)"))
    met = compute_once(met, {"__w": words})
    parts = F.expr("array_join(flatten(transform(ranges, r -> slice(__w, int(r.from + 1), int(r.until - r.from)))), '')")
    text = F.when(F.col("n") == F.col("size"), F.col("d.text")).otherwise(F.regexp_replace(parts, r"^[\x20\x09-\x0D]+", ""))
    out = met.withColumn("__text", text).sortWithinPartitions("first")
    cols = {"text": F.col("__text"), "n_chars": F.length("__text").cast("long")}
    return out.select(*[(cols[c].cast(docs.schema[c].dataType) if c in cols else F.col(f"d.`{c}`")).alias(c) for c in docs.columns])


def _sql() -> str:
    b = BLOCK_WORDS

    def rounds(name: str, start: str, x: str, n: str, key: str, back: bool = False) -> str:
        text = f"{name}_0 as (select *, {x} as {name}_x from {start})"
        for r in range(ROUNDS):
            text += f",\n{name}_{r + 1} as (select * exclude ({name}_x), {_shuffle_round(r, f'{name}_x', n, key, back, '//')} as {name}_x from {name}_{r})"
        return text

    return f"""with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as size,
    (coalesce(((doc_id % {_P}) * 48271 % {_P}) % {BUCKETS} + {BUCKETS}, 0)) % {BUCKETS} as bucket, row_number() over (order by doc_id) as row from documents),
ranked as (
  select *, (rank - 1) % {WEIGHTS} + 1 as weight, source_size * {MAX_REPEATS} as cap from (
    select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as rank from sized group by source)),
sums as (
  select *, (select sum(source_size) from ranked) - coalesce(sum(cap) over w, 0) as left_words,
    (select sum(weight) from ranked) - coalesce(sum(weight) over w, 0) as left_weight
  from ranked window w as (order by cap / weight, rank rows between unbounded preceding and 1 preceding)),
capped as (select *, cap * left_weight <= left_words * weight as capped from sums),
free as (select max(left_words) as free_words, max(left_weight) as free_weight from capped where not capped),
targets as (
  select source, source_size, rank, case when capped then cast(cap as double) else cast(free_words as double) * weight / free_weight end as target
  from capped cross join free),
cut as (
  select *, (source_size + {b - 1}) // {b} as blocks, words // source_size as passes, words % source_size as rest,
    source_size - ((source_size + {b - 1}) // {b} - 1) * {b} as short
  from (select *, cast(round(target) as bigint) as words from targets where source_size > 0)),
{rounds("inv", "cut", "blocks - 1", "blocks", "rank", True)},
counts as (
  select *, case when inv_x >= (rest + {b - 1}) // {b} then (rest + {b - 1}) // {b} else (rest + {b} - short + {b - 1}) // {b} end as extra from inv_{ROUNDS}),
slots as (
  select *, unnest(range(0, passes * blocks + extra)) as k,
    rest - ((extra - 1) * {b} - case when extra - 1 > inv_x then {b} - short else 0 end) as last_words from counts),
{rounds("fwd", "slots", "k % blocks", "blocks", "rank")},
drawn as (
  select rank, fwd_x as block, case when k = passes * blocks + extra - 1 and extra > 0 then last_words
    when fwd_x = blocks - 1 then short else {b} end as words from fwd_{ROUNDS}),
placed as (
  select s.*, t.rank, t.source_size, t.target,
    coalesce(sum(s.size) over (partition by t.rank order by s.bucket, s.doc_id, s.size, s.row rows between unbounded preceding and 1 preceding), 0) as start
  from sized s join targets t on s.source is not distinct from t.source),
pieces as (select *, unnest(range(cast(start // {b} as bigint), cast((start + size - 1) // {b} + 1 as bigint))) as block from placed where size > 0),
taken as (
  select p.row, sum(greatest(0, least(p.start + p.size - p.block * {b}, d.words) - greatest(p.start - p.block * {b}, 0))) as n
  from pieces p join drawn d on p.rank = d.rank and p.block = d.block group by p.row)
select p.doc_id, cast(p.size as bigint) as size, p.source_size, p.target, cast(coalesce(t.n, 0) as bigint) as taken
from placed p left join taken t on p.row = t.row"""


@query("op2_mix_sources", _sql())
def op2(spark, sf_dir) -> DataFrame:
    sized = written(table(spark, sf_dir, "documents").select("doc_id", "source", "text").transform(with_words).drop("text"), "sized")
    placed, taken = mix(sized)
    per_row = taken.groupBy("row").agg(F.sum(F.expr("until - from")).alias("taken"))
    return placed.join(per_row, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
