"""Near duplicates by HyperMinHash.

A text's set holds its distinct five-word shingles as 64-bit hashes. The leading bits of a
hash choose one of 128 buckets; a bucket's register keeps the smallest hash in it as its
count of leading zeros and nine mantissa bits. Empty buckets borrow the register of the
first filled bucket on a fixed pseudorandom path (for band keys only). Bands of four
registers give keys. Texts that share a key are candidates; a Jaccard estimate from the
registers, corrected for registers that agree by accident, drops those more than five
standard deviations below the threshold, and full sets decide about the rest.

No group is expanded into its pairs. Texts with equal sets are one class. In each key the
classes are first compared with one member (the least, then random ones), which joins a
large group of near copies into few components; after that only members of different
components are compared, those outside the key's largest component with blocks of bounded
size, and a block returns one link for each two components that it joins. So a link
between different components is never skipped.

Words are separated by ASCII white space after A-Z is lower-cased. Fewer than five words
are one shingle; without words or text a row is alone with an empty set. Rows with a null
id take part; the component's id is the least id that is not null. Of rows equal in id and
component all are marked alike. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lexanchor.llm.common import batch_of, mix, query, rows, table, written, written_few

SHINGLE_WORDS = 5
#: Links need 100 * intersection >= THRESHOLD * union.
THRESHOLD = 75
BUCKET_BITS, MANTISSA_BITS = 7, 9
BUCKETS = 1 << BUCKET_BITS
BAND_ROWS = 4
BANDS = BUCKETS // BAND_ROWS
DEVIATIONS = 5.0
#: Classes of one key that a task compares with those outside the key's largest component.
BLOCK = 2048
REMEMBERED_WORDS = 150_000

_FACTORS = mix(np.arange(1, SHINGLE_WORDS + 1, dtype=np.uint64)) | np.uint64(1)
#: For each bucket the order in which it looks for a filled one.
_PATHS = np.argsort(mix(np.arange(BUCKETS * BUCKETS, dtype=np.uint64)).reshape(BUCKETS, BUCKETS), axis=1)
_WORDS: dict[bytes, int] = {}


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = [_WORDS.get(w) for w in words]
    if None in hashes:
        if len(_WORDS) > REMEMBERED_WORDS:
            _WORDS.clear()
        for i, h in enumerate(hashes):
            if h is None:
                w = words[i]
                hashes[i] = h = xxhash.xxh3_64_intdigest(w)
                if len(w) <= 64:
                    _WORDS[w] = h
    h = np.array(hashes, np.uint64)
    n = len(h)
    if n < SHINGLE_WORDS:
        return mix((h * _FACTORS[:n]).sum(dtype=np.uint64).reshape(1) + np.uint64(n))
    grams = h[:n - SHINGLE_WORDS + 1] * _FACTORS[0]
    for j in range(1, SHINGLE_WORDS):
        grams += h[j:n - SHINGLE_WORDS + 1 + j] * _FACTORS[j]
    return np.unique(mix(grams))


def sketch(grams: np.ndarray) -> np.ndarray:
    """Registers of a sorted set: 1 + leading zeros and mantissa of the least hash in each bucket, 0 where it is empty."""
    out = np.zeros(BUCKETS, np.uint16)
    bucket = (grams >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(grams) else np.zeros(0, np.int64)
    rest = grams[first] << np.uint64(BUCKET_BITS)
    zeros = np.minimum(64 - np.frexp(rest.astype(np.float64))[1], 62)
    mantissa = (rest << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA_BITS)
    out[bucket[first]] = (zeros << MANTISSA_BITS) + mantissa.astype(np.int64) + 1
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One key for each band, from registers with empty buckets filled."""
    filled = registers > 0
    empty = np.flatnonzero(~filled)
    if len(empty):
        paths = _PATHS[empty]
        registers = registers.copy()
        registers[empty] = registers[paths[np.arange(len(empty)), filled[paths].argmax(axis=1)]]
    keys = np.arange(BANDS, dtype=np.uint64)
    for j in range(BAND_ROWS):
        keys = mix(keys ^ (registers[j::BAND_ROWS].astype(np.uint64) << np.uint64(20)))
    return keys.view(np.int64)


def may_link(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Whether pairs of registers (rows) may reach the threshold, by corrected estimate and by sizes."""
    both = ((a > 0) & (b > 0)).sum(axis=-1)
    any_ = ((a > 0) | (b > 0)).sum(axis=-1)
    same = ((a == b) & (a > 0)).sum(axis=-1)
    na, nb = na.astype(np.float64), nb.astype(np.float64)
    accident = both * 0.75 * 2.0 ** -MANTISSA_BITS * na * nb / (na + nb) ** 2
    j = (same - accident) / np.maximum(any_ - accident, 1)
    least = THRESHOLD / 100
    near = j >= least - DEVIATIONS * np.sqrt(least * (1 - least) / np.maximum(any_, 1))
    return near & (100 * np.minimum(na, nb) >= THRESHOLD * np.maximum(na, nb))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("sig", pa.binary()), ("n", pa.int64()), ("sketch", pa.binary())])
    out: list[list] = [[], [], [], [], []]
    for doc_id, key, text in rows(batches):
        grams = shingle_set(text)
        has = len(grams) > 0
        sig = hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if has else None
        for col, v in zip(out, (doc_id, key, sig, len(grams), sketch(grams).tobytes() if has else None), strict=True):
            col.append(v)
        if len(out[0]) >= 4096:
            yield batch_of(schema, out)
            out = [[], [], [], [], []]
    yield batch_of(schema, out)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            keys = [band_keys(np.frombuffer(s, np.uint16)) for s in part.column("sketch").to_pylist()]
            sigs = part.column("sig").take(pa.array(np.repeat(np.arange(part.num_rows), BANDS)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), sigs], names=["key", "sig"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("sig", pa.binary()), ("grams", pa.list_(pa.int64()))])
    last = None
    for sig, text in rows(batches):
        if sig != last:  # rows equal in id and text come one after the other
            yield batch_of(schema, [[sig], [shingle_set(text).view(np.int64)]])
        last = sig


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("sketch_a", "sketch_b"))
            good = may_link(a, b, batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy())
            yield batch.select(["a", "b"]).filter(pa.array(good))


def _passing(pdf: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each probe of a block its row and the block's own rows of other components that it may link to."""
    own = np.flatnonzero(pdf["own"])
    regs = np.frombuffer(b"".join(pdf["sketch"].iloc[own]), np.uint16).reshape(-1, BUCKETS)
    sizes, labels = pdf["n"].to_numpy(), pdf["label"].to_numpy()
    for i in np.flatnonzero(~pdf["own"]):
        other = np.flatnonzero(labels[own] != labels[i])
        if len(other):
            mine = np.frombuffer(pdf["sketch"].iloc[i], np.uint16)
            good = other[may_link(regs[other], mine[None, :], sizes[own][other], sizes[i:i + 1])]
            if len(good):
                yield i, own[good], (regs[good] == mine).sum(axis=1)


def _cross_members(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Members of a block that may link to another component."""
    found: set[int] = set()
    for i, others, _ in _passing(pdf):
        found.add(i)
        found.update(others.tolist())
    return pd.DataFrame({"sig": list(pdf["sig"].iloc[sorted(found)].unique())})


def _cross_links(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Links by full sets that join components within a block, likeliest first: one for each pair of components at most."""
    sigs, labels, grams = pdf["sig"].to_numpy(), pdf["label"].to_numpy(), pdf["grams"].to_numpy()
    top: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while x in top:
            x = top[x]
        return x

    a, b = [], []
    for i, others, same in _passing(pdf):
        for j in others[np.argsort(-same, kind="stable")]:
            one, two = find(labels[i]), find(labels[j])
            if one != two:
                common = len(np.intersect1d(grams[i], grams[j], assume_unique=True))
                if 100 * common >= THRESHOLD * (len(grams[i]) + len(grams[j]) - common):
                    top[one] = two
                    a.append(sigs[i])
                    b.append(sigs[j])
    return pd.DataFrame({"a": a, "b": b})


def components(links: DataFrame) -> DataFrame:
    """Component labels (least member) of the nodes of undirected links (a, b), by contraction.

    Each round hooks every label to its least neighbour, shortens the chains and relabels
    the links; links within a component fall away, so the rest shrinks fast.
    """
    nodes = written_few(links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("label", F.col("node")), "nodes")
    rest = links.select("a", "b").filter("a <> b")
    while True:
        rest = written_few(rest.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
        if rest.isEmpty():
            return nodes
        hooks = written_few(rest.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")), "hooks")
        while True:  # each step halves the length of the chains
            above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            moved = written_few(hooks.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), "hooks")
            hooks = moved.select("node", "up")
            if moved.filter("moved").isEmpty():
                break
        up = hooks.select(F.col("node").alias("label"), "up")
        nodes = written_few(nodes.join(up, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "nodes")
        for side in ("a", "b"):
            rest = rest.join(hooks.select(F.col("node").alias(side), "up"), side, "left").withColumn(side, F.coalesce("up", side)).drop("up")
        rest = rest.filter("a <> b")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links between labelled nodes."""
    one = links.join(labels.select(F.col("sig").alias("a"), F.col("label").alias("la")), "a").join(
        labels.select(F.col("sig").alias("b"), F.col("label").alias("lb")), "b").select(F.col("la").alias("a"), F.col("lb").alias("b")).filter("a <> b")
    merged = components(written_few(one.distinct(), "label-links")).select(F.col("node").alias("label"), F.col("label").alias("top"))
    return written_few(labels.join(merged, "label", "left").select("sig", F.coalesce("top", "label").alias("label")), "labels")


def _marked(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` with the component's label, which is null for rows with an empty set."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = written(keyed.mapInArrow(_sketches, "doc_id long, text_key long, sig binary, n long, sketch binary"), "sketches")
    classes = written(found.filter("n > 0").groupBy("sig").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_key")).alias("place"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")

    keys = classes.select("sig", "sketch").mapInArrow(_keys, "key long, sig binary")
    shares = keys.groupBy("key").agg(F.count("*").alias("members"), F.min("sig").alias("hub")).filter("members > 1")
    shared = written(keys.join(shares, "key"), "shared")
    short = classes.select("sig", "n", "sketch")

    def estimated(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(short.select(F.col("sig").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")), side)
        return pairs.mapInArrow(_estimate, "a binary, b binary")

    pairs = written_few(estimated(shared.filter("sig <> hub").select(F.col("sig").alias("a"), F.col("hub").alias("b")).distinct()), "pairs")

    def sets_of(members: DataFrame) -> DataFrame:
        place = classes.join(members, "sig", "left_semi").select("sig", F.col("place.doc_id").alias("__id"), F.col("place.text_key").alias("__key"))
        met = keyed.join(place, keyed["doc_id"].eqNullSafe(place["__id"]) & (keyed["text_key"] == place["__key"]))
        return written(met.select("sig", "text").mapInArrow(_sets, "sig binary, grams array<long>"), "sets")

    def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        met = pairs
        for side in ("a", "b"):
            met = met.join(sets.select(F.col("sig").alias(side), F.col("grams").alias(f"grams_{side}")), side)
        met = met.withColumn("common", F.size(F.array_intersect("grams_a", "grams_b")))
        return written_few(met.filter(100 * F.col("common") >= THRESHOLD * (F.size("grams_a") + F.size("grams_b") - F.col("common"))).select("a", "b"), "verified")

    ends = lambda p: p.select(F.col("a").alias("sig")).union(p.select("b")).distinct()

    def across(pairs: DataFrame) -> DataFrame:
        """The pairs whose ends are in different components."""
        for side in ("a", "b"):
            pairs = pairs.join(labels.select(F.col("sig").alias(side), F.col("label").alias(f"l_{side}")), side)
        return pairs.filter("l_a <> l_b").select("a", "b")

    sets = sets_of(ends(pairs))
    labels = written_few(shared.select("sig").distinct().withColumn("label", F.col("sig")), "labels")
    # the least hub of each class joins most; the other hubs are only asked where components still differ
    labels = _relabelled(labels, verified(pairs.groupBy("a").agg(F.min("b").alias("b")), sets))
    rest = written_few(across(pairs), "pairs")
    if not rest.isEmpty():
        labels = _relabelled(labels, verified(rest, sets))

    def mixed_keys(labels: DataFrame) -> DataFrame:
        """Members of keys with several components, where more than the first hub's pairs are open."""
        met = shared.filter("members > 2").join(labels, "sig")
        parts = met.groupBy("key", "label").agg(F.count("*").alias("k"))
        per = parts.groupBy("key").agg(F.max(F.struct("k", "label")).alias("top"), F.sum("k").alias("total"), F.count("*").alias("parts")).filter("parts > 1")
        return written_few(met.select("key", "sig", "label").join(per.select("key", F.col("top.label").alias("main"), "total"), "key"), "mixed")

    left = mixed_keys(labels)
    outside = left.filter("label <> main").count()
    turn = 0
    while outside:
        # a random member of each key's largest component meets the others, as long as that joins a fourth of them
        turn += 1
        hubs = left.filter("label = main").groupBy("key").agg(F.min(F.struct(F.xxhash64("sig", F.lit(turn)).alias("h"), "sig")).alias("h"))
        again = left.filter("label <> main").join(hubs.select("key", F.col("h.sig").alias("b")), "key").select(F.col("sig").alias("a"), "b").distinct()
        again = written_few(estimated(again).groupBy("a").agg(F.min("b").alias("b")), "pairs")
        if again.isEmpty():
            break
        labels = _relabelled(labels, verified(again, sets_of(ends(again))))
        left = mixed_keys(labels)
        before, outside = outside, left.filter("label <> main").count()
        if 4 * outside > 3 * before:
            break
    if outside:
        size = left.withColumn("blocks", F.ceil(F.col("total") / BLOCK)).join(short, "sig")

        def dealt(size: DataFrame) -> DataFrame:
            own = size.withColumns({"own": F.lit(True), "block": F.pmod(F.xxhash64("sig"), "blocks")})
            probes = size.filter("label <> main").withColumns({"own": F.lit(False), "block": F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))})
            return own.union(probes).drop("main", "total", "blocks").groupBy("key", "block")

        open_ = written_few(dealt(size).applyInPandas(_cross_members, "sig binary").distinct(), "open")
        if not open_.isEmpty():
            whole = size.join(sets_of(open_), "sig")
            labels = _relabelled(labels, written_few(dealt(whole).applyInPandas(_cross_links, "a binary, b binary"), "links"))

    ids = classes.select("sig", "least_id").join(labels, "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    tops = ids.groupBy("label").agg(F.min("least_id").alias("component_id"))
    owners = ids.select("sig", "label").join(tops, "label").select("sig", "label", "component_id")
    out = found.select("doc_id", "text_key", "sig", F.col("n").alias("n_shingles")).join(owners, "sig", "left")
    component = F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "label")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text_key, n_shingles, component_id, kept."""
    return _marked(docs).drop("label")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, one document of each component: the least id that is not null, then the least text key."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    found = _marked(docs).filter("label is not null").groupBy("label", "doc_id", "text_key").agg(F.count("*").alias("k"))
    found = written_few(found.select("label", "k", place.alias("place")), "marks")
    first = found.groupBy("label").agg(F.min("place").alias("first"))
    ends = found.join(first, "label").select(F.col("place.doc_id").alias("__id"), F.col("place.text_key").alias("__key"), (F.col("place") > F.col("first")).alias("gone"), "k")
    gone, repeated = ends.filter("gone").select("__id", "__key"), written_few(ends.filter("not gone and k > 1").select("__id", "__key"), "repeated")
    keyed = docs.withColumn("__text_key", F.xxhash64("text"))
    same = lambda rows: keyed["doc_id"].eqNullSafe(rows["__id"]) & (keyed["__text_key"] == rows["__key"])
    out = keyed.join(gone, same(gone), "left_anti")
    if not repeated.isEmpty():  # rows equal in id and text
        once = keyed.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "__text_key"])
        out = out.join(repeated, same(repeated), "left_anti").union(once)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


_W = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
SQL = f"""with recursive w as (select doc_id, {_W} as w from documents),
s as (
  select distinct doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] as g
  from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from w where len(w) >= 5)
  union all select doc_id, array_to_string(w, ' ') from w where len(w) between 1 and 4),
n as (select doc_id, count(*) as n from s group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
links as (select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= {THRESHOLD} * (x.n + y.n - k)),
reach(doc_id, other) as (select doc_id, doc_id from w union select r.doc_id, l.b from reach r join links l on l.a = r.other),
c as (select doc_id, min(other) as component_id from reach group by doc_id)
select w.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id, w.doc_id = c.component_id as kept
from w left join n using (doc_id) join c using (doc_id)"""


@query("op10_near_dedup", SQL)
def op10(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
