"""Lexical search: an inverted index kept up to date by content hashes, and a similarity join over trigrams.

The index is three tables in a folder. ``texts`` has a row for each text, its terms and how often each comes, packed;
``postings`` has a row (term, key, n) for each term of a text, laid out in buckets of terms;
``docs`` has the content hash of each text and the generation that indexed it. An update compares hashes and writes the postings of new and
changed texts only, as one more generation; a posting counts as long as its generation is
the one that ``docs`` names, so nothing written before is touched. The new ``docs`` table
commits the update: one that was cut off is unseen and written again.

The similarity join finds all pairs of token sets at a Jaccard similarity or more without
comparing all: tokens are ordered rarest first, and two sets that are similar enough share
one of their first few, have sizes close to each other, and leave enough tokens after the
shared one. Texts with equal sets travel as one class.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexanchor.functions import text as T
from lexanchor.operators.keyed import compute_once
from lexanchor.operators.vectors import trigrams
from lexanchor.session import cut

BUCKETS = 64


def words(text) -> Column:
    """Words of a text without accents, case, markup and punctuation."""
    return F.filter(F.split(T.word_key(text, prefixes=False), " "), lambda w: w != "")


def bucket_of(term, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def counted(b: DataFrame, key: str, text: str) -> DataFrame:
    """(key, terms, counts): the terms of each text in order and how often each is in it, both with spaces between (words hold none)."""
    w = compute_once(b.select(key, text), {"__w": F.array_sort(words(text))}).drop(text)
    runs = "filter(sequence(0, size(__w) - 1), i -> i = 0 or __w[i] != __w[i - 1])"
    w = compute_once(w.filter("size(__w) > 0"), {"__at": F.expr(runs)})
    return w.select(
        key, F.expr("array_join(transform(__at, a -> __w[a]), ' ')").alias("terms"),
        F.expr("array_join(transform(__at, (a, j) -> cast(coalesce(get(__at, j + 1), size(__w)) - a as string)), ' ')").alias("counts"))


def unpacked(packed: DataFrame, key: str) -> DataFrame:
    """(term, key, n) of (key, terms, counts)."""
    w = compute_once(packed.select(key, "terms", "counts"), {"__t": F.split("terms", " "), "__n": F.split("counts", " ")})
    each = "transform(__t, (t, i) -> named_struct('term', t, 'n', cast(__n[i] as bigint)))"
    return w.select(key, F.expr(f"inline({each})")).select("term", key, "n")


def postings(b: DataFrame, key: str, text: str) -> DataFrame:
    """(term, key, n): how often each term is in each text. Counted within the row, so no words are shuffled."""
    return unpacked(counted(b, key, text), key)


def by_buckets(packed: DataFrame, key: str, buckets: int) -> DataFrame:
    """(term, key, n, bucket) of (key, terms, counts), dealt by bucket. A text travels as one row for each of its buckets."""
    width = len(str(buckets))
    w = compute_once(packed, {"__t": F.split("terms", " "), "__n": F.split("counts", " ")})
    entry = F.transform("__t", lambda t, i: F.concat(F.lpad(bucket_of(t, buckets).cast("string"), width, "0"), t, F.lit(" "), F.col("__n")[i]))
    w = compute_once(w.select(key, entry.alias("__e")), {"__s": F.array_sort("__e")}).drop("__e")
    w = compute_once(w, {"__at": F.expr(f"filter(sequence(0, size(__s) - 1), i -> i = 0 or left(__s[i], {width}) != left(__s[i - 1], {width}))")})
    run = f"array_join(transform(slice(__s, a + 1, coalesce(get(__at, j + 1), size(__s)) - a), e -> substr(e, {width + 1})), ' ')"
    dealt = w.select(key, F.expr(f"inline(transform(__at, (a, j) -> named_struct('bucket', cast(left(__s[a], {width}) as int), 'terms', {run})))"))
    dealt = compute_once(dealt.hint("rebalance", "bucket"), {"__p": F.split("terms", " ")})
    each = "transform(sequence(0, size(__p) div 2 - 1), i -> named_struct('term', __p[2 * i], 'n', cast(__p[2 * i + 1] as bigint)))"
    return dealt.select(key, "bucket", F.expr(f"inline({each})")).select("term", key, "n", "bucket")


def vocabulary(b: DataFrame, text: str) -> DataFrame:
    """The distinct terms of all texts."""
    return compute_once(b.select(text), {"__w": F.array_distinct(words(text))}).select(F.explode("__w").alias("term")).distinct()


@dataclass(frozen=True)
class TextIndex:
    """An inverted index in a folder; keys are unique and not null."""

    spark: SparkSession
    path: str
    key: str = "block_id"
    key_type: str = "bigint"
    buckets: int = BUCKETS

    def _read(self, name: str, schema: str) -> DataFrame | None:
        """A table by generations, null where none is written."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    @property
    def _packed(self) -> str:
        return f"{self.key} {self.key_type}, terms string, counts string"

    def _texts(self) -> DataFrame | None:
        """(key, terms, counts, gen) of all generations."""
        return self._read("texts", f"{self._packed}, gen int")

    def generation(self) -> int:
        """The last committed one; 0 where there is none."""
        all_docs = self._read("docs", "state int")
        return 0 if all_docs is None else all_docs.agg(F.max("state")).first()[0] or 0

    def docs(self) -> DataFrame | None:
        """(key, hash, gen) of the texts that the index holds now."""
        last = self.generation()
        return self._read("docs", f"{self.key} {self.key_type}, hash string, gen int, state int").filter(F.col("state") == last).drop("state") if last else None

    def update(self, b: DataFrame, text: str = "block_text") -> int:
        """Makes the index hold exactly the texts of ``b``; returns how many were indexed anew."""
        last, old = self.generation(), self.docs()
        now = b.select(self.key, F.md5(F.coalesce(text, F.lit(""))).alias("hash"))
        if old is None:
            now = now.withColumn("gen", F.lit(last + 1))
        else:
            before = old.select(self.key, F.col("hash").alias("__hash"), F.col("gen").alias("__gen"))
            now = now.join(before, self.key, "left").withColumn("gen", F.when(F.col("hash") == F.col("__hash"), F.col("__gen")).otherwise(last + 1)).drop("__hash", "__gen")
        now = cut(now)
        fresh = now.filter(F.col("gen") == last + 1).select(self.key)
        n = fresh.count()
        if old is not None and not n and now.count() == old.count():
            return 0
        # in a new index all texts are fresh and stay where they are
        b = b.filter(F.col(self.key).isNotNull()) if old is None else b.join(fresh, self.key, "left_semi")
        place = f"{self.path}/texts/gen={last + 1}"
        counted(b, self.key, text).write.mode("overwrite").option("compression", "zstd").parquet(place)
        rows = by_buckets(self.spark.read.schema(self._packed).parquet(place), self.key, self.buckets)
        # a bucket is one file where it is small; frequent terms are split over files
        rows.sortWithinPartitions("bucket", "term").write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{self.path}/postings/gen={last + 1}")
        now.write.mode("overwrite").parquet(f"{self.path}/docs/state={last + 1}")
        return n

    def live(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """(term, key, n) of all terms, or of those in some buckets, whose partitions alone are read."""
        rows = self._read("postings", f"term string, {self.key} {self.key_type}, n bigint, gen int, bucket int")
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin(list(buckets)))
        return rows.join(self.docs().select(self.key, "gen"), [self.key, "gen"]).select("term", self.key, "n", "bucket")

    def frequencies(self) -> DataFrame:
        """(term, documents, occurrences) over all texts; these meet ``docs`` whole, by their postings only where a generation has no ``texts``."""
        texts, docs = self._texts(), self.docs().select(self.key, "gen")
        whole = texts is not None and not docs.select("gen").distinct().join(texts.select("gen").distinct(), "gen", "left_anti").count()
        rows = unpacked(texts.join(docs, [self.key, "gen"]), self.key) if whole else self.live()
        return rows.groupBy("term").agg(F.count("*").alias("documents"), F.sum("n").alias("occurrences"))

    def lookup(self, terms: Sequence[str]) -> DataFrame:
        """Postings of some terms, written as in a query."""
        given = self.spark.range(1).select(F.array_distinct(F.concat(*[words(F.lit(t)) for t in terms])).alias("w"))
        found = given.select("w", F.transform("w", lambda t: bucket_of(t, self.buckets)).alias("b")).first()
        return self.live(sorted(set(found.b))).filter(F.col("term").isin(found.w)).drop("bucket")

    def search(self, terms: Sequence[str]) -> DataFrame:
        """Texts with any of the terms: how many terms match, how often, and a score that weighs rare terms more."""
        hits = self.lookup(terms)
        total = self.docs().count()
        df = hits.groupBy("term").agg(F.count("*").alias("df"))
        weight = (1 + F.ln("n")) * F.ln(1 + F.lit(total) / F.col("df"))
        return hits.join(F.broadcast(df), "term").groupBy(self.key).agg(  # a row for each term of the query
            F.count("*").alias("matched"), F.sum("n").alias("hits"), F.sum(weight).alias("score"))


# ------------------------------------------------------------ similarity join
def token_classes(df: DataFrame, key: str, tokens: str) -> tuple[DataFrame, DataFrame]:
    """Rows with equal token sets as one class named by its least key: (key, class) and (class, tokens).

    Rows without tokens are in no class.
    """
    keyed = df.filter(F.size(tokens) > 0).select(key, F.array_sort(F.array_distinct(tokens)).alias("tokens"))
    keyed = keyed.withColumn("__set", F.md5(F.array_join("tokens", "\x01")))
    classes = cut(keyed.groupBy("__set").agg(F.min(key).alias("class"), F.first("tokens").alias("tokens")))
    return keyed.select(key, "__set").join(classes.select("__set", "class"), "__set").select(key, "class"), classes.select("class", "tokens")


def rare_first(sets: DataFrame, counts: DataFrame, key: str = "class") -> DataFrame:
    """Orders each set's tokens by how many sets hold them, rarest first; ``counts`` has (token, df)."""
    one = sets.select(key, F.explode("tokens").alias("token")).join(counts, "token", "left")
    return one.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token"))).alias("__o")).select(
        key, F.transform("__o", lambda x: x["token"]).alias("tokens"), F.size("__o").alias("size"))


def similar_sets(left: DataFrame, right: DataFrame, percent: int, one_sided: bool = False) -> DataFrame:
    """Pairs (a, b, shared, united) of (class, tokens) whose Jaccard similarity is at least ``percent`` / 100.

    A token of the prefix meets the sets of fitting size that have it in theirs; the size is
    part of the join key, so a frequent token is split by it. With ``one_sided`` both inputs
    are the same classes and each pair is given once, the smaller name first.
    """
    both = left.select("tokens") if one_sided else left.select("tokens").unionByName(right.select("tokens"))
    counts = cut(both.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df")))
    l_sets = cut(rare_first(left, counts))
    r_sets = l_sets if one_sided else cut(rare_first(right, counts))
    prefix = f"slice(tokens, 1, size - ({percent} * size + 99) div 100 + 1)"
    lp = l_sets.select(F.col("class").alias("a"), F.col("size").alias("a_size"), F.posexplode(F.expr(prefix)).alias("a_pos", "token"))
    lp = lp.withColumn("b_size", F.explode(F.expr(f"sequence(cast(({percent} * a_size + 99) div 100 as int), cast(100 * a_size div {percent} as int))")))
    rp = r_sets.select(F.col("class").alias("b"), F.col("size").alias("b_size"), F.posexplode(F.expr(prefix)).alias("b_pos", "token"))
    if one_sided:
        rp = rp.withColumnRenamed("b_size", "__b").withColumn("b_size", F.col("__b")).drop("__b")
    met = lp.join(rp, ["token", "b_size"])
    if one_sided:
        met = met.filter("a < b")
    needed = f"({percent} * (a_size + b_size) + {99 + percent}) div {100 + percent}"
    pairs = met.filter(f"least(a_size - a_pos, b_size - b_pos) >= {needed}").select("a", "b").distinct()
    found = pairs.join(l_sets.select(F.col("class").alias("a"), F.col("tokens").alias("__a")), "a").join(
        r_sets.select(F.col("class").alias("b"), F.col("tokens").alias("__b")), "b")
    found = compute_once(found, {"shared": F.size(F.array_intersect("__a", "__b"))})
    found = found.withColumn("united", F.size("__a") + F.size("__b") - F.col("shared"))
    return found.filter(100 * F.col("shared") >= percent * F.col("united")).select("a", "b", "shared", "united")


def similar_names(df: DataFrame, key: str, name: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """Names by trigrams: (key, class) and similar classes (a, b, similarity), a before b."""
    members, classes = token_classes(df.select(key, trigrams(name).alias("tokens")), key, "tokens")
    pairs = similar_sets(classes, classes, percent, one_sided=True)
    return members, pairs.select("a", "b", F.round(F.col("shared") / F.col("united"), 6).alias("similarity"))


def similar_terms(terms: Sequence[str], vocabulary: DataFrame, percent: int, term: str = "term") -> DataFrame:
    """Words of a vocabulary close to the words of a query, misspelt ones: (query, term, similarity)."""
    spark = vocabulary.sparkSession
    given = spark.createDataFrame([(t,) for t in dict.fromkeys(terms)], "class string").withColumn("tokens", trigrams("class")).filter(F.size("tokens") > 0)
    shared = given.select(F.explode("tokens").alias("t")).agg(F.collect_set("t").alias("t")).first().t  # trigrams of the query
    near = compute_once(vocabulary.select(term), {"tokens": trigrams(term)}).filter(F.arrays_overlap("tokens", F.array(*[F.lit(t) for t in shared or []]).cast("array<string>")))
    members, classes = token_classes(cut(near), term, "tokens")  # a similar word shares a trigram; texts are read once
    pairs = similar_sets(given, classes, percent).withColumnRenamed("b", "class")
    return pairs.join(members, "class").select(
        F.col("a").alias("query"), F.col(term).alias("term"), F.round(F.col("shared") / F.col("united"), 6).alias("similarity"))
