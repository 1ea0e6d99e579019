"""Language-model scores by a hashed maximum-entropy model.

Counts of all training tokens are exact: tasks count, Spark sums. The vocabulary holds every
token of the lexicon that was counted ``LEAST`` times or more; the others share the leaf "rare".
The softmax is factored into classes by frequency. Of its ``WIDTH`` outputs a node gives the
most frequent half to single words and the others to classes, which deal the remaining words
among them by turns, so that all weigh about the same; each class is a node of its own, until the
words left fit one. A token's chance is the product of the softmaxes on its path (one for the most
frequent words, few for the others); rare tokens share their leaf's chance by add-one counts, so
the chances of all tokens, seen or not, sum to one. Each softmax adds, to the log of its outputs'
counts, rows of weights of hashed pairs of a node and a feature of the text before: the previous
word, the previous two, skips to the second and third word before, and the previous word's last
three bytes by a hash. The table of weights grows with the vocabulary.

Training runs in ``ROUNDS`` over disjoint parts that cover all training documents. In a
round every task starts from the same weights, does minibatch gradient steps over its
documents (Adagrad, sparse rows in numpy) and returns its change; changes are averaged by
their tokens in two steps of bounded groups. A task takes at least a quarter as many tokens as the
table has weights, so that changes stay small beside the texts. Weights start at the unigram model.

The lexicon goes to every task. It holds the tokens above a count limit: at most ``LOOKUP`` or,
if that is more, ``GROWTH`` times the root of the number of training tokens. The other tokens
of a text meet the counts in a join, so their counts are exact too.

Null texts are empty: the end alone. With no training document both scores are those of
an empty count table. Rows with null or repeated ids are scored one by one; an empty table
gives an empty result, very long texts are taken whole, and columns other than doc_id and text are
not read, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from lexanchor.llm.common import batch_of, crc_mod, mix, query, table, written

#: The end of a text; no word holds a space.
END = b" "
#: Least count of a word of the vocabulary.
LEAST = 2
LOOKUP, GROWTH = 200_000, 20
SUFFIXES = 1024
#: Kinds of features, and the code that stands before a text.
KINDS, START = 5, 1 << 40
_BEFORE = np.full(3, START)
#: Outputs of a softmax; weights for each word, and the least size of the table.
WIDTH = 32
PER_WORD, LEAST_TABLE = 32, 1 << 21
BATCH, RATE, DAMPING, ROUNDS = 16384, 0.15, 1.0, 2
#: A step's runs of one row: places added for all runs at once, and the runs that are worth it; rows of a block.
ADDED, FEW, BLOCK = 64, 32, 1024
#: Bytes by which tables are aligned.
LINE = 128
#: Most tasks of a training round, and floats in a slice of their changes.
WORKERS, SLICE = 1024, 1 << 14
#: Distinct tokens that a counting task holds, and bytes of texts that are read at once.
HELD, PIECE = 600_000, 1 << 21


def tokens(text: str | None) -> list[bytes]:
    out = (text or "").encode("utf-8", "surrogatepass").lower().split()
    out.append(END)
    return out


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose texts have some ``PIECE`` bytes in all; a longer text is a piece of its own."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            size = max(1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, side="right")) - at)
            yield batch.slice(at, size)
            at += size


def encoded_words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Words of each text and, one text after another, the words; all as ``tokens`` has them, without the ends."""
    binary = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    words = pc.ascii_split_whitespace(pc.fill_null(pc.ascii_lower(texts), ""))
    found = words.flatten()
    real = pc.not_equal(pc.binary_length(found), 0).to_numpy(zero_copy_only=False)
    before = np.cumsum(np.r_[0, real])
    offsets = words.offsets.to_numpy() - words.offsets[0].as_py()
    return np.diff(before[offsets]), found.filter(pa.array(real)).cast(binary).dictionary_encode()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("token", pa.binary()), ("c", pa.int64())])
    held: list[pa.Table] = []
    size = 0

    def summed() -> pa.Table:
        found = pa.concat_tables(held).group_by("token", use_threads=False).aggregate([("c", "sum")])
        return pa.Table.from_arrays([found["token"], found["c_sum"]], schema=schema)

    for piece in pieces(batches):
        _, words = encoded_words(piece["text"])
        times = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary)).astype(np.int64)
        held.append(pa.table([words.dictionary.cast(pa.binary()), pa.array(times)], schema=schema))
        held.append(pa.table([pa.array([END], pa.binary()), pa.array([piece.num_rows], pa.int64())], schema=schema))
        size += len(times)
        if size > HELD:
            held = [summed()]
            if 2 * len(held[0]) > HELD:
                yield from held[0].to_batches()
                held = []
            size = sum(map(len, held))
    if held:
        yield from summed().to_batches()


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, c) over whole texts, the end of each included."""
    return written(texts.mapInArrow(_count, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c")), "tokens")


@dataclass
class Lexicon:
    """The most frequent tokens with their counts, most frequent first, and the totals of all."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int

    def __post_init__(self) -> None:
        self.rank = {w: i for i, w in enumerate(self.words)}
        self.log_counts = np.log10(self.counts + 1.0) if len(self.counts) else np.zeros(0)
        self.size = int(np.searchsorted(-self.counts, -LEAST, side="right"))
        self.codes = np.array([((i + 1) * SUFFIXES if i < self.size else 0) + suffix_code(w) for i, w in enumerate(self.words)], np.int64)
        inside = int(self.counts[:self.size].sum())
        #: Add-one mass of all tokens outside the vocabulary, one unseen token included.
        self.rare_mass = (self.total - inside) + (self.distinct - self.size) + 1
        self.classes = Classes(np.append(self.rare_mass, self.counts[:self.size] + 1.0))


def suffix_code(word: bytes) -> int:
    return zlib.crc32(word[-3:]) & (SUFFIXES - 1)


class Classes:
    """Leaves (0: rare, then the words, most frequent first) in nodes of ``WIDTH`` outputs, and the logs of their masses."""

    def __init__(self, mass: np.ndarray):
        #: Classes of a node on each level; its other outputs are single leaves.
        self.classes: list[int] = []
        left = len(mass)
        while left > WIDTH:
            c = min(WIDTH // 2, -(-(left - WIDTH) // (WIDTH - 1)))
            self.classes.append(c)
            left = -(-(left - WIDTH + c) // c)
        self.classes.append(0)
        #: First node of each level.
        self.first = np.cumsum([0, *np.cumprod([1, *self.classes[:-1]])])
        total = np.zeros((self.first[-1], WIDTH))
        for at, node, output in self.paths(np.arange(len(mass))):
            np.add.at(total, (node, output), mass[at])
        with np.errstate(divide="ignore"):
            self.bias = np.log(total).astype(np.float32)
        self.of_node = mix(np.arange(len(total), dtype=np.uint64))

    def paths(self, leaf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each level: places in ``leaf`` that reach it, their nodes there and the outputs they take."""
        at, left, node = np.arange(len(leaf)), leaf, np.zeros(len(leaf), np.int64)
        for level, c in enumerate(self.classes):
            single = WIDTH - c
            deeper = np.flatnonzero(left >= single)
            output = left.copy()
            turn = left[deeper] - single
            if len(deeper):
                output[deeper] = single + turn % c
            yield at, node, output
            if not len(deeper):
                return
            at, left = at[deeper], turn // c
            node = self.first[level + 1] + (node[deeper] - self.first[level]) * c + turn % c


def aligned(n: int, width: int = WIDTH, dtype=np.float32) -> np.ndarray:
    """Zeros in ``n`` rows that begin at a line of the cache: a row of 32 floats lies in two lines, not in three."""
    size = np.dtype(dtype).itemsize * n * width
    raw = np.zeros(size + LINE, np.uint8)
    at = -raw.ctypes.data % LINE
    return raw[at:at + size].view(dtype).reshape(n, width)


class Room:
    """Arrays of a task that batches use one after another, by name; what a name gave before is overwritten."""

    def __init__(self) -> None:
        self.held: dict[tuple, np.ndarray] = {}

    def rows(self, name: str, n: int, width: int = WIDTH, dtype=np.float32) -> np.ndarray:
        key = name, width, dtype
        if len(self.held.get(key, ())) < n:
            self.held[key] = aligned(n + n // 4, width, dtype)
        return self.held[key][:n]


ROOM = Room()


class Weights:
    """Rows of ``WIDTH`` weights for hashed pairs of a feature and a node."""

    SIZE = LEAST_TABLE

    def __init__(self, flat: np.ndarray, classes: Classes | None = None):
        if flat.ctypes.data % LINE:
            flat, given = aligned(len(flat) // WIDTH).reshape(-1), flat
            flat[:] = given
        self.flat, self.classes = flat, classes
        self.table = flat.reshape(-1, WIDTH)

    @classmethod
    def unigram(cls, lexicon: Lexicon) -> Weights:
        size = max(cls.SIZE, 1 << (PER_WORD * lexicon.size).bit_length())
        return cls.zeros(size, lexicon.classes)

    @classmethod
    def zeros(cls, size: int, classes: Classes | None = None) -> Weights:
        return cls(aligned(size // WIDTH).reshape(-1), classes)

    def rows(self, feature: np.ndarray, node: np.ndarray) -> np.ndarray:
        pair = (feature + self.classes.of_node[node]) >> np.uint64(32)
        return ((pair * np.uint64(len(self.table))) >> np.uint64(32)).astype(np.int64)


def _features(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashed features of the tokens at these places, a line for each kind; three codes come before each text."""
    codes = codes.astype(np.uint64)
    one, two, three = (mix(codes * np.uint64(KINDS) + np.uint64(j)) for j in range(3))
    pair, end = two[at - 2] * np.uint64(3) + one[at - 1], (codes % np.uint64(SUFFIXES))[at - 1] * np.uint64(KINDS) + np.uint64(3)
    return np.stack([one[at - 1], two[at - 2], three[at - 3], mix(pair), mix(end)], axis=1)


def fetch(table: np.ndarray, row: np.ndarray, name: str) -> np.ndarray:
    """Rows of a table, in the room's array of that name."""
    return np.take(table, row, axis=0, out=ROOM.rows(name, len(row), table.shape[1], table.dtype), mode="clip")


def exponentials(z: np.ndarray, again: Callable[[], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """exp(z - shift), the sums of its rows and the shift: the rows' maxima, or 0 where exp(z) is well within the range of floats.

    With ``again``, which gives z once more, z is overwritten.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.exp(z, out=z if again else None)
        total = out @ np.ones(z.shape[1], z.dtype)
    if 1e-20 < total.min(initial=1) and total.max(initial=1) < 1e30:  # the sums tell it at once; maxima of rows are found slowly
        return out, total, 0.0
    z = again() if again else z
    shift = z.max(axis=1)
    out = np.exp(z - shift[:, None])
    return out, out.sum(axis=1), shift


def log10_chances(w: Weights, features: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log10 of each token's chance; for tokens outside the vocabulary (target -1) of their leaf alone."""
    out = np.zeros(len(target))
    for at, node, output in w.classes.paths(target + 1):
        rows = w.rows(np.take(features, at, axis=0).T, node)

        def logits() -> np.ndarray:
            z = fetch(w.classes.bias, node, "z")
            for line in rows:
                z += fetch(w.table, line, "one kind")
            return z

        z = logits()
        taken = z[np.arange(len(at)), output]
        _, total, shift = exponentials(z, logits)
        out[at] += taken - shift - np.log(total)
    return out / math.log(10)


def runs(row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows, the places in order of their rows, and where each row's run begins, with the end; sorted as one number each."""
    shift = int(place.max(initial=0)).bit_length()
    key = (row << shift) | place
    key.sort()
    order = key & ((1 << shift) - 1)
    key >>= shift
    new = np.ones(len(key) + 1, bool)
    np.not_equal(key[1:], key[:-1], out=new[1:-1])
    start = np.flatnonzero(new)
    return key[start[:-1]], order, start


def sum_runs(g: np.ndarray, order: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each run the sum of g's rows in it: the second rows of all runs are added to the first ones at once, then the third; what few long runs are left, each at once."""
    first, length = start[:-1], np.diff(start)
    total = fetch(g, order[first], "step")
    more = np.flatnonzero(length > 1)
    if len(more):
        more = more[np.argsort(-length[more], kind="stable")]
        first, length = first[more], length[more]
        part = fetch(total, more, "part")
        longer = np.searchsorted(-length, -np.arange(ADDED + 1), side="left")  # runs of more than k rows
        k = 1
        while k < ADDED and longer[k] >= FEW:
            part[:longer[k]] += fetch(g, order[first[:longer[k]] + k], "one kind")
            k += 1
        for i in range(longer[k]):
            part[i] += fetch(g, order[first[i] + k:first[i] + length[i]], "one kind").sum(axis=0)
        put_rows(total, more, part)
    return total


def sum_by_row(g: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their gradients."""
    distinct, order, start = runs(row, np.arange(len(row)))
    return distinct, sum_runs(g, order, start).copy()


def put_rows(table: np.ndarray, row: np.ndarray, values: np.ndarray) -> None:
    """table[row] = values for distinct rows; each is copied as one item, which numpy does in less than half the time."""
    item = np.dtype((np.void, table.itemsize * table.shape[1]))
    table.view(item).reshape(-1)[row] = values.view(item).reshape(-1)


def train_batch(w: Weights, sums: Weights, features: np.ndarray, target: np.ndarray) -> None:
    """Adagrad steps over the batch's summed gradients, one for each level. A row is fetched once, for all places and kinds of feature that it serves."""
    kinds = features.shape[1]
    room = (kinds - 1).bit_length()
    for at, node, output in w.classes.paths(target + 1):
        n = len(at)
        row, order, start = runs(w.rows(np.take(features, at, axis=0), node[:, None]).ravel(), ((np.arange(n) << room)[:, None] | np.arange(kinds)).ravel())
        place = np.empty(n << room, np.int64)
        place[order] = np.repeat(np.arange(len(row)), np.diff(start))
        place = place.reshape(n, -1)
        weight = fetch(w.table, row, "weight")

        def logits() -> np.ndarray:
            z = fetch(w.classes.bias, node, "z")
            for j in range(kinds):
                z += fetch(weight, place[:, j], "one kind")
            return z

        g, total, _ = exponentials(logits(), logits)
        g /= total[:, None]
        g[np.arange(n), output] -= 1
        steps = sum_runs(g, order >> room, start)
        for a in range(0, len(row), BLOCK):  # blocks stay in a core's cache
            line, step, new = row[a:a + BLOCK], steps[a:a + BLOCK], weight[a:a + BLOCK]
            square, root = fetch(sums.table, line, "square"), ROOM.rows("root", len(line))
            np.multiply(step, step, out=root)
            square += root
            put_rows(sums.table, line, square)
            np.add(square, np.float32(DAMPING), out=root)
            np.sqrt(root, out=root)
            step *= np.float32(RATE)
            step /= root
            new -= step
            put_rows(w.table, line, new)


class Reader:
    """Turns texts into ranks, codes and batches."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.words = pa.array(lexicon.words, pa.binary())

    def read(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Ranks of the tokens (-1: not in the lexicon), their codes, and those that are not in it."""
        ranks = np.fromiter(map(self.lexicon.rank.get, words, repeat(-1)), np.int64, len(words))
        codes = np.take(self.lexicon.codes, ranks, mode="clip") if len(self.lexicon.codes) else np.zeros(len(ranks), np.int64)
        at = np.flatnonzero(ranks < 0)
        missing = [words[i] for i in at.tolist()]
        if missing:
            codes[at] = [suffix_code(w) for w in missing]
        return ranks, codes, missing

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """Each text's number of tokens; ranks and codes of all tokens; and as which of the distinct words, which come last, they are given. A word is looked up once."""
        n_words, words = encoded_words(texts)
        distinct = pa.concat_arrays([words.dictionary.cast(pa.binary()), pa.array([END], pa.binary())])
        ranks = pc.fill_null(pc.index_in(distinct, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = np.take(self.lexicon.codes, ranks, mode="clip") if len(self.lexicon.codes) else np.zeros(len(ranks), np.int64)
        missing = ranks < 0
        ends = pc.binary_slice(distinct.filter(pa.array(missing)), -3).dictionary_encode()
        codes[missing] = np.array([suffix_code(w) for w in ends.dictionary.to_pylist()], np.int64)[ends.indices.to_numpy()]
        lengths = n_words + 1
        word = np.full(lengths.sum(), len(distinct) - 1)
        inside = np.ones(len(word), bool)
        inside[np.cumsum(lengths) - 1] = False
        word[inside] = words.indices.to_numpy()
        return lengths, ranks[word], codes[word], word, distinct

    def batches(self, lengths: np.ndarray, ranks: np.ndarray, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Features and targets, ``BATCH`` tokens at a time."""
        codes, at = _with_starts(codes, lengths)
        target = np.where(ranks < self.lexicon.size, ranks, -1)
        for a in range(0, len(at), BATCH):
            part = at[a:a + BATCH]
            low = part[0] - len(_BEFORE)
            yield _features(codes[low:part[-1] + 1], part - low), target[a:a + BATCH]


def _with_starts(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of texts with three codes before each text, and the places of the texts' own codes."""
    at = np.arange(len(codes)) + len(_BEFORE) * (1 + np.repeat(np.arange(len(lengths)), lengths))
    out = np.full(len(codes) + len(_BEFORE) * len(lengths), START)
    out[at] = codes
    return out, at


def _batches_of(texts: list[tuple[np.ndarray, np.ndarray]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and targets of texts given as (ranks, codes)."""
    codes, at = _with_starts(np.concatenate([c for _, c in texts]), np.array([len(r) for r, _ in texts]))
    ranks = np.concatenate([r for r, _ in texts])
    return _features(codes, at), np.where(ranks < size, ranks, -1)


def _train(sent, weights_sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("slice", pa.int32()), ("part", pa.int64()), ("n", pa.float64()), ("change", pa.binary())])
        lexicon: Lexicon = sent.value
        start: np.ndarray = weights_sent.value
        w, sums, reader, n = Weights.zeros(len(start), lexicon.classes), Weights.zeros(len(start)), Reader(lexicon), 0
        w.flat[:] = start
        for piece in pieces(batches):
            lengths, ranks, codes, _, _ = reader.texts(piece["text"])
            for features, target in reader.batches(lengths, ranks, codes):
                train_batch(w, sums, features, target)
                n += len(target)
        if n:
            change = (w.flat - start).astype("<f2")
            parts = [change[at:at + SLICE].tobytes() for at in range(0, len(change), SLICE)]
            me = TaskContext.get().partitionId()
            yield batch_of(schema, [list(range(len(parts))), [me] * len(parts), [float(n)] * len(parts), parts])

    return run


def _sum_changes(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The mean change of a slice, by tokens, in half precision (a change is a small number)."""
    total = sum(np.frombuffer(raw, "<f2").astype(np.float64) * n for raw, n in zip(pdf["change"], pdf["n"], strict=True)) / pdf["n"].sum()
    return pd.DataFrame({"slice": [int(key[0])], "part": [int(key[1])], "n": [pdf["n"].sum()], "change": [total.astype("<f2").tobytes()]})


def fit(docs: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """Weights after all rounds over the texts of (doc_id, text)."""
    spark = docs.sparkSession
    flat = Weights.unigram(lexicon).flat
    sent = spark.sparkContext.broadcast(lexicon)
    columns = "slice int, part long, n double, change binary"
    cores = spark.sparkContext.defaultParallelism
    workers = min(WORKERS, max(cores, 4 * lexicon.total // (ROUNDS * len(flat))))
    for r in range(ROUNDS):
        weights = spark.sparkContext.broadcast(flat)
        part = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == r).select("text").coalesce(workers)
        changes = part.mapInArrow(_train(sent, weights), columns)
        for group in (32, WORKERS):  # at most 32 changes of a slice meet in a group, twice
            changes = changes.withColumn("part", F.expr(f"part div {group}")).groupBy("slice", "part").applyInPandas(_sum_changes, columns)
        got = changes.orderBy("slice").collect()  # the size of the model
        if got:
            flat = flat + np.concatenate([np.frombuffer(x.change, "<f2") for x in got]).astype(np.float32)
        weights.unpersist()
    return flat


def _score(sent, weights_sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                            ("log_counts", pa.float64()), ("log_model", pa.float64()), ("n_rare", pa.int64()),
                            ("tokens", pa.list_(pa.binary())), ("times", pa.list_(pa.int32()))])
        lexicon: Lexicon = sent.value
        w, reader = Weights(weights_sent.value, lexicon.classes), Reader(lexicon)
        row = TaskContext.get().partitionId() << 36
        logs = np.append(lexicon.log_counts, 0.0)  # of rank -1: none
        for piece in pieces(batches):
            lengths, ranks, codes, word, distinct = reader.texts(piece["text"])
            chances = np.concatenate([log10_chances(w, *batch) for batch in reader.batches(lengths, ranks, codes)])
            starts = np.cumsum(lengths) - lengths
            total = lambda x: np.add.reduceat(x, starts)
            known = ranks >= 0
            rare = known & (ranks >= lexicon.size)
            log = logs[ranks]
            missing = np.flatnonzero(~known)
            text = np.repeat(np.arange(len(lengths)), lengths)[missing]
            pairs, times = np.unique(text * len(distinct) + word[missing], return_counts=True)
            offsets = np.searchsorted(pairs, np.arange(len(lengths) + 1) * len(distinct))
            offsets = pa.array(offsets, pa.int32())
            tokens = distinct.take(pa.array(pairs % len(distinct)))
            yield pa.RecordBatch.from_arrays([
                pa.array(row + np.arange(len(lengths))), piece["doc_id"].cast(pa.int64()), piece["held_out"], pa.array(lengths), pa.array(total(known.astype(np.int64))),
                pa.array(total(log)), pa.array(total(chances) + total(np.where(rare, log, 0.0))), pa.array(total((rare | ~known).astype(np.int64))),
                pa.ListArray.from_arrays(offsets, tokens), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))], schema=schema)
            row += len(lengths)

    return run


def _cutoff(counts: DataFrame, most: int = LOOKUP) -> int:
    """The least count that at most ``most`` tokens reach, by counts rounded down to three leading bits."""
    step = F.expr("cast(pow(2, greatest(floor(log2(c)) - 2, 0)) as bigint)")
    sizes = counts.select((F.floor(F.col("c") / step) * step).cast("long").alias("least")).groupBy("least").agg(F.count("*").alias("n")).orderBy(F.desc("least")).collect()
    total, cutoff = 0, 1 << 62
    for r in sizes:  # a few hundred rows
        total += r.n
        if total > most:
            break
        cutoff = r.least
    return cutoff


def scores(docs: DataFrame, train: Column, held_out: Column) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    counts = token_counts(docs.filter(train).select("text"))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    often = counts.filter(F.col("c") >= _cutoff(counts, max(LOOKUP, GROWTH * math.isqrt(total)))).collect()
    often.sort(key=lambda r: (-r.c, r.token))
    lexicon = Lexicon([bytes(r.token) for r in often], np.array([r.c for r in often], np.float64), total, distinct)
    flat = fit(docs.filter(train), lexicon)
    sent, weights = spark.sparkContext.broadcast(lexicon), spark.sparkContext.broadcast(flat)
    first = written(docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        _score(sent, weights), "row long, doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, log_model double, n_rare long, "
        "tokens array<binary>, times array<int>"), "scored")
    rest = first.select("row", F.explode(F.arrays_zip("tokens", "times")).alias("t")).select("row", F.col("t.tokens").alias("token"), F.col("t.times").alias("k"))
    met = rest.join(counts, "token", "left").groupBy("row").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("more_logs"), F.sum(F.when(F.col("c").isNotNull(), F.col("k")).otherwise(0)).alias("more_known"))
    more = lambda c: F.coalesce(c, F.lit(0))
    out = first.select("row", "doc_id", "held_out", "n_tokens", "n_known", "log_counts", "log_model", "n_rare").join(met, "row", "left")
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + more("more_known")).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("log_counts") + more("more_logs") - F.col("n_tokens") * float(np.log10(total + distinct + 1))).alias("base_score"),
        (F.col("log_model") + more("more_logs") - F.col("n_rare") * float(np.log10(lexicon.rare_mass))).alias("score"))


@query("op9_lm_scores")
def op9(spark, sf_dir) -> DataFrame:
    held_out = crc_mod(7) == 2
    return scores(table(spark, sf_dir, "documents").select("doc_id", "text"), ~held_out, held_out)
