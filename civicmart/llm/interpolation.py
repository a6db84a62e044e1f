"""Language-model scores by deleted interpolation of word n-grams.

The probability of a word after its context mixes the maximum-likelihood bigram, the
maximum-likelihood unigram and the uniform share of the vocabulary and one unknown word. The weights
depend on how often the context was seen (a bucket per power of two), and are learned by
expectation-maximisation on all training documents: either half of them is held out in turn, and its
tokens are estimated by the corpus counts from which it is deleted, which are those of the other half.
The tokens are added up by bucket and rounded estimates, with the sums of the estimates themselves, so
that the rounds of expectation-maximisation need only this bounded table.

Counts cover all training tokens, and every word (or the text's begin) is a context with bigrams of
its own. Words that hold at least one in `WORD_SHARE` training tokens are at most that many, and are
sent to every task with their counts; so are pairs that hold at least one in `PAIR_SHARE`. All else is
counted and scored where rows meet. Pairs of two frequent words, nearly all rows, travel packed: a
slice sends each group of pairs one row with the places of their words in the frequent table, their
texts and counts. The others travel likewise, a row per group and many slices, by their context if it
is rare, else by their word. A rare word's count is that of the rows it is the context of, as some
word or the end follows every token. Only pairs of two rare words lack their word's count where they
meet; the distinct ones of a slice are joined to the word counts beforehand, and the answers meet
them. No pair or rare word that rows meet by holds more than about 2/PAIR_SHARE of the tokens, however
crowded it is.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civicmart.llm.columns import BLANK, flat, fold, send, slices, words
from civicmart.session import cut, drop_path, fresh_path

FOLDS, HELD_FOLD = 5, 1
#: Words are sent to every task if at least one token in so many is theirs (at most so many, 16 bytes each), pairs likewise.
WORD_SHARE, PAIR_SHARE = 2_000_000, 50_000
ROUNDS = 60
#: Steps per power of two to which estimates are rounded where tokens are added up for the weights, whose sums stay exact.
STEPS = 4
#: Training tokens whose rows meet in one task, on average.
TOKENS_PER_TASK = 2_000_000
#: Groups of pairs that a task has on average; a slice packs a row for each group.
GROUPS_PER_TASK = 8
#: Successive texts (two to this power) whose sums a task sends in one row.
BLOCK_BITS = 10
#: Bytes of text that a task cuts into words at a time, and rows that it scores at a time; they bound its memory only.
SLICE_BYTES, SCORED = 1 << 20, 200_000
#: Distinct entries that a counting task gathers before it passes them on.
GATHERED = 1_000_000
END = b"\n"  # no word holds a line end


def hashed(found: list[bytes]) -> np.ndarray:
    """A 64-bit number for each distinct word."""
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, found), np.uint64, len(found)).view(np.int64)


def numbered(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """As `distinct`; the words are cut from one buffer, without an Arrow scalar for each."""
    if len(starts) < 2:
        return np.empty(0, np.int64), []
    buffers = [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    array = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, buffers).dictionary_encode()
    found = array.dictionary
    _, ends, held = found.buffers()
    ends = np.frombuffer(ends, np.int64)[found.offset : found.offset + len(found) + 1].tolist()
    held = held.to_pybytes()
    return array.indices.to_numpy(), [held[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def pair(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A 64-bit number for each pair of words."""
    h = context.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ word.view(np.uint64)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def place(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key in a sorted table, or -1."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


class Tokens:
    """The tokens of a slice: words, then one end per text."""

    def __init__(self, texts: pa.Array):
        data, offsets = flat(texts)
        out, starts, before, _ = words(data, offsets, BLANK)
        codes, found = numbered(out, starts)
        n = np.diff(before)
        self.number = n + 1
        self.hashes = hashed([*found, END])
        self.text = np.repeat(np.arange(len(n)), self.number)
        self.codes = np.full(len(codes) + len(n), len(found), np.int64)
        self.codes[np.arange(len(codes)) + np.repeat(np.arange(len(n)), n)] = codes
        self.before = np.concatenate([[len(found)], self.codes[:-1]])


def halved(at: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
    """How often each place occurs in the first and in the second half."""
    return np.bincount(at * 2 + second, minlength=2 * size).reshape(-1, 2).T


def added(row: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and their sums of each line of values."""
    rows, at = np.unique(row, return_inverse=True)
    return rows, np.stack([np.bincount(at, v, len(rows)) for v in values]).astype(float, copy=False)


class Added:
    """Sums by row, of a bounded number of rows."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def take(self, row: np.ndarray, values: np.ndarray, last: bool = False):
        """Takes in more, and gives sums away when there are too many, or at the end."""
        self.parts.append((row, values))
        if last or sum(len(r) for r, _ in self.parts) > GATHERED:
            self.parts = [added(np.concatenate([r for r, _ in self.parts]), np.concatenate([v for _, v in self.parts], axis=1))]
            if last or len(self.parts[0][0]) > GATHERED // 2:
                found = self.parts.pop()
                if len(found[0]):  # at the end all may have been given away before
                    yield found


def halves(docs: DataFrame) -> DataFrame:
    """Each text, and whether it belongs to the second half of the documents. Repeated rows stay together."""
    return docs.select("text", (F.xxhash64("doc_id", "text") % 2 != 0).alias("second"))


def half_of(part: pa.RecordBatch, t: Tokens) -> np.ndarray:
    """The half of each token."""
    return part.column("second").to_numpy(zero_copy_only=False).astype(np.int64)[t.text]


def count_words(docs: DataFrame) -> DataFrame:
    """`key` of every word, and its counts in the first and the second half of the documents."""

    def run(batches):
        sums = Added()

        def told(found):
            return pa.RecordBatch.from_arrays([pa.array(found[0]), *(pa.array(n.astype(np.int64)) for n in found[1])], names=["key", "first", "second"])

        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                t = Tokens(part.column("text"))
                yield from map(told, sums.take(t.hashes, halved(t.codes, half_of(part, t), len(t.hashes))))
        yield from map(told, sums.take(np.empty(0, np.int64), np.empty((2, 0)), last=True))

    rows = halves(docs).mapInArrow(run, "key bigint, first bigint, second bigint")
    return rows.groupBy("key").agg(F.sum("first").alias("first"), F.sum("second").alias("second"))


class Model:
    """What every task needs: totals, frequent words and pairs, and the weights by bucket of the context's count."""

    def __init__(self, total: int, size: int, frequent: tuple[np.ndarray, np.ndarray]):
        self.total, self.size = total, size
        self.words, self.counts = frequent
        self.pairs = self.pair_counts = np.empty(0, np.int64)
        self.weights = np.full((66, 3), 1 / 3)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.total + 0.5 * (self.size + 1)))

    def count(self, at: np.ndarray) -> np.ndarray:
        """The counts of the frequent words at these places, 0 for places outside."""
        inside = (at >= 0) & (at < len(self.counts))
        return np.append(self.counts, 0)[np.where(inside, at, len(self.counts))]

    @staticmethod
    def bucket(c_context: np.ndarray) -> np.ndarray:
        """0 for a context never seen, else 1 more than the whole part of its count's binary logarithm."""
        return np.where(c_context > 0, np.floor(np.log2(np.maximum(c_context, 1))).astype(np.int64) + 1, 0)

    def parts(self, c_context: np.ndarray, c_word: np.ndarray, c_pair: np.ndarray) -> np.ndarray:
        """The three estimates of each row: bigram, unigram, uniform."""
        return np.stack([
            c_pair / np.maximum(c_context, 1), c_word / max(self.total, 1), np.full(len(c_context), 1 / (self.size + 1)),
        ], axis=1)

    def score(self, c_context: np.ndarray, c_word: np.ndarray, c_pair: np.ndarray) -> np.ndarray:
        return np.log10((self.parts(c_context, c_word, c_pair) * self.weights[self.bucket(c_context)]).sum(1))

    def learn(self, buckets: np.ndarray, parts: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> None:
        """Expectation-maximisation of the weights per bucket; buckets without rows take those of the nearest below."""
        mean = self._mix(parts, n, rounds, np.array([0.0, 0.5, 0.5])) if len(n) else np.array([0.0, 0.5, 0.5])
        last = mean
        for b in range(len(self.weights)):
            rows = buckets == b
            start = np.array([0.0, 0.5, 0.5]) if b == 0 else np.full(3, 1 / 3)
            self.weights[b] = last if not rows.any() else self._mix(parts[rows], n[rows], rounds, start)
            if b and rows.any():
                last = self.weights[b]
        self.weights[:, 2] = np.maximum(self.weights[:, 2], 1e-6)  # an unknown word keeps some probability
        self.weights /= self.weights.sum(1, keepdims=True)

    @staticmethod
    def _mix(parts: np.ndarray, n: np.ndarray, rounds: int, w: np.ndarray) -> np.ndarray:
        for _ in range(rounds):
            share = parts * w
            share *= (n / np.maximum(share.sum(1), 1e-300))[:, None]
            w = share.sum(0) / n.sum()
        return w


def tasks_for(spark: SparkSession, total: int) -> int:
    """The number of tasks in which the rows of so many training tokens meet."""
    return max(1, math.ceil(total / TOKENS_PER_TASK), int(spark.conf.get("spark.sql.shuffle.partitions")))


def rare_pairs(texts: DataFrame, counts: DataFrame, words_sent: Callable[[], np.ndarray]) -> DataFrame:
    """The pairs of two rare words that `texts` hold, with the counts of the second word in either half."""

    def run(batches):
        frequent = words_sent()
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                t = Tokens(part.column("text"))
                known = place(frequent, t.hashes) >= 0
                both = ~known[t.before] & ~known[t.codes]
                u = np.unique(t.before[both] * len(t.hashes) + t.codes[both])
                yield pa.RecordBatch.from_arrays([pa.array(t.hashes[u // len(t.hashes)]), pa.array(t.hashes[u % len(t.hashes)])], names=["context", "word"])

    pairs = texts.select("text").mapInArrow(run, "context bigint, word bigint")
    return pairs.join(counts, F.col("word") == F.col("key")).select("context", "word", "first", "second")


def events(total: np.ndarray, c_context: np.ndarray, c_word: np.ndarray, c_pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the weights are learned from: for the tokens of either half, the estimates by the counts of the other half.

    All counts come in two lines, one per half. Gives a number for bucket and rounded estimates, and for each row the
    tokens and their sums of both estimates.
    """
    bins, values = [], []
    for own, other in ((0, 1), (1, 0)):
        at = np.flatnonzero(c_pair[own] > 0)
        n, context = c_pair[own][at].astype(float), c_context[other][at]
        estimates = np.stack([c_pair[other][at] / np.maximum(context, 1), c_word[other][at] / max(total[other], 1)])
        steps = np.where(estimates > 0, 1 + np.floor(-STEPS * np.log2(np.where(estimates > 0, estimates, 1))), 0).astype(np.int64)
        bins.append((Model.bucket(context) << 20 | steps[0]) << 20 | steps[1])
        values.append(np.stack([n, *(n * estimates)]))
    return np.concatenate(bins), np.concatenate(values, axis=1)


def met_pairs(by_half: np.ndarray, code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of frequent words, and by half the counts of their contexts, words and themselves."""
    code, c_pair = added(code, n)
    return code, by_half[:, code >> 32], by_half[:, code & 0xFFFFFFFF], c_pair


def met_rare(by_half: np.ndarray, key: np.ndarray, other: np.ndarray, n: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By half the counts of contexts, words and pairs, of the distinct pairs in all rows of some keys; see `settled`."""
    order = np.lexsort((other, key))
    key, other, n, asks = key[order], other[order], n[:, order], asks[order]
    new_key = np.append(True, key[1:] != key[:-1])[: len(key)]
    new_pair = new_key | np.append(True, other[1:] != other[:-1])[: len(key)]
    first = np.flatnonzero(new_pair)
    frequent = by_half.shape[1] - 1
    by_word = (other >= 0) & (other < frequent)
    seen = np.where(asks, n, 0)
    c_key = np.add.reduceat(np.where(by_word, 0, seen), np.flatnonzero(new_key), axis=1)[:, (np.cumsum(new_key) - 1)[first]]
    c_pair = np.add.reduceat(seen, first, axis=1)
    answer = np.maximum.reduceat(np.where(asks, 0, n), first, axis=1)
    by_word, other = by_word[first], other[first]
    after = (other < 0) & (other >= -frequent)
    c_context = np.where(by_word, by_half[:, np.where(by_word, other, frequent)], c_key)
    c_word = np.where(by_word, c_key, np.where(after, by_half[:, np.where(after, -1 - other, frequent)], answer))
    return c_context, c_word, c_pair


def squeezed(held: list[bytes]) -> list[bytes]:
    """Packed columns, each in fewer bytes, with its size before."""
    return [len(x).to_bytes(4, "little") + pa.compress(x, codec="zstd", asbytes=True) for x in held]


def restored(held: bytes) -> bytes:
    return pa.decompress(held[4:], decompressed_size=int.from_bytes(held[:4], "little"), codec="zstd", asbytes=True)


def packed_keys(groups: int, key: np.ndarray, other: np.ndarray, *rest: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Columns packed by group of their keys, which hold only what the group leaves open of them."""
    found, held = packed(key % groups, np.stack([*split(key // groups), *split(other), *rest]))
    return found, squeezed(held)


def unpacked_keys(groups: int, group: int, held: bytes, columns: int) -> list[np.ndarray]:
    high, low, other_high, other_low, *rest = unpacked(restored(held), columns + 2)
    return [joined(high, low) * groups + group, joined(other_high, other_low), *rest]


def split(values: np.ndarray) -> list[np.ndarray]:
    """64-bit numbers as two columns of 32 bits."""
    return [values >> 32, values & 0xFFFFFFFF]


def joined(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return high << 32 | low & 0xFFFFFFFF


def train(
    docs: DataFrame, share: int = WORD_SHARE, pair_share: int = PAIR_SHARE, held_out_docs: int | None = None, rounds: int = ROUNDS,
    texts: DataFrame | None = None,
) -> tuple[Model, DataFrame]:
    """The model of all texts of `docs` (doc_id, text), and the pairs of rare words that `texts` (else `docs`) hold,
    with the counts of their second words. Only bounded tables come to the driver: at most `share` words, `pair_share`
    pairs, and the tokens by rounded estimates.

    Every document is held out once, with its half of them. `held_out_docs` is taken from older calls and bounds nothing.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "lm-words")
    rows = count_words(docs)
    rows.write.parquet(path)
    counts = spark.read.schema(rows.schema).parquet(path)
    n = F.col("first") + F.col("second")
    size, *in_half = counts.agg(F.count(F.lit(1)), *(F.coalesce(F.sum(c), F.lit(0)) for c in ("first", "second"))).first()
    total = sum(in_half)
    table = counts.filter(n * share >= total).toArrow()
    keys, *both = (table.column(c).to_numpy().astype(np.int64) for c in ("key", "first", "second"))
    order = np.argsort(keys)
    by_half = np.append(np.stack(both)[:, order], [[0], [0]], axis=1)
    model = Model(total, size, (keys[order], by_half[:, :-1].sum(0)))
    frequent = send(spark, (model.words, by_half))
    answers = cut(rare_pairs(docs if texts is None else texts, counts, lambda: frequent()[0]), "lm-rare-pairs")
    drop_path(spark, path)
    if not total:
        model.learn(np.empty(0, np.int64), np.empty((0, 3)), np.empty(0))
        return model, answers

    tasks = tasks_for(spark, total)
    groups = tasks * GROUPS_PER_TASK
    names = ["part", "key", "other", "first", "second", "pairs", "rare"]

    def spread(batches):
        known_words, _ = frequent()
        codes, rare = [], []

        def sent():
            code, n = added(*(np.concatenate(x, axis=-1) for x in zip(*codes, strict=True)))
            n = n.astype(np.int64)
            first, at = split(code)
            columns = np.stack([first, at, *n])
            meet, held = packed((pair(first, at).view(np.uint64) % np.uint64(groups)).astype(np.int64), columns)
            yield "pairs", (meet, squeezed(held))
            key, other, n = (np.concatenate(x, axis=-1) for x in zip(*rare, strict=True))
            yield "rare", packed_keys(groups, key, other, *n)
            codes.clear()
            rare.clear()

        def told(name, found):
            k = len(found[0])
            columns = {"part": pa.array(found[0]), name: pa.array(found[1], pa.binary())}
            kinds = dict.fromkeys(names, pa.int64()) | {"pairs": pa.binary(), "rare": pa.binary()}
            return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(k, kinds[c]) for c in names], names=names)

        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                t = Tokens(part.column("text"))
                u, where = np.unique(t.before * len(t.hashes) + t.codes, return_inverse=True)
                n = halved(where, half_of(part, t), len(u))
                known = place(known_words, t.hashes)
                before, word = u // len(t.hashes), u % len(t.hashes)
                first, at = known[before], known[word]
                has = (first >= 0) & (at >= 0)
                codes.append((first[has] << 32 | at[has], n[:, has]))
                context, word, first, at = t.hashes[before[~has]], t.hashes[word[~has]], first[~has], at[~has]
                rare.append((np.where(first >= 0, word, context), np.where(first >= 0, first, np.where(at >= 0, -1 - at, word)), n[:, ~has]))
                if sum(len(c) for c, _ in codes) + sum(len(k) for k, *_ in rare) > GATHERED:
                    yield from (told(*x) for x in sent())
        if codes:
            yield from (told(*x) for x in sent())

    def gather(batches):
        known_words, by_half = frequent()
        half_totals = np.array(in_half)
        pairs: dict[int, list[bytes]] = {}
        rare: list[tuple[int, bytes]] = []
        asked: list[list[np.ndarray]] = []
        sums = Added()

        def learned(found):
            k = len(found[0])
            return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.nulls(k, pa.int64()), *map(pa.array, found[1])], names=["bin", "key", "n", "bigram", "unigram"])

        for batch in batches:
            some = batch.filter(batch.column("pairs").is_valid())
            for group, rest in zip(some.column("part").to_pylist(), some.column("pairs").to_pylist(), strict=True):
                pairs.setdefault(group, []).append(rest)
            some = batch.filter(batch.column("rare").is_valid())
            rare += zip(some.column("part").to_pylist(), some.column("rare").to_pylist(), strict=True)
            some = batch.filter(batch.column("key").is_valid())
            asked.append([some.column(c).to_numpy() for c in ("key", "other", "first", "second")])
        while pairs:  # one group at a time
            _, group = pairs.popitem()
            first, at, *n = np.concatenate([unpacked(restored(rest), 4) for rest in group], axis=1)
            code, c_context, c_word, c_pair = met_pairs(by_half, first << 32 | at, np.stack(n))
            yield from map(learned, sums.take(*events(half_totals, c_context, c_word, c_pair)))
            often = np.flatnonzero(c_pair.sum(0) * pair_share >= total)
            none = pa.nulls(len(often), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(often), pa.int64()), pa.array(pair(known_words[code[often] >> 32], known_words[code[often] & 0xFFFFFFFF])), pa.array(c_pair.sum(0)[often]), none, none],
                names=["bin", "key", "n", "bigram", "unigram"],
            )
        columns = np.concatenate([np.empty((4, 0), np.int64), *(np.stack(unpacked_keys(groups, group, rest, 4)) for group, rest in rare)], axis=1)
        rare.clear()
        answered = np.concatenate([np.empty((4, 0), np.int64), *asked], axis=1).astype(np.int64)
        asks = np.arange(columns.shape[1] + answered.shape[1]) < columns.shape[1]
        if len(asks):
            key, other, *n = np.append(columns, answered, axis=1)
            found = met_rare(by_half, key, other, np.stack(n), asks)
            yield from map(learned, sums.take(*events(half_totals, *found)))
        yield from map(learned, sums.take(np.empty(0, np.int64), np.empty((3, 0)), last=True))

    kinds = StructType.fromDDL("part bigint, key bigint, other bigint, first bigint, second bigint, pairs binary, rare binary")
    rows = halves(docs).mapInArrow(spread, kinds).union(answers.select(
        F.pmod("context", F.lit(groups)).cast("bigint").alias("part"), F.col("context").alias("key"), F.col("word").alias("other"), "first", "second",
        F.lit(None).cast("binary").alias("pairs"), F.lit(None).cast("binary").alias("rare"),
    )).repartition(tasks, "part")
    found = rows.mapInArrow(gather, "bin bigint, key bigint, n double, bigram double, unigram double")
    table = found.groupBy("bin", "key").agg(*(F.sum(c).alias(c) for c in ("n", "bigram", "unigram"))).toArrow()
    often = table.filter(table.column("key").is_valid())
    keys, n = (often.column(c).to_numpy().astype(np.int64) for c in ("key", "n"))
    order = np.argsort(keys)
    model.pairs, model.pair_counts = keys[order], n[order]
    table = table.filter(table.column("bin").is_valid()).sort_by("bin")
    bins, n, bigram, unigram = (table.column(c).to_numpy() for c in ("bin", "n", "bigram", "unigram"))
    model.learn(bins >> 40, np.stack([bigram / n, unigram / n, np.full(len(n), 1 / (size + 1))], axis=1), n, rounds)
    return model, answers


def packed(groups: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The distinct groups and the columns' values (32 bits) in each, as planes of bytes, which compress well."""
    order = np.lexsort((columns[1], columns[0], groups))
    columns = columns[:, order].astype("<i4")
    found, first = np.unique(groups[order], return_index=True)
    bounds = np.append(first, len(order))
    planes = np.ascontiguousarray(columns).view(np.uint8).reshape(len(columns), -1, 4).transpose(0, 2, 1)
    return found, [planes[:, :, a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def unpacked(held: bytes, columns: int) -> np.ndarray:
    planes = np.frombuffer(held, np.uint8).reshape(columns, 4, -1).transpose(0, 2, 1)
    return np.ascontiguousarray(planes).view("<i4")[:, :, 0].astype(np.int64)


def settled_pairs(m: Model, context: np.ndarray, word: np.ndarray, row: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row, and known words, base score and score, added up by row, from all rows of some pairs of frequent words."""
    code = context << 32 | word
    order = np.argsort(code, kind="stable")
    code, row, n = code[order], row[order], n[order]
    new = np.append(True, code[1:] != code[:-1])[: len(code)]
    first = np.flatnonzero(new)
    c_pair = np.add.reduceat(np.maximum(n, 0), first)
    c_word = m.count(code[first] & 0xFFFFFFFF)
    each = np.cumsum(new) - 1
    values = np.stack([c_word > 0, m.base(c_word), m.score(m.count(code[first] >> 32), c_word, c_pair)])
    return added(row, np.abs(n) * values[:, each])


def settled(m: Model, key: np.ndarray, other: np.ndarray, row: np.ndarray, n: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row, and known words, base score and score, of the rows that ask, from all rows of some keys in the order of key and other."""
    new_key = np.append(True, key[1:] != key[:-1])[: len(key)]
    new_pair = new_key | np.append(True, other[1:] != other[:-1])[: len(key)]
    of_key, of_pair = np.cumsum(new_key) - 1, np.cumsum(new_pair) - 1
    by_word = (other >= 0) & (other < len(m.words))  # the key is the word, else the context; it is rare
    seen = np.where(asks, np.maximum(n, 0), 0)
    c_key = np.add.reduceat(np.where(by_word, 0, seen), np.flatnonzero(new_key))[of_key]
    c_pair = np.add.reduceat(seen, np.flatnonzero(new_pair))[of_pair]
    answer = np.maximum.reduceat(np.where(asks, 0, n), np.flatnonzero(new_pair))[of_pair]
    c_context = np.where(by_word, m.count(other), c_key)
    c_word = np.where(by_word, c_key, np.where((other < 0) & (other >= -len(m.words)), m.count(-1 - other), answer))
    c_context, c_word, c_pair, row, n = (x[asks] for x in (c_context, c_word, c_pair, row, np.abs(n)))
    return row, n * np.stack([c_word > 0, m.base(c_word), m.score(c_context, c_word, c_pair)])


def scores(docs: DataFrame, parts: int = FOLDS, held_fold: int = HELD_FOLD, **settings) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, one row per row of `docs`.

    Trains on the rows outside the held fold (an id that is null counts as the empty text). Null
    texts count as empty and have one token, the end. Repeated rows count and are scored each for
    itself; other columns are not looked at; an empty table gives an empty one, and a table
    without training rows gives every word the probability of an unknown one.
    """
    held_out = (fold("doc_id", parts) == held_fold).alias("held_out")
    rows = docs.select("doc_id", "text", held_out)
    model, answers = train(rows.filter(~F.col("held_out")).select("doc_id", "text"), texts=rows.select("text"), **settings)
    spark = docs.sparkSession
    sent = send(spark, model)
    doc_type = docs.schema["doc_id"].dataType
    doc = pa.struct([("held_out", pa.bool_()), ("tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])

    names = ["part", "key", "other", "row", "n", "packed", "rare", "doc_id", "doc"]
    tasks = tasks_for(spark, model.total)
    groups = tasks * GROUPS_PER_TASK

    def rows_of(name, row, meet, held_bytes, doc_kind):
        k = len(meet)
        blobs = {"packed": pa.nulls(k, pa.binary()), "rare": pa.nulls(k, pa.binary())} | {name: pa.array(held_bytes, pa.binary())}
        return pa.RecordBatch.from_arrays(
            [pa.array(meet), *[pa.nulls(k, pa.int64())] * 2, pa.array(np.full(k, row)), pa.nulls(k, pa.int64()), *blobs.values(), pa.nulls(k, doc_kind), pa.nulls(k, doc)],
            names=names,
        )

    def spread(batches):
        m = sent()
        rare: list[tuple[np.ndarray, ...]] = []

        def rare_rows(doc_kind):
            key, other, row, n = (np.concatenate(x) for x in zip(*rare, strict=True))
            rare.clear()
            return rows_of("rare", row[0], *packed_keys(groups, key, other, row - row[0], n), doc_kind)

        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                t = Tokens(part.column("text"))
                u_size, texts = len(t.hashes), len(t.number)
                known = place(m.words, t.hashes)
                # one row per text, context and word
                u, where = np.unique((t.text * u_size + t.before) * u_size + t.codes, return_inverse=True)
                n = np.bincount(where, minlength=len(u))
                code, rest = u % u_size, u // u_size
                before, text = rest % u_size, rest // u_size
                first, at = known[before], known[code]
                word = t.hashes[code]
                pair_at = np.full(len(u), -1)
                has = (first >= 0) & (at >= 0)
                pair_at[has] = place(m.pairs, pair(t.hashes[before[has]], word[has]))
                here = pair_at >= 0
                c_word = m.count(at[here])
                c_pair = m.pair_counts[pair_at[here]]
                w = n[here]
                own = [np.bincount(text[here], x, texts) for x in (w, w * m.base(c_word), w * m.score(m.count(first[here]), c_word, c_pair))]
                held = part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                row = part.column("row").to_numpy()
                facts = pa.StructArray.from_arrays(
                    [pa.array(held), pa.array(t.number), pa.array(own[0].astype(np.int64)), *(pa.array(x.astype(float)) for x in own[1:])], names=[f.name for f in doc]
                )
                doc_kind = part.schema.field("doc_id").type
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row % groups), *[pa.nulls(texts, pa.int64())] * 2, pa.array(row), pa.nulls(texts, pa.int64()), *[pa.nulls(texts, pa.binary())] * 2, part.column("doc_id"), facts],
                    names=names,
                )
                signed = np.where(held[text], -n, n)
                out = np.flatnonzero(has & ~here)
                if len(out):
                    meet = (pair(first[out], at[out]).view(np.uint64) % np.uint64(groups)).astype(np.int64)
                    yield rows_of("packed", row[0], *packed(meet, np.stack([first[out], at[out], text[out], signed[out]])), doc_kind)
                # `other` of a frequent context is its place, of a frequent word after a rare context -1 less its place
                out = np.flatnonzero(~has)
                if len(out):
                    first, at, word, context = first[out], at[out], word[out], t.hashes[before[out]]
                    key = np.where(first >= 0, word, context)
                    other = np.where(first >= 0, first, np.where(at >= 0, -1 - at, word))
                    rare.append((key, other, row[text[out]], signed[out]))
                    if sum(len(k) for k, *_ in rare) > GATHERED // 2:
                        yield rare_rows(doc_kind)
        if rare:
            yield rare_rows(doc_kind)

    facts_ddl = "struct<held_out: boolean, tokens: bigint, known: bigint, base: double, score: double>"
    kind = doc_type.simpleString()
    sent_schema = StructType.fromDDL(f"part bigint, key bigint, other bigint, row bigint, n bigint, packed binary, rare binary, doc_id {kind}, doc {facts_ddl}")
    numbered = rows.withColumn("row", F.monotonically_increasing_id())  # the rows of a slice have successive numbers

    # the count of the word of each pair of rare words: a row of no text
    answers = answers.withColumn("n", F.col("first") + F.col("second")).select(
        F.pmod("context", F.lit(groups)).cast("bigint").alias("part"), F.col("context").alias("key"), F.col("word").alias("other"),
        *[F.lit(None).cast(sent_schema[c].dataType).alias(c) if c != "n" else F.col("n") for c in ("row", "n", "packed", "rare", "doc_id", "doc")],
    )
    met = numbered.mapInArrow(spread, sent_schema).union(answers).repartition(tasks, "part")

    def gather(batches):
        m = sent()
        held: list[list[np.ndarray]] = []
        pairs: dict[int, list[tuple[int, bytes]]] = {}
        sums = Added()
        doc_kind = None
        for batch in batches:
            doc_kind = batch.schema.field("doc_id").type
            is_doc = batch.column("doc").is_valid()
            some = batch.filter(is_doc)
            if some.num_rows:
                facts = some.column("doc")
                block = pa.array(some.column("row").to_numpy() >> BLOCK_BITS)
                yield pa.RecordBatch.from_arrays(
                    [block, some.column("row"), some.column("doc_id"), *(facts.field(i) for i in range(5)), pa.nulls(some.num_rows, pa.binary())], names=told
                )
            some = batch.filter(batch.column("packed").is_valid())
            for group, row, rest in zip(*(some.column(c).to_pylist() for c in ("part", "row", "packed")), strict=True):
                pairs.setdefault(group, []).append((row, rest))
            some = batch.filter(batch.column("rare").is_valid())
            for group, row, rest in zip(*(some.column(c).to_pylist() for c in ("part", "row", "rare")), strict=True):
                key, other, text, n = unpacked_keys(groups, group, rest, 4)
                held.append([key, other, row + text, n, np.ones(len(n), bool)])
            answer = batch.filter(batch.column("key").is_valid())
            if answer.num_rows:
                key, other, n = (answer.column(c).to_numpy() for c in ("key", "other", "n"))
                held.append([key, other, np.zeros(len(n), np.int64), n, np.zeros(len(n), bool)])

        def summed(row, values):
            blocks, first = np.unique(row >> BLOCK_BITS, return_index=True)
            lines = np.vstack([row & (1 << BLOCK_BITS) - 1, values]).astype("<f8")
            sums = [lines[:, x:y].tobytes() for x, y in zip(first, np.append(first[1:], len(row)), strict=True)]
            k = len(blocks)
            kinds = [pa.int64(), doc_kind, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(blocks), *(pa.nulls(k, t) for t in kinds), pa.array(sums, pa.binary())], names=told)

        while pairs:  # one group at a time
            _, group = pairs.popitem()
            columns = [unpacked(rest, 4) for _, rest in group]
            for c, (row, _) in zip(columns, group, strict=True):
                c[2] += row
            for found in sums.take(*settled_pairs(m, *np.concatenate(columns, axis=1))):
                yield summed(*found)
        if doc_kind is None:
            return
        none = np.empty(0, np.int64)
        columns = [np.concatenate([*(x[i] for x in held), none if i < 4 else none.astype(bool)]) for i in range(5)]
        held.clear()
        order = np.lexsort((columns[1], columns[0]))
        for i in range(5):
            columns[i] = columns[i][order]
        # some whole keys at a time
        ends = np.append(np.flatnonzero(columns[0][1:] != columns[0][:-1]) + 1, len(order))
        cuts = np.unique(np.append(0, ends[np.searchsorted(ends, np.arange(SCORED, len(order) + SCORED, SCORED).clip(max=len(order)))]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            for found in sums.take(*settled(m, *(x[a:b] for x in columns))):
                yield summed(*found)
        for found in sums.take(np.empty(0, np.int64), np.empty((3, 0)), last=True):
            yield summed(*found)

    def total(batches):
        texts: list[pa.RecordBatch] = []
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            is_doc = batch.column("row").is_valid()
            texts.append(batch.filter(is_doc).drop_columns(["block", "sums"]))
            some = batch.filter(pc.invert(is_doc))
            for block, rest in zip(some.column("block").to_pylist(), some.column("sums").to_pylist(), strict=True):
                lines = np.frombuffer(rest, "<f8").reshape(4, -1)
                parts.append(((block << BLOCK_BITS) + lines[0].astype(np.int64), lines[1:]))
        if not sum(t.num_rows for t in texts):
            return
        parts.append((np.empty(0, np.int64), np.empty((3, 0))))
        rows, sums = added(np.concatenate([r for r, _ in parts]), np.concatenate([v for _, v in parts], axis=1))
        sums = np.concatenate([sums, np.zeros((3, 1))], axis=1)
        for t in texts:
            own = sums[:, place(rows, t.column("row").to_numpy())]
            k = t.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    t.column("doc_id"), t.column("held_out"), t.column("tokens"), pa.array(t.column("known").to_numpy() + own[0].astype(np.int64)),
                    pa.array(np.full(k, model_total)), pa.array(t.column("base").to_numpy() + own[1]), pa.array(t.column("score").to_numpy() + own[2]),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    told = ["block", "row", "doc_id", "held_out", "tokens", "known", "base", "score", "sums"]
    model_total = int(model.total)
    # each task has added up a text's rows; the sums meet by blocks of texts
    facts = met.mapInArrow(
        gather, f"block bigint, row bigint, doc_id {kind}, held_out boolean, tokens bigint, known bigint, base double, score double, sums binary"
    ).repartition(tasks, "block")
    return facts.mapInArrow(
        total, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
