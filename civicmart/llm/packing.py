"""Packing of documents into windows of a fixed number of tokens.

Every document is cut into whole windows and one rest. The rests are packed by a plan made from the
histogram of their lengths alone (at most one bin per length): combinations of two or three lengths
that fill a window get repeat counts by non-negative least squares against the histogram, the counts
are rounded down, and what remains is packed greedily. Pieces find their place by their rank among
the pieces of the same length, so only counts pass through the driver.
"""

from __future__ import annotations

import math
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicmart.llm.columns import distinct, flat, ragged, send, slices
from civicmart.session import fresh_path

WINDOW = 1024
END = 0
#: Pieces of one length that are ranked together, on average.
RANKED_TOGETHER = 1000
#: Distinct pre-tokens whose ids a task remembers at a time.
REMEMBERED = 500_000

# fixed values of the vocabulary's pre-tokenizer: contractions that are cut off, and white space
SHORT = ("s", "t", "m", "d")
LONG = ("re", "ve", "ll")
SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def character_kinds() -> np.ndarray:
    """1 letter, 2 number, 3 white space, 0 anything else, by code point."""
    heads = np.frombuffer("".join(unicodedata.category(chr(c))[0] for c in range(0x110000)).encode(), np.uint8)
    kinds = np.where(heads == ord("L"), 1, np.where(heads == ord("N"), 2, 0)).astype(np.uint8)
    kinds[SPACES] = 3
    return kinds


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


def pre_tokens(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pre-tokens begin in the bytes of all texts, and how many lie before each text.

    Runs of letters, numbers, white space or others; one blank goes with the run after it, another
    last white space stands alone; contractions are cut off.
    """
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    n = len(points)
    if not n:
        return np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    text_at = np.searchsorted(chars, offsets)
    head = np.zeros(n + 3, bool)
    head[text_at] = True
    kind = kinds[points]
    first = head[:n].copy()
    first[1:] |= kind[1:] != kind[:-1]
    after = 1 + np.flatnonzero((kind[1:] != 3) & (kind[:-1] == 3) & ~head[1:n])
    first[after - 1] = True
    first[after[points[after - 1] == 32]] = False
    quote = np.flatnonzero((points == 39) & first)
    if len(quote):
        ahead = np.concatenate([points, np.zeros(3, np.uint32)])
        one, two = ahead[quote + 1], ahead[quote + 2]
        ends = np.zeros(len(quote), np.int64)
        ends[np.isin(one, [ord(c) for c in SHORT])] = 2
        for c in LONG:
            ends[(one == ord(c[0])) & (two == ord(c[1])) & ~head[quote + 2]] = 3
        ends[head[quote + 1]] = 0
        cut, ends = quote[ends > 0], ends[ends > 0]
        first[cut + 1] = False
        stop = cut + ends
        first[stop[stop < n]] = True
    at = np.flatnonzero(first)
    return chars[at], np.searchsorted(at, text_at)


class ByteEncoder:
    """Ids of whole texts as the vocabulary's own library gives them, looked up once per distinct pre-token."""

    def __init__(self, vocabulary: str, kinds: np.ndarray, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(vocabulary)
        self.model.no_truncation()
        self.model.no_padding()
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.kinds = kinds
        self.letters = byte_letters()
        self.known: dict[bytes, list[int]] = {}
        self.remembered = remembered

    def look_up(self, tokens: list[bytes]) -> list[list[int]]:
        if len(self.known) > self.remembered:
            self.known.clear()
        cut = self.model.model.tokenize
        for t in tokens:
            if t not in self.known:
                self.known[t] = [x.id for x in cut(t.decode("latin-1").translate(self.letters))]
        return [self.known[t] for t in tokens]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null and empty have none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        own: dict[int, np.ndarray] = {}
        for s in self.special:
            for i in np.flatnonzero(pc.match_substring(texts, s).to_numpy(zero_copy_only=False)).tolist():
                own[i] = np.array(self.model.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
        if own:
            mask = np.zeros(len(texts), bool)
            mask[list(own)] = True
            texts = pc.if_else(pa.array(mask), pa.scalar("", pa.large_string()), texts)
        data, offsets = flat(texts)
        at, before = pre_tokens(data, offsets, self.kinds)
        codes, tokens = distinct(data, np.append(at, data.size))
        found = self.look_up(tokens)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for x in found for i in x), np.uint32, int(sizes.sum()))
        begin = np.cumsum(sizes) - sizes
        sizes_at = sizes[codes] if len(codes) else np.empty(0, np.int64)
        everything = ids[ragged(begin[codes], sizes_at)] if len(codes) else ids
        bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes_at)])[before]
        return [own.get(i, everything[bounds[i] : bounds[i + 1]]) for i in range(len(texts))]


def cut_pieces(docs: DataFrame, vocabulary: str, window: int = WINDOW) -> DataFrame:
    """Whole windows and one rest per document: doc_id, start, length, ids_crc32, doc_tokens."""
    with open(vocabulary, encoding="utf-8") as f:
        held = send(docs.sparkSession, (f.read(), character_kinds()))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encoder = ByteEncoder(*held())
        for batch in batches:
            for part in slices(batch):
                rows, out = [], []
                for i, ids in enumerate(encoder.encode(part.column("text"))):
                    ids = np.append(ids, np.uint32(END)).astype("<u4")
                    for start in range(0, len(ids), window):
                        piece = ids[start : start + window]
                        rows.append(i)
                        out.append((start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
                numbers = np.array(out, np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(rows, pa.int64())), *(pa.array(numbers[:, k]) for k in range(4))],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def fit_repeats(counts: np.ndarray, window: int = WINDOW, sweeps: int = 40) -> list[tuple[tuple[int, ...], float]]:
    """Non-negative least squares of repeat counts of filling pairs and triples against a histogram.

    `counts[l]` pieces have length l. Solved by coordinate descent, pairs first, which keeps the
    solution sparse: each step sets one repeat count to its best value, never below zero.
    """
    has = [n for n in range(1, window) if counts[n]]
    present = set(has)
    combos = [(a, window - a) for a in has if a <= window - a and window - a in present]
    combos += [(a, b, window - a - b) for a in has for b in has if a <= b <= window - a - b and window - a - b in present]
    rest, repeats = counts.astype(float).tolist(), [0.0] * len(combos)
    weights = [sum(c.count(x) ** 2 for x in set(c)) for c in combos]
    active = range(len(combos))
    for sweep in range(sweeps):
        moved = 0.0
        for k in active:
            combo = combos[k]
            step = sum(rest[x] for x in combo) / weights[k]
            step = max(step, -repeats[k])
            if step:
                repeats[k] += step
                moved = max(moved, abs(step))
                for x in combo:
                    rest[x] -= step
        if moved < 0.25:
            break
        if sweep % 4 == 3:  # the others stay at zero unless the next full sweep moves them
            active = range(len(combos))
        else:
            active = [k for k in active if repeats[k] > 0]
    return [(combos[k], r) for k, r in enumerate(repeats) if r >= 1]


def plan(counts: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns (length, times) with their repeats, which use up the histogram exactly.

    Lengths that are powers of two need no padding alone, but they go into windows like the others.
    """
    left = counts.astype(np.int64).copy()
    out: list[tuple[tuple[tuple[int, int], ...], int]] = []

    def put(pattern: dict[int, int], times: int) -> None:
        if times > 0:
            out.append((tuple(pattern.items()), times))
            for x, n in pattern.items():
                left[x] -= n * times

    if left[window]:
        put({window: 1}, int(left[window]))
    for combo, repeats in sorted(fit_repeats(left, window), key=lambda c: -c[1]):
        pattern = {x: combo.count(x) for x in combo}
        put(pattern, min(int(repeats), *(int(left[x]) // n for x, n in pattern.items())))
    while left.any():
        gap, pattern = window, {}
        lengths = np.flatnonzero(left)[::-1].tolist()
        for x in lengths:
            n = min(gap // x, int(left[x]))
            if n:
                pattern[x] = n
                gap -= n * x
            if not gap:
                break
        put(pattern, min(int(left[x]) // n for x, n in pattern.items()))
    return out


def slots(patterns: list[tuple[tuple[tuple[int, int], ...], int]]) -> np.ndarray:
    """Per pattern and length: length, first rank, times in a window, first window, offset; in order of length and rank."""
    used: dict[int, int] = {}
    rows, window = [], 0
    for pattern, repeats in patterns:
        offset = 0
        for x, n in pattern:
            rows.append((x, used.get(x, 0), n, window, offset))
            used[x] = used.get(x, 0) + n * repeats
            offset += x * n
        window += repeats
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Ids are those of the vocabulary, then id 0 as the end of the document; null texts count as empty,
    so each document has a piece. Rows that repeat are packed each for itself. An empty table gives
    an empty one. The pieces (no ids) are written once to the shared work folder. Broadcast are the
    vocabulary and the plan, which has at most `window` entries per pattern.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "pieces")
    cut_pieces(docs, vocabulary, window).write.parquet(path)
    pieces = spark.read.parquet(path)
    counts = np.zeros(window + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most one row per length
        counts[length] = n
    table = spark.sparkContext.broadcast(slots(plan(counts, window)))

    buckets = max(1, math.ceil(int(counts.sum()) / RANKED_TOGETHER))
    bucket = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).alias("_bucket")
    pieces = pieces.select("*", bucket)
    sizes = pieces.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = pieces.withColumn("_rank", F.row_number().over(inside) - 1).join(firsts, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_first")).drop("_bucket", "_first")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def place(batches):
        rows = table.value
        key = (rows[:, 0] << 48) + rows[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "_rank"))
            slot = rows[np.searchsorted(key, (length << 48) + rank, side="right") - 1]
            nth = rank - slot[:, 1]
            sequence, offset = slot[:, 3] + nth // slot[:, 2], slot[:, 4] + nth % slot[:, 2] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return ranked.select(*names, "_rank").mapInArrow(place, schema)
