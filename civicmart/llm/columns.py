"""Arrow text columns as flat arrays, so that whole texts are cut into words without a Python object per word.

Tasks take one slice of a batch at a time, at most `CHUNK_BYTES` of text (or one longer text), which
bounds a task's memory whatever the batch holds.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 4 << 20


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; an id that is null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts


def sample(rows: DataFrame, n: int, *by: str) -> DataFrame:
    """At most `n` rows in the order of a hash, the same on every run, whatever the number of tasks.

    A share of the hash range that should hold half as many again is cut out first, so that tasks send
    about that many rows in all and not `n` each. Rows should differ in the columns given.
    """
    share = min(1.0, (1.5 * n + 100) / max(rows.count(), 1))
    h = F.xxhash64(*by)
    near = rows if share == 1.0 else rows.filter(F.pmod(h, F.lit(1 << 30)) < int(share * (1 << 30)))
    return near.orderBy(h, *by).limit(n)


def send(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcasts a value of a bounded size together with the code of its class; tasks call the result."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (with the end). Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most `limit` bytes of text, or with one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def all_but(separators: bytes) -> np.ndarray:
    """For each byte whether it belongs to a word."""
    kept = np.ones(256, bool)
    kept[np.frombuffer(separators, np.uint8)] = False
    return kept


#: Words are all runs without blanks (\x20, \x09 to \x0D).
BLANK = all_but(bytes([32, 9, 10, 11, 12, 13]))
#: Words are runs of digits, letters and everything beyond ASCII.
PLAIN = all_but(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
PLAIN[65:91] = True


def words(data: np.ndarray, offsets: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of all texts, with A-Z in lower case.

    Returns their bytes without separators, where each word begins there (with the end), the number
    of words before each text (with the total), and where each word begins in `data`.
    """
    inside = kept[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < data.size]
    first[begins] = inside[begins]
    at = np.flatnonzero(first)
    count = np.cumsum(inside, dtype=np.int64)
    starts = np.append(count[at] - 1, count[-1] if data.size else 0)
    return LOWER[data[inside]], starts, np.searchsorted(at, offsets), at


def distinct(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """For each word its number among the distinct ones, and the distinct words."""
    if len(starts) < 2:
        return np.empty(0, np.int64), []
    data = np.ascontiguousarray(data)
    array = pa.Array.from_buffers(
        pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)]
    ).dictionary_encode()
    return array.indices.to_numpy(), array.dictionary.to_pylist()


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every run, one run after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of the values between successive bounds; empty ranges sum to 0."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


ODD = np.uint64(0x9E3779B97F4A7C15)


class Spans:
    """Hashes of any byte ranges of one array, from sums of bytes times powers of an odd number."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        back = np.uint64(pow(int(ODD), -1, 1 << 64))
        powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, ODD)]))
        self.inverse = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, back)]))
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1])])

    def of(self, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
        h = (self.total[ends] - self.total[starts]) * self.inverse[starts] + np.uint64(salt * int(ODD) % (1 << 64))
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))
