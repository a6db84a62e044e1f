"""Exact top-k inner products, block at a time.

Vectors of whole numbers are held in shards (rows of the shared folder), each a series of blocks with a
forward index of its vectors and the least and greatest value of every component. The sum of what a
block's extremes could give bounds every score in it. A query starts from its k-th score in one shard
of bounded size. Then the extremes of whole shards, in pages, tell which shards can reach that score for
which queries of a block, and only those meet. In a shard, blocks are taken in order of their bound and
scored until the bound falls below the k-th score known.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicmart.llm.columns import send
from civicmart.session import cut

SCALE = 1024
EVERY = 100
TOP = 10
#: Vectors per shard and per block, queries that meet a shard together, and shards whose extremes lie in a page.
SHARD, BLOCK, QUERIES, PAGE = 8192, 128, 256, 512
EXACT = 1 << 53


def whole_numbers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """`vec_id` and `v`, floor(scale * component); vectors that are null, without id, or hold a null or
    non-finite component are left out. Components beyond 64 bits become the greatest that fit."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound)
    return kept.select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"))


def dense(column: pa.Array) -> np.ndarray:
    """Lists as a matrix; shorter ones end in zeros, so products run over the components both have."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T; sums beyond 64 bits become the greatest that fit."""
    n = min(a.shape[1], b.shape[1])
    a, b = a[:, :n], b[:, :n]
    reach = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * n
    if reach < EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    wide = a.astype(object) @ b.astype(object).T
    return np.clip(wide, -(2**63), 2**63 - 1).astype(np.int64) if wide.size else np.zeros((len(a), len(b)), np.int64)


def matrix(vectors: bytes, rows: int) -> np.ndarray:
    """Vectors as they are kept in a row; of empty ones only their number is known."""
    return np.frombuffer(vectors, np.int64).reshape(rows, -1) if vectors else np.zeros((rows, 0), np.int64)


def gathered(rows: DataFrame, size: int, ordered: bool, more: tuple[str, ...] = ()) -> DataFrame:
    """Rows in groups of up to `size` vectors: ids, vectors and further whole numbers as bytes.

    With `ordered`, vectors with the same largest component lie side by side, which tightens blocks.
    """
    names = ("vec_id", *more)

    def run(batches):
        held, parts = [[] for _ in names], []

        def group():
            width = max(p.shape[1] for p in parts)
            v = np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])
            columns = [np.concatenate(h) for h in held]
            if ordered and width:
                most = np.argmax(np.abs(v.astype(float)), axis=1)
                order = np.lexsort((columns[0], v[np.arange(len(v)), most] < 0, most))
                v, columns = v[order], [c[order] for c in columns]
            return pa.RecordBatch.from_arrays([*[pa.array([c.tobytes()], pa.binary()) for c in columns], pa.array([v.tobytes()], pa.binary())], names=["ids", *more, "vectors"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                some = batch.slice(at, size - sum(len(p) for p in parts))
                at += some.num_rows
                for h, name in zip(held, names, strict=True):
                    h.append(some.column(name).to_numpy().astype(np.int64))
                parts.append(dense(some.column("v")))
                if sum(len(p) for p in parts) == size:
                    yield group()
                    held, parts = [[] for _ in names], []
        if parts:
            yield group()

    return rows.mapInArrow(run, ", ".join(f"{name} binary" for name in ("ids", *more, "vectors")))


def most(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Per query and pair of extremes: no score with vectors in between is greater."""
    n = min(q.shape[1], low.shape[1])
    q = q[:, :n].astype(float)
    bound = np.maximum(q, 0) @ high[:, :n].astype(float).T + np.minimum(q, 0) @ low[:, :n].astype(float).T
    return bound + np.abs(bound) * 1e-9 + 1  # floats may round down


class Blocks:
    """One shard's blocks with the extremes of their components."""

    def __init__(self, ids: bytes, vectors: bytes, block: int = BLOCK):
        self.ids = np.frombuffer(ids, np.int64)
        self.v = matrix(vectors, len(self.ids))
        self.first = np.arange(0, len(self.ids), block)
        self.low = np.minimum.reduceat(self.v, self.first)
        self.high = np.maximum.reduceat(self.v, self.first)
        self.last = np.append(self.first[1:], len(self.ids))

    def top(self, q: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query number, vector id and score of each query's best k in this shard that reach its floor.

        `own` is the place of the query's own row in this shard, or -1.
        """
        bounds = most(q, self.low, self.high)
        order = np.argsort(-bounds, axis=1)
        scores = [np.empty(0, np.int64) for _ in q]
        ids = [np.empty(0, np.int64) for _ in q]
        floor = floor.astype(float).copy()
        open_ = np.arange(len(q))
        for turn in range(len(self.first)):
            open_ = open_[bounds[open_, order[open_, turn]] >= floor[open_]]
            if not len(open_):
                break
            for b in np.unique(order[open_, turn]):
                mine = open_[order[open_, turn] == b]
                part = slice(self.first[b], self.last[b])
                found = products(q[mine], self.v[part])
                for r, row in zip(mine.tolist(), found, strict=True):
                    fits = row >= floor[r]
                    if self.first[b] <= own[r] < self.last[b]:
                        fits[own[r] - self.first[b]] = False
                    if not fits.any():
                        continue
                    s, i = np.append(scores[r], row[fits]), np.append(ids[r], self.ids[part][fits])
                    best = np.lexsort((i, -s))[:k]
                    scores[r], ids[r] = s[best], i[best]
                    if len(best) == k:
                        floor[r] = max(floor[r], float(scores[r][-1]))
        sizes = [len(s) for s in scores]
        return np.repeat(np.arange(len(q)), sizes), np.concatenate(ids), np.concatenate(scores)


#: A block of queries: ids, own rows (shard and place there), vectors, and the score each has to reach.
_QUERIES = "ids binary, shard binary, place binary, vectors binary, floor binary"
_FIELDS = ("ids", "shard", "place", "floor")


def _queries(row: dict) -> tuple[dict[str, np.ndarray], np.ndarray]:
    held = {name: np.frombuffer(row[name], np.int64) for name in _FIELDS if name in row}
    return held, matrix(row["vectors"], len(held["ids"]))


def _batch(rows: list[dict], fields: str) -> pa.RecordBatch:
    kinds = {"binary": pa.binary(), "bigint": pa.int64()}
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, kinds[k]) for n, k in (f.split() for f in fields.split(", "))]))


def _own_places(held: dict[str, np.ndarray], shard: int) -> np.ndarray:
    return np.where(held["shard"] == shard, held["place"], -1)


def _rows_of(shards: DataFrame, every: int) -> DataFrame:
    """Rows whose id is divisible by `every`, each with its place."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                v = matrix(row["vectors"], len(ids))
                place = np.flatnonzero(ids % every == 0)
                if len(place):
                    lists = pa.ListArray.from_arrays(np.arange(len(place) + 1, dtype=np.int32) * v.shape[1], pa.array(v[place].ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[place]), pa.array(np.full(len(place), row["shard"])), pa.array(place), lists], names=["vec_id", "shard", "place", "v"]
                    )

    return shards.select("shard", "ids", "vectors").mapInArrow(run, "vec_id bigint, shard bigint, place bigint, v array<bigint>")


def _extremes(shards: DataFrame) -> DataFrame:
    """Pages with the extremes of whole shards, at most `PAGE` of one width to a page."""

    def run(batches):
        open_: dict[int, list] = {}

        def page(rows):
            return _batch([{"shards": np.array([r[0] for r in rows]).tobytes(), "low": np.stack([r[1] for r in rows]).tobytes(), "high": np.stack([r[2] for r in rows]).tobytes()}], "shards binary, low binary, high binary")

        for batch in batches:
            for row in batch.to_pylist():
                v = matrix(row["vectors"], len(row["ids"]) // 8)
                same = open_.setdefault(v.shape[1], [])
                same.append((row["shard"], v.min(axis=0), v.max(axis=0)))
                if len(same) == PAGE:
                    yield page(open_.pop(v.shape[1]))
        for same in open_.values():
            yield page(same)

    return shards.select("shard", "ids", "vectors").mapInArrow(run, "shards binary, low binary, high binary")


def neighbours(vectors: DataFrame, every: int = EVERY, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id and score of each query's best; ties go to the smaller id.

    Each row whose id is divisible by `every` is a query of its own, also where ids repeat: every query has its
    ranks from 1. Candidates are all rows but the query's own, so other rows with its id are among them.
    Vectors of different length are multiplied over the components both have; an empty one scores 0 with all.
    Rows without id take no part. An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    shards = cut(gathered(whole_numbers(vectors), SHARD, True).select(F.monotonically_increasing_id().alias("shard"), "*"), "topk-shards")
    queries = gathered(_rows_of(shards, every), QUERIES, False, ("shard", "place"))

    first = shards.orderBy(F.xxhash64("ids"), "shard").limit(1).collect()  # one shard, of bounded size
    seed = send(spark, tuple(first[0]) if first else None)
    lowest = -(2**63)

    def start(batches):
        held_seed = seed()
        if held_seed is None:  # no rows, and so no queries
            return
        shard, ids, vectors = held_seed
        blocks = Blocks(ids, vectors)
        for batch in batches:
            for row in batch.to_pylist():
                held, q = _queries(row)
                floor = np.full(len(q), lowest, np.int64)
                number, _, score = blocks.top(q, _own_places(held, shard), floor, top)
                least = np.full(len(q), 2**63 - 1, np.int64)
                np.minimum.at(least, number, score)
                floor = np.where(np.bincount(number, minlength=len(q)) == top, least, lowest)
                yield _batch([row | {"floor": floor.tobytes()}], _QUERIES)

    started = cut(queries.mapInArrow(start, _QUERIES), "topk-floors")
    pages = cut(_extremes(shards), "topk-extremes")
    count = F.lit(max(pages.count(), 1)).cast("bigint")  # one per PAGE shards, and per task and width
    dealt = pages.select(F.pmod(F.xxhash64("shards"), count).alias("page"), "*")  # a block meets every number, and so every page, once
    asked = started.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)).alias("page")).join(dealt, "page").drop("page")

    def reach(batches):
        """The queries of a block that a shard can give anything, for each shard of a page."""
        for batch in batches:
            for row in batch.to_pylist():
                held, q = _queries(row)
                shards = np.frombuffer(row["shards"], np.int64)
                bounds = most(q, matrix(row["low"], len(shards)), matrix(row["high"], len(shards)))
                for at, fits in zip(shards.tolist(), (bounds >= held["floor"].astype(float)[:, None]).T, strict=True):
                    if fits.any():
                        part = {name: held[name][fits].tobytes() for name in _FIELDS}
                        yield _batch([part | {"vectors": q[fits].tobytes(), "at": at}], _QUERIES + ", at bigint")

    met = asked.mapInArrow(reach, _QUERIES + ", at bigint").join(shards.select(F.col("shard").alias("at"), F.col("ids").alias("all_ids"), F.col("vectors").alias("all_vectors")), "at")

    def score(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                held, q = _queries(row)
                number, found, best = Blocks(row["all_ids"], row["all_vectors"]).top(q, _own_places(held, row["at"]), held["floor"], top)
                columns = [held["ids"][number], held["shard"][number], held["place"][number], found, best]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "shard", "place", "vec_id", "score"])

    found = met.mapInArrow(score, "query_id bigint, shard bigint, place bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("shard", "place").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
