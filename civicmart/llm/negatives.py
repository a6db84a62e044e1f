"""Hard negatives from vectors in blocks along a Hilbert curve, chosen by interval arithmetic.

Every vector has a place on a Hilbert curve through all its components, so vectors that follow each other lie close.
They are stored in that order as Parquet rows of one block each, with the least and greatest value of every component
(the block's zone) and the labels it holds. The products of an anchor with all vectors of a block lie in an interval
that follows from its zone alone. Anchors go through in bounded groups, each in two rounds over the zones: for the
positives a block is read if its interval reaches the anchor's fifth best score in its own block, for the negatives if
its interval meets a window that the positives left and it holds another label. Only blocks that some anchor of the
group must read leave the table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicmart.llm.columns import send
from civicmart.llm.topk import dense, products
from civicmart.session import cut, fresh_path

SCALE, EVERY, POSITIVES, NEGATIVES = 256, 100, 5, 10
#: Window of a negative's score, in hundredths of the positive's.
LEAST, MOST = 30, 90
#: Vectors of a block, anchors that go through together, bits of a component on the curve.
BLOCK, ANCHORS, BITS = 256, 2048, 4
#: Stands for an id that is null; it comes before all others.
NO_ID = -(2**63)
MERGE_AT = 1_000_000
#: One block in so many is read first.
SEED = 8


def sound(vectors: DataFrame, scale: int, relabelled: int = 7, labels: int = 10) -> DataFrame:
    """row (a number of its own), vec_id, label and v, floor(scale * component), of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.select("vec_id", "embedding", "label").filter(F.col("embedding").isNotNull() & F.col("label").isNotNull() & finite)
    moved = F.when(F.col("vec_id") % relabelled == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")).cast("bigint")
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return kept.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("vec_id").cast("bigint"), F.lit(NO_ID)).alias("vec_id"), moved.alias("label"), whole.alias("v"))


def curve(steps: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve through a grid of 2^bits steps a component, as rows of bytes in order.

    The known transform of coordinates to a curve index in any number of dimensions, on whole columns.
    """
    x = steps.T.astype(np.int64).copy()
    for bit in range(bits - 1, 0, -1):  # undo the turns of the cells, from the largest
        high, rest = 1 << bit, (1 << bit) - 1
        for i in range(len(x)):
            turned = (x[i] & high) != 0
            swapped = np.where(turned, 0, (x[0] ^ x[i]) & rest)
            x[0] ^= np.where(turned, rest, swapped)
            x[i] ^= swapped
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flips = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        flips ^= np.where((x[-1] >> bit) & 1, (1 << bit) - 1, 0)
    x ^= flips
    planes = np.stack([(x >> bit) & 1 for bit in range(bits - 1, -1, -1)])  # bit, component, vector
    return np.packbits(planes.transpose(2, 0, 1).reshape(x.shape[1], -1).astype(np.uint8), axis=1)


def extremes(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of every component over all rows."""

    def run(batches):
        for batch in batches:
            v = dense(batch.column("v"))
            if v.size:
                yield pa.RecordBatch.from_arrays([pa.array(range(v.shape[1]), pa.int32()), pa.array(v.min(0)), pa.array(v.max(0))], names=["at", "low", "high"])

    found = rows.select("v").mapInArrow(run, "at int, low bigint, high bigint").groupBy("at").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    held = found.orderBy("at").collect()  # one row per component
    return np.array([r.low for r in held], float), np.array([r.high for r in held], float)


def on_curve(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """Rows with `place`, where they lie on the curve. Components that a vector lacks count as zero."""
    grid = send(rows.sparkSession, extremes(rows))

    def run(batches):
        low, high = grid()
        width = np.where(high > low, high - low, 1)
        for batch in batches:
            v = dense(batch.column("v"))
            full = np.zeros((len(v), len(low)))
            full[:, : v.shape[1]] = v
            steps = np.clip((full - low) / width * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
            places = [p.tobytes() for p in curve(steps, bits)] if len(low) else [b""] * len(v)
            yield batch.append_column("place", pa.array(places, pa.binary()))

    return rows.mapInArrow(run, "row bigint, vec_id bigint, label bigint, v array<bigint>, place binary")


BLOCKED = "rows binary, ids binary, labels binary, vectors binary, low array<bigint>, high array<bigint>, kinds array<bigint>, size int"


def blocked(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks of up to `size` rows that follow each other on the curve, with their zones and labels.

    Rows at one place of the curve are dealt by id and row, so a crowd of equal vectors is split.
    """
    order = ("place", "vec_id", "row")

    def run(batches):
        held: list[pa.RecordBatch] = []
        n = 0

        def block(some: pa.Table):
            v = dense(some.column("v"))
            label = some.column("label").to_numpy()
            own = [some.column("row").to_numpy().astype(np.int64), some.column("vec_id").to_numpy().astype(np.int64), label.astype(np.int64), v]
            zone = [v.min(0).tolist(), v.max(0).tolist(), sorted(set(label.tolist()))]
            kinds = [pa.binary()] * 4 + [pa.list_(pa.int64())] * 3
            columns = [pa.array([x], k) for x, k in zip([x.tobytes() for x in own] + zone, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([len(v)], pa.int32())], names=[part.split()[0] for part in BLOCKED.split(", ")])

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= size:
                table = pa.Table.from_batches(held)
                for at in range(0, n - n % size, size):
                    yield block(table.slice(at, size).combine_chunks())
                rest = table.slice(n - n % size)
                held, n = rest.to_batches(), rest.num_rows
        if n:
            yield block(pa.Table.from_batches(held).combine_chunks())

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("row", "vec_id", "label", "v").mapInArrow(run, BLOCKED).withColumn("block", F.monotonically_increasing_id())


class Best:
    """The best few of every number, by score and then by id."""

    def __init__(self, numbers: int, keep: int, floor: np.ndarray):
        self.keep, self.floor = keep, floor.astype(np.int64).copy()
        self.held = [np.empty((0, 4), np.int64)]
        self.size = 0

    def add(self, number: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        self.held.append(np.stack([number, score, ids, rows], axis=1))
        self.size += len(number)
        if self.size > MERGE_AT:
            self.merged()

    def merged(self) -> np.ndarray:
        found = np.concatenate(self.held)
        found = found[np.lexsort((found[:, 3], found[:, 2], -found[:, 1], found[:, 0]))]
        starts = np.flatnonzero(np.append(True, found[1:, 0] != found[:-1, 0])) if len(found) else np.empty(0, np.int64)
        rank = np.arange(len(found)) - np.repeat(starts, np.diff(np.append(starts, len(found))))
        found = found[rank < self.keep]
        last = found[np.flatnonzero(rank[rank < self.keep] == self.keep - 1)]
        self.floor[last[:, 0]] = np.maximum(self.floor[last[:, 0]], last[:, 1])
        self.held, self.size = [found], 0
        return found


def whole(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, ids, labels and vectors of a stored block."""
    rows, ids, labels = (np.frombuffer(row[c], np.int64) for c in ("rows", "ids", "labels"))
    return rows, ids, labels, np.frombuffer(row["vectors"], np.int64).reshape(len(rows), -1)


def intervals(v: np.ndarray, low: list[int], high: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Per vector, no product with a vector of the zone is less or greater. Floats may round: a little is added."""
    n = min(v.shape[1], len(low))
    up, down = np.maximum(v[:, :n], 0).astype(float), np.minimum(v[:, :n], 0).astype(float)
    least, most = np.array(low[:n], float), np.array(high[:n], float)
    reach = (up - down) @ np.maximum(np.abs(least), np.abs(most)) * 1e-9 + 1
    return up @ least + down @ most - reach, up @ most + down @ least + reach


def anchors_of(blocks: DataFrame, every: int, keep: int) -> DataFrame:
    """One row per anchor, with its block and the score that this block's `keep` best other rows of its label
    reach (the least number where it has fewer)."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                rows, ids, labels, v = whole(row)
                at = np.flatnonzero((ids % every == 0) & (ids != NO_ID))
                if not len(at):
                    continue
                other = (labels[at][:, None] == labels[None, :]) & (at[:, None] != np.arange(len(ids))[None, :])
                score = np.sort(np.where(other, products(v[at], v), NO_ID), axis=1)
                floor = score[:, -keep] if score.shape[1] >= keep else np.full(len(at), NO_ID)
                columns = [pa.array(np.full(len(at), row["block"])), *[pa.array(x[at]) for x in (rows, ids, labels)]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([x.tobytes() for x in v[at]], pa.binary()), pa.array(floor)], names=["block", "row", "id", "label", "v", "floor"])

    held = blocks.select("block", "rows", "ids", "labels", "vectors")
    return held.mapInArrow(run, "block bigint, row bigint, id bigint, label bigint, v binary, floor bigint")


def groups_of(anchors: DataFrame, size: int) -> list[tuple[int, int]]:
    """First and last block of groups that follow each other on the curve and hold about `size` anchors each,
    and at most those of one block more."""
    first, last, n = anchors.agg(F.min("block"), F.max("block"), F.count("*")).first()
    if not n:
        return []
    parts = -(-n // size)
    marks = anchors.approxQuantile("block", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    ends = sorted({*map(int, marks), last})
    return list(zip([first, *[e + 1 for e in ends[:-1]]], ends, strict=True))


def group_of(rows: list) -> dict:
    """The anchors of one group as arrays; shorter vectors end in zeros."""
    vectors = [np.frombuffer(r.v, np.int64) for r in rows]
    v = np.zeros((len(rows), max(map(len, vectors))), np.int64)
    for i, one in enumerate(vectors):
        v[i, : len(one)] = one
    return {"rows": np.array([r.row for r in rows]), "ids": np.array([r.id for r in rows]), "labels": np.array([r.label for r in rows]), "v": v, "floor": np.array([r.floor for r in rows])}


def chosen(blocks: DataFrame, held, needed) -> DataFrame:
    """The blocks that some anchor must read, told from zones and labels alone."""

    def run(batches):
        group = held()
        for batch in batches:
            keep = [needed(group, row).any() for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("block").filter(pa.array(keep, pa.bool_()))], names=["block"])

    return blocks.select("block", "low", "high", "kinds").mapInArrow(run, "block bigint")


def read(blocks: DataFrame, group: dict, needed, matching, keep: int) -> DataFrame:
    """number, score, id and row of the best `keep` rows a number (an anchor or one of its windows) has in the blocks.

    One in `SEED` blocks is read first; what it holds raises the floors for all.
    """
    seed = best_of(blocks.filter(F.pmod(F.xxhash64("block"), F.lit(SEED)) == 0), group, needed, matching, keep)
    floor = group["floor"].copy()
    for row in seed.filter(F.col("rank") == keep).select("number", "score").collect():  # one row a number
        floor[row.number] = max(floor[row.number], row.score)
    return best_of(blocks, group | {"floor": floor}, needed, matching, keep)


def best_of(blocks: DataFrame, group: dict, needed, matching, keep: int) -> DataFrame:
    """The best of the blocks that the floors of a group leave to be read."""
    held = send(blocks.sparkSession, group)
    stored = blocks.join(chosen(blocks, held, needed), "block")

    def run(batches):
        group = held()
        best = Best(len(group["floor"]), keep, group["floor"])
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                own = np.flatnonzero(needed(group, row, best.floor))
                if len(own):
                    best.add(*matching(group, own, *whole(row), best.floor))
        found = best.merged()
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found[:, i]) for i in range(4)], names=["number", "score", "id", "row"])

    columns = ("rows", "ids", "labels", "vectors", "low", "high", "kinds")
    met = stored.select(*columns).mapInArrow(run, "number bigint, score bigint, id bigint, row bigint")
    place = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), "id", "row"))
    return met.withColumn("rank", place).filter(F.col("rank") <= keep)


def needs_positives(group: dict, row: dict, floor: np.ndarray | None = None) -> np.ndarray:
    """Anchors whose label the block holds and whose floor its interval reaches."""
    has = np.isin(group["labels"], np.array(row["kinds"], np.int64))
    _, most = intervals(group["v"], row["low"], row["high"])
    return has & (most >= (group["floor"] if floor is None else floor))


def matching_positives(group, own, rows, ids, labels, v, floor):
    score = products(group["v"][own], v)
    fits = (group["labels"][own][:, None] == labels[None, :]) & (group["rows"][own][:, None] != rows[None, :]) & (score >= floor[own][:, None])
    a, b = np.nonzero(fits)
    return own[a], score[a, b], ids[b], rows[b]


def needs_negatives(group: dict, row: dict, floor: np.ndarray | None = None) -> np.ndarray:
    """Windows that the block's interval meets, where it holds another label than the anchor's."""
    kinds = np.array(row["kinds"], np.int64)
    other = (len(kinds) > 1) | ~np.isin(group["labels"], kinds)
    least, most = intervals(group["v"], row["low"], row["high"])
    of = group["of"]
    return other[of] & (most[of] >= (group["floor"] if floor is None else floor)) & (least[of] <= group["ceiling"])


def matching_negatives(group, own, rows, ids, labels, v, floor):
    anchors, of = np.unique(group["of"][own], return_inverse=True)
    score = np.where(group["labels"][anchors][:, None] != labels[None, :], products(group["v"][anchors], v), NO_ID)
    out = [[], [], [], []]
    for at in range(0, len(own), 1024):  # bounds the comparisons held at once
        some = own[at : at + 1024]
        seen = score[of[at : at + 1024]]
        a, b = np.nonzero((seen >= floor[some][:, None]) & (seen <= group["ceiling"][some][:, None]) & (seen > NO_ID))
        for held, values in zip(out, (some[a], seen[a, b], ids[b], rows[b]), strict=True):
            held.append(values)
    return [np.concatenate(x) for x in out]


def hard_negatives(
    vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST,
    scale: int = SCALE, block: int = BLOCK, anchors: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null label or vector or a null or non-finite component take no part. Anchors are the rows whose id
    is divisible by `every`, each on its own where an id repeats; other rows are all but the anchor's own, repeated
    ones included. A null id is never an anchor, is the smallest in ties and comes out as null. An empty vector has
    product 0 with all; vectors of different length are multiplied over the components both have. An anchor without
    positives, or a positive without rows in its window, gives nothing. Extra columns play no part. An empty table
    gives an empty one.
    """
    spark = vectors.sparkSession
    rows = cut(sound(vectors, scale), "negatives-rows")
    blocks = cut(blocked(on_curve(rows), block), "negatives-blocks")
    own = cut(anchors_of(blocks, every, positives), "negatives-anchors")
    out = fresh_path(spark, "negatives-found")
    empty = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    spark.createDataFrame([], empty).write.parquet(f"{out}/group=-1")
    for number, (first, last) in enumerate(groups_of(own, anchors)):
        group = group_of(own.filter(F.col("block").between(first, last)).collect())  # of bounded size
        mined(blocks, group, positives, negatives, least, most).write.parquet(f"{out}/group={number}")
    return spark.read.schema(empty).parquet(out).drop("group")


def mined(blocks: DataFrame, group: dict, positives: int, negatives: int, least: int, most: int) -> DataFrame:
    """The negatives of one group of anchors, whose size is bounded."""
    spark = blocks.sparkSession
    near = read(blocks, group, needs_positives, matching_positives, positives).orderBy("number", "rank").collect()  # anchors times positives
    of, score = np.array([r.number for r in near], np.int64), np.array([r.score for r in near], object)
    low = [-(-least * s // 100) for s in score]
    high = [most * s // 100 for s in score]
    windows = group | {"of": of, "floor": np.array(low, np.int64), "ceiling": np.array(high, np.int64)}
    found = read(blocks, windows, needs_negatives, matching_negatives, negatives)
    own = [(n, int(group["ids"][r.number]), None if r.id == NO_ID else r.id, r.score) for n, r in enumerate(near)]
    told = spark.createDataFrame(own, "number bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    negative = F.when(F.col("id") != NO_ID, F.col("id")).alias("negative_id")
    return found.join(told, "number").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), negative, "positive_score", F.col("score").alias("negative_score"))
