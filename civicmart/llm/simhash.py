"""SimHash near-duplicates by pivot distance tables.

Each distinct fingerprint gets a table of its Hamming distances to fixed reference fingerprints: zero,
one reference per two neighbouring bits, and a few spread ones. Moving one bit changes a distance by
one, so fingerprints at most two bits apart have tables that differ by two at most (that discards
candidates), and all but two of the differences between the first distance and those of the bit pairs
are equal. Cut into six groups, four groups of these differences agree completely, which makes the
search an equi-join on 15 keys per fingerprint. Survivors are verified.

A key held by many fingerprints (a crowd of near copies) is not paired out: fingerprints in such
keys meet at the fingerprints one bit away from them instead. Two are linked exactly if they share
one of these, at most 65 share one, and each is linked to the least only.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.llm.columns import BLANK, LOWER, flat, slices, words
from civicmart.session import cut

SHINGLE = 3
SEED = 42
DISTANCE = 2
BITS = 64
#: Bit pairs per group; the last group takes the rest of the 32.
GROUPS = 6
#: Fingerprints per key that are still compared pair by pair.
CROWD = 16


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


#: References of two neighbouring bits each, and a few spread ones for the discarding test.
PAIR_PIVOTS = [signed(3 << (2 * j)) for j in range(BITS // 2)]
SPREAD_PIVOTS = [signed(p) for p in (0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F, 0x00FF00FF00FF00FF, 0x0000FFFF0000FFFF, 0x00000000FFFFFFFF)]


def text_fingerprints(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprint of each text: the majority of the bits of its shingles' hashes."""
    from xxhash import xxh64_intdigest

    data, offsets = flat(texts)
    _, starts, before, at = words(data, offsets, BLANK)
    sizes = np.diff(starts)
    # words with one blank between them
    joined = np.full(int(sizes.sum()) + len(sizes), 32, np.uint8)
    begin = starts[:-1] + np.arange(len(sizes))
    inside = BLANK[data]
    joined[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = LOWER[data[inside]]
    held = joined.tobytes()
    end = begin + sizes
    out = np.zeros(len(offsets) - 1, np.uint64)
    b, e = begin.tolist(), end.tolist()
    for row in range(len(out)):
        first, last = int(before[row]), int(before[row + 1])
        if last == first:
            continue
        n = max(1, last - first - shingle + 1)
        width = min(shingle, last - first) - 1
        hashes = np.fromiter(
            (xxh64_intdigest(held[x:y], SEED) for x, y in zip(b[first : first + n], e[first + width : first + width + n], strict=True)),
            np.uint64, n,
        )
        votes = np.zeros(BITS, np.int64)
        for part in range(0, n, 65_536):
            bits = np.unpackbits(hashes[part : part + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes += bits.sum(0, dtype=np.int32)
        out[row] = np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0]
    return out


def with_fingerprints(docs: DataFrame, name: str = "_fp") -> DataFrame:
    """`docs` with the fingerprint of its text as a bigint column; null texts count as empty (zero)."""
    from pyspark.sql.types import LongType, StructField, StructType

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = pa.array(text_fingerprints(part.column("text")).view(np.int64))
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def distance_table(fp: Column) -> list[Column]:
    """Distances to zero, to each bit pair and to the spread references."""
    return [F.bit_count(fp.bitwiseXOR(F.lit(p).cast("bigint"))) for p in [0, *PAIR_PIVOTS, *SPREAD_PIVOTS]]


def with_keys(fps: DataFrame) -> DataFrame:
    """`fp` and `key`: for each choice of the groups that may have changed, the differences of all others as one number."""
    to_zero, *to_pairs = distance_table(F.col("fp"))[: 1 + len(PAIR_PIVOTS)]
    parts = [((to_zero - d + 2) / 2).cast("bigint") for d in to_pairs]
    small, larger = divmod(len(parts), GROUPS)
    columns, steps, at = [], [], 0
    for g in range(GROUPS):
        steps.append(small + (g < larger))
        value = F.lit(0).cast("bigint")
        for p in parts[at : at + steps[-1]]:
            value = value * 3 + p
        columns.append(value.alias(f"g{g}"))
        at += steps[-1]
    keys = []
    for number, kept in enumerate(combinations(range(GROUPS), GROUPS - DISTANCE)):
        key = F.lit(0).cast("bigint")
        for g in kept:
            key = key * 3 ** steps[g] + F.col(f"g{g}")
        keys.append(key * 16 + number)  # at most 3^23 * 16
    return fps.select("fp", *columns).select("fp", F.explode(F.array(*keys)).alias("key"))


def near_tables(a: Column, b: Column, distance: int = DISTANCE) -> Column:
    """Whether no coordinate of the two distance tables differs by more than the distance."""
    return F.greatest(*[F.abs(x - y) for x, y in zip(distance_table(a), distance_table(b), strict=True)]) <= distance


def links(fps: DataFrame) -> DataFrame:
    """Linked pairs (a > b) of distinct fingerprints, `fp`; every component stays connected."""
    keyed = with_keys(fps)
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = cut(keyed.join(sizes, "key"), "simhash-keys")
    few = shared.filter(F.col("n") <= CROWD)
    pairs = (
        few.select("key", F.col("fp").alias("a")).join(few.select("key", F.col("fp").alias("b")), "key")
        .filter(F.col("a") > F.col("b")).filter(near_tables(F.col("a"), F.col("b")))
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE)
    )
    crowded = shared.filter(F.col("n") > CROWD).select("fp").distinct()
    beside = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(signed(1 << i)).cast("bigint")) for i in range(BITS)])
    meeting = crowded.select("fp", F.explode(beside).alias("at"))
    least = F.min("fp").over(Window.partitionBy("at"))  # at most 65 rows
    met = meeting.select(F.col("fp").alias("a"), least.alias("b")).filter("a > b")
    return pairs.select("a", "b").union(met).distinct()


def components(edges: DataFrame) -> DataFrame:
    """`fp` and `root`, the least fingerprint reachable over the edges (a > b); only linked ones.

    Alternates two steps until nothing changes: larger neighbours of each node go to the least one,
    then smaller ones do. Each round is written to the shared folder.
    """
    edges = cut(edges, "simhash-links")
    before = None
    while True:
        for larger in (True, False):
            both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else edges
            least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
            moved = both.join(least, "a")
            if larger:
                moved = moved.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
            else:
                moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
            edges = cut(moved.filter("a != b").distinct(), "simhash-round")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if state == before:
            return edges.select(F.col("a").alias("fp"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("fp"), F.col("b").alias("root")).distinct()
            )
        before = state


def group(marked: DataFrame) -> DataFrame:
    """`doc_id`, `_fp`, `component_id` and `root` (the least fingerprint of the component) for rows of doc_id and `_fp`."""
    fps = cut(marked.groupBy(F.col("_fp").alias("fp")).agg(F.min("doc_id").alias("first")), "simhash-fps")
    roots = components(links(fps.select("fp")))
    linked = fps.join(roots, "fp")
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    placed = linked.join(least, "root").select("fp", "component_id", "root")
    owned = fps.join(placed, "fp", "left").select(
        F.col("fp").alias("_fp"), F.coalesce("component_id", "first").alias("component_id"), F.coalesce("root", "fp").alias("root")
    )
    return marked.join(owned, "_fp").select("doc_id", "_fp", "component_id", "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row per row of `docs`.

    Null texts count as empty; texts without words have fingerprint zero and are linked like any
    other. Ids that repeat belong to the component of each of their texts. A null id has a component
    like the others, named by the least id in it, or null if none of it has an id.
    """
    marked = cut(with_fingerprints(docs.select("doc_id", "text")).select("doc_id", "_fp"), "simhash-docs")
    found = group(marked)
    hexed = F.lower(F.lpad(F.hex("_fp"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """`docs` with one document of each component: the one whose id names it.

    A component without any id keeps one of its documents. Of rows that repeat an id, one stays in
    each component that the id names. Other columns stay as they are.
    """
    marked = cut(with_fingerprints(docs.select("doc_id", "text")).select("doc_id", "_fp"), "simhash-docs")
    found = cut(group(marked), "simhash-groups")
    repeated = cut(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc_id").alias("id")), "simhash-repeated")
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    gone = found.filter(~own).select(F.col("doc_id").alias("id")).union(repeated).distinct()
    same = lambda side: docs["doc_id"].eqNullSafe(side["id"])
    once = docs.join(gone, same(gone), "left_anti")

    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    boxed = docs.join(repeated, same(repeated), "left_semi").select("doc_id", "text", F.struct("doc_id", *[F.col(f"`{c}`") for c in others]).alias("_row"))
    kept = found.filter(own).select(F.col("doc_id").alias("id"), F.col("_fp").alias("kept_fp"), "root").distinct()
    left = with_fingerprints(boxed).join(kept, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("_fp") == F.col("kept_fp")))
    least = left.groupBy("root").agg(F.min_by(F.struct("text", "_row"), F.xxhash64("text", "_row")).alias("r"))
    again = least.select(*[F.col("r.text") if c == "text" else F.col(f"r._row.`{c}`") for c in docs.columns])
    return once.union(again)
