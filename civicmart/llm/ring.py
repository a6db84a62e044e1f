"""Shards on a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at many places of a ring of equal slots. A row's id gives its slot; the row walks clockwise and
enters the first shard that still has room. Rows arrive by turns (a hash of id, size and checksum), within a turn
clockwise, then by that hash: an order that depends on the rows alone, not on files or tasks. Rows between two nodes
that arrive in the same turn form a cell, and all that decides where a cell goes is when each shard becomes full.
So the rows are counted by cell (as many cells as nodes times turns, whatever the table holds), the moments at which
the shards become full follow from these counts, and every row finds its shard and slot from its rank in its cell.

With a load of 1 the room is the rows divided by the shards, so that counts differ by one at most. Repeated rows are
counted where they are read before they meet; no cell and no shard is ever held in one task as rows.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.session import cut

SHARDS = 24
#: Nodes of a shard, turns in which rows arrive, and bits of a slot.
VIRTUAL, TURNS, SLOT_BITS = 32, 64, 14
ITEM = ("doc_id", "size", "text_crc32")


def nodes(shards: int = SHARDS, virtual: int = VIRTUAL) -> dict[int, int]:
    """The shard at each taken slot. Shards take theirs in order, so one more shard moves no node of the others."""
    if not 0 < shards * virtual <= 1 << SLOT_BITS:
        raise ValueError("the ring has no place for so many nodes")
    taken: dict[int, int] = {}
    for shard in range(shards):
        for node in range(virtual):
            slot = int.from_bytes(hashlib.sha256(f"{shard}:{node}".encode()).digest()[:8]) >> (64 - SLOT_BITS)
            while slot in taken:
                slot = (slot + 1) % (1 << SLOT_BITS)
            taken[slot] = shard
    return taken


def walks(taken: dict[int, int]) -> tuple[list[int], list[list[int]]]:
    """For each slot the number of the node that it meets first, and for each node all shards as met from there."""
    order = sorted(taken)
    met, at = [], 0
    for slot in range(1 << SLOT_BITS):
        while at < len(order) and order[at] < slot:
            at += 1
        met.append(at % len(order))
    around = [taken[slot] for slot in order]
    return met, [list(dict.fromkeys(around[i:] + around[:i])) for i in range(len(around))]


def rooms(rows: int, shards: int, load: float = 1.0) -> list[int]:
    """How many rows each shard may hold."""
    if load < 1:
        raise ValueError("a load below 1 leaves rows without a shard")
    if load > 1:
        return [math.ceil(rows * load / shards)] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def full_at(cells: list[tuple[int, int]], paths: list[list[int]], room: list[int]) -> list[tuple[int, int]]:
    """For each shard the cell and the rank in it from which on rows find the shard full."""
    left = list(room)
    found = [(-1, 0) if not r else (1 << 62, 0) for r in left]
    for cell, rows in sorted(cells):
        rank = 0
        for shard in paths[cell % len(paths)]:
            if left[shard]:
                more = min(left[shard], rows - rank)
                left[shard] -= more
                rank += more
                if not left[shard]:
                    found[shard] = (cell, rank)
            if rank == rows:
                break
    return found


def numbers(values: list) -> Column:
    """A constant array of whole numbers."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """doc_id, size (UTF-8 bytes of the text and 8) and text_crc32; a null text is empty, without bytes."""
    held = F.coalesce(docs[text], F.lit(""))
    return [docs[doc_id].cast("bigint").alias("doc_id"), (F.octet_length(held) + 8).cast("bigint").alias("size"), F.crc32(held).alias("text_crc32")]


def counted(rows: DataFrame, met: list[int], arcs: int, turns: int) -> DataFrame:
    """Rows that are alike and were read together, counted, with the cell they belong to."""
    slot = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - SLOT_BITS).cast("int")
    turn = F.pmod(F.col("_hash"), F.lit(turns))
    hashed = rows.withColumn("_hash", F.xxhash64(*ITEM)).withColumn("cell", turn * arcs + F.get(numbers(met), slot))
    return hashed.groupBy("cell", "_hash", *ITEM, "part").agg(F.count("*").alias("n"))


def pieces(cells: DataFrame, paths: list[list[int]], full: list[tuple[int, int]]) -> DataFrame:
    """The ranks [start, stop) of each cell that enter a shard, and how many rows the shard holds by then.

    At most cells plus shards rows, both set by the parameters: a bounded table.
    """
    width = len(full)
    path = F.slice(numbers([s for p in paths for s in p]), (F.col("cell") % len(paths) * width + 1).cast("int"), F.lit(width))
    walked = cells.select("cell", "rows", F.posexplode(path).alias("step", "shard"))
    at = F.col("shard").cast("int")
    last, rank = F.get(numbers([c for c, _ in full]), at), F.get(numbers([r for _, r in full]), at)
    stop = F.when(F.col("cell") < last, F.col("rows")).when(F.col("cell") == last, rank).otherwise(0)
    before = F.coalesce(F.max("stop").over(Window.partitionBy("cell").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = walked.withColumn("stop", stop).withColumn("start", before).filter("start < stop")
    held = F.sum(F.col("stop") - F.col("start")).over(Window.partitionBy("shard").orderBy("cell", "start"))
    return cuts.select("cell", "start", "stop", at.alias("shard"), (held - (F.col("stop") - F.col("start"))).alias("held"))


def numbered(groups: DataFrame, shards: int, virtual: int, turns: int, load: float) -> DataFrame:
    """One row for each row counted in `groups` (stored): its items, part, number among them, shard and slot."""
    _, paths = walks(nodes(shards, virtual))
    cells = cut(groups.groupBy("cell").agg(F.sum("n").alias("rows")), "ring-cells")
    known = [(r.cell, r.rows) for r in cells.collect()]  # at most nodes times turns
    full = full_at(known, paths, rooms(sum(n for _, n in known), shards, load))
    before = F.sum("n").over(Window.partitionBy("cell").orderBy("_hash", *ITEM, "part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    ranked = groups.withColumn("first", before).repartition("cell", *ITEM, "part")  # a cell of repeats is dealt out again
    each = ranked.select("cell", *ITEM, "part", "first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("nth"))
    each = each.withColumn("rank", F.col("first") + F.col("nth"))
    held = F.broadcast(pieces(cells, paths, full))
    fits = (each["cell"] == held["cell"]) & (each["rank"] >= held["start"]) & (each["rank"] < held["stop"])
    return each.join(held, fits).select(*ITEM, "part", "nth", "shard", (F.col("held") + F.col("rank") - F.col("start")).alias("slot"))


def places(docs: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL, turns: int = TURNS, load: float = 1.0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row.

    Slots of a shard run from 0 without gaps, in the order of arrival. Rows that are alike in all of
    doc_id, size and checksum are interchangeable and get places one after another. Ids that are null share
    one place of the ring. A null text has no bytes. Extra columns play no part. An empty table gives an empty
    one; with fewer rows than shards, shards stay empty.
    """
    met, paths = walks(nodes(shards, virtual))
    rows = docs.select(*measured(docs, doc_id, text)).withColumn("part", F.spark_partition_id())
    groups = cut(counted(rows, met, len(paths), turns), "ring-groups")
    return numbered(groups, shards, virtual, turns, load).drop("part", "nth")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, virtual: int = VIRTUAL, turns: int = TURNS, load: float = 1.0, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes whole rows as Parquet below `path`, one folder shard=… each, in the order of their slots.

    The rows are stored once with the number of the task that read them, so that repeated rows keep the
    place they were given whatever task is run again. Own columns named shard or slot give way to the new ones.
    """
    met, paths = walks(nodes(shards, virtual))
    keys = measured(docs, doc_id, text)
    rows = cut(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *keys, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "ring-rows")
    groups = cut(counted(rows.select(*ITEM, "part"), met, len(paths), turns), "ring-groups")
    placed = numbered(groups, shards, virtual, turns, load)
    nth = F.row_number().over(Window.partitionBy(*ITEM, "part").orderBy("at")) - 1
    own = rows.withColumn("nth", nth.cast("bigint"))
    same = [own[c].eqNullSafe(placed[c]) for c in (*ITEM, "part", "nth")]
    on = same[0]
    for more in same[1:]:
        on &= more
    full = own.join(placed, on).select(own["row"], placed["shard"], placed["slot"])
    full = full.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot")
    full.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in ("shard", "slot")], "slot", "shard").write.partitionBy("shard").parquet(path)


def sharded(docs: DataFrame) -> DataFrame:
    """The rows of `places` under the law that their counts are at most one apart."""
    return places(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
