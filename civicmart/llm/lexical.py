"""Ranked lexical search without random access (NRA), range of documents by range.

Each range keeps, for every term that an item asks for, where it occurs and how often. The impact of a term on a
document is fixed once the corpus is counted, so every list of a range is sorted by it and read from its head only.
An item's documents carry a lower score (what was read) and an upper one (what the heads of the lists not yet seen for
them could add). Reading goes on, twice as deep each time and only in lists that an open document still waits for,
until every document whose upper score reaches the k-th lower score has both equal: members, ties and scores are
then settled. The best of all ranges are the best of the table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.llm.columns import PLAIN, distinct, flat, send, slices, words
from civicmart.session import cut, fresh_path

TOP = 50
#: Documents and list entries of a range, terms of items that are asked together, and first depth of reading.
RANGE_DOCS, RANGE_ENTRIES, ASKED_TERMS, DEPTH = 4096, 2_000_000, 100_000, 64
#: Bits of the map of asked terms; it keeps other terms from being listed.
MAP_BITS = 1 << 23
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RANGE = "terms array<string>, lengths array<bigint>, places binary, counts binary, doc_ids array<bigint>, sizes binary, with_terms bigint, total bigint"


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def asked_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """item (a number of the row), item_id and each of its terms once."""
    found = F.array_distinct(F.regexp_extract_all(lowered(F.coalesce(items[text], F.lit(""))), F.lit(TERM), F.lit(0)))
    own = items.select(F.monotonically_increasing_id().alias("item"), items[item_id].alias("item_id"), found.alias("terms"))
    return own.select("item", "item_id", F.explode("terms").alias("term"))


def term_map(asked: DataFrame) -> np.ndarray:
    """For each remainder of a term's hash whether an asked term has it; a megabyte, whatever is asked."""
    place = F.pmod(F.xxhash64("term"), F.lit(MAP_BITS)) + 1
    parts = asked.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(MAP_BITS, bool)
    for row in parts.collect():  # at most MAP_BITS / 32768 rows
        bits = np.unpackbits(np.frombuffer(row.bits, np.uint8), bitorder="little")
        out[(row.part - 1) * len(bits) : row.part * len(bits)] = bits
    return out


class Gathered:
    """The lists of the documents met so far."""

    def __init__(self):
        self.ids, self.sizes, self.keys, self.counts, self.terms, self.entries = [], [], [], [], {}, 0

    def add(self, ids: list, data: np.ndarray, offsets: np.ndarray, asked: np.ndarray) -> None:
        text, starts, before, _ = words(data, offsets, PLAIN)
        code, vocabulary = distinct(text, starts)
        number = np.full(len(vocabulary), -1, np.int64)
        for i, word in enumerate(vocabulary):
            if asked[xxhash.xxh64_intdigest(word, 42) % MAP_BITS]:
                number[i] = self.terms.setdefault(word, len(self.terms))
        sizes = np.diff(before)
        doc = np.repeat(np.arange(len(ids)), sizes) + len(self.ids)
        term = number[code]
        key, count = np.unique((term[term >= 0] << 32) | doc[term >= 0], return_counts=True)
        self.ids.extend(ids)
        self.sizes.append(sizes)
        self.keys.append(key)
        self.counts.append(count)
        self.entries += len(key)

    def row(self) -> pa.RecordBatch:
        key, count, sizes = np.concatenate(self.keys), np.concatenate(self.counts), np.concatenate(self.sizes).astype(np.int64)
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
        columns = [
            [[w.decode("utf-8", "replace") for w in self.terms]], [np.bincount(key >> 32, minlength=len(self.terms))],
            [(key & 0xFFFFFFFF).astype(np.int32).tobytes()], [count.astype(np.int64).tobytes()], [self.ids], [sizes.tobytes()],
            [int((sizes > 0).sum())], [int(sizes.sum())],
        ]
        kinds = [pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64()]
        names = [part.split()[0] for part in RANGE.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def ranges(docs: DataFrame, asked: np.ndarray, doc_id: str, text: str, range_docs: int = RANGE_DOCS) -> DataFrame:
    """One row per range of documents: its lists, its documents and their numbers of terms."""
    held = send(docs.sparkSession, asked)

    def run(batches):
        bits, found = held(), Gathered()
        for batch in batches:
            for part in slices(batch):
                ids = part.column("doc_id").to_pylist()
                data, offsets = flat(part.column("text"))
                for at in range(0, len(ids), range_docs):
                    some = slice(at, at + range_docs)
                    ends = offsets[at : at + range_docs + 1]
                    found.add(ids[some], data[ends[0] : ends[-1]], ends - ends[0], bits)
                    if len(found.ids) >= range_docs or found.entries >= RANGE_ENTRIES:
                        yield found.row()
                        found = Gathered()
        if found.ids:
            yield found.row()

    return docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text")).mapInArrow(run, RANGE)


def settle(lists: list[tuple[np.ndarray, np.ndarray]], docs: int, k: int, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Documents and scores that can be among the best k, ties with the k-th included, from lists sorted by impact."""
    lower = np.zeros(docs)  # whole numbers below 2^53
    seen_docs, seen_lists = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    read = np.zeros(len(lists), np.int64)
    head = np.array([impact[0] if len(impact) else 0 for _, impact in lists], float)
    waited = np.ones(len(lists), bool)
    while True:
        for i in np.flatnonzero(waited):
            places, impact = lists[i]
            some = slice(read[i], read[i] + depth)
            lower[places[some]] += impact[some]
            seen_docs.append(places[some].astype(np.int64))
            seen_lists.append(np.full(len(places[some]), i))
            read[i] = min(read[i] + depth, len(places))
            head[i] = impact[read[i]] if read[i] < len(places) else 0
        seen_docs, seen_lists = [np.concatenate(seen_docs)], [np.concatenate(seen_lists)]
        upper = lower + head.sum() - np.bincount(seen_docs[0], weights=head[seen_lists[0]], minlength=docs)
        least = np.partition(lower, docs - k)[docs - k] if docs > k else 0.0
        open_ = (upper >= max(least, 1)) & (upper > lower)
        if not open_.any():
            best = np.flatnonzero((lower >= max(least, 1)) & (upper == lower))
            return best, lower[best].astype(np.int64)
        met = np.bincount(seen_lists[0][open_[seen_docs[0]]], minlength=len(lists))
        waited = (met < open_.sum()) & (head > 0)
        depth *= 2


def ranked(row: dict, asked: dict[str, tuple[int, list[int]]], items: int, rows: int, total: int, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """The best documents of one range for each item, as item, places and scores."""
    ends = np.concatenate([[0], np.cumsum(np.array(row["lengths"], np.int64))])
    places, counts = np.frombuffer(row["places"], np.int32), np.frombuffer(row["counts"], np.int64)
    sizes = np.frombuffer(row["sizes"], np.int64)
    rate = np.array([100 - 50 + (50 * n * rows) // max(total, 1) for n in sizes.tolist()], np.int64)
    lists: list[list] = [[] for _ in range(items)]
    for i, term in enumerate(row["terms"]):
        if term not in asked:
            continue
        some = slice(ends[i], ends[i + 1])
        share = (1_000_000_000 * counts[some]) // (1000 * counts[some] + 20 * rate[places[some]])
        order = np.argsort(-share, kind="stable")
        weight, askers = asked[term]
        one = (places[some][order], weight * share[order])
        for item in askers:
            lists[item].append(one)
    out = []
    for item, own in enumerate(lists):
        if own:
            best, score = settle(own, len(sizes), k)
            if len(best):
                out.append((item, best, score))
    return out


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    range_docs: int = RANGE_DOCS, asked_terms_at_once: int = ASKED_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id and score of each item's best documents, by score and then by doc_id (null first).

    Every row of `items` is ranked on its own, also where an item_id repeats. Repeated documents are documents
    each. Null and empty texts have no terms: as documents they are never found, as items they find nothing. Very
    long texts fill a range by themselves. Extra columns play no part; an empty table on either side gives an
    empty result.

    Documents are read once. Items are asked in blocks of about `asked_terms_at_once` terms, each against the
    stored lists of all ranges.
    """
    spark = docs.sparkSession
    asked = cut(asked_terms(items, item_id, text), "lexical-asked")
    held = cut(ranges(docs, term_map(asked), doc_id, text, range_docs), "lexical-ranges")
    rows, total = held.agg(F.coalesce(F.sum("with_terms"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    found = held.select(F.explode(F.arrays_zip("terms", "lengths")).alias("t")).groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.lengths").alias("df"))
    weight = F.floor(F.lit(1000) * F.log(F.lit(2.0 * rows + 2) / (2 * F.col("df") + 1)))
    weighted = asked.join(found, "term").withColumn("weight", weight).filter("weight > 0")
    blocks = max(1, -(-asked.count() // asked_terms_at_once))
    weighted = cut(weighted.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks))), "lexical-weighted")

    out = fresh_path(spark, "lexical-best")
    for block in range(blocks):
        best = block_ranked(held, weighted.filter(F.col("block") == block), rows, total, top)
        best.write.parquet(f"{out}/block={block}")
    return spark.read.schema(best.schema).parquet(out).select(F.col("item_id"), "rank", "doc_id", "score")


def block_ranked(held: DataFrame, weighted: DataFrame, rows: int, total: int, top: int) -> DataFrame:
    """The ranks of one block of items."""
    numbers: dict[int, int] = {}
    asked: dict[str, tuple[int, list[int]]] = {}
    for row in weighted.select("item", "term", "weight").toLocalIterator():  # one block of asked terms
        asked.setdefault(row.term, (row.weight, []))[1].append(numbers.setdefault(row.item, len(numbers)))
    block = send(held.sparkSession, (list(numbers), asked))

    def run(batches):
        items, terms = block()
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in ("terms", "lengths", "places", "counts", "sizes")}
                ids = batch.column("doc_ids")[i].values
                found = ranked(row, terms, len(items), rows, total, top)
                if found:
                    item = np.repeat([items[n] for n, _, _ in found], [len(b) for _, b, _ in found])
                    where = pa.array(np.concatenate([b for _, b, _ in found]))
                    yield pa.RecordBatch.from_arrays([pa.array(item), ids.take(where), pa.array(np.concatenate([s for _, _, s in found]))], names=["item", "doc_id", "score"])

    found = held.select("terms", "lengths", "places", "counts", "sizes", "doc_ids").mapInArrow(run, "item bigint, doc_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
    best = found.withColumn("rank", place).filter(F.col("rank") <= top)
    return best.join(weighted.select("item", "item_id").distinct(), "item").select("item_id", "rank", "doc_id", "score")
