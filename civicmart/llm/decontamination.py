"""Decontamination against a benchmark with a generalised suffix automaton over words.

The automaton holds every run of words of every item. Streaming a document's words through it gives,
at each word, the longest run ending there that some item has; runs of a window's length, and short
items that occur whole, mark their words. Items are taken in blocks of a bounded number of words, so
that the automaton sent to the tasks never outgrows them; one block is the usual case.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.llm.columns import PLAIN, distinct, flat, send, slices, words
from civicmart.session import cut

WINDOW = 13
#: A document counts as contaminated if at least one word in this many is hit.
SHARE = 20
#: Words of benchmark items per automaton; each takes about 1 KB in a task.
BLOCK_WORDS = 200_000


class Automaton:
    """A suffix automaton of several word sequences, with the items and whole short items of its states."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        ends: list[set[int]] = [set()]
        short: dict[int, int] = {}
        self.items = [i for i, _ in items]
        self.shortest = min((min(window, len(w)) for _, w in items), default=window)
        for number, (_, item) in enumerate(items):
            state = 0
            for word in item:
                state = self._add(state, self.words.setdefault(word, len(self.words)), ends)
                ends[state].add(number)
            if len(item) < window:
                short[state] = len(item)
        # a state's items are those of all states that have it as suffix; its whole short items come from its suffixes
        order = sorted(range(1, len(self.size)), key=self.size.__getitem__)
        for s in reversed(order):
            if self.size[self.link[s]] >= self.shortest:
                ends[self.link[s]] |= ends[s]
        whole: list[tuple[int, ...]] = [()] * len(self.size)
        for s in order:
            whole[s] = whole[self.link[s]] + ((s,) if s in short else ())
        self.ends, self.short, self.whole = [tuple(e) for e in ends], short, whole

    def _add(self, last: int, word: int, ends: list[set[int]]) -> int:
        follow, link, size = self.next, self.link, self.size
        if word in follow[last]:
            there = follow[last][word]
            if size[there] == size[last] + 1:
                return there
            return self._split(last, word, there, ends)
        new = self._state({}, size[last] + 1, 0, ends)
        at = last
        while at != -1 and word not in follow[at]:
            follow[at][word] = new
            at = link[at]
        if at != -1:
            there = follow[at][word]
            link[new] = there if size[there] == size[at] + 1 else self._split(at, word, there, ends)
        return new

    def _state(self, follow: dict[int, int], size: int, link: int, ends: list[set[int]]) -> int:
        self.next.append(follow)
        self.size.append(size)
        self.link.append(link)
        ends.append(set())
        return len(self.size) - 1

    def _split(self, at: int, word: int, there: int, ends: list[set[int]]) -> int:
        copy = self._state(dict(self.next[there]), self.size[at] + 1, self.link[there], ends)
        self.link[there] = copy
        while at != -1 and self.next[at].get(word) == there:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def stream(self, run: list[int]) -> Iterator[tuple[int, int, int]]:
        """For each word of a run: its place, the state reached and the length matched."""
        follow, link, size = self.next, self.link, self.size
        state = length = 0
        for place, word in enumerate(run):
            while state and word not in follow[state]:
                state = link[state]
                length = size[state]
            if word in follow[state]:
                state = follow[state][word]
                length += 1
            yield place, state, length

    def hits(self, run: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit ranges of words in a run of known words, and the numbers of the items that occur."""
        ranges: list[tuple[int, int]] = []
        items: set[int] = set()
        seen: set[int] = set()
        for place, state, length in self.stream(run):
            if length < self.shortest:
                continue
            reach = 0
            if length >= self.window:
                reach, s = self.window, state
                while self.size[self.link[s]] >= self.window:
                    s = self.link[s]
                if s not in seen:
                    seen.add(s)
                    items.update(self.ends[s])
            for s in self.whole[state]:
                if self.short[s] <= length:
                    reach = max(reach, self.short[s])
                    if -s not in seen:
                        seen.add(-s)
                        items.update(n for n in self.ends[s] if self.lengths[n] == self.short[s])
            if reach:
                begin = place + 1 - reach
                if ranges and begin <= ranges[-1][1]:
                    ranges[-1] = (min(ranges[-1][0], begin), place + 1)
                else:
                    ranges.append((begin, place + 1))
        return ranges, items

    @classmethod
    def of(cls, items: list[tuple[str, list[bytes]]], window: int) -> Automaton:
        made = cls(items, window)
        made.lengths = [len(w) for _, w in items]
        return made

    def kept(self) -> bytes:
        return pickle.dumps(vars(self))

    @classmethod
    def again(cls, held: bytes) -> Automaton:
        made = cls.__new__(cls)
        vars(made).update(pickle.loads(held))
        return made


def item_words(text: str | None) -> list[bytes]:
    data, offsets = flat(pa.array([text], pa.string()))
    out, starts, _, _ = words(data, offsets, PLAIN)
    held = out.tobytes()
    return [held[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]


def item_parts(benchmark: DataFrame, window: int, limit: int) -> DataFrame:
    """The words of the items that have any (`item_id`, `n`, `words`), in parts of at most `limit` words, or of a window."""
    size = max(limit, window)

    def run(batches):
        for batch in batches:
            ids, texts = batch.column("item_id").to_pylist(), batch.column("text")
            for i, item_id in enumerate(ids):
                found = item_words(texts[i].as_py())
                for begin in range(0, max(len(found) - window + 1, min(len(found), 1)), size - window + 1):
                    part = found[begin : begin + size]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(["" if item_id is None else item_id]), pa.array([len(part)]), pa.array([b"\n".join(part)], pa.binary())], names=["item_id", "n", "words"]
                    )

    return benchmark.select(F.col("item_id").cast("string"), "text").mapInArrow(run, "item_id string, n bigint, words binary")


def automata(benchmark: DataFrame, window: int, limit: int) -> DataFrame:
    """One row per block of about `limit` words, at most twice as many, with its automaton (`held`)."""
    parts = cut(item_parts(benchmark, window, limit), "item-parts")
    total = parts.agg(F.sum("n")).first()[0] or 0

    def build(batches):
        block, held = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                block.append((row["item_id"], row["words"].split(b"\n")))
                held += row["n"]
                if held >= limit:
                    yield pa.RecordBatch.from_arrays([pa.array([Automaton.of(block, window).kept()], pa.binary())], names=["held"])
                    block, held = [], 0
        if block:
            yield pa.RecordBatch.from_arrays([pa.array([Automaton.of(block, window).kept()], pa.binary())], names=["held"])

    return cut(parts.repartition(max(1, math.ceil(total / limit))).mapInArrow(build, "held binary"), "automata")


def _merge(a: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(a):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of `docs` (`text` and columns without these names) with `_n_words`, `_hits` (begin and end of hit word ranges, in order), `_spans`
    (the same as bytes of the text) and `_items` (ids of the items whose windows occur).

    Null texts and items have no words and hit nothing; an item of fewer words than a window is a
    window itself; repeated items count once by id; an empty benchmark hits nothing.
    """
    pairs = "array<struct<begin: bigint, end: bigint>>"
    extra = f"_n_words bigint, _hits {pairs}, _spans {pairs}, _items array<string>"
    empty = F.from_json(F.lit("[]"), pairs)
    columns = docs.columns
    marked = docs.select(
        *columns, F.lit(0).cast("bigint").alias("_n_words"), empty.alias("_hits"), empty.alias("_spans"),
        F.lit([]).cast("array<string>").alias("_items"),
    )
    made = None
    for row in automata(benchmark, window, block_words).toLocalIterator():  # an automaton of bounded size at a time
        if made is not None:  # more blocks than one: each pass holds one automaton only
            marked = cut(made, "hits")
        made = _pass(marked, send(docs.sparkSession, row.held), docs.schema, extra)
    if made is None:
        made = _pass(marked, send(docs.sparkSession, Automaton.of([], window).kept()), docs.schema, extra)
    return made


def _pass(marked: DataFrame, held, schema, extra: str) -> DataFrame:
    from pyspark.sql.types import StructType

    out_schema = StructType([*schema.fields, *StructType.fromDDL(extra).fields])
    keep = [f.name for f in schema.fields]
    pair = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        automaton = Automaton.again(held())
        for batch in batches:
            for part in slices(batch):
                data, offsets = flat(part.column("text"))
                out, starts, before, at = words(data, offsets, PLAIN)
                codes, found = distinct(out, starts)
                known = np.fromiter((automaton.words.get(w, -1) for w in found), np.int64, len(found))
                ids = known[codes] if len(codes) else codes
                sizes = starts[1:] - starts[:-1]
                hits = [[(h["begin"], h["end"]) for h in x or ()] for x in part.column("_hits").to_pylist()]
                items = [set(x or ()) for x in part.column("_items").to_pylist()]
                inside = ids >= 0
                change = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
                run_starts, run_ends = change[::2], change[1::2]
                for i in np.flatnonzero(run_ends - run_starts >= automaton.shortest).tolist():
                    a, b = int(run_starts[i]), int(run_ends[i])
                    row = int(np.searchsorted(before, a, side="right")) - 1
                    while a < b:  # a run may go on over the end of a text
                        stop = min(b, int(before[row + 1]))
                        if stop - a >= automaton.shortest:
                            ranges, numbers = automaton.hits(ids[a:stop].tolist())
                            hits[row] += [(a - int(before[row]) + x, a - int(before[row]) + y) for x, y in ranges]
                            items[row].update(automaton.items[n] for n in numbers)
                        a, row = stop, row + 1
                hits = [_merge(h) for h in hits]
                spans = [
                    [(int(at[before[r] + x] - offsets[r]), int(at[before[r] + y - 1] + sizes[before[r] + y - 1] - offsets[r])) for x, y in h]
                    for r, h in enumerate(hits)
                ]
                as_pairs = lambda rows: pa.array([[{"begin": x, "end": y} for x, y in r] for r in rows], pair)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in keep), pa.array(np.diff(before)), as_pairs(hits), as_pairs(spans),
                        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    ],
                    names=[*keep, "_n_words", "_hits", "_spans", "_items"],
                )

    return marked.mapInArrow(run, out_schema)


def digests(hits: DataFrame, share: int = SHARE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("_hits", F.lit(0).cast("bigint"), lambda n, h: n + h["end"] - h["begin"])
    out = hits.select(
        "doc_id", F.col("_n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("_items").cast("bigint").alias("n_items"), F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
    )
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of `docs` with its counts and whether it is contaminated; see `find_hits` for the cases."""
    return digests(find_hits(docs.select("doc_id", "text"), benchmark, window, block_words), share)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """`docs` without contaminated documents (coverage limit), and without the hit spans of the others (length limit).

    Text outside the spans stays as it is, null and empty texts stay, as do all other columns.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    found = find_hits(docs.select("text", F.struct("doc_id", *others).alias("_row")), benchmark, window)
    hit = F.aggregate("_hits", F.lit(0).cast("bigint"), lambda n, h: n + h["end"] - h["begin"])
    clean = found.filter((hit == 0) | (share * hit < F.col("_n_words")))
    raw = F.encode(F.col("text"), "UTF-8")
    ends = F.concat(F.transform("_spans", lambda s: s["begin"]), F.array(F.octet_length("text").cast("bigint")))
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("_spans", lambda s: s["end"]))
    kept = F.zip_with(begins, ends, lambda b, e: F.decode(F.substring(raw, (b + 1).cast("int"), (e - b).cast("int")), "UTF-8"))
    text = F.when(F.size("_spans") == 0, F.col("text")).otherwise(F.array_join(kept, ""))
    return clean.select(*[text.alias(c) if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns])
