"""Search, negatives and shards against plain versions, on the small tables and on odd rows."""

import re
import struct
import zlib
from collections import Counter
from math import floor, inf, log, nan

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicmart.llm import lexical, negatives, ring
from civicmart.session import fresh_path

SMALL = "/root/testdata/sf0.001"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TEXTS = [
    (-1, None), (-2, ""), (-3, " \n"), (None, "No id, the and OF"), (-4, "THE the ÄÖ äö Ä"), (-5, "the " * 40_000), (-6, "the and of"), (-6, "the and of"),
    (-6, "of and the"), (-7, "a_b`c{d}e"), (-8, "日本語 ｔｈｅ the"), (None, None),
]
ITEMS = [(900, "the and of THE"), (900, "äö the"), (901, None), (902, ""), (903, "?!"), (None, "日本語"), (904, "nowhere-found zzzzz"), (905, "no id")]


def plain(value):
    return sorted(map(repr, map(tuple, value)))


def search(docs, items, top=50):
    found = lambda t: re.findall(TERM, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    words = [(d, Counter(found(t))) for d, t in docs]
    kept = [(d, c) for d, c in words if c]
    n, total = len(kept), sum(sum(c.values()) for _, c in kept)
    df = Counter(w for _, c in kept for w in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in kept:
            m = 50 + 50 * sum(c.values()) * n // total
            score = sum(floor(1000 * log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 20 * m)) for w in set(found(text)) if c[w])
            if score:
                scores.append((-score, doc is not None, doc or 0))
        out += [(item, r, d if known else None, -s) for r, (s, known, d) in enumerate(sorted(scores)[:top], 1)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    odd = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    small = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    return small.union(odd).selectExpr("*", "1 AS n", "'x' AS item", "2 AS shard", "doc_id AS cell", "text AS part", "1 AS terms", "3 AS slot").repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    small = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text")
    return small.union(spark.createDataFrame(ITEMS, "item_id bigint, text string")).selectExpr("*", "1 AS term", "2 AS weight", "3 AS doc_id")


@pytest.mark.parametrize("limits", [{}, {"range_docs": 7, "asked_terms_at_once": 300}])
def test_search_ranks_every_document(docs, items, limits):
    want = search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert plain(lexical.search(docs, items, **limits).collect()) == plain(want)


def test_search_of_empty_tables(docs, items):
    assert lexical.search(docs.limit(0), items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []
    assert lexical.search(docs.filter("text IS NULL"), items).collect() == []


def test_reading_stops_early_but_settles_ties_and_scores():
    rng = np.random.default_rng(4)
    for docs, many, k in ((60, 5, 3), (500, 12, 10), (5, 2, 50), (300, 40, 1)):
        impact = rng.integers(0, 4, (many, docs)) * rng.integers(1, 50, (many, 1))
        lists = []
        for row in impact:
            at = np.flatnonzero(row)
            at = at[np.argsort(-row[at], kind="stable")]
            lists.append((at, row[at]))
        best, score = lexical.settle(lists, docs, k, depth=2)
        total = impact.sum(0)
        least = max(np.sort(total)[-k] if docs >= k else 0, 1)
        assert dict(zip(best.tolist(), score.tolist(), strict=True)) == {d: s for d, s in enumerate(total.tolist()) if s >= least}


def test_term_map_keeps_all_asked_terms(spark):
    import xxhash

    words = [f"w{i}é" for i in range(3000)]
    asked = lexical.term_map(spark.createDataFrame([(w,) for w in words], "term string"))
    assert all(asked[xxhash.xxh64_intdigest(w.encode(), 42) % lexical.MAP_BITS] for w in words) and asked.sum() <= 3000


def mined(rows, every=100, positives=5, keep=10):
    kept = [
        (n, i, (y + 1) % 10 if i is not None and i % 7 == 0 else y, [floor(256 * x) for x in v])
        for n, (i, v, y) in enumerate(rows) if y is not None and v is not None and all(x is not None and abs(x) < inf for x in v)
    ]
    product = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    smallest = lambda i: (i is not None, i or 0)
    out = []
    for n, i, y, v in kept:
        if i is None or i % every:
            continue
        met = sorted(((-product(v, w), smallest(j), m, j, z == y) for m, j, z, w in kept if m != n))
        for s, _, _, p, _ in [x for x in met if x[4]][:positives]:
            fits = [x for x in met if not x[4] and 30 * -s <= 100 * -x[0] <= 90 * -s][:keep]
            out += [(i, p, r, x[3], -s, -x[0]) for r, x in enumerate(fits, 1)]
    return out


VECTORS = [
    (700, [0.5, 0.25], 1), (700, [0.5, 0.25], 1), (None, [0.5, 0.25], 2), (None, [0.4, 0.2], 1), (3, [], 2), (100, [], 2), (5, None, 1), (6, [nan, 1.0], 1),
    (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [0.1, 0.2], None), (-200, [1.0], 3), (-7, [0.9, 4.0, 5.0], 3), (14, [0.3], 9), (200, [0.5], 0), (11, [0.25, 0.5], 4),
    (-201, [0.5, 0.1], 3), (15, [0.4], 5), (16, [0.4], 5), (17, [0.4], 5), (17, [0.4], 5),
]


@pytest.mark.parametrize("limits", [{}, {"block": 8, "anchors": 2}])
def test_hard_negatives(spark, limits):
    columns = ("vec_id", "embedding", "label")
    small = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select(*columns).collect()]
    for rows in (small + VECTORS, VECTORS, [(i, v, 0 if y else y) for i, v, y in VECTORS]):
        frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").selectExpr("*", "1 AS row", "2 AS v", "'x' AS block").repartition(3)
        held = [(r[0], r[1], r[2]) for r in frame.collect()]
        assert plain(negatives.hard_negatives(frame, **limits).collect()) == plain(mined(held))


def test_hard_negatives_of_nothing(spark):
    frame = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert negatives.hard_negatives(frame).collect() == []
    assert negatives.hard_negatives(spark.createDataFrame([(1, [1.0], 1), (100, None, 1)], frame.schema)).collect() == []


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 4), (3, 3), (5, 2)])
def test_curve_goes_through_every_cell_by_single_steps(dimensions, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
    places = [p.tobytes() for p in negatives.curve(grid, bits)]
    assert len(set(places)) == len(grid)
    path = grid[np.argsort(np.array(places, object), kind="stable")]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_groups_hold_every_anchor_once(spark):
    anchors = spark.range(3000).selectExpr("id * id % 211 AS block")
    found = negatives.groups_of(anchors, 200)
    counts = [anchors.filter(F.col("block").between(*g)).count() for g in found]
    assert sum(counts) == 3000 and max(counts) < 400 and len(found) > 7
    assert negatives.groups_of(anchors.limit(0), 200) == []


def test_intervals_hold_every_product():
    rng = np.random.default_rng(2)
    zone, anchors = rng.integers(-300, 300, (40, 6)), rng.integers(-300, 300, (9, 6))
    least, most = negatives.intervals(anchors, zone.min(0).tolist(), zone.max(0).tolist())
    score = anchors @ zone.T
    assert (least <= score.min(1)).all() and (score.max(1) <= most).all()


def test_a_block_out_of_reach_is_not_read(spark):
    near, far = [(i, [1.0, 0.001 * i], 1 + i % 2) for i in range(64)], [(1000 + i, [-1.0, -0.001 * i], 1 + i % 2) for i in range(64)]
    frame = spark.createDataFrame(near + far, "vec_id bigint, embedding array<double>, label int").coalesce(1)
    blocks = negatives.cut(negatives.blocked(negatives.on_curve(negatives.sound(frame, 256)), 16), "test")
    group = negatives.group_of(negatives.anchors_of(blocks, 100, 5).filter("id = 0").collect())
    picked = negatives.chosen(blocks, lambda: group, negatives.needs_positives).count()
    assert 0 < picked <= blocks.count() / 2


def xx(values, seed=42):
    import xxhash

    for v in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
    return seed


def placed(rows, shards=24, load=None):
    met, paths = ring.walks(ring.nodes(shards))
    arrived = []
    for d, t in rows:
        item = (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
        h = xx(item)
        arc = met[xx((d,)) >> 50]
        signed = h - (1 << 64) if h >= 1 << 63 else h
        arrived.append((h % 64 if signed >= 0 else signed % 64, arc, signed, item[0] is not None, item[0] or 0, *item[1:], item))
    room = ring.rooms(len(rows), shards, load or 1.0)
    taken = [0] * shards
    out = []
    for turn, arc, *_, item in sorted(arrived):
        shard = next(s for s in paths[arc] if taken[s] < room[s])
        out.append((*item, shard, taken[shard]))
        taken[shard] += 1
    return out


@pytest.mark.parametrize("load", [1.0, 1.2])
def test_shards_are_those_of_rows_that_walk_one_by_one(docs, load):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = ring.places(docs, load=load)
    assert plain(got.collect()) == plain(placed(rows, load=load))
    assert plain(ring.places(docs.repartition(7), load=load).collect()) == plain(got.collect())


def test_counts_differ_by_one_whatever_the_rows(spark, docs):
    crowd = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS doc_id", "CASE WHEN id % 3 = 0 THEN 'copy' ELSE string(id) END AS text")
    for rows, shards in ((crowd, 24), (docs.limit(10), 24), (docs, 1)):
        got = ring.places(rows, shards).collect()
        count = Counter(r.shard for r in got)
        assert len(got) == rows.count()
        assert max(count.values()) - min(count.get(s, 0) for s in range(shards)) <= 1
        for shard, n in count.items():
            assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    assert ring.places(docs.limit(0)).collect() == []
    assert ring.sharded(docs).columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_one_more_shard_moves_few_rows(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "string(id) AS text")
    old, new = (ring.places(rows, n).select("doc_id", F.col("shard").alias(f"s{n}")) for n in (24, 25))
    moved = old.join(new, "doc_id").filter("s24 <> s25").count()
    assert moved < 0.12 * 20_000  # a 25th must move, by remainder 24 of 25 would


def test_more_room_or_nodes_than_the_ring_has():
    with pytest.raises(ValueError):
        ring.nodes(1 << 14, 2)
    with pytest.raises(ValueError):
        ring.rooms(10, 3, 0.9)


def test_written_shards_hold_every_row_in_order(spark, docs):
    path = fresh_path(spark, "test")
    ring.write_shards(docs, path, 5)
    back = spark.read.parquet(path)
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    assert plain(back.select(kept).collect()) == plain(docs.select(kept).collect())
    assert plain(back.select("doc_id", "shard", "slot").collect()) == plain(ring.places(docs, 5).select("doc_id", "shard", "slot").collect())
