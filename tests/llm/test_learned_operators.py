"""Learned scores by held-out labels, top-k by brute force, and the pipeline."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from civicmart.llm import quality, registry, secret_scan, topk, toxicity  # noqa: E402

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


def read(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@pytest.mark.parametrize(("operator", "label", "parts", "held", "least"), [(quality, "quality", 3, 1, 0.98), (toxicity, "toxic", 5, 0, 0.88)])
def test_held_out_accuracy(spark, operator, label, parts, held, least):
    labels = read(spark, MORE, "labels")
    rows = operator.scores(read(spark, MORE, "documents"), labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (brute.fold(r.doc_id, parts) == held) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    own = [r for r in rows if r.held_out and r[label] is not None]
    assert brute.auc([r[label] for r in own], [r.score for r in own]) > least
    assert sum(r.predicted == r[label] for r in own) / len(own) > 0.95


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_odd_rows_and_labels(spark, operator):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 2.0), (2, "", 2.0), (3, "  \n", 3.0), (None, "no id at all", None), (5, "x " * 200_000, 5.0)], "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(1, None, None), (2, 1, 1), (2, 0, 0), (None, 1, 1), (77, 0, 1)], "doc_id bigint, quality int, toxic int")
    for given in (labels, labels.limit(0), read(spark, SMALL, "labels")):
        rows = operator.scores(docs, given).collect()
        assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "2", "3", "5", "None"]
        assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
        assert all(0 <= r.score <= 1 for r in rows)
    assert operator.scores(docs.limit(0), labels).count() == 0


def test_toxic_documents_go_and_columns_stay(spark):
    docs, labels = read(spark, MORE, "documents").limit(3000).withColumnRenamed("lang", "_row"), read(spark, MORE, "labels")
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in toxicity.scores(docs, labels).collect() if r.predicted}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()} - gone


def neighbours_of(rows, every=100, top=10):
    import math

    whole = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, v) in enumerate(whole):
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for m, (i, w) in enumerate(whole) if m != n)
            out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:top])]
    return sorted(out)


def found_by(vectors):
    return sorted(map(tuple, topk.neighbours(vectors).collect()))


@pytest.mark.parametrize(("shard", "queries", "page"), [(100, 2, 3), (7, 5, 512), (8192, 256, 512)])
def test_neighbours(spark, monkeypatch, shard, queries, page):
    for name, value in (("SHARD", shard), ("QUERIES", queries), ("PAGE", page)):
        monkeypatch.setattr(topk, name, value)
    rows = [(r.vec_id, r.embedding) for r in read(spark, SMALL, "embeddings").collect()]
    rows += [(i, rows[3][1]) for i in range(10_000, 10_200)] + [(10_000, rows[4][1]), (600, None), (700, [None] * 64), (800, [float("nan")] * 64), (None, rows[0][1])]
    rows += [(20_001, [1e6] * 64), (20_100, [3e5, -2e5]), (20_101, []), (20_102, [float("inf")] * 64), (-100, rows[5][1])]
    rows += [(30_000, [])] * 2 + [(30_100, rows[6][1])] * 15  # queries that repeat, and empty ones
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    assert found_by(vectors.selectExpr("*", "1 AS score", "2 AS at", "3 AS shard", "4 AS place")) == neighbours_of(rows)


def test_neighbours_of_few_and_odd_rows(spark):
    kind = "vec_id bigint, embedding array<double>"
    for rows in ([], [(100, [1.0, 2.0])], [(100, []), (200, [])], [(100, [1.0, 2.0]), (100, [3.0, 1.0])], [(7, [1.0])], [(None, [1.0]), (100, None)]):
        assert found_by(spark.createDataFrame(rows, kind)) == neighbours_of(rows)


def test_shards_out_of_reach_are_not_met(spark, monkeypatch):
    import numpy as np

    ends = [np.array([[0, 0], [5, 5]]), np.array([[-9, -9], [-1, -1]])]
    low, high = np.stack([e[0] for e in ends]), np.stack([e[1] for e in ends])
    bounds = topk.most(np.array([[2, 3], [-1, -1]]), low, high)
    assert (bounds[0] >= 25).tolist() == [True, False] and (bounds[1] >= 18).tolist() == [False, True]
    monkeypatch.setattr(topk, "SHARD", 10)
    rows = [(i, [float(s * (i + 1)), float(s * i)]) for s in (1, -1) for i in range(200)]
    assert found_by(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")) == neighbours_of(rows)


def test_forest_learns_given_labels(spark):
    docs = read(spark, MORE, "documents").limit(2000)
    from pyspark.sql import functions as F

    found = secret_scan.findings(docs.select("text"), []).select(F.explode("found").alias("c"))
    labelled = found.select("c.*", (F.col("c.upper") > 0.4).cast("int").alias("label"))
    forest = secret_scan.train(labelled)
    right = labelled.filter((secret_scan.probability(F.struct("*"), forest) >= 0.5) == (F.col("label") == 1)).count()
    assert right > 0.98 * labelled.count()


def test_pipeline(spark):
    docs = read(spark, SMALL, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        rows = {r.doc_id for r in out.select("doc_id").collect()}
        assert rows and rows <= {r.doc_id for r in docs.select("doc_id").collect()}
        docs = out
    last = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in last.select("doc_id").collect()} == rows
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_on_an_empty_table(spark):
    docs = read(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_queries_agree_with_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = registry.QUERIES[name](spark, SMALL)
    want = con.execute(registry.ORACLE_SQL[name])
    assert [d[0] for d in want.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
