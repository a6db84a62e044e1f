"""Steps that loads share, by what they do to many rows."""

import pytest
from conftest import DATA, column
from pyspark.sql import functions as F

from checks import registry as R
from civicmart.operators import sets as S
from civicmart.plans import warehouse as W
from civicmart.sources import tables as T


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_least_spelling_is_taken_of_distinct_rows_only(spark):
    rows = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "x"), ("b", None), (None, "z")], "k string, v string")
    got = S.distinct_by(rows, {"k": F.col("k")}, {"v": F.col("v")})
    assert sorted(map(str, column(got, "k", "v"))) == sorted(map(str, [("a", "x"), ("b", None), (None, "z")]))
    assert plan_of(got).count("HashAggregate") == 2  # rows are reduced by hash before any is sorted


def test_dimensions_alone(spark, requests_of, folder):
    wh = W.create_warehouse(spark, folder)
    T.load_staging(requests_of({}), folder, 1)
    assert list(W.run_all(wh, 1, fact=False)) == W.STEPS[:-1]
    assert wh.fact.count() == 0 and wh.table("dim_location").count() == 1
    assert W.run_all(wh, 1)[T.FACT].inserted == 1


@pytest.mark.parametrize("name", ["dimension_matches", "streamed_checks"])
def test_dimensions_are_enough(spark, monkeypatch, name):
    monkeypatch.setattr(R, "load", lambda *_: pytest.fail("the fact is not asked for"))
    monkeypatch.setattr(R, "_LOADED", {})
    assert R.QUERIES[name].run(spark, DATA).count() > 0


def test_one_delivery_is_staged_without_a_sort_and_a_refresh_replaces_it(spark, requests_of, folder):
    W.create_warehouse(spark, folder)
    for key, refresh in (("1", True), ("2", False), ("3", True)):
        T.load_staging(requests_of({"unique_key": key}), folder, 1, refresh)
    assert column(T.read_staging(spark, folder), "unique_key") == ["3"]
    assert column(T.pending_loads(spark, folder), "stg_batch_id") == [1]


def test_files_by_value_are_written_without_a_sort(spark, folder):
    from civicmart.session import open_files

    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    rows = spark.range(100).select(F.col("id").cast("string").alias("v"), (F.col("id") % 3).alias("k"))
    with open_files(spark, 8):
        with open_files(spark, 8):
            rows.write.partitionBy("k").csv(folder)
        assert spark.conf.get(name) == "8"
    assert spark.conf.get(name) == before
    assert spark.read.csv(folder).count() == 100


@pytest.mark.parametrize("most", [0, 100_000])
def test_verdicts_alone_are_those_of_whole_rows(spark, requests_of, folder, monkeypatch, most):
    from civicmart.operators import fact as FA

    wh = W.create_warehouse(spark, folder)
    T.load_staging(requests_of({"unique_key": "old"}), folder, 1)
    W.run_all(wh, 1)
    T.load_staging(
        requests_of({"unique_key": " OLD"}, {"unique_key": "2"}, {"unique_key": "2"}, {"unique_key": "3"}, {"unique_key": None}, {"unique_key": "2", "status": "Bogus"}, {"agency": "NONE"}),
        folder, 2,
    )
    monkeypatch.setattr(FA, "MARKS_MET", most)

    def rows(**how):
        return FA.resolve(wh.staging, wh.dims(*T.DIMENSIONS[1:]), wh.fact_keys, wh.settings, **how)

    narrow = rows(whole=False)
    assert not {"error_message", "raw_created"} <= {n for n in narrow.columns if narrow.filter(F.col(n).isNotNull() & (F.col("error_type") == "NULL_UNIQUE_KEY")).count()}
    counts = dict(column(FA.stage_counts(narrow), "outcome", "row_count"))
    assert counts == dict(column(FA.stage_counts(rows()), "outcome", "row_count"))
    assert counts == {
        "LOADED": 2, "DUPLICATE_IN_BATCH": 1, "DUPLICATE_UNIQUE_KEY": 1, "NULL_UNIQUE_KEY": 1, "INVALID_STATUS": 1, "NO_DIM_AGENCY_MATCH": 1,
    }


def test_many_repeats_shuffle_no_full_row(spark, requests_of, folder, monkeypatch):
    """Copies that are alike, that differ, and that the fact has; the rows meet the decisions as bits, whole or by page."""
    from civicmart.operators import fact as FA

    frames = {}
    cut = FA.cut
    monkeypatch.setattr(FA, "cut", lambda df, name: (frames.update({name: df}), cut(df, name))[1])
    monkeypatch.setattr(FA, "MARKS_MET", 3)
    wh = W.create_warehouse(spark, folder)
    same = [{"unique_key": f"s{i}"} for i in range(30)]
    other = [{"unique_key": f"d{i}", "closed_date": None, "resolution_description": str(i)} for i in range(5)]
    later = [{**row, "created_date": "2024-05-21T00:00:00.000"} for row in other]
    T.load_staging(requests_of(*same, *other, *same, *later, {"unique_key": " S1 "}).repartition(4), folder, 1)
    for name in W.STEPS[1:-1]:
        W.LOADERS[name](wh, 50 + W.STEPS.index(name), 1)
    for sent in (FA.PAGES_SENT, 0):
        monkeypatch.setattr(FA, "PAGES_SENT", sent)
        resolved = FA.resolve(wh.pending, wh.dims(*T.DIMENSIONS[1:]), wh.fact_keys, wh.settings)
        rows = column(resolved, "unique_key", "created", "error_type")
        kept = [(key.strip().upper(), day.day) for key, day, error in rows if error is None]
        assert len(rows) == 71 and len(kept) == 35 and {e for *_, e in rows} == {None, "DUPLICATE_IN_BATCH"}
        assert sorted(kept) == sorted([(f"S{i}", 20) for i in range(30)] + [(f"D{i}", 21) for i in range(5)])
        plan = frames["judged"]._jdf.queryExecution().optimizedPlan().toString()
        assert ("broadcast" in plan) == (sent > 0) and "dedup_key" not in plan.split("Join")[0].split("Project")[1]
    W.run_all(wh, 1)
    T.load_staging(requests_of(*same, {"unique_key": "new"}), folder, 2)
    found = W.run_all(wh, 2)["fact_service_requests"]
    assert (found.read, found.inserted, found.skipped) == (31, 1, 30)
