"""Files arriving over time."""

import pytest
from conftest import column
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from civicmart.plans import warehouse as W
from civicmart.session import fresh_path
from civicmart.sources import tables as T
from civicmart.streaming import ingest as I


def deliver(rows, path):
    rows.coalesce(1).write.option("header", True).option("escape", '"').csv(path)


def test_two_deliveries_equal_one_load(spark, requests_of, folder):
    inbox, progress = fresh_path(spark, "inbox"), fresh_path(spark, "progress")
    wh = W.create_warehouse(spark, folder)
    deliver(requests_of({}, {"unique_key": "2"}, {"unique_key": "3", "status": "Bogus"}), f"{inbox}/a")
    I.load_stream(wh, inbox, progress).awaitTermination()
    deliver(requests_of({"unique_key": "2"}, {"unique_key": "4"}), f"{inbox}/b")
    I.load_stream(wh, inbox, progress).awaitTermination()
    I.load_stream(wh, inbox, progress).awaitTermination()
    assert sorted(column(wh.fact, "unique_key", "dw_batch_id")) == [("1", 0), ("2", 0), ("4", 1)]
    logged = wh.table("etl_errors").filter(F.col("step_name") == T.FACT)
    assert sorted(column(logged, "unique_key", "error_type")) == [("2", "DUPLICATE_UNIQUE_KEY"), ("3", "INVALID_STATUS")]


def test_ingest_resumes_and_lands_once(spark, requests_of, folder):
    inbox, progress = fresh_path(spark, "inbox"), fresh_path(spark, "progress")
    wh = W.create_warehouse(spark, folder)
    for name, key in (("a", "1"), ("b", "2"), ("c", "3")):
        deliver(requests_of({"unique_key": key}), f"{inbox}/{name}")
    I.ingest_stream(wh, inbox, progress, files_per_batch=1).awaitTermination()
    I.ingest_stream(wh, inbox, progress, files_per_batch=1).awaitTermination()
    assert sorted(column(wh.staging, "unique_key")) == ["1", "2", "3"]
    assert sorted(column(I.staged_batches(wh), "stg_batch_id", "rows_landed")) == [(0, 1), (1, 1), (2, 1)]


def test_two_streams_into_one_warehouse(spark, requests_of, folder):
    wh = W.create_warehouse(spark, folder)
    for key in ("S1", "S2"):
        inbox = fresh_path(spark, "inbox")
        deliver(requests_of({"unique_key": key}), inbox)
        I.load_stream(wh, inbox, fresh_path(spark, "progress")).awaitTermination()
    assert sorted(column(wh.fact, "unique_key")) == ["S1", "S2"]


def test_batches_landed_first_and_loaded_later_keep_one_row_per_key(spark, requests_of, folder):
    inbox, progress = fresh_path(spark, "inbox"), fresh_path(spark, "progress")
    wh = W.create_warehouse(spark, folder)
    for name in ("a", "b"):
        deliver(requests_of({"unique_key": "K"}), f"{inbox}/{name}")
    I.ingest_stream(wh, inbox, progress, files_per_batch=1).awaitTermination()
    assert I.staged_batches(wh).count() == 2
    assert W.run_all(wh, 9)[T.FACT] == W.StepCounts(2, 1, 1, 0)


def test_checks_on_a_stream(spark, requests_of, folder):
    inbox, progress, out = (fresh_path(spark, n) for n in ("inbox", "progress", "out"))
    wh = W.create_warehouse(spark, folder)
    deliver(requests_of({}, {"unique_key": "2", "created_date": "x"}, {"unique_key": None}), inbox)
    tagged = I.checked_stream(I.read_stream(spark, inbox), wh).select("unique_key", "error_type")
    tagged.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).trigger(
        availableNow=True
    ).start().awaitTermination()
    got = spark.read.schema("unique_key string, error_type string").parquet(out)
    assert set(column(got, "unique_key", "error_type")) == {("1", None), ("2", "INVALID_CREATED_DATE"), (None, "NULL_UNIQUE_KEY")}


def test_other_header_stops_the_stream(spark, requests_of, folder):
    inbox, progress = fresh_path(spark, "inbox"), fresh_path(spark, "progress")
    wh = W.create_warehouse(spark, folder)
    rows = requests_of({})
    deliver(rows.select(*reversed(rows.columns)), inbox)
    with pytest.raises(StreamingQueryException):
        I.ingest_stream(wh, inbox, progress).awaitTermination()
    assert wh.staging.count() == 0


def test_first_ever_takes_late_and_undated_rows(spark, requests_of):
    inbox, progress, out = (fresh_path(spark, n) for n in ("inbox", "progress", "out"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    I.state_on_disk(spark)

    def run():
        rows = I.first_ever(I.read_stream(spark, inbox, files_per_batch=1)).select("unique_key", "status")
        rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).trigger(
            availableNow=True
        ).start().awaitTermination()
        return sorted(map(str, column(spark.read.schema("unique_key string, status string").parquet(out), "unique_key")))

    try:
        deliver(requests_of({"created_date": "2024-05-20T00:00:00.000"}, {"unique_key": "u", "created_date": None}, {"unique_key": None}), f"{inbox}/a")
        assert run() == ["1", "None", "u"]
        # Years late, undated again, without a key again, and one key many times.
        deliver(
            requests_of({"created_date": "2001-01-01T00:00:00.000"}, {"unique_key": " U", "created_date": "x"}, {"unique_key": " "}, *[{"unique_key": "new"}] * 30),
            f"{inbox}/b",
        )
        assert run() == ["1", "None", "None", "new", "u"]
        assert run() == ["1", "None", "None", "new", "u"]
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_checks_of_a_stream_count_what_a_load_counts(spark, requests_of, folder):
    inbox, progress, out = (fresh_path(spark, n) for n in ("inbox", "progress", "out"))
    wh = W.create_warehouse(spark, folder)
    T.load_staging(requests_of({}), folder, 1)
    W.run_all(wh, 1)
    deliver(requests_of({"unique_key": "2"}, {"unique_key": "3", "agency": "NONE"}, {"unique_key": None}), f"{inbox}/a")
    first = I.check_stream(wh, inbox, progress, out)
    assert [{k: n for k, n in c.items() if n} for c in first.values()] == [
        {"rows_read": 3, "VALID": 1, "NO_DIM_AGENCY_MATCH": 1, "NULL_UNIQUE_KEY": 1}
    ]
    deliver(requests_of({"unique_key": "4", "status": "Bogus"}), f"{inbox}/b")
    assert [c["INVALID_STATUS"] for c in I.check_stream(wh, inbox, progress, out).values()] == [1]
    assert I.check_stream(wh, inbox, progress, out) == {}
    log = wh.table("etl_log").filter("step_name = 'checked_stream'")
    assert sorted(column(log, "batch_id", "rows_read", "rows_rejected", "status")) == [(0, 3, 2, "SUCCESS"), (1, 1, 1, "SUCCESS")]
    assert sorted(map(str, column(spark.read.parquet(out), "unique_key"))) == ["2", "3", "4", "None"]


def test_pages_go_on_where_a_run_stopped(spark, requests_of, folder):
    from civicmart.sources import pages as P

    inbox = fresh_path(spark, "inbox")
    wh = W.create_warehouse(spark, folder)
    for name, first in (("a", 0), ("b", 100)):
        deliver(requests_of(*[{"unique_key": str(first + i)} for i in range(25)]), f"{inbox}/{name}")
    page = {"page_rows": 4, "pages_per_save": 2}

    def keys():
        return sorted(map(int, column(wh.staging, "unique_key")))

    assert P.ingest_pages(spark, folder, inbox, 1, most_saves=2, **page) == {"rows_landed": 16, "saves": 2}
    assert keys() == list(range(16))
    assert P.ingest_pages(spark, folder, inbox, 1, most_saves=3, **page) == {"rows_landed": 9 + 8, "saves": 3}
    assert keys() == [*range(25), *range(100, 108)]
    assert P.ingest_pages(spark, folder, inbox, 1, **page) == {"rows_landed": 17, "saves": 3}
    assert P.ingest_pages(spark, folder, inbox, 1, **page) == {"rows_landed": 0, "saves": 0}
    assert keys() == [*range(25), *range(100, 125)] and wh.pending.count() == 50


@pytest.mark.parametrize("most", [None, 7])
def test_pages_and_files_land_together(spark, requests_of, folder, monkeypatch, most):
    from civicmart.sources import pages as P

    inbox = fresh_path(spark, "inbox")
    wh = W.create_warehouse(spark, folder)
    for name in range(3):
        rows = requests_of(*[{"unique_key": f"{name}-{i}", "city": str(i)} for i in range(25)])
        deliver(rows.select(*rows.columns[::-1]) if name == 1 else rows, f"{inbox}/{name}")
    if most:
        monkeypatch.setattr(P, "SAVES_AT_ONCE", most)
    group = f"pages-{most}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert P.ingest_pages(spark, folder, inbox, 1, page_rows=2, pages_per_save=1) == {"rows_landed": 75, "saves": 39}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    if not most:
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < 39
    landed = column(wh.staging, "load_id", "unique_key", "city")
    assert sorted(k for _, k, _ in landed) == sorted(f"{n}-{i}" for n in range(3) for i in range(25))
    assert all(k.split("-")[1] == c and int(load[-9:]) == int(c) // 2 for load, k, c in landed)
    assert len({(load[:24], k.split("-")[0]) for load, k, _ in landed}) == 3 and wh.pending.count() == 75
    assert P.ingest_pages(spark, folder, inbox, 1, page_rows=2, pages_per_save=1) == {"rows_landed": 0, "saves": 0}


def test_rows_are_numbered_in_the_order_of_the_file(spark, requests_of):
    from civicmart.sources import pages as P

    inbox = fresh_path(spark, "inbox")
    deliver(requests_of(*[{"unique_key": str(i)} for i in range(300)]), inbox)
    path = P.deliveries(spark, inbox)[0][0]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = P.numbered_rows(spark, path)
        assert sorted(column(rows, "row_number", "unique_key")) == [(i, str(i)) for i in range(300)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
