"""Small tables stay few files, whatever is dropped or dies when."""

import os

from conftest import column

from civicmart.plans import warehouse as W
from civicmart.sources import packs as P
from civicmart.sources import tables as T


def add(wh, *numbers):
    for n in numbers:
        W.log_step(wh, n, 7, "dim_date", 1, "SUCCESS", W.StepCounts(n))


def logged(wh):
    return sorted(column(wh.table("etl_log"), "log_id", "rows_read"))


def files(root, *names):
    return sum(f.endswith(".parquet") for name in names for _, _, found in os.walk(f"{root}/{name}") for f in found)


def test_hundred_partitions_become_few_files(spark, folder):
    wh = W.create_warehouse(spark, folder)
    for start in range(1, 101, 20):
        rows = spark.range(start, start + 20).selectExpr("id AS log_id", "id AS rows_read")
        T.save_table(rows.selectExpr("*", *[f"NULL AS {f.split()[0]}" for f in T.SCHEMAS["etl_log"].split(", ") if f.split()[0] not in rows.columns]), folder, "etl_log")
        T.pack_tables(spark, folder, 0)
    T.pack_tables(spark, folder, 0)
    assert logged(wh) == [(n, n) for n in range(1, 101)]
    assert files(folder, "etl_log") <= 1 and files(folder, "_packs/etl_log") <= 8
    assert wh.table("etl_log").columns == [f.split()[0] for f in T.SCHEMAS["etl_log"].split(", ")]


def test_packs_of_a_size_are_joined(spark, folder):
    wh = W.create_warehouse(spark, folder)
    sizes = []
    for n in range(1, 9):
        add(wh, n)
        P.pack(spark, lambda: T._own_rows(spark, folder, "etl_log"), folder, "etl_log", "log_id", 0)
        sizes.append([b - a + 1 for a, b in P.packs(spark, folder, "etl_log")[0]])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1], [4, 2], [4, 2, 1], [8]]


def test_a_row_is_seen_once_at_every_moment(spark, folder, monkeypatch):
    wh = W.create_warehouse(spark, folder)
    add(wh, 1, 2, 3)
    listed = wh.table("etl_log")  # planned before the pack
    assert T.pack_tables(spark, folder, 0)["etl_log"] == 3
    assert listed.count() == 3 and logged(wh) == [(1, 1), (2, 2), (3, 3)]
    add(wh, 4)
    monkeypatch.setattr(P, "drop_path", lambda *_: None)  # a run that dies before it drops anything
    T.pack_tables(spark, folder, 0)
    T.pack_tables(spark, folder, 0)
    assert logged(wh) == [(n, n) for n in range(1, 5)]


def test_a_pack_that_was_not_finished_does_not_count(spark, folder):
    wh = W.create_warehouse(spark, folder)
    add(wh, 1, 2)
    T.pack_tables(spark, folder, 0)
    add(wh, 3)
    T.pack_tables(spark, folder, 0)
    os.remove(f"{folder}/_packs/etl_log/pack=1-2/_SUCCESS")
    assert logged(wh) == [(1, 1), (2, 2), (3, 3)]
    T.pack_tables(spark, folder, 0)
    assert logged(wh) == [(1, 1), (2, 2), (3, 3)]


def test_open_partitions_stay_and_empty_ones_go(spark, folder):
    wh = W.create_warehouse(spark, folder)
    add(wh, 1)
    T.save_batch(wh.table("etl_errors"), folder, "etl_errors", "log_id", 5)
    assert T.pack_tables(spark, folder, 3600) == dict.fromkeys(T.PACKED, 0)
    assert T.pack_tables(spark, folder, 0)["etl_errors"] == 1
    T.pack_tables(spark, folder, 0)
    assert files(folder, "etl_errors") == 0 and wh.table("etl_errors").count() == 0


def test_a_packed_warehouse_loads_on(spark, requests_of, folder):
    wh = W.create_warehouse(spark, folder)
    T.load_staging(requests_of({}, {"unique_key": "2", "agency": " "}), folder, 1)
    W.run_all(wh, 1)
    before = {n: wh.table(n).count() for n in T.PACKED}
    packed = W.compact(wh, 0)
    assert all(packed[n] for n in T.PACKED if before[n]) and {n: wh.table(n).count() for n in T.PACKED if n != "fact_loads"} == {n: v for n, v in before.items() if n != "fact_loads"}
    W.compact(wh, 0)
    T.load_staging(requests_of({}, {"unique_key": "3"}), folder, 2, refresh=False)
    assert wh.pending.count() == 2
    got = W.run_all(wh, 2)["fact_service_requests"]
    assert (got.inserted, got.skipped) == (1, 1) and wh.pending.count() == 0
    assert W.run_summary(wh.table("etl_log")).count() == 10


def test_a_cleared_table_has_no_packs(spark, requests_of, folder):
    wh = W.create_warehouse(spark, folder)
    T.load_staging(requests_of({}), folder, 1)
    W.run_all(wh, 1)
    W.compact(wh, 0)
    T.reset_warehouse(spark, folder, reset_flag=True, clear_log=True)
    assert wh.table("etl_log").count() == 0 and wh.pending.count() == 1
    assert W.run_all(wh, 2)["fact_service_requests"].inserted == 1
