"""Several writers in one warehouse."""

import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import column
from pyspark.sql import functions as F

from civicmart.functions.text import norm_key
from civicmart.operators import fact as FA
from civicmart.plans import warehouse as W
from civicmart.session import cut
from civicmart.sources import tables as T
from civicmart.sources.lease import Lease, LeaseLost, Notes, WarehouseBusy


def test_only_one_holds_the_lease(spark, folder):
    inside, most, turns = [], [], []

    def work(n):
        lease = Lease(spark, folder).take(60)
        inside.append(n)
        most.append(len(inside))
        time.sleep(0.02)
        inside.remove(n)
        turns.append(lease.number)
        lease.release()

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(work, range(16)))
    assert max(most) == 1 and sorted(turns) == list(range(1, 17))
    assert len([n for n in Notes(spark, f"{folder}/_lease").names() if n.isdigit()]) == 1


def test_a_living_holder_keeps_others_out(spark, folder):
    holder = Lease(spark, folder, patience=1.0, beat=0.1).take(0)
    with pytest.raises(WarehouseBusy):
        Lease(spark, folder, patience=1.0).take(2.5)
    holder.check()
    holder.release()
    Lease(spark, folder).take(0).release()


def test_a_dead_holder_is_followed_and_finds_out(spark, folder):
    dead = Lease(spark, folder, patience=0.5).take(0)
    dead.ended.set()
    with ThreadPoolExecutor(4) as pool:
        tries = [pool.submit(Lease(spark, folder, patience=0.5, beat=0.1).take, 3) for _ in range(4)]
        held = [t.result() for t in tries if not t.exception()]
    assert len(held) == 1
    with pytest.raises(LeaseLost):
        dead.check()
    dead.release()
    held[0].check()
    held[0].release()


def dimensions(wh, number):
    for name in W.STEPS[:-1]:
        W.LOADERS[name](wh, number, number)


def test_rows_that_land_after_the_dimensions_wait_for_the_next_run(spark, requests_of, folder):
    wh = W.create_warehouse(spark, folder)
    T.load_staging(requests_of({}), folder, 1)
    dimensions(wh, 1)
    T.load_staging(requests_of({"unique_key": "2", "agency": "NEW"}), folder, 1, refresh=False)
    assert W.load_fact(wh, 15, 1) == W.StepCounts(1, 1, 0, 0)
    assert column(wh.pending, "unique_key") == ["2"]
    assert W.run_all(wh, 2)[T.FACT] == W.StepCounts(1, 1, 0, 0)
    assert wh.pending.count() == 0 and wh.table("etl_errors").count() == 0


def test_a_load_that_has_not_landed_whole_is_not_pending(spark, requests_of, folder):
    wh = W.create_warehouse(spark, folder)
    rows = T.with_audit(requests_of({}).withColumn("source_year", F.lit(None).cast("int")), 1, "half")
    T.save_batch(rows, folder, T.STAGING, "load_id", "half")
    assert wh.staging.count() == 1 and wh.pending.count() == 0
    T.publish_load(spark, folder, "half", 1)
    assert wh.pending.count() == 1


def test_two_loads_at_once_keep_each_key_once(spark, requests_of, folder):
    wh = W.create_warehouse(spark, folder)
    T.load_staging(requests_of({}, {"unique_key": "2"}), folder, 1)
    dimensions(wh, 1)
    with ThreadPoolExecutor(2) as pool:
        started = [pool.submit(W.load_fact, wh, log_id, 1) for log_id in (11, 12)]
        inserted = sorted(s.result().inserted for s in started)
    assert inserted == [0, 2]
    assert sorted(column(wh.fact, "unique_key")) == ["1", "2"]


def test_a_frame_cut_beside_a_load_stays(spark, requests_of, folder):
    wh = W.create_warehouse(spark, folder)
    T.load_staging(requests_of({}), folder, 1)
    begun, frames = threading.Event(), []

    def beside():
        begun.wait(60)
        frames.append(cut(spark.range(5), "beside"))

    other = threading.Thread(target=beside)
    other.start()
    started = W.LOADERS["dim_date"]

    def first(*args):
        begun.set()
        other.join()
        return started(*args)

    W.LOADERS["dim_date"] = first
    try:
        W.run_all(wh, 1)
    finally:
        W.LOADERS["dim_date"] = started
    assert frames[0].count() == 5


def scanned(df):
    """Bytes of the files that the scans of a frame read."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    df.collect()
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if node.nodeName().startswith("Scan parquet") and "dedup_key" in node.simpleString(100):
            total += node.metrics().apply("filesSize").value()
    return total


def test_a_small_batch_reads_no_more_of_a_longer_history(spark, folder, monkeypatch):
    monkeypatch.setattr(FA, "KEYS_PER_BUCKET", 2000)
    wh = W.create_warehouse(spark, folder)
    batch = spark.createDataFrame([("K5",), ("NEW",)], "unique_key string").select(norm_key(F.col("unique_key")).alias("dedup_key"))
    counts = cut(FA.key_counts(batch), "counts")
    read = []
    with W.exclusive(wh) as own:
        for log_id, (first, last) in enumerate([(0, 16_000), (16_000, 64_000)], 1):
            W._save_keys(own, spark.range(first, last).select(F.concat(F.lit("K"), "id").alias("dedup_key"), F.lit(log_id).alias("log_id")), log_id)
            W._mark(own, log_id, "DONE")
            assert W.spread_keys(own)
            assert column(FA.known_keys(counts, own.fact_keys), "dedup_key") == ["K5"]
            read.append(scanned(FA.known_keys(counts, own.fact_keys)))
            assert own.fact_keys.rows.count() == last
        assert own.fact_keys.depth == 5 and not W.spread_keys(own)
        assert W.spread_keys(own, always=True) and own.fact_keys.rows.count() == 64_000
    assert 0 < read[1] < 1.5 * read[0]


def test_keys_are_dealt_by_the_size_of_the_table():
    per = FA.KEYS_PER_BUCKET
    assert [FA.key_depth(n) for n in (0, 1, per, per + 1, 2 * per, 2 * per + 1, 64 * per)] == [0, 0, 0, 1, 1, 2, 6]
