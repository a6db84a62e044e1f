"""Profiles stored per load against the profile of the rows."""

import os
import shutil

from pyspark.sql import functions as F

from civicmart.plans import profiles as PP
from civicmart.plans import verify as V
from civicmart.plans import warehouse as W
from civicmart.sources import tables as T


def same(wh):
    got, want = PP.stored_profile(wh).first().asDict(), V.staging_profile(wh.staging).first().asDict()
    assert got == want
    return got


def test_profiles_of_loads_add_up(spark, requests_of, folder):
    wh = W.create_warehouse(spark, folder)
    assert PP.refresh_profiles(wh) == 0 and set(PP.stored_profile(wh).first()) == {0}
    T.load_staging(requests_of({}, {"agency": "A"}, {"agency": None, "borough": None}, {"unique_key": None, "created_date": None}), folder, 1)
    assert PP.refresh_profiles(wh) == 1 and PP.refresh_profiles(wh) == 0
    assert same(wh)["distinct_agencies"] == 2
    T.load_staging(requests_of({"agency": "a"}, {"agency": "A", "complaint_type": "agency"}), folder, 1, refresh=False)
    T.load_staging(requests_of({}).limit(0), folder, 1, refresh=False)
    assert PP.refresh_profiles(wh) == 2
    assert same(wh)["distinct_agencies"] == 3
    one = wh.table("load_profiles").filter("total_rows = 2")
    assert PP.stored_profile(wh, one).first().distinct_agencies == 2
    W.compact(wh, 0)
    W.compact(wh, 0)
    same(wh)
    T.load_staging(requests_of({}), folder, 2)  # what was staged before is gone
    assert PP.refresh_profiles(wh) == 1
    assert same(wh)["total_rows"] == 1


def test_a_profile_that_was_cut_short_is_made_again(spark, requests_of, folder):
    wh = W.create_warehouse(spark, folder)
    T.load_staging(requests_of({}, {"agency": "B"}), folder, 1)
    PP.refresh_profiles(wh)
    T._write_empty(spark, folder, "load_profiles", "overwrite")
    assert PP.refresh_profiles(wh) == 1 and same(wh)["distinct_agencies"] == 2
    assert wh.table("profile_values").count() == 4


def test_more_values_than_a_page_holds(spark, requests_of, folder):
    wh = W.create_warehouse(spark, folder)
    good = requests_of({}).drop("agency")
    for first in (0, 30_000):
        T.load_staging(good.crossJoin(F.broadcast(spark.range(first, first + 40_000).select(F.col("id").cast("string").alias("agency")))), folder, 1, refresh=False)
        PP.refresh_profiles(wh)
    assert same(wh)["distinct_agencies"] == 70_000


def test_old_loads_are_not_read(spark, requests_of, folder):
    wh = W.create_warehouse(spark, folder)
    T.load_staging(requests_of({}, {"agency": "B"}), folder, 1)
    PP.refresh_profiles(wh)
    old = wh.table("staged_loads").first().load_id
    T.load_staging(requests_of({"agency": "C"}), folder, 1, refresh=False)
    for name in os.listdir(f"{folder}/{T.STAGING}/load_id={old}"):
        if name.endswith(".parquet"):
            shutil.copy("/dev/null", f"{folder}/{T.STAGING}/load_id={old}/{name}")  # can't be read any more
    assert PP.refresh_profiles(wh) == 1
    assert PP.stored_profile(wh).first().distinct_agencies == 3
