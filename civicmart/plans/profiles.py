"""Staging profiles that merge: counts and distinct values stored per load and combined on reading.

Every distinct value of a counted column gets a number once. A load's values are then bits in pages of 32,768
numbers, and the distinct values of any loads together are the bits of their pages joined by OR, so profiles
of periods or of the whole of staging never read a load again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.operators import dims as D
from civicmart.plans.warehouse import Warehouse, exclusive
from civicmart.session import cut, scratch
from civicmart.sources.tables import STAGING, read_table, save_table

#: Counted columns with the name their distinct count goes by.
COUNTED = {"agency": "distinct_agencies", "borough": "distinct_boroughs", "complaint_type": "distinct_complaints"}
COUNTS = ["total_rows", "null_keys", "null_agency", "null_borough", "null_dates"]


def refresh_profiles(wh: Warehouse) -> int:
    """Profiles the staged loads that have none yet, and says how many that were. Only their rows are read.

    A load has a profile once its counts are there, which are written last: a run that dies is done again,
    with the numbers its values have got already and with bits that may be set twice.
    """
    with scratch(wh.spark), exclusive(wh) as own:
        seen = own.table("load_profiles").select("load_id")
        loads = [r[0] for r in own.table("staged_loads").join(seen, "load_id", "left_anti").select("load_id").distinct().collect()]  # loads since the last time
        if not loads:
            return 0
        rows = read_table(own.spark, own.root, STAGING).filter(F.col("load_id").isin(loads))
        groups = cut(
            rows.groupBy("load_id", *COUNTED).agg(
                F.count(F.lit(1)).alias("n"),
                F.count_if(F.col("unique_key").isNull()).alias("no_key"),
                F.count_if(F.col("created_date").isNull()).alias("no_date"),
            ),
            "profile-groups",
        )
        values = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in COUNTED])).alias("v")
        held = cut(groups.select("load_id", values).select("load_id", "v.*").filter("value IS NOT NULL").distinct(), "profile-values")
        known = own.table("profile_values")
        _, last = D.rows_and_max_key(known, "value_id")
        fresh = held.select("column_name", "value").distinct().join(known, ["column_name", "value"], "left_anti")
        numbered = D.assign_keys(fresh, "value_id", ["column_name", "value"], last)
        own.lease.check()
        save_table(numbered, own.root, "profile_values")
        # A value that got two numbers, from a run that was overtaken while it wrote, counts by the lesser.
        ids = own.table("profile_values").join(held.select("column_name", "value").distinct(), ["column_name", "value"], "left_semi")
        ids = ids.groupBy("column_name", "value").agg(F.min("value_id").alias("value_id"))
        bits = held.join(ids, ["column_name", "value"]).groupBy("load_id", "column_name", F.bitmap_bucket_number("value_id").alias("page"))
        own.lease.check()
        save_table(bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("value_id")).alias("bits")), own.root, "load_bits")
        totals = groups.groupBy("load_id").agg(
            F.sum("n").alias("total_rows"),
            F.sum("no_key").alias("null_keys"),
            F.sum(F.when(F.col("agency").isNull(), F.col("n")).otherwise(0)).alias("null_agency"),
            F.sum(F.when(F.col("borough").isNull(), F.col("n")).otherwise(0)).alias("null_borough"),
            F.sum("no_date").alias("null_dates"),
        )
        every = own.spark.createDataFrame([(load,) for load in loads], "load_id string")
        save_table(every.join(totals, "load_id", "left").fillna(0), own.root, "load_profiles")
        return len(loads)


def stored_profile(wh: Warehouse, loads: DataFrame | None = None) -> DataFrame:
    """The profile of the given loads (`load_id`), or of all that are staged, from what is stored of each."""
    wanted = (wh.table("staged_loads") if loads is None else loads).select("load_id").distinct()
    counts = wh.table("load_profiles").join(wanted, "load_id", "left_semi").dropDuplicates(["load_id"])
    totals = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS])
    pages = wh.table("load_bits").join(wanted, "load_id", "left_semi").groupBy("column_name", "page")
    sizes = pages.agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    distinct = sizes.agg(*[F.coalesce(F.sum(F.when(F.col("column_name") == c, F.col("n"))), F.lit(0)).alias(name) for c, name in COUNTED.items()])
    return totals.join(F.broadcast(distinct))  # one row each
