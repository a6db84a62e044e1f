"""Joins of requests, dimensions and calendars.

Dimensions are stored tables, so Catalyst knows their size in bytes: below
`spark.sql.autoBroadcastJoinThreshold` it broadcasts them, above it the join shuffles and
adaptive execution splits a crowded key. No join here forces a broadcast of a stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.functions.dates import parse_coord
from civicmart.functions.text import blank_norm_key, norm_key
from civicmart.operators.sets import top_n_with_ties


def attach_dims(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Keys of agency, location and complaint for raw rows; a miss leaves the key NULL."""
    agency = dims["dim_agency"].select("agency_key", norm_key(F.col("agency_code")).alias("_agency"))
    location = dims["dim_location"].select(
        "location_key",
        norm_key(F.col("borough")).alias("_borough"),
        blank_norm_key(F.col("zip_code")).alias("_zip"),
        blank_norm_key(F.col("community_board")).alias("_board"),
    )
    complaint = dims["dim_complaint_type"].select(
        "complaint_key",
        norm_key(F.col("complaint_type")).alias("_complaint"),
        blank_norm_key(F.col("descriptor")).alias("_descriptor"),
    )
    keyed = df.withColumns(
        {
            "_agency": norm_key(F.col("agency")),
            "_borough": norm_key(F.col("borough")),
            "_zip": blank_norm_key(F.col("incident_zip")),
            "_board": blank_norm_key(F.col("community_board")),
            "_complaint": norm_key(F.col("complaint_type")),
            "_descriptor": blank_norm_key(F.col("descriptor")),
        }
    )
    joined = (
        keyed.join(agency, "_agency", "left")
        .join(location, ["_borough", "_zip", "_board"], "left")
        .join(complaint, ["_complaint", "_descriptor"], "left")
    )
    return joined.drop("_agency", "_borough", "_zip", "_board", "_complaint", "_descriptor")


DIM_KEYS = {
    "dim_date": "date_key",
    "dim_agency": "agency_key",
    "dim_location": "location_key",
    "dim_complaint_type": "complaint_key",
}


def star(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Inner join of the fact with the given dimensions.

    The fact's `year` is its partition column and meets the calendar's: a filter on year prunes files, and
    any other filter on the calendar (a quarter, the last month) prunes the years it leaves out while the query runs.
    """
    out = fact
    for name, dim in dims.items():
        keys = [DIM_KEYS[name]]
        if name == "dim_date" and "year" in fact.columns and "year" in dim.columns:
            keys.append("year")
        out = out.join(dim, keys, "inner")
    return out


def attach_by_coords(df: DataFrame, location: DataFrame) -> DataFrame:
    """Older location match: borough, zip and equal coordinates; rows without one are dropped."""
    loc = location.select(
        "location_key",
        F.col("borough").alias("_borough"),
        blank_norm_key(F.col("zip_code")).alias("_zip"),
        F.col("latitude").alias("_lat"),
        F.col("longitude").alias("_lon"),
    )
    keyed = df.withColumns(
        {
            "_borough": norm_key(F.col("borough")),
            "_zip": blank_norm_key(F.col("incident_zip")),
            "_lat": parse_coord(F.col("latitude")),
            "_lon": parse_coord(F.col("longitude")),
        }
    )
    return keyed.join(loc, ["_borough", "_zip", "_lat", "_lon"], "inner").drop(
        "_borough", "_zip", "_lat", "_lon"
    )


def only_new(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not in `existing`."""
    return df.join(existing.select(*keys), keys, "left_anti")


def already_loaded(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are in `existing`."""
    return df.join(existing.select(*keys), keys, "left_semi")


def attach_calendar(df: DataFrame, calendar: DataFrame, on: str = "created_date") -> DataFrame:
    """Calendar attributes by the day of a date column; days outside the calendar stay blank."""
    attributes = [c for c in calendar.columns if c not in df.columns or c == "full_date"]
    days = calendar.select(*attributes)
    return df.withColumn("_day", F.to_date(on)).join(days, F.col("_day") == F.col("full_date"), "left").drop("_day")


def keep_top(df: DataFrame, key: str, measures: DataFrame, measure: str, n: int) -> DataFrame:
    """Rows whose key ranks in the first n of an aggregated frame, ties kept."""
    return df.join(top_n_with_ties(measures, measure, n).select(key), key, "left_semi")
