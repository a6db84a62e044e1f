"""Building the four dimensions from staged rows, and their rejected rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicmart.functions.dates import calendar_columns, parse_coord
from civicmart.functions.rules import DEPARTMENT, Settings, agency_name, categorise, in_bbox, sla_days
from civicmart.functions.text import blank_key, blank_norm_key, error_text, is_blank, norm_key
from civicmart.operators.joins import only_new
from civicmart.operators.sets import date_spine, distinct_by
from civicmart.session import cut


def assign_keys(df: DataFrame, key: str, order: list[str], start: int) -> DataFrame:
    """Consecutive numbers after `start`, in the order of the business key.

    The set is range-partitioned on the business key and stored; a row's number is its place in
    its own partition plus the rows of the partitions before it.
    """
    ranged = cut(
        df.repartitionByRange(*[F.col(c) for c in order]).withColumn("_part", F.spark_partition_id()), "members"
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition, so the broadcast is bounded by the number of partitions.
    offsets = per_part.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = ranged.join(F.broadcast(offsets), "_part").withColumn(
        "_row", F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    )
    number = F.col("_row") + F.col("_before") + F.lit(start)
    return numbered.select(number.cast("int").alias(key), *df.columns)


def rows_and_max_key(existing: DataFrame, key: str) -> tuple[int, int]:
    row = existing.agg(F.count(F.lit(1)), F.coalesce(F.max(key), F.lit(0))).first()
    return row[0], row[1]


def build_dim_date(spark: SparkSession, settings: Settings, existing: DataFrame) -> DataFrame:
    """Calendar days that are not stored yet."""
    days = date_spine(spark, settings.first_day, settings.last_day)
    calendar = days.select(*calendar_columns(F.col("full_date")))
    return only_new(calendar, existing, ["date_key"])


def staged_agencies(staged: DataFrame) -> DataFrame:
    """Distinct agency codes with one spelling of the name."""
    rows = staged.filter(~is_blank(F.col("agency")))
    return distinct_by(
        rows, {"agency_code": norm_key(F.col("agency"))}, {"raw_name": F.trim(F.col("agency_name"))}
    )


def new_agencies(agencies: DataFrame, settings: Settings, existing: DataFrame) -> DataFrame:
    code = F.col("agency_code")
    fresh = only_new(agencies, existing, ["agency_code"])
    return fresh.select(
        code,
        agency_name(code, F.col("raw_name"), settings.agency_names).alias("agency_name"),
        F.lit(DEPARTMENT).alias("department"),
        sla_days(code, settings.sla_days, settings.default_sla).alias("sla_days"),
        F.lit(True).alias("is_active"),
    )


def refresh_sla(dim_agency: DataFrame, settings: Settings) -> DataFrame:
    """Stored agencies with today's targets; an agency without one keeps its stored days."""
    code = F.col("agency_code")
    if not settings.sla_days:
        return dim_agency
    today = sla_days(code, settings.sla_days, settings.default_sla)
    known = code.isin(list(settings.sla_days))
    return dim_agency.withColumn("sla_days", F.when(known, today).otherwise(F.col("sla_days")))


def staged_locations(staged: DataFrame, settings: Settings) -> DataFrame:
    """One row per borough, board and zip with the mean coordinates.

    Board and zip are compared without regard to case; the least spelling is kept.
    """
    lat, lon = parse_coord(F.col("latitude")), parse_coord(F.col("longitude"))
    if settings.zero_as_null:
        lat, lon = F.nullif(lat, F.lit(0).cast("decimal(9,6)")), F.nullif(lon, F.lit(0).cast("decimal(9,6)"))
    borough = norm_key(F.col("borough"))
    rows = staged.filter(F.col("borough").isNotNull() & ~borough.isin("UNSPECIFIED", ""))
    # First one row per spelling, by hash; the least spelling is then taken of that small frame.
    spelled = rows.groupBy(
        borough.alias("borough"),
        blank_key(F.col("community_board")).alias("community_board"),
        blank_key(F.col("incident_zip")).alias("zip_code"),
    ).agg(F.sum(lat).alias("_lat"), F.count(lat).alias("_n_lat"), F.sum(lon).alias("_lon"), F.count(lon).alias("_n_lon"))
    mean = lambda total, n: _mean(F.sum(total), F.sum(n))
    grouped = spelled.groupBy(
        "borough", blank_norm_key(F.col("community_board")).alias("_board"), blank_norm_key(F.col("zip_code")).alias("_zip")
    ).agg(
        F.min("community_board").alias("community_board"), F.min("zip_code").alias("zip_code"),
        mean("_lat", "_n_lat").alias("latitude"), mean("_lon", "_n_lon").alias("longitude"),
    )
    return grouped.drop("_board", "_zip")


def _mean(total: Column, n: Column) -> Column:
    """A mean of six-place decimals, in the two roundings of an average: ten places, then six."""
    exact = total.cast("decimal(27,6)") / F.nullif(n, F.lit(0)).cast("decimal(15,0)")
    return F.round(exact, 10).cast("decimal(20,10)").cast("decimal(9,6)")


def location_error(settings: Settings) -> Column:
    """NULL for a usable mean position, else the reject reason."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return F.when(lat.isNull() | lon.isNull(), "NULL_AVG_COORDINATES").when(
        ~in_bbox(lat, lon, settings.box), "OUT_OF_RANGE_AVG_COORDINATES"
    )


def new_locations(locations: DataFrame, existing: DataFrame) -> DataFrame:
    keys = {"_board": "community_board", "_zip": "zip_code"}
    stored = existing.select("borough", *[blank_norm_key(F.col(c)).alias(k) for k, c in keys.items()])
    fresh = locations.withColumns({k: blank_norm_key(F.col(c)) for k, c in keys.items()})
    return (
        fresh.join(stored, ["borough", *keys], "left_anti")
        .drop(*keys)
        .withColumn("neighborhood", F.lit(None).cast("string"))
    )


def staged_complaints(staged: DataFrame) -> DataFrame:
    """Distinct complaint and descriptor; a missing descriptor is the empty text."""
    rows = staged.filter(~is_blank(F.col("complaint_type")))
    return distinct_by(
        rows,
        {
            "complaint_type": norm_key(F.col("complaint_type")),
            "_descriptor": blank_norm_key(F.col("descriptor")),
        },
        {"descriptor": blank_key(F.col("descriptor"))},
    )


def new_complaints(complaints: DataFrame, settings: Settings, existing: DataFrame) -> DataFrame:
    stored = existing.select("complaint_type", blank_norm_key(F.col("descriptor")).alias("_descriptor"))
    fresh = only_new(complaints, stored, ["complaint_type", "_descriptor"])
    return fresh.select(
        "complaint_type",
        "descriptor",
        categorise(F.col("complaint_type"), settings.category_rules).alias("category"),
    )


def agency_rejects(staged: DataFrame) -> DataFrame:
    return _blank_rejects(
        staged,
        F.col("agency"),
        "NULL_AGENCY_CODE",
        "Agency code is NULL or blank — cannot load to dim_agency",
    )


def complaint_rejects(staged: DataFrame) -> DataFrame:
    return _blank_rejects(
        staged,
        F.col("complaint_type"),
        "NULL_COMPLAINT_TYPE",
        "complaint_type is NULL or blank — cannot load to dim_complaint_type",
    )


def _blank_rejects(staged: DataFrame, c: Column, error_type: str, message: str) -> DataFrame:
    return staged.filter(is_blank(c)).select(
        "unique_key",
        F.lit(error_type).alias("error_type"),
        F.lit(message).alias("error_message"),
        F.col("agency").alias("raw_agency"),
        F.col("borough").alias("raw_borough"),
        F.col("complaint_type").alias("raw_complaint"),
        F.col("created_date").alias("raw_created"),
    )


def location_rejects(locations: DataFrame, settings: Settings) -> DataFrame:
    tagged = locations.withColumn("error_type", location_error(settings))
    return tagged.filter(F.col("error_type").isNotNull()).select(
        F.lit(None).cast("string").alias("unique_key"),
        "error_type",
        error_text(
            "borough=", F.col("borough"), " zip=", F.col("zip_code"), " board=", F.col("community_board"),
            " avg_lat=", F.col("latitude"), " avg_long=", F.col("longitude"),
        ).alias("error_message"),
        F.col("borough").alias("raw_borough"),
        F.col("latitude").cast("string").alias("raw_latitude"),
        F.col("longitude").cast("string").alias("raw_longitude"),
    )


def dim_rejects(staged: DataFrame, settings: Settings) -> DataFrame:
    """Count of rejected rows (or areas) per dimension error type."""
    found = (
        agency_rejects(staged).select("error_type")
        .unionByName(location_rejects(staged_locations(staged, settings), settings).select("error_type"))
        .unionByName(complaint_rejects(staged).select("error_type"))
    )
    return found.groupBy("error_type").agg(F.count(F.lit(1)).alias("error_count"))
