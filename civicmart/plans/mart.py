"""Reporting mart and summaries: lazy views over fact and dimensions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicmart.functions.rules import days_open, is_sla_breach, resolution_bucket
from civicmart.operators.joins import star
from civicmart.plans.warehouse import Warehouse, exclusive
from civicmart.session import cut
from civicmart.sources.tables import save_batch


def as_date(as_of: str | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of


def service_requests_mart(wh: Warehouse, as_of: str | Column | None = None) -> DataFrame:
    """One wide row per request; `as_of` dates the age of open requests (default: today)."""
    wide = star(wh.fact, wh.dims())
    return wide.select(
        "request_key", "unique_key", "created_date", "closed_date", "status", "resolution_days",
        "year", "quarter_name", "month", "month_name", "month_short", "day_name", "is_weekend", "is_holiday",
        "agency_code", "agency_name", "department", "sla_days",
        "borough", "community_board", "zip_code", "latitude", "longitude", "neighborhood",
        "complaint_type", "descriptor", "category",
        is_sla_breach(F.col("resolution_days"), F.col("sla_days")).alias("is_sla_breach"),
        days_open(F.col("status"), F.col("created_date"), as_date(as_of)).alias("days_open_if_pending"),
        resolution_bucket(F.col("resolution_days")).alias("resolution_bucket"),
    )


def closed() -> Column:
    return F.col("status") == "Closed"


def breach() -> Column:
    return F.col("resolution_days") > F.col("sla_days")


def percent(part: str, whole: str, places: int = 1) -> Column:
    exact = F.col(part).cast("decimal(18,0)") * 100 / F.nullif(F.col(whole), F.lit(0))
    return exact.cast(f"decimal(7,{places})")


Months = list[tuple[int, int]]


def rows_of_months(wh: Warehouse, months: Months | None) -> DataFrame:
    """The fact, or of its partitions those of the given months; within a year the scan is told the days."""
    if months is None:
        return wh.fact
    days = F.lit(False)
    for year, month in months:
        days |= F.col("date_key").between(year * 10000 + month * 100, year * 10000 + month * 100 + 99)
    return wh.fact.filter(F.col("year").isin(sorted({y for y, _ in months})) & days)


def agency_summary(wh: Warehouse, months: Months | None = None) -> DataFrame:
    """Agency by month. Breaches count every request past its target, closed or not."""
    rows = star(rows_of_months(wh, months), wh.dims("dim_agency", "dim_date"))
    return (
        rows.groupBy("agency_code", "agency_name", "sla_days", "year", "month", "month_name")
        .agg(
            F.count(F.lit(1)).alias("total_requests"),
            F.count_if(closed()).alias("total_closed"),
            F.count_if(~closed()).alias("total_open"),
            F.avg("resolution_days").alias("avg_resolution_days"),
            F.max("resolution_days").alias("max_resolution_days"),
            F.count_if(breach()).alias("sla_breaches"),
        )
        .withColumn("sla_breach_pct", percent("sla_breaches", "total_closed"))
    )


def borough_summary(wh: Warehouse, months: Months | None = None) -> DataFrame:
    """Borough by month and category."""
    rows = star(rows_of_months(wh, months), wh.dims())
    return rows.groupBy("borough", "year", "month", "category").agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(closed()).alias("total_closed"),
        F.avg("resolution_days").alias("avg_resolution_days"),
        F.count_if(breach()).alias("sla_breaches"),
    )


def register_views(wh: Warehouse, as_of: str | None = None) -> None:
    """The reporting views as temporary views of the session."""
    service_requests_mart(wh, as_of).createOrReplaceTempView("vw_service_requests")
    agency_summary(wh).createOrReplaceTempView("vw_agency_summary")
    borough_summary(wh).createOrReplaceTempView("vw_borough_summary")


def report_model(wh: Warehouse, as_of: str | Column | None = None) -> dict[str, DataFrame]:
    """Tables as the report takes them in: requests by creation day, the calendar of the report
    years, and both summaries."""
    requests = service_requests_mart(wh, as_of).withColumn("created_date", F.to_date("created_date"))
    return {
        "requests": requests,
        "calendar": wh.table("dim_date").filter(F.col("year").between(*wh.settings.report_years)),
        "agency_summary": agency_summary(wh),
        "borough_summary": borough_summary(wh),
    }


SUMMARIES = {"agency_summary": agency_summary, "borough_summary": borough_summary}


def write_summaries(wh: Warehouse) -> None:
    """Store both summaries by year and month, so that reports read a few rows per group instead of the fact.

    Everything is written anew, which a change of rules (targets, names) asks for; `refresh_summaries`
    follows the loads.
    """
    with exclusive(wh) as own:
        loads = _unsummed(own)
        for name in SUMMARIES:
            _write_months(own, name, None, "static")
        _summed(own, loads)


def refresh_summaries(wh: Warehouse) -> Months:
    """Bring the stored summaries up to date and say which months that took.

    Only the months that loads have added rows to since the last time are read and written; their partitions
    are replaced, so doing it twice changes nothing. A run that dies is done again by the next one.
    """
    with exclusive(wh) as own:
        loads = _unsummed(own)
        touched = own.table("touched_months").join(loads, "log_id", "left_semi").select("year", "month").distinct()
        months = sorted((r.year, r.month) for r in touched.collect())  # at most the months of the calendar
        if months:
            for name in SUMMARIES:
                _write_months(own, name, months, "dynamic")
            _summed(own, loads)
        return months


def stored_summary(wh: Warehouse, name: str) -> DataFrame:
    return wh.spark.read.schema(SUMMARIES[name](wh).schema).parquet(f"{wh.root}/{name}")


def _write_months(wh: Warehouse, name: str, months: Months | None, mode: str) -> None:
    rows = SUMMARIES[name](wh, months).repartition("year", "month")
    wh.lease.check()
    rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("year", "month").parquet(f"{wh.root}/{name}")


def _unsummed(wh: Warehouse) -> DataFrame:
    """Loads of the fact whose months the summaries do not hold yet."""
    done = wh.table("summary_loads").select("log_id")
    return cut(wh.table("touched_months").select("log_id").distinct().join(done, "log_id", "left_anti"), "unsummed")


def _summed(wh: Warehouse, loads: DataFrame) -> None:
    save_batch(loads.withColumn("mark", F.lit(None).cast("string")).coalesce(1), wh.root, "summary_loads", "mark", uuid.uuid4().hex)
