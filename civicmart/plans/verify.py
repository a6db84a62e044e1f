"""Data-quality report: staging and fact profiles, volumes, SLA performance, constraint checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.functions.rules import STATUSES
from civicmart.functions.text import norm_key
from civicmart.operators.joins import star
from civicmart.operators.sets import share_of_total, top_n, union_counts
from civicmart.plans.mart import breach, closed, percent
from civicmart.plans.warehouse import Warehouse
from civicmart.sources.tables import DIMENSIONS, FACT


def staging_profile(staged: DataFrame) -> DataFrame:
    """Rows, NULL counts and distinct values.

    The rows are first reduced to one per combination of the three counted columns, so the
    distinct counts run over that small frame and not over an expanded copy of staging.
    """
    counted = ["agency", "borough", "complaint_type"]
    groups = staged.groupBy(*counted).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("unique_key").isNull()).alias("no_key"),
        F.count_if(F.col("created_date").isNull()).alias("no_date"),
    )
    return groups.agg(
        F.sum("n").alias("total_rows"),
        F.sum("no_key").alias("null_keys"),
        F.sum(F.when(F.col("agency").isNull(), F.col("n")).otherwise(0)).alias("null_agency"),
        F.sum(F.when(F.col("borough").isNull(), F.col("n")).otherwise(0)).alias("null_borough"),
        F.sum("no_date").alias("null_dates"),
        F.countDistinct("agency").alias("distinct_agencies"),
        F.countDistinct("borough").alias("distinct_boroughs"),
        F.countDistinct("complaint_type").alias("distinct_complaints"),
    )


def row_counts(wh: Warehouse) -> DataFrame:
    """Rows per table; staging also by processed and pending."""
    tables = {"raw_requests": wh.staging} | {n: wh.table(n) for n in [*DIMENSIONS, FACT]}
    return union_counts(tables, "stg_is_processed")


def fact_profile(fact: DataFrame) -> DataFrame:
    days = F.col("resolution_days")
    return fact.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("closed_date").isNull()).alias("open_cases"),
        F.count_if(F.col("closed_date").isNotNull()).alias("closed_cases"),
        F.count_if(days < 0).alias("negative_days"),
        F.count_if(days > 365).alias("over_365_days"),
        F.min("created_date").alias("earliest_date"),
        F.max("created_date").alias("latest_date"),
        F.avg(days).alias("avg_resolution_days"),
    )


def top_complaints(wh: Warehouse, n: int = 10) -> DataFrame:
    """Most frequent complaint, category and agency, with share of all requests."""
    grouped = (
        star(wh.fact, wh.dims("dim_complaint_type", "dim_agency"))
        .groupBy("complaint_type", "category", "agency_code")
        .agg(F.count(F.lit(1)).alias("total_requests"), F.avg("resolution_days").alias("avg_days"))
    )
    order = [F.desc("total_requests"), F.asc("complaint_type"), F.asc("agency_code")]
    return top_n(share_of_total(grouped, "total_requests"), order, n)


def borough_volume(wh: Warehouse) -> DataFrame:
    return (
        star(wh.fact, wh.dims("dim_location"))
        .groupBy("borough")
        .agg(
            F.count(F.lit(1)).alias("total_requests"),
            F.count_if(closed()).alias("closed"),
            F.count_if(~closed()).alias("open"),
            F.avg("resolution_days").alias("avg_resolution_days"),
        )
        .orderBy(F.desc("total_requests"), "borough")
    )


def agency_sla_performance(wh: Warehouse) -> DataFrame:
    """Closed requests per agency against its target, worst first."""
    return (
        star(wh.fact.filter(closed()), wh.dims("dim_agency"))
        .groupBy("agency_code", F.col("sla_days").alias("sla_threshold"))
        .agg(
            F.count(F.lit(1)).alias("total_closed"),
            F.avg("resolution_days").alias("avg_days"),
            F.count_if(breach()).alias("sla_breaches"),
        )
        .withColumn("breach_pct", percent("sla_breaches", "total_closed"))
        .orderBy(F.desc("breach_pct"), "agency_code")
    )


def monthly_trend(wh: Warehouse, year: int) -> DataFrame:
    """Requests and closure rate per month; only the year's partition is read."""
    return (
        star(wh.fact.filter(F.col("year") == year), wh.dims("dim_date"))
        .groupBy("month", "month_short")
        .agg(F.count(F.lit(1)).alias("request_count"), F.count_if(closed()).alias("closed_count"))
        .withColumn("closure_rate_pct", percent("closed_count", "request_count"))
        .orderBy("month")
    )


def newest_requests(mart: DataFrame, n: int = 5) -> DataFrame:
    """The n latest mart rows."""
    shown = [
        "year", "month_name", "agency_code", "borough", "complaint_type", "category", "status",
        "resolution_days", "is_sla_breach", "unique_key",
    ]
    return top_n(mart, [F.desc("created_date"), F.asc("unique_key")], n).select(*shown)


def repeated_members(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key combinations that occur more than once; texts that are one key to the load are one key here."""
    named = [norm_key(F.col(k)).alias(k) if dict(df.dtypes)[k] == "string" else F.col(k) for k in keys]
    grouped = df.groupBy(*named).agg(F.count(F.lit(1)).alias("n_rows"))
    return grouped.filter(F.col("n_rows") > 1)


def orphans(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no parent row."""
    return df.join(parent.select(key), key, "left_anti")


def orphan_counts(wh: Warehouse) -> DataFrame:
    """Orphans per foreign key of the fact, and errors without a log row.

    The fact is reduced to its distinct keys with their counts before it meets a parent.
    """
    pairs = {
        "fact.date_key": (wh.fact, wh.table("dim_date"), "date_key"),
        "fact.agency_key": (wh.fact, wh.table("dim_agency"), "agency_key"),
        "fact.location_key": (wh.fact, wh.table("dim_location"), "location_key"),
        "fact.complaint_key": (wh.fact, wh.table("dim_complaint_type"), "complaint_key"),
        "errors.log_id": (wh.table("etl_errors"), wh.table("etl_log"), "log_id"),
    }

    def count(name: str, df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        lost = orphans(per_key, parent, key)
        return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
            F.lit(name).alias("check_name"), "violations"
        )

    frames = [count(n, *p) for n, p in pairs.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def count_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule, in one pass; one output row per rule."""
    totals = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    return totals.unpivot([], list(rules), "check_name", "violations")


def check_rules() -> dict[str, Column]:
    days = F.col("resolution_days")
    return {
        "negative_resolution_days": days < 0,
        "status_not_allowed": ~F.col("status").isin(STATUSES),
    }


def not_null_rules(columns: list[str]) -> dict[str, Column]:
    return {f"{c}_is_null": F.col(c).isNull() for c in columns}


# The columns each table declares as required.
REQUIRED = {
    "dim_date": [
        "date_key", "full_date", "year", "quarter", "quarter_name", "month", "month_name", "month_short",
        "week_of_year", "day_of_month", "day_of_week", "day_name", "is_weekend", "is_holiday",
    ],
    "dim_agency": ["agency_key", "agency_code", "agency_name", "sla_days", "is_active"],
    "dim_location": ["location_key", "borough"],
    "dim_complaint_type": ["complaint_key", "complaint_type", "category"],
    FACT: [
        "request_key", "unique_key", "date_key", "agency_key", "location_key", "complaint_key",
        "created_date", "status", "dw_created_date",
    ],
}
UNIQUE = {
    "dim_date": ["date_key"],
    "dim_agency": ["agency_code"],
    "dim_complaint_type": ["complaint_type", "descriptor"],
    "dim_location": ["borough", "zip_code", "community_board"],
    FACT: ["unique_key"],
}


def uniqueness(wh: Warehouse) -> DataFrame:
    """Repeated key combinations per table."""
    out = None
    for name, keys in UNIQUE.items():
        n = repeated_members(wh.table(name), keys).agg(F.count(F.lit(1)).alias("violations"))
        row = n.select(F.lit(f"{name}({', '.join(keys)})").alias("check_name"), "violations")
        out = row if out is None else out.unionByName(row)
    return out


def required_values(wh: Warehouse) -> DataFrame:
    """NULLs in required columns, per table and column."""
    out = None
    for name, columns in REQUIRED.items():
        rows = count_violations(wh.table(name), not_null_rules(columns))
        rows = rows.select(F.concat(F.lit(f"{name}."), F.col("check_name")).alias("check_name"), "violations")
        out = rows if out is None else out.unionByName(rows)
    return out


def calendar_gaps(calendar: DataFrame) -> DataFrame:
    """Days whose next stored day is not the following day.

    Bounded by the calendar, one row per day, so the single window task stays small.
    """
    after = F.lead("full_date").over(Window.orderBy("full_date"))
    return (
        calendar.select("full_date", after.alias("next_date"))
        .filter(F.datediff("next_date", "full_date") > 1)
        .withColumn("missing_days", F.datediff("next_date", "full_date") - 1)
    )
