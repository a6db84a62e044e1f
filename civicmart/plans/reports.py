"""The report queries, one function each. `where` carries the page slicers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.functions.rules import aging_bucket, aging_sort, breach_label, resolution_bucket_sort
from civicmart.functions.text import fmt_days, fmt_magnitude
from civicmart.operators import measures as M
from civicmart.operators.joins import keep_top, star
from civicmart.operators.sets import share_of_total, top_n_with_ties
from civicmart.plans.warehouse import Warehouse

Where = dict[str, object] | None


# The visuals of the overview page that group requests: columns and measures of each.
OVERVIEW = {
    "borough": (["borough"], ["total_requests", "closure_rate", "avg_resolution_days"]),
    "month": (["month", "month_short"], ["total_requests"]),
    "resolution_bucket": (["resolution_bucket"], ["total_requests"]),
    "agency": (["agency_code"], ["sla_breach_rate", "sla_breaches", "total_closed", "total_requests"]),
    "weekend": (["is_weekend"], ["total_requests"]),
    "category": (["category"], ["total_requests", "sla_breach_rate"]),
    "category_month": (["category", "month_short"], ["total_requests"]),
    "status": (["status"], ["total_requests", "total_open"]),
    "cards": ([], ["total_requests", "total_closed", "closure_rate", "avg_resolution_days", "sla_breach_rate"]),
}


def overview_page(mart: DataFrame, where: Where = None) -> dict[str, DataFrame]:
    """Every visual of the page under its slicers, from one scan of the requests."""
    return M.measures_of_page(mart, OVERVIEW, where)


def requests_of_days(wh: Warehouse, days: DataFrame) -> DataFrame:
    """Requests per agency created on the given calendar days. Only the years that hold such a day are read."""
    rows = star(wh.fact, wh.dims("dim_agency") | {"dim_date": days})
    return rows.groupBy("agency_code", "year", "month").agg(F.count(F.lit(1)).alias("total_requests"))


def daily_in_month(mart: DataFrame, calendar: DataFrame, month_name: str, where_date: Where = None) -> DataFrame:
    """Requests by day of month in one named month."""
    out = M.period_measures(
        mart, calendar, {"": ["total_requests"]}, ["day_of_month"],
        where_date={"month_name": month_name, **(where_date or {})},
    )
    return out.orderBy("day_of_month")


def to_date_cards(mart: DataFrame, calendar: DataFrame, where: Where = None, where_date: Where = None) -> DataFrame:
    """Month-to-date and year-to-date counts at the last calendar day in scope."""
    wanted = {"_mtd": ["total_requests"], "_ytd": ["total_requests"]}
    return M.period_measures(mart, calendar, wanted, where=where, where_date=where_date)


def running_totals(mart: DataFrame, calendar: DataFrame, where_date: Where = None) -> DataFrame:
    """Per calendar day: month to date, year to date and the month to date a year before."""
    wanted = {"": ["total_requests"], "_mtd": ["total_requests"], "_ytd": ["total_requests"], "_mtd_ly": ["total_requests"]}
    return M.period_measures(mart, calendar, wanted, ["full_date"], where_date=where_date).orderBy("full_date")


def borough_share(mart: DataFrame, where: Where = None) -> DataFrame:
    """Volume per borough with its share, largest first."""
    grouped = M.measures(mart, ["total_requests"], ["borough"], where)
    return share_of_total(grouped, "total_requests").orderBy(F.desc("total_requests"), "borough")


def yoy_by_month(mart: DataFrame, calendar: DataFrame, where: Where = None, where_date: Where = None) -> DataFrame:
    wanted = {"": ["total_requests"], "_ly": ["total_requests"]}
    out = M.period_measures(
        mart, calendar, wanted, ["month", "month_short"], where=where, where_date=where_date
    )
    yoy = M.change(F.col("total_requests"), F.col("total_requests_ly"))
    return out.withColumn("requests_yoy", yoy).orderBy("month")


def year_comparison(mart: DataFrame, calendar: DataFrame, by: list[str] | None = None, where: Where = None) -> DataFrame:
    """Per year: requests, closure rate and mean days against the year before, with texts and colours."""
    names = ["total_requests", "closure_rate", "avg_resolution_days"]
    out = M.period_measures(mart, calendar, {"": names, "_ly": names}, ["year"], by, where)
    return out.select("*", *M.year_over_year_columns()).orderBy("year", *(by or []))


def requests_by_month(mart: DataFrame, where: Where = None) -> DataFrame:
    return M.measures(mart, ["total_requests"], ["month", "month_short"], where).orderBy("month")


def month_by_year(mart: DataFrame, years: list[int], where: Where = None) -> DataFrame:
    """One line of months per year. The year slicer does not apply here, so a filter on it is
    left out; the pivot runs on one row per month and year."""
    kept = {k: v for k, v in (where or {}).items() if k != "year"}
    grouped = M.measures(mart, ["total_requests"], ["month", "month_short", "year"], kept)
    return (
        grouped.groupBy("month", "month_short").pivot("year", years).agg(F.sum("total_requests")).orderBy("month")
    )


def agency_matrix(mart: DataFrame, where: Where = None) -> DataFrame:
    """Requests and mean days per agency with a total row, whose mean is that of all requests.

    The rollup runs over one row per agency."""
    names = ["total_requests", "avg_resolution_days"]
    parts = M.needed_parts(names)
    per_agency = M.reduce_rows(mart, parts, ["agency_name"], where or {})
    again = [F.sum(M.part(p)).alias(f"_{p}") for p in parts]
    rolled = per_agency.rollup("agency_name").agg(*again, F.grouping("agency_name").alias("is_total"))
    label = F.when(F.col("is_total") == 1, "Total").otherwise(F.col("agency_name"))
    out = rolled.select(label.alias("agency_name"), F.col("is_total").cast("int"), *M.formulas(names))
    return out.orderBy("is_total", F.desc("total_requests"), "agency_name")


def resolution_buckets(mart: DataFrame, where: Where = None) -> DataFrame:
    """Requests per resolution bucket in bucket order."""
    grouped = M.measures(mart, ["total_requests"], ["resolution_bucket"], where)
    return grouped.withColumn("bucket_sort", resolution_bucket_sort(F.col("resolution_bucket"))).orderBy("bucket_sort")


def breach_rate_by_agency(mart: DataFrame, where: Where = None) -> DataFrame:
    out = M.measures(mart, ["sla_breach_rate", "sla_breaches", "total_closed"], ["agency_code"], where)
    return out.withColumn("breach_text", M.sla_breach_text(F.col("sla_breach_rate"))).orderBy(
        F.desc("sla_breach_rate"), "agency_code"
    )


def breach_labels(mart: DataFrame, where: Where = None) -> DataFrame:
    """Requests within and past target by label."""
    grouped = M.measures(mart, ["total_requests"], ["is_sla_breach"], where)
    return grouped.withColumn("breach_label", breach_label(F.col("is_sla_breach"))).orderBy("is_sla_breach")


def borough_map(mart: DataFrame, where: Where = None) -> DataFrame:
    return M.measures(mart, ["total_requests"], ["borough"], where).orderBy("borough")


def top_zips(mart: DataFrame, n: int = 20, where: Where = None) -> DataFrame:
    """The zips with most requests, each with its first borough; ties on the last place stay."""
    scoped = mart
    for column, wanted in (where or {}).items():
        scoped = scoped.filter(M.condition(column, wanted))
    spelled = scoped.groupBy("zip_code", "borough").agg(F.count(F.lit(1)).alias("n"))
    grouped = spelled.groupBy("zip_code").agg(F.sum("n").alias("total_requests"), F.min("borough").alias("first_borough"))
    return top_n_with_ties(grouped, "total_requests", n).orderBy("rank", "zip_code")


def weekend_split(mart: DataFrame, where: Where = None) -> DataFrame:
    return M.measures(mart, ["total_requests"], ["is_weekend"], where).orderBy("is_weekend")


def borough_table(mart: DataFrame, where: Where = None) -> DataFrame:
    """Borough comparison: counts as text, breach rate and the two colour bands."""
    names = ["total_requests", "total_closed", "total_open", "sla_breach_rate", "avg_resolution_days"]
    out = M.measures(mart, names, ["borough"], where)
    c = F.col
    shown = [
        fmt_magnitude(c("total_requests")).alias("requests"),
        fmt_magnitude(c("total_closed")).alias("closed"),
        fmt_magnitude(c("total_open")).alias("open"),
        "sla_breach_rate",
    ]
    return out.select("borough", *shown, *M.color_columns()).orderBy("borough")


def top_complaint_types(mart: DataFrame, n: int = 15, where: Where = None) -> DataFrame:
    grouped = M.measures(mart, ["total_requests"], ["complaint_type"], where)
    return top_n_with_ties(grouped, "total_requests", n).orderBy("rank", "complaint_type")


def rows_of_top_complaints(mart: DataFrame, n: int = 15) -> DataFrame:
    """The requests whose complaint type is among the most frequent."""
    grouped = M.measures(mart, ["total_requests"], ["complaint_type"])
    return keep_top(mart, "complaint_type", grouped, "total_requests", n)


def category_by_month(mart: DataFrame, months: list[str], where: Where = None) -> DataFrame:
    """Category by month matrix without totals; the pivot runs on one row per cell."""
    grouped = M.measures(mart, ["total_requests"], ["category", "month_short"], where)
    return grouped.groupBy("category").pivot("month_short", months).agg(F.sum("total_requests")).orderBy("category")


def category_totals(mart: DataFrame, where: Where = None) -> DataFrame:
    return M.measures(mart, ["total_requests"], ["category"], where).orderBy(F.desc("total_requests"), "category")


def open_by_agency(mart: DataFrame, where: Where = None) -> DataFrame:
    """Open requests by agency, then category, then complaint: every level in one rollup, over
    one row per lowest group. `level` is 1, 2 or 3."""
    scope = {**(where or {}), "status": F.col("status") != "Closed"}
    path = ["agency_code", "category", "complaint_type"]
    kept = mart
    for column, wanted in scope.items():
        kept = kept.filter(M.condition(column, wanted))
    lowest = kept.groupBy(*path).agg(F.count(F.lit(1)).alias("n"))
    rolled = lowest.rollup(*path).agg(F.sum("n").alias("total_open"), F.grouping_id().alias("gid"))
    level = F.when(F.col("gid") == 3, 1).when(F.col("gid") == 1, 2).when(F.col("gid") == 0, 3)
    out = rolled.select(*path, level.alias("level"), "total_open").filter(F.col("level").isNotNull())
    color = M.band_down(F.col("total_open"), [(20000, M.PALE_RED), (10000, M.PALE_AMBER)], M.PALE_GREEN)
    return out.withColumn("color", color).orderBy("level", F.desc("total_open"), *path)


def open_by_age(mart: DataFrame, where: Where = None) -> DataFrame:
    """Open requests per age band in band order."""
    days = F.col("days_open_if_pending")
    aged = mart.withColumns({"aging_bucket": aging_bucket(days), "aging_sort": aging_sort(days)})
    scope = {**(where or {}), "status": F.col("status") != "Closed"}
    out = M.measures(aged, ["total_open"], ["aging_bucket", "aging_sort"], scope)
    return out.withColumn("color", M.aging_color(F.col("aging_bucket"))).orderBy("aging_sort")


def all_by_age(mart: DataFrame) -> DataFrame:
    """All requests per age band; closed ones, which have no age, count in the first."""
    days = F.col("days_open_if_pending")
    aged = mart.withColumns({"aging_bucket": aging_bucket(days), "aging_sort": aging_sort(days)})
    return M.measures(aged, ["total_requests"], ["aging_bucket", "aging_sort"]).orderBy("aging_sort")


def open_by_day(mart: DataFrame, where: Where = None) -> DataFrame:
    """Open requests by creation day; days without any do not show."""
    dated = mart.withColumn("full_date", F.to_date("created_date"))
    scope = {**(where or {}), "status": F.col("status") != "Closed"}
    return M.measures(dated, ["total_open"], ["full_date"], scope).orderBy("full_date")


def open_cards(mart: DataFrame, where: Where = None) -> DataFrame:
    """Backlog cards: one row with counts, ages, stale bands and the oldest case.

    One pass over the requests to one row per age, from which cards and oldest case follow.
    """
    scope = {**(where or {}), "status": F.col("status") != "Closed"}
    names = [
        "total_open", "avg_days_open", "stale_over_90", "stale_over_90_rate", "oldest_open_case", "within_sla_count",
        "sla_breach_rate_open", "avg_days_waiting_vs_sla", "stale_90_to_180", "stale_180_to_365",
        "stale_over_365",
    ]
    parts = M.needed_parts(names)
    per_age = M.reduce_rows(mart, parts, ["days_open_if_pending"], scope, M.first_of_open())
    cards = M.combine(per_age, parts, [], [M.pick_oldest().alias("oldest")])
    return cards.select(*M.formulas(names), M.case_summary("oldest.").alias("oldest_case_summary")).select(
        "*",
        fmt_days(F.col("avg_days_open")).alias("avg_open_days_display"),
        fmt_days(F.col("oldest_open_case"), 0).alias("oldest_open_display"),
        M.waiting_label(F.col("avg_days_waiting_vs_sla")).alias("avg_days_waiting_label"),
    )
