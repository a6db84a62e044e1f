"""Measures: filter replacement, blanks, periods."""

import datetime as dt

import pytest
from conftest import column
from pyspark.sql import functions as F

from civicmart.functions.dates import calendar_columns
from civicmart.operators import measures as M
from civicmart.operators import sets as S
from civicmart.plans import reports as R
from civicmart.plans import verify as V


@pytest.fixture(scope="module")
def calendar(spark):
    days = S.date_spine(spark, "2023-01-01", "2025-12-31")
    return days.select(*calendar_columns(F.col("full_date"))).cache()


ROW = "created_date date, status string, borough string, agency_code string, agency_name string, complaint_type string, resolution_days int, days_open_if_pending int, is_sla_breach int, sla_days int"


def rows(spark, *items):
    full = [
        (dt.date.fromisoformat(d), status, borough, "A", "Agency", "Noise", days, age, breach, 5)
        for d, status, borough, days, age, breach in items
    ]
    return spark.createDataFrame(full, ROW)


@pytest.fixture
def mart(spark):
    return rows(
        spark,
        ("2024-01-05", "Closed", "X", 0, None, 0),
        ("2024-01-06", "Closed", "X", 10, None, 1),
        ("2024-01-07", "Open", "X", None, 100, 0),
        ("2024-01-07", "Pending", "Y", None, 400, 0),
    )


def test_same_day_cases_leave_the_report_mean_only(mart):
    assert M.measures(mart, ["avg_resolution_days"]).first()[0] == 10.0
    assert mart.agg(F.avg("resolution_days")).first()[0] == 5.0


def test_own_filter_replaces_the_scope(mart):
    row = M.measures(mart, ["total_requests", "total_closed", "total_open", "closure_rate"], where={"status": "Open"}).first()
    assert tuple(row) == (1, 2, 2, 2.0)
    by = M.measures(mart, ["total_requests", "total_closed"], ["status"])
    assert sorted(column(by, "status", "total_requests", "total_closed")) == [("Closed", 2, 2), ("Open", 1, 2), ("Pending", 1, 2)]


def test_nothing_is_blank_and_blank_groups_hide(mart):
    row = M.measures(mart, ["total_requests", "closure_rate", "oldest_open_case"], where={"borough": "Z"}).first()
    assert tuple(row) == (None, None, None)
    assert column(M.measures(mart, ["sla_breaches"], ["borough"]), "borough") == ["X"]


def test_open_counts_within_target(mart):
    row = M.measures(mart, ["within_sla_count", "sla_breach_rate", "sla_breach_rate_open", "avg_days_waiting_vs_sla"]).first()
    assert tuple(row) == (3, 0.5, 0.5, 245.0)


def test_leap_day_goes_to_the_28th(spark, calendar):
    data = rows(spark, *[(d, "Open", "X", None, 1, 0) for d in ("2023-02-28", "2024-02-28", "2024-02-29")])
    out = M.period_measures(data, calendar, {"": ["total_requests"], "_ly": ["total_requests"]}, ["full_date"])
    got = {str(r.full_date): (r.total_requests, r.total_requests_ly) for r in out.collect()}
    assert got["2024-02-28"] == (1, 1)
    assert got["2024-02-29"] == (1, 1)
    assert got["2025-02-28"] == (None, 1)


def test_whole_february_maps_to_29_days(spark, calendar):
    data = rows(spark, *[(f"2024-02-{d:02d}", "Open", "X", None, 1, 0) for d in range(1, 30)])
    out = M.period_measures(data, calendar, {"_ly": ["total_requests"]}, ["year", "month"])
    assert column(out, "year", "month", "total_requests_ly") == [(2025, 2, 29)]


def test_running_totals_end_at_the_last_calendar_day(spark, calendar):
    data = rows(spark, *[(d, "Open", "X", None, 1, 0) for d in ("2024-03-01", "2024-03-05", "2024-02-10", "2023-03-04")])
    cards = R.to_date_cards(data, calendar, where_date={"year": 2024, "month": [1, 2, 3]}).first()
    assert tuple(cards) == (2, 3)
    whole = R.to_date_cards(data, calendar).first()
    assert tuple(whole) == (None, None)
    daily = {str(r.full_date): r for r in R.running_totals(data, calendar).collect()}
    assert (daily["2024-03-04"].total_requests, daily["2024-03-04"].total_requests_mtd) == (None, 1)
    assert daily["2024-03-04"].total_requests_mtd_ly == 1
    assert daily["2024-03-05"].total_requests_ytd == 3


def test_rows_outside_the_calendar_count_without_a_date_filter(spark, calendar):
    data = rows(spark, ("2020-01-01", "Open", "X", None, 1, 0), ("2024-01-01", "Open", "X", None, 1, 0))
    assert M.measures(data, ["total_requests"]).first()[0] == 2
    assert M.period_measures(data, calendar, {"": ["total_requests"]}).first()[0] == 1


def test_comparison_without_an_earlier_year(spark, calendar):
    row = R.year_comparison(rows(spark, ("2023-05-05", "Open", "X", None, 1, 0)), calendar).filter("year = 2023").first()
    assert row.requests_yoy is None
    assert (row.kpi_color_yoy, row.requests_yoy_color, row.closure_rate_vs_ly, row.avg_days_vs_ly) == (M.SLATE, "Grey", "", " Days")


def test_oldest_case_ties(spark):
    data = spark.createDataFrame(
        [
            (dt.date(2023, 1, 2), "Open", "B", "Bee", "Rats", 50),
            (dt.date(2023, 1, 1), "Pending", "C", "Cee", "Noise", 50),
            (dt.date(2020, 1, 1), "Open", "A", "Aye", "Heat", 49),
        ],
        "created_date date, status string, agency_code string, agency_name string, complaint_type string, days_open_if_pending int",
    )
    row = M.oldest_case(data).first()
    assert (row.days_open_if_pending, row.created_date, row.department) == (50, dt.date(2023, 1, 1), "Bee")
    assert row.summary == "B | Noise | Jan 01, 2023"


def test_titles(mart, calendar):
    one = M.titles(mart, calendar, {"borough": "X"}, {"year": 2024}).first()
    assert (one.dynamic_title, one.open_trend_label, one.mtd_label) == ("Service requests — X | 2024", "Open Cases — 2024", "Dec 2024")
    free = M.titles(mart, calendar).first()
    assert (free.dynamic_title, free.open_trend_label) == ("Service requests — All Boroughs | All Years", "Open Cases — All Years")
    several = M.titles(mart, calendar, {"borough": ["X", "Y"]}, {"year": [2023, 2024]}).first()
    assert several.dynamic_title == "Service requests — Multiple Boroughs | Multiple Years"


def test_bands(spark):
    data = spark.createDataFrame([(0.5, 3.0, 20000), (0.1, 3.1, 5000), (None, None, None)], "sla_breach_rate double, avg_resolution_days double, total_open int").coalesce(1)
    got = [tuple(r) for r in data.select(*M.color_columns()).collect()]
    assert got[0] == (M.RED, "#059669", M.PALE_GREEN, M.PALE_RED, M.PALE_RED, M.PALE_RED)
    assert got[1] == (M.AMBER, "#10b981", M.PALE_GREEN, M.PALE_GREEN, M.PALE_GREEN, M.PALE_GREEN)
    assert got[2] == (M.SLATE, M.SLATE, M.PALE_GREEN, M.PALE_GREEN, M.PALE_GREEN, M.PALE_GREEN)


def test_top_keeps_ties(spark):
    data = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 1)], "k string, n int")
    assert sorted(column(S.top_n_with_ties(data, "n", 2), "k")) == ["a", "b", "c"]


def test_calendar_gaps(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 5)], "full_date date")
    assert [tuple(r) for r in V.calendar_gaps(days).collect()] == [(dt.date(2024, 1, 2), dt.date(2024, 1, 5), 2)]
