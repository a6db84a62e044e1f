"""Report measures at any grain, with filter replacement and time intelligence.

A measure is made of parts. A part is one aggregate of the rows (a count, sum, maximum or
minimum) that can be aggregated again, so every query reduces the requests once, to one row per
group and day at most, and all further work (totals, shifted periods, running totals) runs on
that small frame.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.functions.rules import band, band_down, sign_label
from civicmart.functions.text import (
    fixed,
    fmt_days,
    fmt_delta,
    fmt_magnitude,
    fmt_month_day_year,
    fmt_percent,
    fmt_thousands,
    safe_div,
)
from civicmart.session import cut

# Report colours and the limits they stand for.
SLATE, RED, AMBER, GREEN = "#64748b", "#ef4444", "#f59e0b", "#10b981"
PALE_GREEN, PALE_AMBER, PALE_RED = "#9FE1CB", "#FAC775", "#F09595"
NAVY, LIGHT_NAVY = "#0C447C", "#185FA5"
AVG_DAYS_BANDS = [
    (3, "#059669"), (6, "#10b981"), (10, "#6ee7b7"), (15, "#fcd34d"), (20, "#f59e0b"), (30, "#f97316"),
]
AGING_COLORS = {
    "0–30 days": "#10b981", "31–90 days": "#f59e0b", "91–180 days": "#ef4444",
    "181–365 days": "#dc2626", "Over 365 days": "#7f1d1d",
}


@dataclass(frozen=True)
class Part:
    """One aggregate: `value` is what a row adds, None for rows that do not count.

    `replaces` names the columns on which the measure sets its own filter; a filter or grouping
    on such a column does not apply to it.
    """

    kind: str
    value: Callable[[], Column]
    replaces: frozenset[str] = frozenset()


def _open() -> Column:
    return F.col("status") != "Closed"


def _days() -> Column:
    return F.col("days_open_if_pending")


def _when(condition: Callable[[], Column], value: Callable[[], Column] = lambda: F.lit(1)):
    return lambda: F.when(condition(), value())


STATUS = frozenset({"status"})
STATUS_AND_AGE = frozenset({"status", "days_open_if_pending"})
FLAG = frozenset({"is_sla_breach"})


def _resolved() -> Column:
    # The report's test "not equal to blank" is also false for 0, so same-day cases are left out.
    return F.col("resolution_days").isNotNull() & (F.col("resolution_days") != 0)


PARTS = {
    "n": Part("sum", lambda: F.lit(1)),
    "n_closed": Part("sum", _when(lambda: F.col("status") == "Closed"), STATUS),
    "n_open": Part("sum", _when(_open), STATUS),
    "n_breach": Part("sum", _when(lambda: F.col("is_sla_breach") == 1), FLAG),
    "n_within": Part("sum", _when(lambda: F.col("is_sla_breach") == 0), FLAG),
    "res_sum": Part("sum", _when(_resolved, lambda: F.col("resolution_days"))),
    "res_n": Part("sum", _when(_resolved)),
    "age_sum": Part("sum", _when(_open, _days), STATUS),
    "age_n": Part("sum", _when(lambda: _open() & _days().isNotNull()), STATUS),
    "age_max": Part("max", _when(_open, _days), STATUS),
    "n_stale": Part("sum", _when(lambda: _open() & (_days() > 90)), STATUS_AND_AGE),
    "n_90_180": Part("sum", _when(lambda: _open() & (_days() > 90) & (_days() <= 180)), STATUS_AND_AGE),
    "n_180_365": Part("sum", _when(lambda: _open() & (_days() > 180) & (_days() <= 365)), STATUS_AND_AGE),
    "n_over_365": Part("sum", _when(lambda: _open() & (_days() > 365)), STATUS_AND_AGE),
    "sla_sum": Part("sum", lambda: F.col("sla_days")),
    "sla_n": Part("sum", lambda: F.when(F.col("sla_days").isNotNull(), 1)),
}


def part(name: str) -> Column:
    return F.col(f"_{name}")


def _ratio(a: str, b: str) -> Callable[[], Column]:
    return lambda: safe_div(part(a), part(b))


# Measure -> (parts it needs, formula over them). Counts over nothing and divisions by nothing
# are NULL, because a sum over no rows is NULL.
MEASURES: dict[str, tuple[list[str], Callable[[], Column]]] = {
    "total_requests": (["n"], lambda: part("n")),
    "total_closed": (["n_closed"], lambda: part("n_closed")),
    "total_open": (["n_open"], lambda: part("n_open")),
    "sla_breaches": (["n_breach"], lambda: part("n_breach")),
    "sla_breached_count": (["n_breach"], lambda: part("n_breach")),
    "within_sla_count": (["n_within"], lambda: part("n_within")),
    "closure_rate": (["n_closed", "n"], _ratio("n_closed", "n")),
    "sla_breach_rate": (["n_breach", "n_closed"], _ratio("n_breach", "n_closed")),
    "sla_breach_rate_open": (["n_breach", "n_open"], _ratio("n_breach", "n_open")),
    "avg_resolution_days": (["res_sum", "res_n"], _ratio("res_sum", "res_n")),
    "avg_days_open": (["age_sum", "age_n"], _ratio("age_sum", "age_n")),
    "oldest_open_case": (["age_max"], lambda: part("age_max")),
    "stale_over_90": (["n_stale"], lambda: part("n_stale")),
    "stale_over_90_rate": (["n_stale", "n_open"], _ratio("n_stale", "n_open")),
    "stale_90_to_180": (["n_90_180"], lambda: part("n_90_180")),
    "stale_180_to_365": (["n_180_365"], lambda: part("n_180_365")),
    "stale_over_365": (["n_over_365"], lambda: part("n_over_365")),
    "avg_days_waiting_vs_sla": (
        ["age_sum", "age_n", "sla_sum", "sla_n"],
        lambda: safe_div(part("age_sum"), part("age_n")) - safe_div(part("sla_sum"), part("sla_n")),
    ),
}


def condition(column: str, wanted: object) -> Column:
    """A filter from a plain value, a list of values, or a ready-made Column."""
    if isinstance(wanted, Column):
        return wanted
    c = F.col(column)
    return c.isin(list(wanted)) if isinstance(wanted, (list, tuple, set)) else c == wanted


def _again(kind: str, c: Column) -> Column:
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](c)


def needed_parts(names: list[str]) -> list[str]:
    seen: dict[str, None] = {}
    for m in names:
        seen.update(dict.fromkeys(MEASURES[m][0]))
    return list(seen)


def reduce_rows(
    rows: DataFrame, parts: list[str], by: list[str], where: dict[str, object], more: list[Column] | None = None,
    sets: list[list[str]] | None = None,
) -> DataFrame:
    """Parts per group, and `more` aggregates. Filters no part replaces are applied to the scan;
    the others per part. With `sets`, per group of each of these sets of the columns `by`."""
    replaced = set().union(*[PARTS[p].replaces for p in parts])
    for column, wanted in where.items():
        if column not in replaced:
            rows = rows.filter(condition(column, wanted))
    aggregates = []
    for name in parts:
        p = PARTS[name]
        value = p.value()
        for column, wanted in where.items():
            if column in replaced and column not in p.replaces:
                value = F.when(condition(column, wanted), value)
        aggregates.append(_again(p.kind, value).alias(f"_{name}"))
    aggregates += more or []
    if sets is not None:
        return rows.groupingSets([[F.col(c) for c in s] for s in sets], *by).agg(*aggregates)
    return rows.groupBy(*by).agg(*aggregates) if by else rows.agg(*aggregates)


def combine(df: DataFrame, parts: list[str], by: list[str], more: list[Column] | None = None) -> DataFrame:
    """Parts of finer groups put together to coarser ones, with `more` aggregates."""
    aggregates = [_again(PARTS[p].kind, part(p)).alias(f"_{p}") for p in parts] + (more or [])
    return df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates)


def replace_grouping(df: DataFrame, parts: list[str], by: list[str]) -> DataFrame:
    """Parts that replace the filter on a grouping column get the value over all its groups."""
    for name in parts:
        p = PARTS[name]
        if p.replaces & set(by):
            rest = [c for c in by if c not in p.replaces]
            df = df.withColumn(f"_{name}", _again(p.kind, part(name)).over(Window.partitionBy(*rest)))
    return df


def formulas(names: list[str], suffix: str = "") -> list[Column]:
    return [MEASURES[m][1]().alias(m + suffix) for m in names]


def measures(
    rows: DataFrame, names: list[str], by: list[str] | None = None, where: dict[str, object] | None = None
) -> DataFrame:
    """The named measures per group of `by`, over the rows that `where` leaves.

    As in a report, a group in which every measure is blank does not show.
    """
    by, where = by or [], where or {}
    parts = needed_parts(names)
    reduced = replace_grouping(reduce_rows(rows, parts, by, where), parts, by)
    out = reduced.select(*by, *formulas(names))
    return out.filter(F.coalesce(*[F.col(m).cast("double") for m in names]).isNotNull()) if by else out


def set_number(by: list[str], columns: list[str]) -> int:
    """What `grouping_id` gives for the groups of `by` among `columns`: a bit for each column left out."""
    return sum(1 << i for i, c in enumerate(reversed(columns)) if c not in by)


def measures_of_page(
    rows: DataFrame, visuals: dict[str, tuple[list[str], list[str]]], where: dict[str, object] | None = None
) -> dict[str, DataFrame]:
    """The measures of several visuals (group columns and measure names each) from one pass over the rows.

    All groupings are grouping sets of one aggregation, whose result (one row per group) is stored; each visual
    reads its own set from it. Every visual equals `measures` over its columns.
    """
    columns = list(dict.fromkeys(c for by, _ in visuals.values() for c in by))
    sets = [list(s) for s in dict.fromkeys(tuple(sorted(by, key=columns.index)) for by, _ in visuals.values())]
    parts = needed_parts([m for _, names in visuals.values() for m in names])
    held = cut(reduce_rows(rows, parts, columns, where or {}, [F.grouping_id().alias("_set")], sets), "page")
    out = {}
    for visual, (by, names) in visuals.items():
        own = needed_parts(names)
        groups = replace_grouping(held.filter(F.col("_set") == set_number(by, columns)), own, by)
        shown = groups.select(*by, *formulas(names))
        out[visual] = shown.filter(F.coalesce(*[F.col(m).cast("double") for m in names]).isNotNull()) if by else shown
    return out


# ---- periods -------------------------------------------------------------------------------
# A context is a group of calendar columns (or everything); a period frame holds, per context,
# the days a measure takes in. Contexts and days are bounded by the calendar.


def contexts(calendar: DataFrame, by: list[str], where: dict[str, object] | None = None) -> DataFrame:
    """The calendar days of each context, in `full_date`."""
    for column, wanted in (where or {}).items():
        calendar = calendar.filter(condition(column, wanted))
    shown = [c for c in by if c != "full_date"]
    return calendar.select(*shown, F.col("full_date").alias("day"), *(["full_date"] if "full_date" in by else []))


def _in_calendar(days: DataFrame, calendar: DataFrame) -> DataFrame:
    return days.join(calendar.select(F.col("full_date").alias("day")), "day", "left_semi")


def same_period_last_year(ctx: DataFrame, by: list[str], calendar: DataFrame) -> DataFrame:
    """Days one year earlier. A context that ends a month takes in the whole end of the month
    before it, so February 2025 maps to all 29 days of February 2024."""
    earlier = F.add_months("day", -12)
    month_end = F.col("day") == F.last_day("day")
    last_two = F.count("day").over(
        Window.partitionBy(*by, F.trunc("day", "month"))
        .orderBy(F.unix_date("day")).rangeBetween(-1, 0)
    ) > 1
    first = ctx.select(*by, earlier.alias("day"))
    ends = (
        ctx.withColumn("_both", last_two)
        .filter(F.col("_both") & month_end)
        .select(*by, F.last_day(earlier).alias("day"))
    )
    return _in_calendar(first.unionByName(ends).distinct(), calendar)


def last_days(ctx: DataFrame, by: list[str]) -> DataFrame:
    """The last day of each context."""
    return ctx.groupBy(*by).agg(F.max("day").alias("day"))


# Period -> (the days of its contexts, what is read at those days: the day itself or the running month or year).
PERIODS: dict[str, tuple[Callable[[DataFrame, list[str], DataFrame], DataFrame], str]] = {
    "": (lambda ctx, by, cal: ctx, "day"),
    "_ly": (same_period_last_year, "day"),
    "_mtd": (lambda ctx, by, cal: last_days(ctx, by), "month"),
    "_ytd": (lambda ctx, by, cal: last_days(ctx, by), "year"),
    "_mtd_ly": (lambda ctx, by, cal: last_days(same_period_last_year(ctx, by, cal), by), "month"),
}


def values_at_days(daily: DataFrame, parts: list[str], by: list[str], calendar: DataFrame, units: list[str]) -> DataFrame:
    """Parts per group, day and `_unit`: those of the day itself, or running from the start of its month or year.

    Each group and period is summed once in the order of its days, and a day without requests
    shows the one before it: as many rows as days, however long the period.
    """
    def of(unit: str) -> Column:
        if unit == "day":
            until, shown = F.col("day"), [part(p) for p in parts]
        else:
            start = F.trunc("day", unit)
            days = Window.partitionBy(*by, start).orderBy("day")
            so_far = days.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            shown = [_again(PARTS[p].kind, part(p)).over(so_far) for p in parts]
            end = F.date_sub(F.add_months(start, {"month": 1, "year": 12}[unit]), 1)
            until = F.coalesce(F.date_sub(F.lead("day").over(days), 1), end)
        return F.struct(F.lit(unit).alias("_unit"), until.alias("_until"), *[c.alias(f"_{p}") for c, p in zip(shown, parts, strict=True)])

    each = _in_calendar(daily, calendar).select(*by, "day", *[of(u).alias(f"_{u}") for u in units])
    spread = each.select(*by, "day", F.explode(F.array(*[f"_{u}" for u in units])).alias("v"))
    every = F.explode(F.sequence("day", "v._until")).alias("day")
    return spread.select(*by, "v._unit", *[f"v._{p}" for p in parts], every)


def daily_parts(rows: DataFrame, parts: list[str], by: list[str], where: dict[str, object]) -> DataFrame:
    """Parts per group and creation day: the one pass over the requests."""
    dated = rows.withColumn("_day", F.to_date("created_date"))
    return reduce_rows(dated, parts, [*by, "_day"], where).withColumnRenamed("_day", "day")


def period_measures(
    rows: DataFrame,
    calendar: DataFrame,
    wanted: dict[str, list[str]],
    by_date: list[str] | None = None,
    by: list[str] | None = None,
    where: dict[str, object] | None = None,
    where_date: dict[str, object] | None = None,
) -> DataFrame:
    """Measures over periods, one row per calendar context and group.

    `wanted` maps a period ('', '_ly', '_mtd', '_ytd', '_mtd_ly') to measures; the output
    columns carry the period as suffix. The requests are reduced once to groups and days, and
    that frame to running months and years where a period asks for them; the days of all periods
    meet these in one join and one aggregate. As in a report, a context shows when any of its
    periods has requests.
    """
    by_date, by, where = by_date or [], by or [], where or {}
    parts = needed_parts([m for names in wanted.values() for m in names])
    daily = daily_parts(rows, parts, by, where)
    ctx = contexts(calendar, by_date, where_date)
    keys = [*by_date, *by]
    days = [
        PERIODS[suffix][0](ctx, by_date, calendar)
        .select(*by_date, "day", F.lit(suffix).alias("_period"), F.lit(PERIODS[suffix][1]).alias("_unit"))
        for suffix in wanted
    ]
    units = sorted({PERIODS[suffix][1] for suffix in wanted})
    values = daily.withColumn("_unit", F.lit("day")) if units == ["day"] else values_at_days(daily, parts, by, calendar, units)
    tagged = reduce(DataFrame.unionByName, days)
    aggregates = [
        _again(PARTS[p].kind, F.when(F.col("_period") == suffix, part(p))).alias(f"_{p}{suffix}")
        for suffix, names in wanted.items()
        for p in needed_parts(names)
    ]
    met = tagged.join(values, ["day", "_unit"])
    out = met.groupBy(*keys).agg(*aggregates) if keys else met.agg(*aggregates)
    for suffix, names in wanted.items():
        own = needed_parts(names)
        plain = out.withColumns({f"_{p}": F.col(f"_{p}{suffix}") for p in own})
        ready = replace_grouping(plain, own, keys)
        out = ready.withColumns({m + suffix: MEASURES[m][1]() for m in names})
    return out.select(*keys, *[m + suffix for suffix, names in wanted.items() for m in names])


def change(cur: Column, old: Column) -> Column:
    """(cur - old) / old, NULL without an old value. A missing current value counts as 0."""
    return safe_div(F.coalesce(cur, F.lit(0)) - old, old)


def difference(cur: Column, old: Column) -> Column:
    """cur - old with blanks as 0; NULL only when both are missing."""
    both = cur.isNull() & old.isNull()
    return F.when(~both, F.coalesce(cur, F.lit(0)) - F.coalesce(old, F.lit(0)))


def year_over_year_columns() -> list[Column]:
    """Comparison texts and colours; needs the measures of '' and '_ly'."""
    c = F.col
    requests = change(c("total_requests"), c("total_requests_ly"))
    closure = change(c("closure_rate"), c("closure_rate_ly"))
    days = difference(c("avg_resolution_days"), c("avg_resolution_days_ly"))
    return [
        requests.alias("requests_yoy"),
        sign_label(requests, "Green", "Red", "Grey").alias("requests_vs_ly_color"),
        sign_label(requests, "Red", "Green", "Grey").alias("requests_yoy_color"),
        F.when(requests.isNull(), SLATE).when(requests >= 0, RED).otherwise(AMBER).alias("kpi_color_yoy"),
        F.coalesce(fmt_delta(closure, fmt_percent(F.abs(closure))), F.lit("")).alias("closure_rate_vs_ly"),
        sign_label(closure, "Green", "Red", "Grey").alias("closure_rate_vs_ly_color"),
        fmt_delta(days, fmt_days(F.abs(days))).alias("avg_days_vs_ly"),
        sign_label(days, "Red", "Green", "Grey").alias("avg_days_vs_ly_color"),
    ]


def vs_citywide(rows: DataFrame, by: list[str], over: str = "borough", where: dict | None = None) -> DataFrame:
    """Mean resolution per group minus the mean of the same group over all values of `over`."""
    keys = by if over in by else [*by, over]
    parts = needed_parts(["avg_resolution_days"])
    reduced = reduce_rows(rows, parts, keys, where or {})
    rest = Window.partitionBy(*[c for c in keys if c != over])
    whole = {p: F.sum(part(p)).over(rest) for p in parts}
    own = MEASURES["avg_resolution_days"][1]()
    return reduced.select(
        *keys,
        own.alias("avg_resolution_days"),
        difference(own, safe_div(whole["res_sum"], whole["res_n"])).alias("vs_citywide_avg"),
    )


OLDEST = {
    "created_date": "created_date", "department": "agency_name", "agency_code": "agency_code",
    "complaint_type": "complaint_type",
}


def first_of_open() -> list[Column]:
    """Least creation day, agency and complaint of the open rows of a group."""
    return [F.min(F.when(_open(), F.col(source))).alias(f"_{name}") for name, source in OLDEST.items()]


def pick_oldest() -> Column:
    """The values of the greatest age, from groups that each hold one age."""
    age = F.when(F.col("_created_date").isNotNull(), _days())
    shown = [_days().alias("days_open_if_pending"), *[F.col(f"_{n}").alias(n) for n in OLDEST]]
    return F.max_by(F.struct(*shown), age)


def case_summary(case: str = "") -> Column:
    day = fmt_month_day_year(F.to_date(f"{case}created_date"))
    return F.concat_ws(" | ", f"{case}agency_code", f"{case}complaint_type", day)


def oldest_case(rows: DataFrame, by: list[str] | None = None, where: dict | None = None) -> DataFrame:
    """The longest-open requests: creation day, first agency and first complaint among ties."""
    by = by or []
    kept = rows.filter(_open() & _days().isNotNull())
    for column, wanted in (where or {}).items():
        if column != "days_open_if_pending":
            kept = kept.filter(condition(column, wanted))
    days = _days().alias("days_open_if_pending")
    sources = [F.col(source).alias(name) for name, source in OLDEST.items()]
    # By hash: the greatest age per group, then one row per case of that age; only those are sorted for the least.
    ages = kept.select(*by, days).groupBy(*by).agg(F.max("days_open_if_pending").alias("_age"))
    same = F.col("days_open_if_pending") == F.col("_age")
    of_age = kept.select(*by, days, *sources)
    if by:
        named = ages.select(*[F.col(c).alias(f"_by_{c}") for c in by], "_age")
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
        met = of_age.join(named, same)
    else:
        met = of_age.join(ages, same)
    cases = met.select(*by, "days_open_if_pending", *OLDEST).distinct()
    top = cases.groupBy(*by).agg(F.max("days_open_if_pending").alias("days_open_if_pending"), *[F.min(n).alias(n) for n in OLDEST])
    return top.withColumn("summary", case_summary())


def display_columns() -> list[Column]:
    """Text forms of the card measures."""
    c = F.col
    return [
        fmt_magnitude(c("total_requests")).alias("total_requests_display"),
        fmt_thousands(c("total_requests")).alias("total_requests_full"),
        fmt_magnitude(c("total_closed")).alias("total_closed_display"),
        fmt_magnitude(c("total_open")).alias("total_open_display"),
        fmt_days(c("avg_resolution_days")).alias("avg_resolution_display"),
        fmt_days(c("avg_days_open")).alias("avg_open_days_display"),
        fmt_days(c("oldest_open_case"), 0).alias("oldest_open_display"),
    ]


def sla_breach_text(rate: Column) -> Column:
    return band_down(rate, [(0.20, "Above 20% threshold"), (0.10, "Above 10% threshold")], "Below 10% threshold")


def waiting_label(diff: Column) -> Column:
    days = F.coalesce(fixed(diff, 0), F.lit(""))
    return F.when(diff > 0, F.concat(F.lit("+"), days, F.lit(" days over SLA target"))).otherwise(
        F.concat(days, F.lit(" days under SLA target"))
    )


def color_columns() -> list[Column]:
    """Threshold colours; blank counts as 0 where the report compares it with a limit."""
    c = F.col
    zero = F.lit(0)
    rate, days = F.coalesce(c("sla_breach_rate"), zero), F.coalesce(c("avg_resolution_days"), zero)
    backlog = F.coalesce(c("total_open"), zero)
    return [
        band_down(c("sla_breach_rate"), [(0.50, RED), (0.10, AMBER)], GREEN, SLATE).alias("sla_breach_color"),
        band(c("avg_resolution_days"), AVG_DAYS_BANDS, RED, SLATE).alias("avg_days_color"),
        band(days, [(15, PALE_GREEN), (30, PALE_AMBER)], PALE_RED).alias("avg_resolution_color"),
        band(rate, [(0.10, PALE_GREEN), (0.20, PALE_AMBER)], PALE_RED).alias("borough_sla_color"),
        band(backlog, [(5000, PALE_GREEN), (10000, PALE_AMBER)], PALE_RED).alias("borough_open_color"),
        band_down(backlog, [(20000, PALE_RED), (10000, PALE_AMBER)], PALE_GREEN).alias("agency_open_color"),
    ]


def aging_color(bucket: Column) -> Column:
    out = F.when(F.lit(False), F.lit(SLATE))
    for label, colour in AGING_COLORS.items():
        out = out.when(bucket == label, colour)
    return out.otherwise(SLATE)


# ---- scope descriptions --------------------------------------------------------------------


def selected(c: Column, several: str) -> Column:
    """The only value in scope as text, else `several`."""
    return F.when(F.min(c) == F.max(c), F.max(c).cast("string")).otherwise(F.lit(several))


def titles(
    rows: DataFrame,
    calendar: DataFrame,
    where: dict[str, object] | None = None,
    where_date: dict[str, object] | None = None,
    prefix: str = "Service requests",
) -> DataFrame:
    """Titles that describe the filters: one value, several, or all."""
    where, where_date = where or {}, where_date or {}
    scope, days = rows, calendar
    for column, wanted in where.items():
        scope = scope.filter(condition(column, wanted))
    for column, wanted in where_date.items():
        days = days.filter(condition(column, wanted))
    boroughs = scope.agg(selected(F.col("borough"), "Multiple Boroughs").alias("borough"))
    years = days.agg(
        selected(F.col("year"), "Multiple Years").alias("year"),
        selected(F.col("year"), "All Years").alias("one_year"),
        F.max("year").alias("last_year"),
        F.max("full_date").alias("last_day"),
    )
    both = boroughs.unionByName(years, allowMissingColumns=True)
    scope_row = both.agg(*[F.max(c).alias(c) for c in both.columns])
    borough = F.col("borough") if "borough" in where else F.lit("All Boroughs")
    year = F.col("year") if "year" in where_date else F.lit("All Years")
    month = F.date_format("last_day", "MMM yyyy")
    return scope_row.select(
        F.concat(F.lit(prefix + " — "), borough, F.lit(" | "), year).alias("dynamic_title"),
        F.concat(F.lit("Open Cases — "), F.col("one_year")).alias("open_trend_label"),
        F.col("last_year").cast("string").alias("sparkline_title"),
        month.alias("mtd_label"),
        month.alias("mtd_sparkline_title"),
    )


def last_month_flags(calendar: DataFrame, by: list[str]) -> DataFrame:
    """Per calendar context: is its last day in the calendar's last month, and the bar colour."""
    per = calendar.groupBy(*by).agg(F.max("full_date").alias("last_day"), F.max("month").alias("last_month_no"))
    end = F.max("last_day").over(Window.partitionBy())
    same = F.trunc("last_day", "month") == F.trunc(end, "month")
    return per.select(
        *by,
        F.when(same, 1).otherwise(0).alias("is_last_month"),
        F.when(F.col("last_month_no") == F.month(end), NAVY).otherwise(LIGHT_NAVY).alias("sparkline_bar_color"),
    )
