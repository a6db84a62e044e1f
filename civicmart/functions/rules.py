"""Business rules: lookups, allow-lists, classifiers, buckets and bands."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicmart.functions.text import is_blank, norm_key

# Request states, their synonyms, and the official agency names and targets.
STATUSES = ["Open", "Closed", "Pending", "In Progress", "Unspecified", "Assigned"]
STATUS_SYNONYMS = {
    "Closed": ["CLOSED", "CLOSE", "RESOLVED"],
    "Open": ["OPEN", "OPENED"],
    "Pending": ["PENDING", "HOLD", "ON HOLD"],
    "In Progress": ["IN PROGRESS", "IN-PROGRESS", "INPROGRESS", "STARTED"],
    "Assigned": ["ASSIGNED", "DISPATCHED"],
}
AGENCY_NAMES = {
    "NYPD": "New York City Police Department",
    "HPD": "Housing Preservation and Development",
    "DOT": "Department of Transportation",
    "DSNY": "Department of Sanitation",
    "DEP": "Department of Environmental Protection",
    "DPR": "Department of Parks and Recreation",
    "DOB": "Department of Buildings",
    "TLC": "Taxi and Limousine Commission",
    "FDNY": "Fire Department of New York",
    "DOE": "Department of Education",
    "DHS": "Department of Homeless Services",
    "ACS": "Administration for Children Services",
    "HRA": "Human Resources Administration",
    "EDC": "Economic Development Corporation",
    "DDC": "Department of Design and Construction",
    "OMB": "Office of Management and Budget",
    "DOHMH": "Department of Health and Mental Hygiene",
    "DCAS": "Department of Citywide Administrative Services",
}
AGENCY_SLA_DAYS = {
    "NYPD": 2, "HPD": 10, "DOT": 15, "DSNY": 3, "DEP": 10, "DPR": 14,
    "DOB": 15, "TLC": 5, "FDNY": 7, "DOE": 30, "DOHMH": 5,
}
DEFAULT_SLA_DAYS = 10
DEPARTMENT = "City Agency"

# Keyword -> category, first match wins.
CATEGORY_RULES = [
    ("NOISE", "Noise"),
    ("ILLEGAL PARKING", "Vehicle"), ("VEHICLE", "Vehicle"), ("TRAFFIC", "Vehicle"),
    ("HEAT", "Housing"), ("HOT WATER", "Housing"), ("PLUMBING", "Housing"), ("PAINT", "Housing"),
    ("MOLD", "Housing"), ("ELEVATOR", "Housing"), ("HOUSING", "Housing"),
    ("STREET LIGHT", "Infrastructure"), ("STREET CONDITION", "Infrastructure"),
    ("SEWER", "Infrastructure"), ("POTHOLE", "Infrastructure"), ("SIDEWALK", "Infrastructure"),
    ("WATER SYSTEM", "Infrastructure"),
    ("TREE", "Environment"), ("LITTER", "Environment"), ("DIRTY", "Environment"),
    ("SANITATION", "Environment"), ("RODENT", "Environment"), ("PEST", "Environment"),
    ("FIRE", "Safety"), ("HAZARD", "Safety"), ("DRUG", "Safety"), ("WEAPON", "Safety"),
    ("ASSAULT", "Safety"),
]
LEGACY_CATEGORY_RULES = [
    ("NOISE", "Noise"),
    ("PARK", "Vehicle"), ("VEHICLE", "Vehicle"),
    ("HEAT", "Housing"), ("PLUMB", "Housing"), ("PAINT", "Housing"), ("WATER", "Housing"),
    ("LIGHT", "Infrastructure"), ("STREET", "Infrastructure"), ("SEWER", "Infrastructure"),
    ("TREE", "Environment"), ("LITTER", "Environment"), ("DIRTY", "Environment"),
]
OTHER_CATEGORY = "Other"

# Coordinate box, resolution buckets in sort order, backlog age limits.
CITY_BOX = {"lat": (40.4, 40.9), "lon": (-74.3, -73.7)}
RESOLUTION_BUCKETS = ["Same Day", "1-3 Days", "4-7 Days", "8-30 Days", "Over 30 Days", "Open"]
AGING_LIMITS = [
    (30, "0–30 days"), (90, "31–90 days"), (180, "91–180 days"),
    (365, "181–365 days"),
]
AGING_REST = "Over 365 days"


@dataclass(frozen=True)
class Settings:
    """What one warehouse is loaded with; the defaults are the city's own."""

    first_day: str = "2020-01-01"
    last_day: str = "2030-12-31"
    agency_names: dict[str, str] = field(default_factory=lambda: dict(AGENCY_NAMES))
    sla_days: dict[str, int] = field(default_factory=lambda: dict(AGENCY_SLA_DAYS))
    default_sla: int = DEFAULT_SLA_DAYS
    category_rules: list[tuple[str, str]] = field(default_factory=lambda: list(CATEGORY_RULES))
    box: dict[str, tuple[float, float]] = field(default_factory=lambda: dict(CITY_BOX))
    zero_as_null: bool = False
    report_years: tuple[int, int] = (2023, 2025)

    @property
    def key_range(self) -> tuple[int, int]:
        return int(self.first_day.replace("-", "")), int(self.last_day.replace("-", ""))


# The agencies the older load names, and those it has targets for.
LEGACY_NAMED = ["NYPD", "HPD", "DOT", "DSNY", "DEP", "DPR", "DOB", "TLC", "FDNY", "DOE"]
LEGACY_TARGETS = ["NYPD", "HPD", "DOT", "DSNY", "DEP", "DPR", "DOB", "TLC"]


def legacy_settings() -> Settings:
    """Rules of the older load: fewer names and targets, the shorter classifier."""
    return Settings(
        agency_names={code: AGENCY_NAMES[code] for code in LEGACY_NAMED},
        sla_days={code: AGENCY_SLA_DAYS[code] for code in LEGACY_TARGETS},
        category_rules=list(LEGACY_CATEGORY_RULES),
    )


def lookup(key: Column, table: dict) -> Column:
    """Value of a small fixed table, NULL for an unknown key."""
    if not table:
        return F.lit(None)
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def normalise_status(c: Column) -> Column:
    """One of the six states, or the text unchanged when it is none of them."""
    key = norm_key(c)
    branches = F.when(is_blank(c), "Unspecified")
    for state, words in STATUS_SYNONYMS.items():
        branches = branches.when(key.isin(words), state)
    # Trailing blanks do not matter to the allow-list, leading ones do.
    return branches.when(F.upper(F.rtrim(c)) == "UNSPECIFIED", "Unspecified").otherwise(c)


def valid_status(c: Column) -> Column:
    """Allow-list test that ignores case and trailing blanks."""
    return F.upper(F.rtrim(c)).isin([s.upper() for s in STATUSES])


def agency_name(code: Column, raw: Column, names: dict[str, str]) -> Column:
    """Official name, else the name in the file, else the code."""
    return F.coalesce(lookup(code, names).cast("string"), F.trim(raw), code)


def sla_days(code: Column, table: dict[str, int], default: int) -> Column:
    return F.coalesce(lookup(code, table).cast("int"), F.lit(default))


def categorise(c: Column, rules: list[tuple[str, str]]) -> Column:
    """Category of the first keyword the upper-cased text contains."""
    text = F.upper(c)
    start = F.when(F.lit(False), F.lit(OTHER_CATEGORY))
    chain = reduce(lambda acc, r: acc.when(text.contains(r[0]), F.lit(r[1])), rules, start)
    return chain.otherwise(OTHER_CATEGORY)


def in_bbox(lat: Column, lon: Column, box: dict[str, tuple[float, float]]) -> Column:
    def within(c: Column, limits: tuple[float, float]) -> Column:
        low, high = (F.lit(str(x)).cast("decimal(9,6)") for x in limits)
        return c.between(low, high)

    return within(lat, box["lat"]) & within(lon, box["lon"])


def in_calendar(key: Column, low: int, high: int) -> Column:
    return key.between(low, high)


def is_sla_breach(days: Column, sla: Column) -> Column:
    """1 above target, else 0; an open request counts as 0."""
    return F.when(days > sla, 1).otherwise(0)


def days_open(status: Column, created: Column, as_of: Column) -> Column:
    return F.when(status != "Closed", F.datediff(as_of, F.to_date(created)))


def resolution_bucket(days: Column) -> Column:
    same, few, week, month, over, still_open = RESOLUTION_BUCKETS
    return (
        F.when(days.isNull(), still_open)
        .when(days == 0, same)
        .when(days <= 3, few)
        .when(days <= 7, week)
        .when(days <= 30, month)
        .otherwise(over)
    )


def resolution_bucket_sort(bucket: Column) -> Column:
    return F.coalesce(lookup(bucket, {b: i for i, b in enumerate(RESOLUTION_BUCKETS, 1)}), F.lit(99))


def breach_label(flag: Column) -> Column:
    return F.when(flag == 1, "SLA Breached").otherwise("Within SLA")


def aging_bucket(days: Column) -> Column:
    """Backlog age band. The report compares blank as 0, so closed requests fall in the first band."""
    return band(F.coalesce(days, F.lit(0)), AGING_LIMITS, AGING_REST)


def aging_sort(days: Column) -> Column:
    order = [(limit, i) for i, (limit, _) in enumerate(AGING_LIMITS, 1)]
    return band(F.coalesce(days, F.lit(0)), order, len(AGING_LIMITS) + 1)


def band(value: Column, upto: list[tuple], rest, blank=None) -> Column:
    """Label of the first limit that `value` does not exceed; `blank` labels NULL if given."""
    head = F.when(value.isNull(), F.lit(blank)) if blank is not None else F.when(F.lit(False), F.lit(rest))
    return reduce(lambda acc, r: acc.when(value <= r[0], F.lit(r[1])), upto, head).otherwise(F.lit(rest))


def band_down(value: Column, at_least: list[tuple], rest, blank=None) -> Column:
    """Label of the first limit that `value` reaches, limits in falling order."""
    head = F.when(value.isNull(), F.lit(blank)) if blank is not None else F.when(F.lit(False), F.lit(rest))
    return reduce(lambda acc, r: acc.when(value >= r[0], F.lit(r[1])), at_least, head).otherwise(F.lit(rest))


def sign_label(value: Column, above: str, below: str, level: str) -> Column:
    return F.when(value > 0, above).when(value < 0, below).otherwise(level)
