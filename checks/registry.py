"""Every registered query: its Spark form, its output columns, and the SQL that must agree."""

from __future__ import annotations

import functools
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle as O
from civicmart.functions import dates as FD
from civicmart.functions import rules as FR
from civicmart.functions import text as FT
from civicmart.operators import dims as D
from civicmart.operators import fact as FA
from civicmart.operators import joins as J
from civicmart.operators import measures as M
from civicmart.operators import sets as S
from civicmart.plans import mart as PM
from civicmart.plans import profiles as PP
from civicmart.plans import reports as R
from civicmart.plans import verify as V
from civicmart.plans import warehouse as W
from civicmart.session import cut, fresh_path, open_files
from civicmart.sources import adapter as A
from civicmart.sources import pages as PG
from civicmart.sources import raw as RW
from civicmart.sources import tables as T
from civicmart.streaming import ingest as I

c = F.col
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
YEARS = list(range(1995, 2002))
UNDATED = 1990
BATCH = 20020101


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    columns: str
    sql: str | None


QUERIES: dict[str, Query] = {}


def shaped(df: DataFrame, columns: str) -> DataFrame:
    """Output columns in agreed types, as `oracle.typed` gives them."""
    out = []
    for item in columns.split():
        name, kind = item.rsplit(":", 1)
        col = F.col(f"`{name}`")
        cast = {
            "s": lambda x: x.cast("string"),
            "i": lambda x: x.cast("bigint"),
            "f": lambda x: F.round(x.cast("double"), 6),
            "d": lambda x: F.date_format(x, "yyyy-MM-dd"),
            "t": lambda x: F.date_format(x, "yyyy-MM-dd HH:mm:ss"),
        }[kind]
        out.append(cast(col).alias(name))
    return df.select(*out)


def query(name: str, columns: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return shaped(fn(spark, sf), columns)

        QUERIES[name] = Query(run, columns, O.typed(columns, sql) if sql else None)
        return fn

    return register


# ---- inputs: one warehouse per session, data folder and form, loaded on first use -------------

_LOADED: dict[tuple, W.Warehouse] = {}
FORMS = {"clean": A.clean_requests, "untidy": A.untidy_requests}


def load(spark: SparkSession, sf: str, form: str) -> W.Warehouse:
    """Stage and load a fresh warehouse from the order tables."""
    wh = W.create_warehouse(spark, fresh_path(spark, f"warehouse-{form}"), A.order_settings())
    T.load_staging(FORMS[form](spark, sf), wh.root, BATCH)
    W.run_all(wh, BATCH)
    return wh


def unloaded(spark: SparkSession, sf: str, form: str) -> W.Warehouse:
    """A warehouse with staged requests and dimensions, before its first load of the fact."""
    key = (spark.sparkContext.applicationId, sf, form, "unloaded")
    if key not in _LOADED:
        wh = W.create_warehouse(spark, fresh_path(spark, f"unloaded-{form}"), A.order_settings())
        T.load_staging(FORMS[form](spark, sf), wh.root, BATCH)
        W.run_all(wh, BATCH, fact=False)
        _LOADED[key] = wh
    return _LOADED[key]


def warehouse(spark: SparkSession, sf: str, form: str = "clean") -> W.Warehouse:
    key = (spark.sparkContext.applicationId, sf, form)
    if key not in _LOADED:
        _LOADED[key] = load(spark, sf, form)
    return _LOADED[key]


def mart(spark: SparkSession, sf: str, form: str = "clean") -> DataFrame:
    return PM.service_requests_mart(warehouse(spark, sf, form), A.AS_OF)


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse(spark, sf).table("dim_date")


def untidy(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse(spark, sf, "untidy").staging


def _write_files(rows: DataFrame, path: str, *by: str, packed: bool = False) -> None:
    """CSV as it is, with the blanks around values kept; in folders by the values of `by`, which are few."""
    writer = rows.write.option("header", True).option("escape", '"').option("compression", "gzip" if packed else "none")
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    with open_files(rows.sparkSession, len(YEARS) + 1):
        writer.partitionBy(*by).csv(path)


def csv_folder(spark: SparkSession, sf: str, form: str, packed: bool = False, staged: DataFrame | None = None) -> str:
    """Request files, one folder of part files per creation year, as a source system leaves them.

    Requests without a readable creation date lie in a file of their own, under `UNDATED`. `packed` files are
    gzipped, as streams read them too. `staged` holds the requests where they are stored already, as they came.
    """
    key = (spark.sparkContext.applicationId, sf, form, "csv", packed)
    if key not in _LOADED:
        rows = FORMS[form](spark, sf) if staged is None else staged.select(*RW.RAW_COLUMNS)
        root = fresh_path(spark, f"files-{form}")
        year = F.year(FD.parse_ts(c("created_date")))
        file = F.format_string("requests_%d.csv", F.when(year.isin(YEARS), year).otherwise(UNDATED))
        _write_files(rows.withColumn("file", file), root, "file", packed=packed)  # all files in one pass
        for absent in {*YEARS, UNDATED} - set(RW.files_of_years(spark, root)):
            _write_files(rows.limit(0), f"{root}/requests_{absent}.csv", packed=packed)
        _LOADED[key] = root
    return _LOADED[key]


# ---- sources and sinks ------------------------------------------------------------------------

RAW_TEXT = " ".join(f"{n}:s" for n in RW.RAW_COLUMNS)
_CREATED = O.ts("created_date")


@query(
    "raw_request_files",
    RAW_TEXT + " source_year:i",
    O.over(
        "untidy",
        "SELECT * REPLACE (nullif(city, '') AS city),"
        f" CASE WHEN year({_CREATED}) BETWEEN 1995 AND 2001 THEN year({_CREATED}) ELSE 1990 END AS source_year FROM raw_landed",
    ),
)
def raw_request_files(spark, sf):
    return RW.read_raw(spark, csv_folder(spark, sf, "untidy"))


@query(
    "raw_files_by_own_header",
    "unique_key:s status:s agency:s source_year:i",
    O.over("clean", "SELECT unique_key, status, CASE WHEN hash_part = 2 THEN NULL ELSE agency END AS agency, 1998 AS source_year FROM ("
           "SELECT *, CAST(split_part(unique_key, '-', 1) AS BIGINT) % 3 AS hash_part FROM raw_landed)"),
)
def raw_files_by_own_header(spark, sf):
    """Three files of one year: columns in order, in reverse, and without one."""
    import warnings

    rows = A.clean_requests(spark, sf).withColumn("part", F.substring_index("unique_key", "-", 1).cast("bigint") % 3)
    root = fresh_path(spark, "files-headers")
    columns = RW.RAW_COLUMNS
    shapes = [columns, columns[::-1], [n for n in columns if n != "agency"]]
    for number, names in enumerate(shapes):
        _write_files(rows.filter(c("part") == number).select(*names), f"{root}/{number}_1998.csv")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return RW.read_raw(spark, root)


@query(
    "request_files_by_year",
    "source_year:i n_rows:i n_open:i",
    O.over(
        "clean",
        "SELECT year(TRY_CAST(created_date AS TIMESTAMP)) AS source_year, count(*) AS n_rows,"
        " count(*) FILTER (closed_date IS NULL) AS n_open FROM raw"
        " WHERE year(TRY_CAST(created_date AS TIMESTAMP)) BETWEEN 1997 AND 1999 GROUP BY 1",
    ),
)
def request_files_by_year(spark, sf):
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        files = RW.read_raw(spark, csv_folder(spark, sf, "clean"), (1997, 1999), first_year=1995)
    return files.groupBy("source_year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(c("closed_date").isNull()).alias("n_open")
    )


@query(
    "missing_columns_filled",
    "status:s n_rows:i n_board:i n_zip:i",
    O.over("clean", "SELECT status, count(*) AS n_rows, 0 AS n_board, count(incident_zip) AS n_zip FROM raw GROUP BY 1"),
)
def missing_columns_filled(spark, sf):
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        known = RW.select_known(A.clean_requests(spark, sf).drop("community_board").withColumn("extra", F.lit(1)))
    return known.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("community_board").alias("n_board"),
        F.count("incident_zip").alias("n_zip"),
    )


@query(
    "year_slice",
    "unique_key:s created_date:s",
    O.over("clean", "SELECT unique_key, created_date FROM raw WHERE created_date >= '1998' AND created_date < '1999'"),
)
def year_slice(spark, sf):
    return RW.slice_year(A.clean_requests(spark, sf), 1998)


@query(
    "trimmed_requests",
    RAW_TEXT,
    O.over("untidy", "SELECT " + ", ".join(f"trim({n}) AS {n}" for n in RW.RAW_COLUMNS) + " FROM raw"),
)
def trimmed_requests(spark, sf):
    return RW.trim_all(A.untidy_requests(spark, sf))


@query(
    "staged_rows",
    "stg_batch_id:i n_rows:i n_processed:i n_errors:i n_row_ids:i n_loaded_at:i",
    O.over(
        "clean",
        f"SELECT {BATCH} AS stg_batch_id, count(*) AS n_rows, count(*) AS n_processed, 0 AS n_errors,"
        " count(*) AS n_row_ids, count(*) AS n_loaded_at FROM raw",
    ),
)
def staged_rows(spark, sf):
    return warehouse(spark, sf).staging.groupBy("stg_batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("stg_is_processed").alias("n_processed"),
        F.count("stg_error_message").alias("n_errors"), F.countDistinct("stg_row_id").alias("n_row_ids"),
        F.count("stg_load_date").alias("n_loaded_at"),
    )


@query(
    "report_model_tables",
    "table_name:s total_rows:i",
    O.over(
        "clean",
        "SELECT 'requests' AS table_name, count(*) AS total_rows FROM mart"
        " UNION ALL SELECT 'calendar', count(*) FROM dim_date WHERE year BETWEEN 1997 AND 1999"
        " UNION ALL SELECT 'agency_summary', count(DISTINCT (agency_code, year, month)) FROM mart"
        " UNION ALL SELECT 'borough_summary', count(DISTINCT (borough, year, month, category)) FROM mart",
    ),
)
def report_model_tables(spark, sf):
    return S.union_counts(PM.report_model(warehouse(spark, sf), A.AS_OF))


# ---- scalar functions -------------------------------------------------------------------------


@query(
    "canonical_keys",
    "agency_key_text:s descriptor_key:s agency_blank:i n_rows:i",
    O.over(
        "untidy",
        "SELECT upper(trim(agency)) AS agency_key_text, coalesce(trim(descriptor), '') AS descriptor_key,"
        " CAST(agency IS NULL OR trim(agency) = '' AS INTEGER) AS agency_blank, count(*) AS n_rows"
        " FROM raw GROUP BY ALL",
    ),
)
def canonical_keys(spark, sf):
    return untidy(spark, sf).groupBy(
        FT.norm_key(c("agency")).alias("agency_key_text"),
        FT.blank_key(c("descriptor")).alias("descriptor_key"),
        FT.is_blank(c("agency")).cast("int").alias("agency_blank"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "parsed_dates",
    "date_key:i in_calendar:i n_rows:i n_closed:i sum_days:i",
    O.over(
        "untidy",
        "SELECT CAST(strftime(created, '%Y%m%d') AS INTEGER) AS date_key,"
        " CAST(CAST(strftime(created, '%Y%m%d') AS INTEGER) BETWEEN 19970101 AND 19991231 AS INTEGER) AS in_calendar,"
        " count(*) AS n_rows, count(closed) AS n_closed, sum(datediff('day', created, closed)) AS sum_days"
        f" FROM (SELECT {_CREATED} AS created, {O.ts('closed_date')} AS closed FROM raw) GROUP BY 1, 2",
    ),
)
def parsed_dates(spark, sf):
    rows = untidy(spark, sf).select(
        FD.parse_ts(c("created_date")).alias("created"), FD.parse_ts(c("closed_date")).alias("closed")
    )
    key = FD.date_key(c("created"))
    return rows.groupBy(
        key.alias("date_key"), FR.in_calendar(key, 19970101, 19991231).cast("int").alias("in_calendar")
    ).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("closed").alias("n_closed"),
        F.sum(FD.resolution_days(c("created"), c("closed"))).alias("sum_days"),
    )


@query(
    "elapsed_seconds",
    "event_type:s n_rows:i sum_seconds:i",
    "SELECT event_type, count(*) AS n_rows,"
    " sum(CAST(floor(epoch_us(ts - TIMESTAMP '2024-01-01') / 1000000.0) AS BIGINT)) AS sum_seconds FROM events GROUP BY 1",
)
def elapsed_seconds(spark, sf):
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return A.read_tables(spark, sf, "events")[0].groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(FD.duration_sec(start, c("ts"))).alias("sum_seconds")
    )


@query(
    "coordinates_in_box",
    "readable:i inside:i n_rows:i",
    O.over(
        "untidy",
        "SELECT CAST(lat IS NOT NULL AS INTEGER) AS readable,"
        " CAST(lat BETWEEN 40.4 AND 40.9 AND lon BETWEEN -74.3 AND -73.7 AS INTEGER) AS inside, count(*) AS n_rows"
        " FROM (SELECT TRY_CAST(trim(latitude) AS DECIMAL(9,6)) AS lat, TRY_CAST(trim(longitude) AS DECIMAL(9,6)) AS lon"
        " FROM raw) GROUP BY 1, 2",
    ),
)
def coordinates_in_box(spark, sf):
    rows = untidy(spark, sf).select(
        FD.parse_coord(c("latitude")).alias("lat"), FD.parse_coord(c("longitude")).alias("lon")
    )
    return rows.groupBy(
        c("lat").isNotNull().cast("int").alias("readable"),
        FR.in_bbox(c("lat"), c("lon"), FR.CITY_BOX).cast("int").alias("inside"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "status_mapping",
    "status:s mapped:s allowed:i n_rows:i",
    O.over(
        "untidy",
        f"SELECT status, mapped, CAST(upper(rtrim(mapped)) IN {O.ALLOWED} AS INTEGER) AS allowed, count(*) AS n_rows"
        f" FROM (SELECT status, {O.STATUS} AS mapped FROM raw) GROUP BY 1, 2, 3",
    ),
)
def status_mapping(spark, sf):
    mapped = FR.normalise_status(c("status"))
    return untidy(spark, sf).groupBy(
        "status", mapped.alias("mapped"), FR.valid_status(mapped).cast("int").alias("allowed")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


# The rules as the twin knows them, in the order in which they are tried.
TWIN_RULES = [
    ("NOISE", "Noise"), ("ILLEGAL PARKING", "Vehicle"), ("VEHICLE", "Vehicle"), ("TRAFFIC", "Vehicle"),
    ("HEAT", "Housing"), ("HOT WATER", "Housing"), ("PLUMBING", "Housing"), ("PAINT", "Housing"),
    ("MOLD", "Housing"), ("ELEVATOR", "Housing"), ("HOUSING", "Housing"), ("STREET LIGHT", "Infrastructure"),
    ("STREET CONDITION", "Infrastructure"), ("SEWER", "Infrastructure"), ("POTHOLE", "Infrastructure"),
    ("SIDEWALK", "Infrastructure"), ("WATER SYSTEM", "Infrastructure"), ("TREE", "Environment"),
    ("LITTER", "Environment"), ("DIRTY", "Environment"), ("SANITATION", "Environment"), ("RODENT", "Environment"),
    ("PEST", "Environment"), ("FIRE", "Safety"), ("HAZARD", "Safety"), ("DRUG", "Safety"), ("WEAPON", "Safety"),
    ("ASSAULT", "Safety"),
]
TWIN_OLDER_RULES = [
    ("NOISE", "Noise"), ("PARK", "Vehicle"), ("VEHICLE", "Vehicle"), ("HEAT", "Housing"), ("PLUMB", "Housing"),
    ("PAINT", "Housing"), ("WATER", "Housing"), ("LIGHT", "Infrastructure"), ("STREET", "Infrastructure"),
    ("SEWER", "Infrastructure"), ("TREE", "Environment"), ("LITTER", "Environment"), ("DIRTY", "Environment"),
]


def _like_case(text: str, rules: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {text} LIKE '%{k}%' THEN '{v}'" for k, v in rules) + " ELSE 'Other' END"


@query(
    "text_categories",
    "doc_id:i category:s legacy_category:s",
    f"SELECT doc_id, {_like_case('upper(text)', TWIN_RULES)} AS category,"
    f" {_like_case('upper(text)', TWIN_OLDER_RULES)} AS legacy_category FROM documents",
)
def text_categories(spark, sf):
    return A.read_tables(spark, sf, "documents")[0].select(
        "doc_id",
        FR.categorise(c("text"), FR.CATEGORY_RULES).alias("category"),
        FR.categorise(c("text"), FR.LEGACY_CATEGORY_RULES).alias("legacy_category"),
    )


@query(
    "title_case_text",
    "source:s titled:s n_rows:i",
    "SELECT source, nullif(array_to_string(list_transform(list_filter(string_split(trim(x), ' '), lambda w: w <> ''),"
    " lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' '), '') AS titled, count(*) AS n_rows FROM ("
    " SELECT 'part' AS source, upper(p_name) || '   ' || p_type AS x FROM part"
    " UNION ALL SELECT 'order', '  ' || o_orderpriority FROM orders"
    " UNION ALL SELECT 'customer', lower(c_mktsegment) || ' ' FROM customer) GROUP BY ALL",
)
def title_case_text(spark, sf):
    part, orders, customer = A.read_tables(spark, sf, "part", "orders", "customer")
    rows = (
        part.select(F.lit("part").alias("source"), F.concat(F.upper("p_name"), F.lit("   "), "p_type").alias("x"))
        .unionByName(orders.select(F.lit("order").alias("source"), F.concat(F.lit("  "), "o_orderpriority").alias("x")))
        .unionByName(customer.select(F.lit("customer").alias("source"), F.concat(F.lower("c_mktsegment"), F.lit(" ")).alias("x")))
    )
    return rows.groupBy("source", FT.pascal_case(c("x")).alias("titled")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "calendar_days",
    "date_key:i full_date:d year:i quarter:i quarter_name:s month:i month_name:s month_short:s week_of_year:i"
    " day_of_month:i day_of_week:i day_name:s is_weekend:i is_holiday:i n_orders:i",
    O.over(
        "clean",
        "SELECT d.*, coalesce(n, 0) AS n_orders FROM dim_date d LEFT JOIN"
        " (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1) ON day = full_date",
    ),
)
def calendar_days(spark, sf):
    orders = A.read_tables(spark, sf, "orders")[0]
    per_day = orders.groupBy(F.to_date("o_orderdate").alias("full_date")).agg(F.count(F.lit(1)).alias("n"))
    empty = calendar(spark, sf).limit(0)
    days = D.build_dim_date(spark, A.order_settings(), empty)
    return days.join(per_day, "full_date", "left").withColumn("n_orders", F.coalesce(c("n"), F.lit(0)))


@query(
    "calendar_months",
    "year_month:s year_month_sort:i is_last_month:i n_requests:i",
    "SELECT strftime(o_orderdate, '%Y-%m') AS year_month, year(o_orderdate) * 100 + month(o_orderdate) AS year_month_sort,"
    " CAST(date_trunc('month', o_orderdate) = (SELECT date_trunc('month', max(o_orderdate)) FROM orders) AS INTEGER) AS is_last_month,"
    " count(*) AS n_requests FROM orders GROUP BY 1, 2, 3",
)
def calendar_months(spark, sf):
    orders = A.read_tables(spark, sf, "orders")[0]
    per_day = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    last = F.max("day").over(S.Window.partitionBy())
    dated = per_day.withColumn("last", last)
    return dated.groupBy(*FD.year_month_columns(c("day"), c("last"))).agg(F.sum("n").alias("n_requests"))


@query(
    "drill_calendar",
    "year:i month_no:i month:s quarter_no:i quarter:s day:i n_lines:i",
    "SELECT year(l_shipdate) AS year, month(l_shipdate) AS month_no, strftime(l_shipdate, '%B') AS month,"
    " quarter(l_shipdate) AS quarter_no, 'Qtr ' || quarter(l_shipdate) AS quarter, day(l_shipdate) AS day,"
    " count(*) AS n_lines FROM lineitem GROUP BY ALL",
)
def drill_calendar(spark, sf):
    lines = A.read_tables(spark, sf, "lineitem")[0].select(F.to_date("l_shipdate").alias("d"))
    return lines.groupBy(*FD.hierarchy_columns(c("d"))).agg(F.count(F.lit(1)).alias("n_lines"))


@query(
    "display_numbers",
    "o_orderkey:i magnitude:s days:s whole:s percent:s shown_day:s",
    f"SELECT o_orderkey, {O.magnitude('o_totalprice * 3')} AS magnitude, {O.dec('o_totalprice / 1000', 2)} || ' Days' AS days,"
    " format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS whole,"
    f" {O.dec('o_totalprice / 500000 * 100', 1)} || '%' AS percent, strftime(o_orderdate, '%b %d, %Y') AS shown_day FROM orders",
)
def display_numbers(spark, sf):
    price = c("o_totalprice")
    return A.read_tables(spark, sf, "orders")[0].select(
        "o_orderkey",
        FT.fmt_magnitude(price * 3).alias("magnitude"),
        FT.fmt_days(price / 1000).alias("days"),
        FT.fmt_thousands(F.floor(price)).alias("whole"),
        FT.fmt_percent(price / 500000).alias("percent"),
        FT.fmt_month_day_year(c("o_orderdate")).alias("shown_day"),
    )


# ---- dimensions and fact ----------------------------------------------------------------------


@query(
    "dim_agency_rows",
    "agency_key:i agency_code:s agency_name:s department:s sla_days:i is_active:i",
    O.over("untidy", "SELECT * FROM dim_agency"),
)
def dim_agency_rows(spark, sf):
    return warehouse(spark, sf, "untidy").table("dim_agency")


@query(
    "dim_location_rows",
    "location_key:i borough:s community_board:s zip_code:s latitude:f longitude:f neighborhood:s",
    O.over("untidy", "SELECT * FROM dim_location"),
)
def dim_location_rows(spark, sf):
    return warehouse(spark, sf, "untidy").table("dim_location")


@query(
    "dim_complaint_rows",
    "complaint_key:i complaint_type:s descriptor:s category:s",
    O.over("untidy", "SELECT * FROM dim_complaint_type"),
)
def dim_complaint_rows(spark, sf):
    return warehouse(spark, sf, "untidy").table("dim_complaint_type")


@query(
    "location_averages",
    "borough:s community_board:s zip_code:s latitude:f longitude:f error_type:s",
    O.over("untidy", "SELECT * FROM judged_locations"),
)
def location_averages(spark, sf):
    wh = warehouse(spark, sf, "untidy")
    return D.staged_locations(wh.staging, wh.settings).withColumn("error_type", D.location_error(wh.settings))


@query(
    "dimension_rejects",
    "error_type:s error_count:i",
    O.over(
        "untidy",
        "SELECT error_type, count(*) AS error_count FROM judged_locations WHERE error_type IS NOT NULL GROUP BY 1"
        " UNION ALL SELECT 'NULL_AGENCY_CODE', count(*) FROM raw WHERE coalesce(trim(agency), '') = ''"
        " UNION ALL SELECT 'NULL_COMPLAINT_TYPE', count(*) FROM raw WHERE coalesce(trim(complaint_type), '') = ''",
    ),
)
def dimension_rejects(spark, sf):
    wh = warehouse(spark, sf, "untidy")
    return D.dim_rejects(wh.staging, wh.settings)


@query(
    "fact_rows",
    "unique_key:s date_key:i agency_key:i location_key:i complaint_key:i created_date:t closed_date:t status:s"
    " resolution_days:i year:i",
    O.over("untidy", "SELECT * FROM fact"),
)
def fact_rows(spark, sf):
    return warehouse(spark, sf, "untidy").fact


_RAW_ERRORS = (
    "unique_key, error_type, agency AS raw_agency, borough AS raw_borough, complaint_type AS raw_complaint,"
    " created_date AS raw_created, closed_date AS raw_closed, latitude AS raw_latitude, longitude AS raw_longitude,"
    " CASE WHEN error_type LIKE 'NO_DIM%' OR error_type LIKE 'DUPLICATE%' THEN norm_status ELSE status END AS raw_status"
)
_MESSAGE = (
    "CASE error_type"
    " WHEN 'NULL_UNIQUE_KEY' THEN 'unique_key is NULL or blank — cannot load to fact table'"
    " WHEN 'CITY_MISSING' THEN 'borough, incident_zip, latitude and longitude present but city is NULL/blank'"
    " WHEN 'INVALID_CREATED_DATE' THEN 'created_date cannot be parsed as DATETIME: [' || coalesce(created_date, 'NULL') || ']'"
    " WHEN 'NEGATIVE_RESOLUTION' THEN 'closed_date [' || closed_date || '] is before created_date [' || created_date || ']'"
    " WHEN 'INVALID_STATUS' THEN 'status value [' || status ||"
    " '] not in allowed list (Open/Closed/Pending/In Progress/Assigned/Unspecified)'"
    " WHEN 'NO_DIM_AGENCY_MATCH' THEN 'agency code [' || coalesce(agency, 'NULL') || '] not found in dim_agency'"
    " WHEN 'NO_DIM_LOCATION_MATCH' THEN 'borough/zip/lat/long combo not found in dim_location'"
    " WHEN 'NO_DIM_COMPLAINT_MATCH' THEN 'complaint_type/descriptor combo not found in dim_complaint_type'"
    " WHEN 'DUPLICATE_IN_BATCH' THEN 'unique_key occurs again in this batch — another row was kept' END AS error_message"
)


@query(
    "load_errors",
    "unique_key:s error_type:s error_message:s raw_agency:s raw_borough:s raw_complaint:s raw_created:s raw_closed:s"
    " raw_latitude:s raw_longitude:s raw_status:s",
    O.over("untidy", f"SELECT {_RAW_ERRORS}, {_MESSAGE} FROM judged WHERE error_type IS NOT NULL"),
)
def load_errors(spark, sf):
    return warehouse(spark, sf, "untidy").table("etl_errors").filter(c("step_name") == T.FACT)


@query(
    "stage_row_counts",
    "outcome:s row_count:i",
    O.over("untidy", "SELECT coalesce(error_type, 'LOADED') AS outcome, count(*) AS row_count FROM judged GROUP BY 1"),
)
def stage_row_counts(spark, sf):
    wh = unloaded(spark, sf, "untidy")
    return FA.stage_counts(FA.resolve(wh.staging, wh.dims(*T.DIMENSIONS[1:]), wh.fact_keys, wh.settings, whole=False))


@query(
    "reload_rejects_loaded_keys",
    "outcome:s row_count:i",
    O.over(
        "untidy",
        "SELECT CASE WHEN row_error IS NULL THEN 'DUPLICATE_UNIQUE_KEY' ELSE row_error END AS outcome,"
        " count(*) AS row_count FROM judged GROUP BY 1",
    ),
)
def reload_rejects_loaded_keys(spark, sf):
    wh = warehouse(spark, sf, "untidy")
    return FA.stage_counts(FA.resolve(wh.staging, wh.dims(*T.DIMENSIONS[1:]), wh.fact_keys, wh.settings, whole=False))


@query(
    "load_error_summary",
    "step_name:s error_type:s error_count:i example_message:s",
    O.over(
        "untidy",
        "SELECT 'fact_service_requests' AS step_name, error_type, count(*) AS error_count, min(error_message) AS example_message"
        f" FROM (SELECT error_type, {_MESSAGE} FROM judged WHERE error_type IS NOT NULL) GROUP BY 2"
        " UNION ALL SELECT 'dim_location', error_type, count(*), min('borough=' || coalesce(borough, 'NULL') || ' zip=' ||"
        " coalesce(zip_code, 'NULL') || ' board=' || coalesce(community_board, 'NULL') || ' avg_lat=' ||"
        " coalesce(CAST(latitude AS VARCHAR), 'NULL') || ' avg_long=' || coalesce(CAST(longitude AS VARCHAR), 'NULL'))"
        " FROM judged_locations WHERE error_type IS NOT NULL GROUP BY 2"
        " UNION ALL SELECT 'dim_agency', 'NULL_AGENCY_CODE', count(*),"
        " 'Agency code is NULL or blank — cannot load to dim_agency' FROM raw"
        " WHERE coalesce(trim(agency), '') = '' HAVING count(*) > 0"
        " UNION ALL SELECT 'dim_complaint_type', 'NULL_COMPLAINT_TYPE', count(*),"
        " 'complaint_type is NULL or blank — cannot load to dim_complaint_type' FROM raw"
        " WHERE coalesce(trim(complaint_type), '') = '' HAVING count(*) > 0",
    ),
)
def load_error_summary(spark, sf):
    return W.error_summary(warehouse(spark, sf, "untidy").table("etl_errors"), BATCH)


@query(
    "load_run_summary",
    "step_number:i step_name:s status:s rows_read:i rows_inserted:i rows_skipped:i rows_rejected:i error_message:s",
    O.over(
        "untidy",
        "SELECT *, 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_message FROM ("
        " SELECT 1 AS step_number, 'dim_date' AS step_name, 0 AS rows_read, count(*) AS rows_inserted,"
        " 0 AS rows_skipped, 0 AS rows_rejected FROM dim_date"
        " UNION ALL SELECT 2, 'dim_agency', count(*), count(*), 0,"
        " (SELECT count(*) FROM raw WHERE coalesce(trim(agency), '') = '') FROM dim_agency"
        " UNION ALL SELECT 3, 'dim_location', count(*), count(*) FILTER (error_type IS NULL), 0,"
        " count(*) FILTER (error_type IS NOT NULL) FROM judged_locations"
        " UNION ALL SELECT 4, 'dim_complaint_type', count(*), count(*), 0,"
        " (SELECT count(*) FROM raw WHERE coalesce(trim(complaint_type), '') = '') FROM dim_complaint_type"
        " UNION ALL SELECT 5, 'fact_service_requests', count(*), count(*) FILTER (error_type IS NULL), 0,"
        " count(*) FILTER (error_type IS NOT NULL) FROM judged)",
    ),
)
def load_run_summary(spark, sf):
    return W.run_summary(warehouse(spark, sf, "untidy").table("etl_log"), BATCH)


_LEGACY = """
legacy_location AS (
  SELECT DISTINCT upper(trim(borough)) AS borough, trim(community_board) AS community_board,
    trim(incident_zip) AS zip_code, trim(city) AS city, TRY_CAST(trim(latitude) AS DECIMAL(9,6)) AS latitude,
    TRY_CAST(trim(longitude) AS DECIMAL(9,6)) AS longitude
  FROM raw WHERE borough IS NOT NULL AND upper(trim(borough)) <> 'UNSPECIFIED'
),
legacy_fact AS (
  SELECT CAST(strftime(p.created, '%Y%m%d') AS INTEGER) AS date_key, trim(coalesce(p.status, 'Unknown')) AS status,
    p.closed AS closed_date, row_number() OVER (PARTITION BY upper(trim(p.unique_key))
      ORDER BY p.created DESC, p.closed DESC NULLS LAST, trim(coalesce(p.status, 'Unknown')) DESC) AS place
  FROM parsed p
  JOIN dim_agency a ON upper(trim(p.agency)) = a.agency_code
  JOIN legacy_location l ON upper(trim(p.borough)) = l.borough
    AND upper(coalesce(trim(p.incident_zip), '')) = upper(coalesce(l.zip_code, ''))
    AND TRY_CAST(trim(p.latitude) AS DECIMAL(9,6)) = l.latitude
    AND TRY_CAST(trim(p.longitude) AS DECIMAL(9,6)) = l.longitude
  JOIN dim_complaint_type t ON upper(trim(p.complaint_type)) = t.complaint_type
    AND upper(trim(p.descriptor)) = upper(trim(t.descriptor))
  WHERE p.unique_key IS NOT NULL AND p.agency IS NOT NULL AND p.borough IS NOT NULL
    AND upper(trim(p.borough)) <> 'UNSPECIFIED' AND p.created IS NOT NULL
    AND coalesce(datediff('day', p.created, p.closed), 0) >= 0
)"""


@query(
    "loose_load",
    "date_key:i status:s n_rows:i n_closed:i",
    O.over(
        "untidy",
        "SELECT date_key, status, count(*) AS n_rows, count(closed_date) AS n_closed FROM legacy_fact WHERE place = 1 GROUP BY 1, 2",
        _LEGACY,
    ),
)
def loose_load(spark, sf):
    """The older load as a whole, in a warehouse of its own; a second run adds nothing."""
    wh = W.create_warehouse(spark, fresh_path(spark, "warehouse-older"), A.order_settings())
    T.load_staging(A.untidy_requests(spark, sf), wh.root, BATCH)
    for number, name in enumerate(W.STEPS[:-1]):
        W.LOADERS[name](wh, number, BATCH)
    W.load_fact(wh, 5, BATCH, strict=False)
    return wh.fact.groupBy("date_key", "status").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("closed_date").alias("n_closed")
    )


# ---- joins ------------------------------------------------------------------------------------


@query(
    "dimension_matches",
    "no_agency:i no_location:i no_complaint:i n_rows:i",
    O.over(
        "untidy",
        "SELECT CAST(agency_key IS NULL AS INTEGER) AS no_agency, CAST(location_key IS NULL AS INTEGER) AS no_location,"
        " CAST(complaint_key IS NULL AS INTEGER) AS no_complaint, count(*) AS n_rows FROM parsed GROUP BY 1, 2, 3",
    ),
)
def dimension_matches(spark, sf):
    wh = unloaded(spark, sf, "untidy")  # the matches need the dimensions, not the fact
    matched = J.attach_dims(wh.staging, wh.dims(*T.DIMENSIONS[1:]))
    return matched.groupBy(
        c("agency_key").isNull().cast("int").alias("no_agency"),
        c("location_key").isNull().cast("int").alias("no_location"),
        c("complaint_key").isNull().cast("int").alias("no_complaint"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "known_and_new_customers",
    "c_mktsegment:s known:i n_customers:i",
    "SELECT c_mktsegment, CAST(c_custkey IN (SELECT o_custkey FROM orders) AS INTEGER) AS known,"
    " count(*) AS n_customers FROM customer GROUP BY 1, 2",
)
def known_and_new_customers(spark, sf):
    customer, orders = A.read_tables(spark, sf, "customer", "orders")
    big = orders.select(c("o_custkey").alias("c_custkey"))

    def counted(rows: DataFrame, known: int) -> DataFrame:
        return rows.groupBy("c_mktsegment", F.lit(known).alias("known")).agg(F.count(F.lit(1)).alias("n_customers"))

    return counted(J.already_loaded(customer, big, ["c_custkey"]), 1).unionByName(
        counted(J.only_new(customer, big, ["c_custkey"]), 0)
    )


@query(
    "requests_by_report_year",
    "report_year:i n_requests:i",
    O.over(
        "clean",
        "SELECT CASE WHEN year BETWEEN 1997 AND 1999 THEN year END AS report_year, count(*) AS n_requests FROM mart GROUP BY 1",
    ),
)
def requests_by_report_year(spark, sf):
    model = PM.report_model(warehouse(spark, sf), A.AS_OF)
    named = model["calendar"].select("full_date", c("year").alias("report_year"))
    return J.attach_calendar(model["requests"], named).groupBy("report_year").agg(F.count(F.lit(1)).alias("n_requests"))


@query(
    "closures_by_quarter",
    "year:i quarter:s n_closed:i",
    O.over(
        "clean",
        "SELECT year(closed_date) AS year, 'Qtr ' || quarter(closed_date) AS quarter, count(*) AS n_closed FROM fact GROUP BY 1, 2",
    ),
)
def closures_by_quarter(spark, sf):
    wh = warehouse(spark, sf)
    first, last = A.FIRST_DAY, "2002-12-31"
    days = S.date_spine(spark, first, last).select("full_date", *FD.hierarchy_columns(c("full_date")))
    rows = wh.fact.select("closed_date")
    return J.attach_calendar(rows, days, "closed_date").groupBy("year", "quarter").agg(F.count(F.lit(1)).alias("n_closed"))


@query(
    "requests_of_top_complaints",
    "complaint_type:s status:s n_requests:i",
    O.over(
        "clean",
        "SELECT complaint_type, status, count(*) AS n_requests FROM mart WHERE complaint_type IN (SELECT complaint_type FROM"
        " (SELECT complaint_type, rank() OVER (ORDER BY count(*) DESC) AS r FROM mart GROUP BY 1) WHERE r <= 15) GROUP BY 1, 2",
    ),
)
def requests_of_top_complaints(spark, sf):
    return R.rows_of_top_complaints(mart(spark, sf)).groupBy("complaint_type", "status").agg(
        F.count(F.lit(1)).alias("n_requests")
    )


# ---- mart, summaries, verification ------------------------------------------------------------

_MART_COLUMNS = (
    "unique_key:s created_date:t closed_date:t status:s resolution_days:i year:i quarter_name:s month:i month_name:s"
    " month_short:s day_name:s is_weekend:i is_holiday:i agency_code:s agency_name:s department:s sla_days:i borough:s"
    " community_board:s zip_code:s latitude:f longitude:f neighborhood:s complaint_type:s descriptor:s category:s"
    " is_sla_breach:i days_open_if_pending:i resolution_bucket:s"
)


@query("service_requests_mart", _MART_COLUMNS, O.over("clean", "SELECT * FROM mart"))
def service_requests_mart(spark, sf):
    return mart(spark, sf)


_BREACHES = "count(*) FILTER (resolution_days > sla_days)"


@query(
    "agency_summary",
    "agency_code:s agency_name:s sla_days:i year:i month:i month_name:s total_requests:i total_closed:i total_open:i"
    " avg_resolution_days:f max_resolution_days:i sla_breaches:i sla_breach_pct:f",
    O.over(
        "untidy",
        "SELECT agency_code, agency_name, sla_days, year, month, month_name, count(*) AS total_requests,"
        f" {O.CLOSED} AS total_closed, {O.OPEN} AS total_open, avg(resolution_days) AS avg_resolution_days,"
        f" max(resolution_days) AS max_resolution_days, {_BREACHES} AS sla_breaches,"
        f" {O.pct(_BREACHES, O.CLOSED)} AS sla_breach_pct FROM mart GROUP BY 1, 2, 3, 4, 5, 6",
    ),
)
def agency_summary(spark, sf):
    return PM.agency_summary(warehouse(spark, sf, "untidy"))


@query(
    "borough_summary",
    "borough:s year:i month:i category:s total_requests:i total_closed:i avg_resolution_days:f sla_breaches:i",
    O.over(
        "clean",
        f"SELECT borough, year, month, category, count(*) AS total_requests, {O.CLOSED} AS total_closed,"
        f" avg(resolution_days) AS avg_resolution_days, {_BREACHES} AS sla_breaches FROM mart GROUP BY 1, 2, 3, 4",
    ),
)
def borough_summary(spark, sf):
    return PM.borough_summary(warehouse(spark, sf))


_PROFILE = (
    "total_rows:i null_keys:i null_agency:i null_borough:i null_dates:i distinct_agencies:i distinct_boroughs:i"
    " distinct_complaints:i"
)
_PROFILED = (
    "SELECT count(*) AS total_rows, count(*) FILTER (unique_key IS NULL) AS null_keys,"
    " count(*) FILTER (agency IS NULL) AS null_agency, count(*) FILTER (borough IS NULL) AS null_borough,"
    " count(*) FILTER (created_date IS NULL) AS null_dates, count(DISTINCT agency) AS distinct_agencies,"
    " count(DISTINCT borough) AS distinct_boroughs, count(DISTINCT complaint_type) AS distinct_complaints FROM raw"
)


@query("staging_profile", _PROFILE, O.over("untidy", _PROFILED))
def staging_profile(spark, sf):
    return V.staging_profile(untidy(spark, sf))


@query("profile_of_stored_loads", _PROFILE, O.over("untidy", _PROFILED))
def profile_of_stored_loads(spark, sf):
    """Three loads, each profiled when it has landed; the whole is put together from what is stored of each."""
    wh = new_warehouse(spark, "profiles")
    rows = A.untidy_requests(spark, sf)
    for n in range(3):
        T.load_staging(rows.filter(F.pmod(F.hash("unique_key"), F.lit(3)) == n), wh.root, BATCH, refresh=False)
        assert PP.refresh_profiles(wh) == 1
    return PP.stored_profile(wh)


@query(
    "row_counts",
    "table_name:s total_rows:i processed:i pending:i",
    O.over(
        "untidy",
        "SELECT 'raw_requests' AS table_name, count(*) AS total_rows, count(*) AS processed, 0 AS pending FROM raw"
        " UNION ALL SELECT 'dim_date', count(*), NULL, NULL FROM dim_date"
        " UNION ALL SELECT 'dim_agency', count(*), NULL, NULL FROM dim_agency"
        " UNION ALL SELECT 'dim_location', count(*), NULL, NULL FROM dim_location"
        " UNION ALL SELECT 'dim_complaint_type', count(*), NULL, NULL FROM dim_complaint_type"
        " UNION ALL SELECT 'fact_service_requests', count(*), NULL, NULL FROM fact",
    ),
)
def row_counts(spark, sf):
    return V.row_counts(warehouse(spark, sf, "untidy"))


@query(
    "fact_profile",
    "total_rows:i open_cases:i closed_cases:i negative_days:i over_365_days:i earliest_date:t latest_date:t"
    " avg_resolution_days:f",
    O.over(
        "untidy",
        "SELECT count(*) AS total_rows, count(*) FILTER (closed_date IS NULL) AS open_cases,"
        " count(closed_date) AS closed_cases, count(*) FILTER (resolution_days < 0) AS negative_days,"
        " count(*) FILTER (resolution_days > 365) AS over_365_days, min(created_date) AS earliest_date,"
        " max(created_date) AS latest_date, avg(resolution_days) AS avg_resolution_days FROM fact",
    ),
)
def fact_profile(spark, sf):
    return V.fact_profile(warehouse(spark, sf, "untidy").fact)


@query(
    "top_complaints",
    "complaint_type:s category:s agency_code:s total_requests:i pct_of_total:f avg_days:f",
    O.over(
        "clean",
        f"SELECT complaint_type, category, agency_code, count(*) AS total_requests,"
        f" {O.pct('count(*)', 'CAST(sum(count(*)) OVER () AS BIGINT)', 2)} AS pct_of_total, avg(resolution_days) AS avg_days"
        " FROM mart GROUP BY 1, 2, 3 ORDER BY total_requests DESC, complaint_type, agency_code LIMIT 10",
    ),
)
def top_complaints(spark, sf):
    return V.top_complaints(warehouse(spark, sf))


@query(
    "borough_volume",
    "borough:s total_requests:i closed:i open:i avg_resolution_days:f",
    O.over(
        "untidy",
        f'SELECT borough, count(*) AS total_requests, {O.CLOSED} AS closed, {O.OPEN} AS "open",'
        " avg(resolution_days) AS avg_resolution_days FROM mart GROUP BY 1",
    ),
)
def borough_volume(spark, sf):
    return V.borough_volume(warehouse(spark, sf, "untidy"))


@query(
    "agency_sla_performance",
    "agency_code:s sla_threshold:i total_closed:i avg_days:f sla_breaches:i breach_pct:f",
    O.over(
        "clean",
        "SELECT agency_code, sla_days AS sla_threshold, count(*) AS total_closed, avg(resolution_days) AS avg_days,"
        f" {_BREACHES} AS sla_breaches, {O.pct(_BREACHES, 'count(*)')} AS breach_pct"
        " FROM mart WHERE status = 'Closed' GROUP BY 1, 2",
    ),
)
def agency_sla_performance(spark, sf):
    return V.agency_sla_performance(warehouse(spark, sf))


@query(
    "monthly_trend",
    "month:i month_short:s request_count:i closed_count:i closure_rate_pct:f",
    O.over(
        "clean",
        f"SELECT month, month_short, count(*) AS request_count, {O.CLOSED} AS closed_count,"
        f" {O.pct(O.CLOSED, 'count(*)')} AS closure_rate_pct FROM mart WHERE year = 1998 GROUP BY 1, 2",
    ),
)
def monthly_trend(spark, sf):
    return V.monthly_trend(warehouse(spark, sf), 1998)


@query(
    "newest_requests",
    "year:i month_name:s agency_code:s borough:s complaint_type:s category:s status:s resolution_days:i is_sla_breach:i"
    " unique_key:s",
    O.over("clean", "SELECT * FROM mart ORDER BY created_date DESC, unique_key LIMIT 5"),
)
def newest_requests(spark, sf):
    return V.newest_requests(mart(spark, sf))


# ---- data quality -----------------------------------------------------------------------------


@query(
    "repeated_request_keys",
    "unique_key:s n_rows:i",
    O.over("untidy", "SELECT upper(trim(unique_key)) AS unique_key, count(*) AS n_rows FROM raw GROUP BY 1 HAVING count(*) > 1"),
)
def repeated_request_keys(spark, sf):
    return V.repeated_members(untidy(spark, sf), ["unique_key"])


@query(
    "unique_members",
    "check_name:s violations:i",
    O.over(
        "untidy",
        "SELECT 'dim_date(date_key)' AS check_name, count(*) - count(DISTINCT date_key) AS violations FROM dim_date"
        " UNION ALL SELECT 'dim_agency(agency_code)', count(*) - count(DISTINCT agency_code) FROM dim_agency"
        " UNION ALL SELECT 'dim_complaint_type(complaint_type, descriptor)',"
        " count(*) - count(DISTINCT (complaint_type, descriptor)) FROM dim_complaint_type"
        " UNION ALL SELECT 'dim_location(borough, zip_code, community_board)',"
        " count(*) - count(DISTINCT (borough, zip_code, community_board)) FROM dim_location"
        " UNION ALL SELECT 'fact_service_requests(unique_key)', count(*) - count(DISTINCT upper(trim(unique_key))) FROM fact",
    ),
)
def unique_members(spark, sf):
    return V.uniqueness(warehouse(spark, sf, "untidy"))


@query(
    "orphan_rows",
    "check_name:s violations:i",
    O.over(
        "untidy",
        "SELECT 'fact.date_key' AS check_name, count(*) AS violations FROM fact WHERE date_key NOT IN (SELECT date_key FROM dim_date)"
        " UNION ALL SELECT 'fact.agency_key', count(*) FROM fact WHERE agency_key NOT IN (SELECT agency_key FROM dim_agency)"
        " UNION ALL SELECT 'fact.location_key', count(*) FROM fact WHERE location_key NOT IN (SELECT location_key FROM dim_location)"
        " UNION ALL SELECT 'fact.complaint_key', count(*) FROM fact WHERE complaint_key NOT IN (SELECT complaint_key FROM dim_complaint_type)"
        " UNION ALL SELECT 'errors.log_id', 0",
    ),
)
def orphan_rows(spark, sf):
    return V.orphan_counts(warehouse(spark, sf, "untidy"))


@query(
    "orphan_lines",
    "status:s n_lines:i",
    O.over(
        "untidy",
        "SELECT norm_status AS status, count(*) AS n_lines FROM parsed WHERE NOT EXISTS"
        " (SELECT 1 FROM fact WHERE upper(trim(fact.unique_key)) = upper(trim(parsed.unique_key))) GROUP BY 1",
    ),
)
def orphan_lines(spark, sf):
    """Staged requests, repeated and unreadable ones included, whose key never reached the fact."""
    wh = warehouse(spark, sf, "untidy")
    lines = FA.parsed(wh.staging).withColumn("key", FT.norm_key(c("unique_key")))
    kept = wh.fact.select(FT.norm_key(c("unique_key")).alias("key"))
    return V.orphans(lines, kept, "key").groupBy(c("norm_status").alias("status")).agg(F.count(F.lit(1)).alias("n_lines"))


@query(
    "rule_violations",
    "check_name:s violations:i",
    O.over(
        "untidy",
        "SELECT 'negative_resolution_days' AS check_name, count(*) FILTER (datediff('day', created, closed) < 0) AS violations"
        " FROM parsed UNION ALL SELECT 'status_not_allowed',"
        " count(*) FILTER (norm_status NOT IN ('Open', 'Closed', 'Pending', 'In Progress', 'Unspecified', 'Assigned')) FROM parsed",
    ),
)
def rule_violations(spark, sf):
    rows = FA.parsed(untidy(spark, sf))
    checked = rows.select(
        c("norm_status").alias("status"), FD.resolution_days(c("created"), c("closed")).alias("resolution_days")
    )
    return V.count_violations(checked, V.check_rules())


@query(
    "missing_values",
    "check_name:s violations:i",
    O.over(
        "untidy",
        " UNION ALL ".join(
            f"SELECT '{n}_is_null' AS check_name, count(*) FILTER ({n} IS NULL) AS violations FROM raw"
            for n in ["unique_key", "created_date", "agency", "borough", "complaint_type", "status"]
        ),
    ),
)
def missing_values(spark, sf):
    names = ["unique_key", "created_date", "agency", "borough", "complaint_type", "status"]
    return V.count_violations(untidy(spark, sf), V.not_null_rules(names))


TWIN_REQUIRED = {
    "dim_date": "date_key full_date year quarter quarter_name month month_name month_short week_of_year day_of_month"
    " day_of_week day_name is_weekend is_holiday",
    "dim_agency": "agency_key agency_code agency_name sla_days is_active", "dim_location": "location_key borough",
    "dim_complaint_type": "complaint_key complaint_type category",
    "fact_service_requests": "request_key unique_key date_key agency_key location_key complaint_key created_date status"
    " dw_created_date",
}


@query(
    "required_values",
    "check_name:s violations:i",
    O.over(
        "untidy",
        " UNION ALL ".join(
            f"SELECT '{t}.{n}_is_null' AS check_name, count(*) FILTER ({source} IS NULL) AS violations"
            f" FROM {'fact' if t == T.FACT else t}"
            for t, names in TWIN_REQUIRED.items()
            for n in names.split()
            for source in ["unique_key" if n in ("request_key", "dw_created_date") else n]
        ),
    ),
)
def required_values(spark, sf):
    return V.required_values(warehouse(spark, sf, "untidy"))


@query(
    "calendar_gaps",
    "full_date:d next_date:d missing_days:i",
    "SELECT day AS full_date, next_date, datediff('day', day, next_date) - 1 AS missing_days FROM ("
    " SELECT day, lead(day) OVER (ORDER BY day) AS next_date FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders"
    " UNION SELECT CAST(ts AS DATE) FROM events)) WHERE datediff('day', day, next_date) > 1",
)
def calendar_gaps(spark, sf):
    """Days without an order or an event between days that have one."""
    orders, events = A.read_tables(spark, sf, "orders", "events")
    days = orders.select(F.to_date("o_orderdate").alias("full_date")).union(events.select(F.to_date("ts")))
    return V.calendar_gaps(days.distinct())


# ---- measures ---------------------------------------------------------------------------------

_ALL = list(O.MEASURES)
_COUNTS = {
    "closure_rate", "sla_breach_rate", "sla_breach_rate_open", "avg_resolution_days", "avg_days_open",
    "stale_over_90_rate", "avg_days_waiting_vs_sla",
}
_MEASURE_COLUMNS = " ".join(f"{m}:{'f' if m in _COUNTS else 'i'}" for m in _ALL)


@query(
    "measures_by_agency_year",
    f"agency_code:s year:i {_MEASURE_COLUMNS}",
    O.over("untidy", f"SELECT agency_code, year, {O.measure_list(_ALL)} FROM mart GROUP BY 1, 2"),
)
def measures_by_agency_year(spark, sf):
    return M.measures(mart(spark, sf, "untidy"), _ALL, ["agency_code", "year"])


@query(
    "measures_overall",
    _MEASURE_COLUMNS,
    O.over("clean", f"SELECT {O.measure_list(_ALL)} FROM mart"),
)
def measures_overall(spark, sf):
    return M.measures(mart(spark, sf), _ALL)


@query(
    "measures_under_status_filter",
    "borough:s total_requests:i total_closed:i total_open:i closure_rate:f avg_resolution_days:f stale_over_90:i",
    O.over(
        "clean",
        "SELECT borough, nullif(count(*) FILTER (status = 'Open'), 0) AS total_requests,"
        f" {O.MEASURES['total_closed']} AS total_closed, {O.MEASURES['total_open']} AS total_open,"
        f" nullif({O.CLOSED}, 0) / CAST(nullif(count(*) FILTER (status = 'Open'), 0) AS DOUBLE) AS closure_rate,"
        f" avg(resolution_days) FILTER ({O.RES} AND status = 'Open') AS avg_resolution_days,"
        f" {O.MEASURES['stale_over_90']} AS stale_over_90 FROM mart WHERE category = 'Rings' GROUP BY 1",
    ),
)
def measures_under_status_filter(spark, sf):
    names = ["total_requests", "total_closed", "total_open", "closure_rate", "avg_resolution_days", "stale_over_90"]
    return M.measures(mart(spark, sf), names, ["borough"], {"status": "Open", "category": "Rings"})


@query(
    "measures_by_status",
    "category:s status:s total_requests:i total_closed:i closure_rate:f oldest_open_case:i",
    O.over(
        "clean",
        "SELECT category, status, count(*) AS total_requests, any_value(total_closed) AS total_closed,"
        " any_value(total_closed) / CAST(count(*) AS DOUBLE) AS closure_rate,"
        f" any_value(oldest_open_case) AS oldest_open_case FROM mart JOIN (SELECT category, {O.MEASURES['total_closed']} AS total_closed,"
        f" {O.MEASURES['oldest_open_case']} AS oldest_open_case FROM mart GROUP BY 1) USING (category) GROUP BY 1, 2",
    ),
)
def measures_by_status(spark, sf):
    names = ["total_requests", "total_closed", "closure_rate", "oldest_open_case"]
    return M.measures(mart(spark, sf), names, ["category", "status"])


_BY_YEAR = (
    f"per_year AS (SELECT year, count(*) AS n, {O.MEASURES['closure_rate']} AS rate,"
    f" {O.MEASURES['avg_resolution_days']} AS days FROM mart GROUP BY 1)"
)
_UP, _DOWN = "⮝ ", "⮟ "


@query(
    "year_comparison",
    "year:i total_requests:i total_requests_ly:i closure_rate:f closure_rate_ly:f avg_resolution_days:f"
    " avg_resolution_days_ly:f requests_yoy:f requests_vs_ly_color:s requests_yoy_color:s kpi_color_yoy:s"
    " closure_rate_vs_ly:s closure_rate_vs_ly_color:s avg_days_vs_ly:s avg_days_vs_ly_color:s",
    O.over(
        "clean",
        "SELECT year, n AS total_requests, ly_n AS total_requests_ly, rate AS closure_rate, ly_rate AS closure_rate_ly,"
        " days AS avg_resolution_days, ly_days AS avg_resolution_days_ly, yoy AS requests_yoy,"
        " CASE WHEN yoy > 0 THEN 'Green' WHEN yoy < 0 THEN 'Red' ELSE 'Grey' END AS requests_vs_ly_color,"
        " CASE WHEN yoy > 0 THEN 'Red' WHEN yoy < 0 THEN 'Green' ELSE 'Grey' END AS requests_yoy_color,"
        " CASE WHEN yoy IS NULL THEN '#64748b' WHEN yoy >= 0 THEN '#ef4444' ELSE '#f59e0b' END AS kpi_color_yoy,"
        f" CASE WHEN rc > 0 THEN '{_UP}' WHEN rc < 0 THEN '{_DOWN}' ELSE '' END || coalesce({O.dec('abs(rc) * 100', 1)} || '%', '')"
        " AS closure_rate_vs_ly,"
        " CASE WHEN rc > 0 THEN 'Green' WHEN rc < 0 THEN 'Red' ELSE 'Grey' END AS closure_rate_vs_ly_color,"
        f" CASE WHEN dc > 0 THEN '{_UP}' WHEN dc < 0 THEN '{_DOWN}' ELSE '' END || coalesce({O.dec('abs(dc)', 2)}, '') || ' Days'"
        " AS avg_days_vs_ly,"
        " CASE WHEN dc > 0 THEN 'Red' WHEN dc < 0 THEN 'Green' ELSE 'Grey' END AS avg_days_vs_ly_color FROM ("
        " SELECT a.*, b.n AS ly_n, b.rate AS ly_rate, b.days AS ly_days, (a.n - b.n) / CAST(b.n AS DOUBLE) AS yoy,"
        " (a.rate - b.rate) / b.rate AS rc, coalesce(a.days, 0) - coalesce(b.days, 0) AS dc"
        " FROM per_year a LEFT JOIN per_year b ON b.year = a.year - 1)",
        _BY_YEAR,
    ),
)
def year_comparison(spark, sf):
    return R.year_comparison(mart(spark, sf), calendar(spark, sf))


@query(
    "year_comparison_by_borough",
    "year:i borough:s total_requests:i total_requests_ly:i requests_yoy:f",
    O.over(
        "untidy",
        "SELECT year, borough, a.n AS total_requests, b.n AS total_requests_ly,"
        " (coalesce(a.n, 0) - b.n) / CAST(b.n AS DOUBLE) AS requests_yoy"
        " FROM g a FULL JOIN (SELECT year + 1 AS year, borough, n FROM g WHERE year < 2001) b USING (year, borough)",
        "g AS (SELECT year, borough, count(*) AS n FROM mart GROUP BY 1, 2)",
    ),
)
def year_comparison_by_borough(spark, sf):
    return R.year_comparison(mart(spark, sf, "untidy"), calendar(spark, sf), ["borough"])


@query(
    "yoy_by_month",
    "month:i month_short:s total_requests:i total_requests_ly:i requests_yoy:f",
    O.over(
        "clean",
        "SELECT month, month_short, n AS total_requests, ly AS total_requests_ly, (n - ly) / CAST(ly AS DOUBLE) AS requests_yoy"
        " FROM (SELECT month, month_short, nullif(count(*) FILTER (year = 1997), 0) AS n,"
        " nullif(count(*) FILTER (year = 1996), 0) AS ly FROM mart WHERE year IN (1996, 1997) GROUP BY 1, 2)",
    ),
)
def yoy_by_month(spark, sf):
    return R.yoy_by_month(mart(spark, sf), calendar(spark, sf), where_date={"year": 1997})


_DAILY = """
per_day AS (
  SELECT full_date, d.year, d.month, coalesce(n, 0) AS n FROM dim_date d
  LEFT JOIN (SELECT CAST(created_date AS DATE) AS day, count(*) AS n FROM mart GROUP BY 1) ON day = full_date
),
running AS (
  SELECT full_date, n, sum(n) OVER (PARTITION BY year, month ORDER BY full_date) AS mtd,
    sum(n) OVER (PARTITION BY year ORDER BY full_date) AS ytd FROM per_day
)"""


@query(
    "running_totals",
    "full_date:d total_requests:i total_requests_mtd:i total_requests_ytd:i total_requests_mtd_ly:i",
    O.over(
        "clean",
        "SELECT * FROM (SELECT a.full_date, nullif(a.n, 0) AS total_requests, nullif(a.mtd, 0) AS total_requests_mtd,"
        " nullif(a.ytd, 0) AS total_requests_ytd, nullif(b.mtd, 0) AS total_requests_mtd_ly FROM running a"
        " LEFT JOIN running b ON b.full_date = CAST(a.full_date - INTERVAL 1 YEAR AS DATE))"
        " WHERE coalesce(total_requests, total_requests_mtd, total_requests_ytd, total_requests_mtd_ly) IS NOT NULL",
        _DAILY,
    ),
)
def running_totals(spark, sf):
    return R.running_totals(mart(spark, sf), calendar(spark, sf))


@query(
    "to_date_cards",
    "total_requests_mtd:i total_requests_ytd:i",
    O.over(
        "clean",
        "SELECT nullif(count(*) FILTER (year = 2000 AND month = 5), 0) AS total_requests_mtd,"
        " nullif(count(*) FILTER (year = 2000 AND month <= 5), 0) AS total_requests_ytd FROM mart WHERE borough = 'ASIA'",
    ),
)
def to_date_cards(spark, sf):
    days = c("month").between(2, 5)
    return R.to_date_cards(mart(spark, sf), calendar(spark, sf), {"borough": "ASIA"}, {"year": 2000, "month": days})


@query(
    "daily_in_december",
    "day_of_month:i total_requests:i",
    O.over(
        "clean",
        "SELECT day(created_date) AS day_of_month, count(*) AS total_requests FROM mart WHERE month = 12 AND year = 1999 GROUP BY 1",
    ),
)
def daily_in_december(spark, sf):
    return R.daily_in_month(mart(spark, sf), calendar(spark, sf), "December", {"year": 1999})


@query(
    "vs_citywide",
    "agency_code:s borough:s avg_resolution_days:f vs_citywide_avg:f",
    O.over(
        "clean",
        f"SELECT agency_code, borough, avg(resolution_days) FILTER ({O.RES}) AS avg_resolution_days,"
        f" avg(resolution_days) FILTER ({O.RES}) - any_value(whole) AS vs_citywide_avg FROM mart JOIN"
        f" (SELECT agency_code, avg(resolution_days) FILTER ({O.RES}) AS whole FROM mart GROUP BY 1) USING (agency_code)"
        " GROUP BY 1, 2",
    ),
)
def vs_citywide(spark, sf):
    return M.vs_citywide(mart(spark, sf), ["agency_code", "borough"])


_OLDEST = (
    "SELECT {by} max(days_open_if_pending) AS days_open_if_pending, min(created_date) AS created_date,"
    " min(agency_name) AS department, min(agency_code) AS agency_code, min(complaint_type) AS complaint_type FROM mart"
    " WHERE status <> 'Closed' AND days_open_if_pending = {top} {group}"
)


@query(
    "oldest_case_by_borough",
    "borough:s days_open_if_pending:i created_date:t department:s agency_code:s complaint_type:s summary:s",
    O.over(
        "clean",
        "SELECT *, agency_code || ' | ' || complaint_type || ' | ' || strftime(created_date, '%b %d, %Y') AS summary FROM ("
        + _OLDEST.format(
            by="borough,",
            top="(SELECT max(days_open_if_pending) FROM mart m WHERE m.borough = mart.borough AND m.status <> 'Closed')",
            group="GROUP BY 1",
        )
        + ")",
    ),
)
def oldest_case_by_borough(spark, sf):
    return M.oldest_case(mart(spark, sf), ["borough"])


@query(
    "display_measures",
    "borough:s total_requests_display:s total_requests_full:s total_closed_display:s total_open_display:s"
    " avg_resolution_display:s avg_open_days_display:s oldest_open_display:s waiting_label:s breach_text:s"
    " sla_breach_color:s avg_days_color:s avg_resolution_color:s borough_sla_color:s borough_open_color:s agency_open_color:s",
    O.over(
        "clean",
        f"SELECT borough, {O.magnitude('n')} AS total_requests_display, format('{{:,}}', n) AS total_requests_full,"
        f" {O.magnitude('closed')} AS total_closed_display, {O.magnitude('open_n')} AS total_open_display,"
        f" {O.dec('days', 2)} || ' Days' AS avg_resolution_display, {O.dec('age', 2)} || ' Days' AS avg_open_days_display,"
        f" {O.dec('oldest', 0)} || ' Days' AS oldest_open_display,"
        f" CASE WHEN age - sla > 0 THEN '+' || {O.dec('age - sla', 0)} || ' days over SLA target'"
        f" ELSE {O.dec('age - sla', 0)} || ' days under SLA target' END AS waiting_label,"
        " CASE WHEN rate >= 0.2 THEN 'Above 20% threshold' WHEN rate >= 0.1 THEN 'Above 10% threshold'"
        " ELSE 'Below 10% threshold' END AS breach_text,"
        " CASE WHEN rate IS NULL THEN '#64748b' WHEN rate >= 0.5 THEN '#ef4444' WHEN rate >= 0.1 THEN '#f59e0b'"
        " ELSE '#10b981' END AS sla_breach_color,"
        " CASE WHEN days IS NULL THEN '#64748b' WHEN days <= 3 THEN '#059669' WHEN days <= 6 THEN '#10b981'"
        " WHEN days <= 10 THEN '#6ee7b7' WHEN days <= 15 THEN '#fcd34d' WHEN days <= 20 THEN '#f59e0b'"
        " WHEN days <= 30 THEN '#f97316' ELSE '#ef4444' END AS avg_days_color,"
        " CASE WHEN coalesce(days, 0) <= 15 THEN '#9FE1CB' WHEN days <= 30 THEN '#FAC775' ELSE '#F09595' END AS avg_resolution_color,"
        " CASE WHEN coalesce(rate, 0) <= 0.1 THEN '#9FE1CB' WHEN rate <= 0.2 THEN '#FAC775' ELSE '#F09595' END AS borough_sla_color,"
        " CASE WHEN open_n <= 5000 THEN '#9FE1CB' WHEN open_n <= 10000 THEN '#FAC775' ELSE '#F09595' END AS borough_open_color,"
        " CASE WHEN open_n >= 20000 THEN '#F09595' WHEN open_n >= 10000 THEN '#FAC775' ELSE '#9FE1CB' END AS agency_open_color"
        f" FROM (SELECT borough, count(*) AS n, {O.CLOSED} AS closed, {O.OPEN} AS open_n,"
        f" {O.MEASURES['avg_resolution_days']} AS days, {O.MEASURES['avg_days_open']} AS age, avg(sla_days) AS sla,"
        f" {O.MEASURES['oldest_open_case']} AS oldest, {O.MEASURES['sla_breach_rate']} AS rate FROM mart GROUP BY 1)",
    ),
)
def display_measures(spark, sf):
    names = [
        "total_requests", "total_closed", "total_open", "avg_resolution_days", "avg_days_open", "oldest_open_case",
        "sla_breach_rate", "avg_days_waiting_vs_sla",
    ]
    out = M.measures(mart(spark, sf), names, ["borough"])
    return out.select(
        "borough", *M.display_columns(),
        M.waiting_label(c("avg_days_waiting_vs_sla")).alias("waiting_label"),
        M.sla_breach_text(c("sla_breach_rate")).alias("breach_text"),
        *M.color_columns(),
    )


@query(
    "report_titles",
    "dynamic_title:s open_trend_label:s sparkline_title:s mtd_label:s mtd_sparkline_title:s",
    O.over(
        "clean",
        "SELECT 'Service requests — ' || (SELECT CASE WHEN count(DISTINCT borough) = 1 THEN any_value(borough)"
        " ELSE 'Multiple Boroughs' END FROM mart WHERE borough IN ('ASIA', 'EUROPE')) || ' | ' || max(year) AS dynamic_title,"
        " 'Open Cases — ' || max(year) AS open_trend_label, CAST(max(year) AS VARCHAR) AS sparkline_title,"
        " strftime(max(full_date), '%b %Y') AS mtd_label, strftime(max(full_date), '%b %Y') AS mtd_sparkline_title"
        " FROM dim_date WHERE year = 1999",
    ),
)
def report_titles(spark, sf):
    return M.titles(mart(spark, sf), calendar(spark, sf), {"borough": ["ASIA", "EUROPE"]}, {"year": 1999})


@query(
    "last_month_flags",
    "year:i month:i is_last_month:i sparkline_bar_color:s n_requests:i",
    O.over(
        "clean",
        "SELECT year, month, CAST(year = 2001 AND month = 12 AS INTEGER) AS is_last_month,"
        " CASE WHEN month = 12 THEN '#0C447C' ELSE '#185FA5' END AS sparkline_bar_color, count(unique_key) AS n_requests"
        " FROM (SELECT DISTINCT year, month FROM dim_date) LEFT JOIN mart USING (year, month) GROUP BY 1, 2",
    ),
)
def last_month_flags(spark, sf):
    flags = M.last_month_flags(calendar(spark, sf), ["year", "month"])
    counts = M.measures(mart(spark, sf), ["total_requests"], ["year", "month"])
    return flags.join(counts, ["year", "month"], "left").withColumn(
        "n_requests", F.coalesce(c("total_requests"), F.lit(0))
    )


# ---- report pages -----------------------------------------------------------------------------


@query(
    "borough_share",
    "borough:s total_requests:i pct_of_total:f",
    O.over(
        "clean",
        f"SELECT borough, count(*) AS total_requests, {O.pct('count(*)', 'CAST(sum(count(*)) OVER () AS BIGINT)', 2)} AS pct_of_total"
        " FROM mart WHERE year = 1998 GROUP BY 1",
    ),
)
def borough_share(spark, sf):
    return R.borough_share(mart(spark, sf), {"year": 1998})


@query(
    "requests_by_month",
    "month:i month_short:s total_requests:i",
    O.over("clean", "SELECT month, month_short, count(*) AS total_requests FROM mart WHERE year = 1998 GROUP BY 1, 2"),
)
def requests_by_month(spark, sf):
    return R.requests_by_month(mart(spark, sf), {"year": 1998})


@query(
    "month_by_year",
    "month:i month_short:s " + " ".join(f"{y}:i" for y in YEARS),
    O.over(
        "clean",
        "SELECT month, month_short, "
        + ", ".join(f'nullif(count(*) FILTER (year = {y}), 0) AS "{y}"' for y in YEARS)
        + " FROM mart WHERE borough = 'AFRICA' GROUP BY 1, 2",
    ),
)
def month_by_year(spark, sf):
    return R.month_by_year(mart(spark, sf), YEARS, {"year": 1998, "borough": "AFRICA"})


@query(
    "agency_matrix",
    "agency_name:s is_total:i total_requests:i avg_resolution_days:f",
    O.over(
        "clean",
        f"SELECT agency_name, 0 AS is_total, count(*) AS total_requests, {O.MEASURES['avg_resolution_days']} AS avg_resolution_days"
        " FROM mart WHERE year = 1998 GROUP BY 1 UNION ALL SELECT 'Total', 1, count(*),"
        f" {O.MEASURES['avg_resolution_days']} FROM mart WHERE year = 1998",
    ),
)
def agency_matrix(spark, sf):
    return R.agency_matrix(mart(spark, sf), {"year": 1998})


_BUCKET_SORT = (
    "CASE resolution_bucket WHEN 'Same Day' THEN 1 WHEN '1-3 Days' THEN 2 WHEN '4-7 Days' THEN 3 WHEN '8-30 Days' THEN 4"
    " WHEN 'Over 30 Days' THEN 5 WHEN 'Open' THEN 6 ELSE 99 END"
)


@query(
    "resolution_buckets",
    "resolution_bucket:s bucket_sort:i total_requests:i",
    O.over("clean", f"SELECT resolution_bucket, {_BUCKET_SORT} AS bucket_sort, count(*) AS total_requests FROM mart GROUP BY 1"),
)
def resolution_buckets(spark, sf):
    return R.resolution_buckets(mart(spark, sf))


@query(
    "breach_rate_by_agency",
    "agency_code:s sla_breach_rate:f sla_breaches:i total_closed:i breach_text:s",
    O.over(
        "untidy",
        "SELECT *, CASE WHEN sla_breach_rate >= 0.2 THEN 'Above 20% threshold' WHEN sla_breach_rate >= 0.1"
        " THEN 'Above 10% threshold' ELSE 'Below 10% threshold' END AS breach_text FROM (SELECT agency_code,"
        f" {O.measure_list(['sla_breach_rate', 'sla_breaches', 'total_closed'])} FROM mart GROUP BY 1)",
    ),
)
def breach_rate_by_agency(spark, sf):
    return R.breach_rate_by_agency(mart(spark, sf, "untidy"))


@query(
    "breach_labels",
    "is_sla_breach:i breach_label:s total_requests:i",
    O.over(
        "clean",
        "SELECT is_sla_breach, CASE is_sla_breach WHEN 1 THEN 'SLA Breached' ELSE 'Within SLA' END AS breach_label,"
        " count(*) AS total_requests FROM mart GROUP BY 1",
    ),
)
def breach_labels(spark, sf):
    return R.breach_labels(mart(spark, sf))


@query(
    "borough_map",
    "borough:s total_requests:i",
    O.over("untidy", "SELECT borough, count(*) AS total_requests FROM mart WHERE category = 'Fixings' GROUP BY 1"),
)
def borough_map(spark, sf):
    return R.borough_map(mart(spark, sf, "untidy"), {"category": "Fixings"})


@query(
    "top_zips",
    "zip_code:s total_requests:i first_borough:s rank:i",
    O.over(
        "clean",
        "SELECT * FROM (SELECT zip_code, count(*) AS total_requests, min(borough) AS first_borough,"
        " rank() OVER (ORDER BY count(*) DESC) AS rank FROM mart GROUP BY 1) WHERE rank <= 20",
    ),
)
def top_zips(spark, sf):
    return R.top_zips(mart(spark, sf))


@query(
    "weekend_split",
    "is_weekend:i total_requests:i",
    O.over("clean", "SELECT is_weekend, count(*) AS total_requests FROM mart WHERE year = 1998 GROUP BY 1"),
)
def weekend_split(spark, sf):
    return R.weekend_split(mart(spark, sf), {"year": 1998})


@query(
    "borough_table",
    "borough:s requests:s closed:s open:s sla_breach_rate:f borough_sla_color:s borough_open_color:s",
    O.over(
        "clean",
        f"SELECT borough, {O.magnitude('n')} AS requests, {O.magnitude('k')} AS closed, {O.magnitude('m')} AS \"open\","
        " rate AS sla_breach_rate, CASE WHEN coalesce(rate, 0) <= 0.1 THEN '#9FE1CB' WHEN rate <= 0.2 THEN '#FAC775'"
        " ELSE '#F09595' END AS borough_sla_color, CASE WHEN m <= 5000 THEN '#9FE1CB' WHEN m <= 10000 THEN '#FAC775'"
        f" ELSE '#F09595' END AS borough_open_color FROM (SELECT borough, count(*) AS n, {O.CLOSED} AS k, {O.OPEN} AS m,"
        f" {O.MEASURES['sla_breach_rate']} AS rate FROM mart GROUP BY 1)",
    ),
)
def borough_table(spark, sf):
    return R.borough_table(mart(spark, sf))


@query(
    "top_complaint_types",
    "complaint_type:s total_requests:i rank:i",
    O.over(
        "clean",
        "SELECT * FROM (SELECT complaint_type, count(*) AS total_requests, rank() OVER (ORDER BY count(*) DESC) AS rank"
        " FROM mart WHERE year = 1998 GROUP BY 1) WHERE rank <= 15",
    ),
)
def top_complaint_types(spark, sf):
    return R.top_complaint_types(mart(spark, sf), 15, {"year": 1998})


@query(
    "category_by_month",
    "category:s " + " ".join(f"{m}:i" for m in MONTHS),
    O.over(
        "clean",
        "SELECT category, "
        + ", ".join(f'nullif(count(*) FILTER (month_short = \'{m}\'), 0) AS "{m}"' for m in MONTHS)
        + " FROM mart WHERE year = 1998 GROUP BY 1",
    ),
)
def category_by_month(spark, sf):
    return R.category_by_month(mart(spark, sf), MONTHS, {"year": 1998})


@query(
    "category_totals",
    "category:s total_requests:i",
    O.over("clean", "SELECT category, count(*) AS total_requests FROM mart GROUP BY 1"),
)
def category_totals(spark, sf):
    return R.category_totals(mart(spark, sf))


@query(
    "open_by_agency",
    "agency_code:s category:s complaint_type:s level:i total_open:i color:s",
    O.over(
        "clean",
        "SELECT *, CASE WHEN total_open >= 20000 THEN '#F09595' WHEN total_open >= 10000 THEN '#FAC775' ELSE '#9FE1CB' END AS color"
        " FROM (SELECT agency_code, NULL AS category, NULL AS complaint_type, 1 AS level, count(*) AS total_open FROM o GROUP BY 1"
        " UNION ALL SELECT agency_code, category, NULL, 2, count(*) FROM o GROUP BY 1, 2"
        " UNION ALL SELECT agency_code, category, complaint_type, 3, count(*) FROM o GROUP BY 1, 2, 3)",
        "o AS (SELECT * FROM mart WHERE status <> 'Closed')",
    ),
)
def open_by_agency(spark, sf):
    return R.open_by_agency(mart(spark, sf))


def _age(c: str, labels: list) -> str:
    return (
        f"CASE WHEN {c} <= 30 THEN {labels[0]} WHEN {c} <= 90 THEN {labels[1]} WHEN {c} <= 180 THEN {labels[2]}"
        f" WHEN {c} <= 365 THEN {labels[3]} ELSE {labels[4]} END"
    )


_BANDS = ["'0–30 days'", "'31–90 days'", "'91–180 days'", "'181–365 days'", "'Over 365 days'"]
_BAND_COLORS = ["'#10b981'", "'#f59e0b'", "'#ef4444'", "'#dc2626'", "'#7f1d1d'"]


@query(
    "open_by_age",
    "aging_bucket:s aging_sort:i total_open:i color:s",
    O.over(
        "clean",
        f"SELECT {_age('days_open_if_pending', _BANDS)} AS aging_bucket,"
        f" {_age('days_open_if_pending', [1, 2, 3, 4, 5])} AS aging_sort,"
        f" {_age('days_open_if_pending', _BAND_COLORS)} AS color, count(*) AS total_open"
        " FROM mart WHERE status <> 'Closed' GROUP BY 1, 2, 3",
    ),
)
def open_by_age(spark, sf):
    return R.open_by_age(mart(spark, sf))


@query(
    "all_by_age",
    "aging_bucket:s aging_sort:i total_requests:i",
    O.over(
        "clean",
        f"SELECT {_age('coalesce(days_open_if_pending, 0)', _BANDS)} AS aging_bucket,"
        f" {_age('coalesce(days_open_if_pending, 0)', [1, 2, 3, 4, 5])} AS aging_sort, count(*) AS total_requests"
        " FROM mart GROUP BY 1, 2",
    ),
)
def all_by_age(spark, sf):
    return R.all_by_age(mart(spark, sf))


@query(
    "open_by_day",
    "full_date:d total_open:i",
    O.over(
        "clean",
        "SELECT CAST(created_date AS DATE) AS full_date, count(*) AS total_open FROM mart WHERE status <> 'Closed' GROUP BY 1",
    ),
)
def open_by_day(spark, sf):
    return R.open_by_day(mart(spark, sf))


_CARD_NAMES = [
    "total_open", "avg_days_open", "stale_over_90", "stale_over_90_rate", "oldest_open_case", "within_sla_count",
    "sla_breach_rate_open", "stale_90_to_180", "stale_180_to_365", "stale_over_365",
]


@query(
    "open_case_cards",
    " ".join(f"{m}:{'f' if m in _COUNTS else 'i'}" for m in _CARD_NAMES)
    + " avg_days_waiting_vs_sla:f avg_open_days_display:s oldest_open_display:s avg_days_waiting_label:s oldest_case_summary:s",
    O.over(
        "untidy",
        f"SELECT *, {O.dec('avg_days_open', 2)} || ' Days' AS avg_open_days_display,"
        f" {O.dec('oldest_open_case', 0)} || ' Days' AS oldest_open_display,"
        f" CASE WHEN avg_days_waiting_vs_sla > 0 THEN '+' || {O.dec('avg_days_waiting_vs_sla', 0)} || ' days over SLA target'"
        f" ELSE {O.dec('avg_days_waiting_vs_sla', 0)} || ' days under SLA target' END AS avg_days_waiting_label,"
        " (SELECT agency_code || ' | ' || complaint_type || ' | ' || strftime(created_date, '%b %d, %Y') FROM ("
        + _OLDEST.format(by="", top="(SELECT max(days_open_if_pending) FROM mart)", group="")
        + f")) AS oldest_case_summary FROM (SELECT {O.measure_list([*_CARD_NAMES, 'avg_days_waiting_vs_sla'])}"
        " FROM mart WHERE status <> 'Closed')",
    ),
)
def open_case_cards(spark, sf):
    return R.open_cards(mart(spark, sf, "untidy"))


# ---- several writes into one warehouse ---------------------------------------------------------

_WRITES = "writes:s year:i n_rows:i n_keys:i n_rejected:i n_pending:i"
_ONCE = "SELECT '{}' AS writes, year, count(*) AS n_rows, count(DISTINCT unique_key) AS n_keys, {} AS n_rejected, 0 AS n_pending FROM fact GROUP BY 2"


def halves(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The clean requests in two parts by their key."""
    rows = A.clean_requests(spark, sf)
    return [rows.filter(F.substring_index("unique_key", "-", 1).cast("bigint") % 2 == n) for n in (0, 1)]


def new_warehouse(spark: SparkSession, name: str) -> W.Warehouse:
    return W.create_warehouse(spark, fresh_path(spark, f"warehouse-{name}"), A.order_settings())


def written(wh: W.Warehouse, name: str) -> DataFrame:
    """What is in the fact, what was rejected by reason, and what is left unread."""
    rejected = wh.table("etl_errors").filter(c("step_name") == T.FACT).groupBy("error_type").count()
    per_year = wh.fact.groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("unique_key").alias("n_keys"))
    lost = {r[0]: r[1] for r in rejected.collect()}  # one row per reason
    assert set(lost) <= {"DUPLICATE_IN_BATCH"}
    return per_year.withColumns({
        "writes": F.lit(name), "n_rejected": F.lit(sum(lost.values())), "n_pending": F.lit(wh.pending.count()),
    })


@query("refreshed_twice", _WRITES, O.over("clean", _ONCE.format("refreshed", 0)))
def refreshed_twice(spark, sf):
    """Two refreshes of staging under one batch number, each loaded."""
    wh = new_warehouse(spark, "refreshed")
    for part in halves(spark, sf):
        T.load_staging(part, wh.root, BATCH)
        W.run_all(wh, BATCH)
    return written(wh, "refreshed")


@query("appended_twice", _WRITES, O.over("clean", _ONCE.format("appended", 0)))
def appended_twice(spark, sf):
    """Two writes to staging under one batch number, then one load."""
    wh = new_warehouse(spark, "appended")
    for part in halves(spark, sf):
        T.load_staging(part, wh.root, BATCH, refresh=False)
    W.run_all(wh, BATCH)
    return written(wh, "appended")


@query("pending_batches_share_keys", _WRITES, O.over("clean", _ONCE.format("shared", "(SELECT count(*) FROM fact)")))
def pending_batches_share_keys(spark, sf):
    """Two pending batches that both hold every key."""
    wh = new_warehouse(spark, "shared")
    rows = cut(A.clean_requests(spark, sf), "requests")  # joined once
    for batch in (BATCH, BATCH + 1):
        T.load_staging(rows, wh.root, batch, refresh=False)
    W.run_all(wh, BATCH + 1)
    return written(wh, "shared")


@query("two_streams", _WRITES, O.over("clean", _ONCE.format("two streams", 0)))
def two_streams(spark, sf):
    """Two streams with progress of their own into one warehouse."""
    wh = new_warehouse(spark, "streams")
    for part in halves(spark, sf):
        inbox = fresh_path(spark, "inbox")
        _write_files(part, f"{inbox}/a")
        I.load_stream(wh, inbox, fresh_path(spark, "progress")).awaitTermination()
    return written(wh, "two streams")


@query("ingested_then_loaded", _WRITES, O.over("clean", _ONCE.format("ingested", "(SELECT count(*) FROM fact WHERE year = 1997)")))
def ingested_then_loaded(spark, sf):
    """Files landed in several micro-batches, the second repeating a year, then one load."""
    wh = new_warehouse(spark, "ingested")
    inbox, progress = fresh_path(spark, "inbox"), fresh_path(spark, "progress")
    rows = cut(A.clean_requests(spark, sf), "requests")  # joined once
    for name, part in {"a": rows.filter(c("created_date") < "1998"), "b": rows.filter(c("created_date") >= "1997")}.items():
        _write_files(part, f"{inbox}/{name}", packed=True)
        I.ingest_stream(wh, inbox, progress).awaitTermination()
    W.run_all(wh, BATCH)
    return written(wh, "ingested")


@query("cleared_warehouse", _WRITES, O.over("clean", _ONCE.format("cleared", 0)))
def cleared_warehouse(spark, sf):
    """Everything loaded, cleared and loaded again from what is staged."""
    wh = new_warehouse(spark, "cleared")
    T.load_staging(A.clean_requests(spark, sf), wh.root, BATCH)
    W.run_all(wh, BATCH)
    left = T.reset_warehouse(spark, wh.root, reset_flag=True)
    assert not any(r.total_rows for r in left.collect())  # one row per table
    W.run_all(wh, BATCH)
    return written(wh, "cleared")


def by_agency(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The clean requests in two parts that share no agency."""
    rows = A.clean_requests(spark, sf)
    return [rows.filter(F.crc32("agency") % 2 == n) for n in (0, 1)]


@query("packed_between_loads", _WRITES, O.over("clean", _ONCE.format("packed", 0)))
def packed_between_loads(spark, sf):
    """Two loads with the small tables packed after each; what was loaded, logged and marked stays so."""
    wh = new_warehouse(spark, "packed")
    for part in halves(spark, sf):
        T.load_staging(part, wh.root, BATCH, refresh=False)
        W.run_all(wh, BATCH)
        W.compact(wh, 0)
    assert W.run_all(wh, BATCH)[T.FACT].read == 0 and wh.table("etl_log").count() == 3 * len(W.STEPS)
    return written(wh, "packed")


@query("landed_during_load", _WRITES, O.over("clean", _ONCE.format("landed", 0)))
def landed_during_load(spark, sf):
    """Requests of agencies that no dimension knows land after the dimensions and before the fact."""
    wh = new_warehouse(spark, "landed")
    first, second = by_agency(spark, sf)
    T.load_staging(first, wh.root, BATCH)
    for number, name in enumerate(W.STEPS[:-1]):
        W.LOADERS[name](wh, number, BATCH)
    T.load_staging(second, wh.root, BATCH, refresh=False)
    W.load_fact(wh, len(W.STEPS), BATCH)
    W.run_all(wh, BATCH)
    return written(wh, "landed")


@query("two_loads_at_once", _WRITES, O.over("clean", _ONCE.format("at once", 0)))
def two_loads_at_once(spark, sf):
    """Two loads started together on the same pending rows, with a landing beside them."""
    wh = new_warehouse(spark, "at-once")
    first, second = by_agency(spark, sf)
    T.load_staging(first, wh.root, BATCH)
    with ThreadPoolExecutor(3) as pool:
        started = [pool.submit(W.run_all, wh, BATCH) for _ in range(2)]
        started.append(pool.submit(T.load_staging, second, wh.root, BATCH, False))
        for one in started:
            one.result()
    W.run_all(wh, BATCH)
    return written(wh, "at once")


@query(
    "summaries_kept_up",
    "agency_code:s agency_name:s sla_days:i year:i month:i month_name:s total_requests:i total_closed:i total_open:i"
    " avg_resolution_days:f max_resolution_days:i sla_breaches:i sla_breach_pct:f n_refreshed:i",
    O.over(
        "clean",
        "SELECT agency_code, agency_name, sla_days, year, month, month_name, count(*) AS total_requests,"
        f" {O.CLOSED} AS total_closed, {O.OPEN} AS total_open, avg(resolution_days) AS avg_resolution_days,"
        f" max(resolution_days) AS max_resolution_days, {_BREACHES} AS sla_breaches,"
        f" {O.pct(_BREACHES, O.CLOSED)} AS sla_breach_pct, (SELECT count(DISTINCT (year, month)) FROM mart WHERE year >= 1998) AS n_refreshed"
        " FROM mart GROUP BY 1, 2, 3, 4, 5, 6",
    ),
)
def summaries_kept_up(spark, sf):
    """The stored summary after two loads, each followed by a refresh of the months it touched."""
    wh = new_warehouse(spark, "summaries")
    rows = A.clean_requests(spark, sf)
    for part in (rows.filter(c("created_date") < "1998"), rows.filter(c("created_date") >= "1998")):
        T.load_staging(part, wh.root, BATCH)
        W.run_all(wh, BATCH)
        months = PM.refresh_summaries(wh)
    assert PM.refresh_summaries(wh) == []
    return PM.stored_summary(wh, "agency_summary").withColumn("n_refreshed", F.lit(len(months)))


# ---- files that arrive over time --------------------------------------------------------------


def _streamed(spark: SparkSession, sf: str) -> W.Warehouse:
    """The clean requests as two deliveries of files; the second repeats all keys of 1997.

    The source system writes both in one pass over the requests, and hands over a folder at a time.
    """
    key = (spark.sparkContext.applicationId, sf, "streamed")
    if key not in _LOADED:
        rows = A.clean_requests(spark, sf)
        outbox, inbox = fresh_path(spark, "outbox"), fresh_path(spark, "inbox")
        wh = W.create_warehouse(spark, fresh_path(spark, "warehouse-streamed"), A.order_settings())
        progress = fresh_path(spark, "progress")
        first, second = F.when(c("created_date") < "1998", "first"), F.when(c("created_date") >= "1997", "second")
        _write_files(rows.withColumn("part", F.explode(F.array_compact(F.array(first, second)))), outbox, "part", packed=True)
        for name in ("first", "second"):
            if not RW.hand_over(spark, f"{outbox}/part={name}", f"{inbox}/{name}"):
                _write_files(rows.limit(0), f"{inbox}/{name}")
            I.load_stream(wh, inbox, progress).awaitTermination()
        _LOADED[key] = wh
    return _LOADED[key]


@query(
    "streamed_fact",
    "year:i status:s n_rows:i n_keys:i sum_days:i",
    O.over(
        "clean",
        "SELECT year, status, count(*) AS n_rows, count(DISTINCT unique_key) AS n_keys, sum(resolution_days) AS sum_days"
        " FROM fact GROUP BY 1, 2",
    ),
)
def streamed_fact(spark, sf):
    return _streamed(spark, sf).fact.groupBy("year", "status").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("unique_key").alias("n_keys"),
        F.sum("resolution_days").alias("sum_days"),
    )


@query(
    "streamed_batches",
    "batch_id:i rows_read:i rows_inserted:i rows_skipped:i rows_rejected:i",
    O.over(
        "clean",
        "SELECT 0 AS batch_id, count(*) FILTER (year < 1998) AS rows_read, count(*) FILTER (year < 1998) AS rows_inserted,"
        " 0 AS rows_skipped, 0 AS rows_rejected FROM fact UNION ALL SELECT 1, count(*) FILTER (year >= 1997),"
        " count(*) FILTER (year >= 1998), count(*) FILTER (year = 1997), count(*) FILTER (year = 1997) FROM fact",
    ),
)
def streamed_batches(spark, sf):
    log = _streamed(spark, sf).table("etl_log")
    return log.filter(c("step_name") == T.FACT)


@query(
    "streamed_first_of_key",
    "n_rows:i n_keys:i n_undated:i",
    O.over(
        "untidy",
        "SELECT count(DISTINCT k) + count(*) FILTER (k IS NULL) AS n_rows, count(DISTINCT k) AS n_keys,"
        f" count(DISTINCT k) FILTER (undated) + count(*) FILTER (k IS NULL AND undated) AS n_undated"
        f" FROM (SELECT nullif(upper(trim(unique_key)), '') AS k, {_CREATED} IS NULL AS undated FROM raw)",
    ),
)
def streamed_first_of_key(spark, sf):
    """Every row of every file, dated or not, in several micro-batches; a key is either dated or not."""
    out, progress = fresh_path(spark, "first-of-key"), fresh_path(spark, "progress")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    I.state_on_disk(spark)
    try:
        first = I.first_ever(I.read_stream(spark, csv_folder(spark, sf, "untidy", packed=True), files_per_batch=20)).select("dedup_key", "created_date")
        (
            first.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)
            .trigger(availableNow=True).start().awaitTermination()
        )
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    kept = spark.read.schema("dedup_key string, created_date string").parquet(out)
    return kept.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct(F.nullif("dedup_key", F.lit(""))).alias("n_keys"),
        F.count_if(FD.parse_ts(c("created_date")).isNull()).alias("n_undated"),
    )


@query(
    "streamed_checks",
    "outcome:s observed:i written:i",
    O.over("untidy", "SELECT coalesce(row_error, 'VALID') AS outcome, count(*) AS observed, count(*) AS written FROM tagged GROUP BY 1"),
)
def streamed_checks(spark, sf):
    """All checks on a stream of files: what its micro-batches observed, and what they wrote."""
    wh = unloaded(spark, sf, "untidy")  # the checks need the dimensions, not the fact
    out = fresh_path(spark, "judged")
    batches = I.check_stream(wh, csv_folder(spark, sf, "untidy", packed=True, staged=wh.staging), fresh_path(spark, "progress"), out, files_per_batch=20)
    total: dict[str, int] = {}
    for counts in batches.values():  # one row of counts per micro-batch
        for outcome, n in counts.items():
            total[outcome] = total.get(outcome, 0) + n
    assert total.pop("rows_read") == sum(total.values())
    observed = spark.createDataFrame([(k, n) for k, n in total.items() if n], "outcome string, observed bigint")
    written_ = spark.read.parquet(out).groupBy(F.coalesce("error_type", F.lit("VALID")).alias("outcome")).agg(F.count(F.lit(1)).alias("written"))
    return observed.join(written_, "outcome", "full")


@query("paged_delivery", _WRITES, O.over("clean", _ONCE.format("paged", 0)))
def paged_delivery(spark, sf):
    """A delivery that lands page by page, stopped inside a file and taken up again, then loaded."""
    wh = new_warehouse(spark, "paged")
    folder = csv_folder(spark, sf, "clean")
    page = {"page_rows": 2000, "pages_per_save": 2}
    first = PG.ingest_pages(spark, wh.root, folder, BATCH, most_saves=3, **page)
    assert first["saves"] == 3
    second = PG.ingest_pages(spark, wh.root, folder, BATCH, **page)
    assert first["rows_landed"] + second["rows_landed"] == wh.staging.count()
    assert PG.ingest_pages(spark, wh.root, folder, BATCH, **page) == {"rows_landed": 0, "saves": 0}
    W.run_all(wh, BATCH)
    return written(wh, "paged")


# ---- reports over all years -------------------------------------------------------------------

_REPORTS = {
    "borough_share": R.borough_share,
    "requests_by_month": R.requests_by_month,
    "agency_matrix": R.agency_matrix,
    "weekend_split": R.weekend_split,
    "top_complaint_types": lambda rows: R.top_complaint_types(rows, 15),
    "category_by_month": lambda rows: R.category_by_month(rows, MONTHS),
}


def _over_all_years(name: str) -> Query:
    """A report without its year slicer, and its twin without the same condition."""
    sliced = QUERIES[name]
    assert " WHERE year = 1998" in sliced.sql
    return Query(
        lambda spark, sf: shaped(_REPORTS[name](mart(spark, sf)), sliced.columns), sliced.columns, sliced.sql.replace(" WHERE year = 1998", ""),
    )


QUERIES |= {f"{name}_all_years": _over_all_years(name) for name in _REPORTS}


@query(
    "running_totals_by_borough",
    "full_date:d borough:s total_requests_mtd:i total_requests_ytd:i",
    O.over(
        "clean",
        "SELECT full_date, borough, nullif(mtd, 0) AS total_requests_mtd, ytd AS total_requests_ytd FROM ("
        " SELECT full_date, borough, sum(n) OVER (PARTITION BY borough, year, month ORDER BY full_date) AS mtd,"
        " sum(n) OVER (PARTITION BY borough, year ORDER BY full_date) AS ytd FROM ("
        " SELECT full_date, year, month, borough, coalesce(n, 0) AS n FROM"
        " (SELECT full_date, year, month, borough FROM dim_date, (SELECT DISTINCT borough FROM mart))"
        " LEFT JOIN (SELECT CAST(created_date AS DATE) AS full_date, borough, count(*) AS n FROM mart GROUP BY 1, 2)"
        " USING (full_date, borough))) WHERE ytd > 0",
    ),
)
def running_totals_by_borough(spark, sf):
    wanted = {"_mtd": ["total_requests"], "_ytd": ["total_requests"]}
    return M.period_measures(mart(spark, sf), calendar(spark, sf), wanted, ["full_date"], ["borough"])


@query(
    "overview_page",
    "visual:s label:s total_requests:i sla_breach_rate:f",
    O.over(
        "clean",
        " UNION ALL ".join(
            f"SELECT '{visual}' AS visual, {label} AS label, {count} AS total_requests, {rate} AS sla_breach_rate FROM mart {where} GROUP BY ALL"
            for visual, label, count, rate, where in [
                ("borough", "borough", "count(*)", "NULL::DOUBLE", "WHERE year = 1998"),
                ("month", "month_short", "count(*)", "NULL::DOUBLE", "WHERE year = 1998"),
                ("resolution_bucket", "resolution_bucket", "count(*)", "NULL::DOUBLE", "WHERE year = 1998"),
                ("agency", "agency_code", "count(*)", O.MEASURES["sla_breach_rate"], "WHERE year = 1998"),
                ("weekend", "CAST(is_weekend AS VARCHAR)", "count(*)", "NULL::DOUBLE", "WHERE year = 1998"),
                ("category", "category", "count(*)", O.MEASURES["sla_breach_rate"], "WHERE year = 1998"),
                ("category_month", "category || ' ' || month_short", "count(*)", "NULL::DOUBLE", "WHERE year = 1998"),
                ("status", "status", "count(*)", "NULL::DOUBLE", "WHERE year = 1998"),
                ("cards", "NULL::VARCHAR", "count(*)", O.MEASURES["sla_breach_rate"], "WHERE year = 1998"),
            ]
        ),
    ),
)
def overview_page(spark, sf):
    """Nine visuals of one year from one pass over the requests."""
    pages = []
    for visual, df in R.overview_page(mart(spark, sf), {"year": 1998}).items():
        by = [n for n in R.OVERVIEW[visual][0] if n != "month"]
        label = F.concat_ws(" ", *[c(n).cast("string") for n in by]) if by else F.lit(None).cast("string")
        rate = c("sla_breach_rate") if "sla_breach_rate" in df.columns else F.lit(None).cast("double")
        pages.append(df.select(F.lit(visual).alias("visual"), label.alias("label"), "total_requests", rate.cast("double").alias("sla_breach_rate")))
    return functools.reduce(DataFrame.unionByName, pages)


@query(
    "requests_of_last_month",
    "agency_code:s year:i month:i total_requests:i",
    O.over(
        "clean",
        "SELECT agency_code, year, month, count(*) AS total_requests FROM mart WHERE (year, month) ="
        " (SELECT (max(year), max(month)) FROM mart WHERE year = (SELECT max(year) FROM mart)) GROUP BY ALL",
    ),
)
def requests_of_last_month(spark, sf):
    """The last month that has a request; the plan reads the one year it lies in."""
    wh = warehouse(spark, sf)
    days = calendar(spark, sf)
    last = wh.fact.agg(F.max("date_key")).first()[0]
    return R.requests_of_days(wh, days.filter((c("date_key") >= last // 100 * 100) & (c("date_key") <= last)))
