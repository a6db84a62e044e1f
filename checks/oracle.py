"""SQL building blocks: the same warehouse, computed from the order tables by another engine.

Everything is spelled out again here; nothing is taken from the Spark code.
"""

from __future__ import annotations

LINES = """
lines AS (
  SELECT l.*, o.*, c.*, p.*, home.n_name AS home_nation, r.r_name, seat.n_name AS seat_nation
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation home ON c.c_nationkey = home.n_nationkey
  JOIN region r ON home.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation seat ON s.s_nationkey = seat.n_nationkey
)"""

ISO = "'%Y-%m-%dT%H:%M:%S.000'"
LAT = "CAST(CAST(40450000 + (c_custkey % 400) * 1000 AS DECIMAL(18,0)) / 1000000 AS DECIMAL(9,6))"
LON = "CAST(CAST(-74250000 + (c_custkey % 500) * 1000 AS DECIMAL(18,0)) / 1000000 AS DECIMAL(9,6))"

CLEAN = f"""
raw AS (
  SELECT
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d'),
              CAST(l_quantity AS BIGINT)) AS unique_key,
    strftime(o_orderdate, {ISO}) AS created_date,
    CASE WHEN o_orderstatus = 'F'
         THEN strftime(CAST(o_orderdate AS DATE) + CAST(l_quantity - 1 AS INTEGER), {ISO}) END AS closed_date,
    seat_nation AS agency, seat_nation AS agency_name, p_name AS complaint_type, p_brand AS descriptor,
    p_type AS location_type, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS incident_zip,
    c_name AS incident_address, home_nation AS city, r_name AS borough,
    CAST({LAT} AS VARCHAR) AS latitude, CAST({LON} AS VARCHAR) AS longitude,
    CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Open' ELSE 'Pending' END AS status,
    o_orderpriority AS resolution_description, c_mktsegment AS community_board
  FROM lines
)"""

UNTIDY = f"""
raw AS (
  SELECT
    CASE WHEN l_orderkey % 89 = 0 THEN ' ' ELSE concat_ws('-', l_orderkey, l_linenumber) END AS unique_key,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 101 = 0 THEN 'not a date'
         WHEN l_orderkey % 5 = 0 THEN strftime(o_orderdate, '%m/%d/%Y %I:%M:%S %p')
         ELSE strftime(o_orderdate, {ISO}) END AS created_date,
    CASE WHEN o_orderstatus = 'F' THEN strftime(l_shipdate, {ISO}) END AS closed_date,
    CASE WHEN l_suppkey % 31 = 0 THEN '  ' WHEN l_linenumber = 3 THEN ' ' || lower(seat_nation)
         ELSE seat_nation END AS agency,
    CASE WHEN l_linenumber = 2 THEN upper(seat_nation || ' Office')
         ELSE ' ' || seat_nation || ' office ' END AS agency_name,
    CASE WHEN l_partkey % 61 = 0 THEN NULL WHEN l_linenumber % 2 = 0 THEN upper(p_name)
         ELSE p_name END AS complaint_type,
    CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN ' ' ELSE p_brand END AS descriptor,
    p_type AS location_type,
    CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS incident_zip,
    c_name AS incident_address,
    CASE WHEN c_custkey % 47 = 0 THEN '' ELSE home_nation END AS city,
    CASE WHEN c_custkey % 33 = 0 THEN 'Unspecified' WHEN l_linenumber = 5 THEN lower(r_name)
         ELSE r_name END AS borough,
    CASE WHEN c_custkey % 53 = 0 THEN '0' WHEN c_nationkey = 7 THEN 'n/a'
         WHEN c_nationkey = 9 AND c_mktsegment = 'BUILDING' THEN '12.5'
         ELSE CAST({LAT} AS VARCHAR) END AS latitude,
    CASE WHEN c_custkey % 53 = 0 THEN '0' ELSE CAST({LON} AS VARCHAR) END AS longitude,
    CASE WHEN l_linenumber = 1 THEN CASE WHEN o_orderstatus = 'F' THEN 'resolved' ELSE 'opened' END
         WHEN l_linenumber = 2 THEN 'ON HOLD'
         WHEN l_linenumber = 3 AND l_orderkey % 7 = 0 THEN 'Bogus'
         WHEN l_linenumber = 4 THEN NULL
         WHEN l_linenumber = 5 THEN ' in-progress '
         WHEN l_linenumber = 6 THEN 'unspecified'
         ELSE CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' ELSE 'Dispatched' END END AS status,
    o_orderpriority AS resolution_description,
    CASE WHEN c_custkey % 43 = 0 THEN NULL ELSE c_mktsegment END AS community_board
  FROM lines
)"""

# An untidy row as it lands in staging: empty text is NULL.
LANDED = "raw_landed AS (SELECT * REPLACE (nullif(city, '') AS city) FROM raw)"


def ts(c: str) -> str:
    return f"coalesce(TRY_CAST(trim({c}) AS TIMESTAMP), try_strptime(trim({c}), '%m/%d/%Y %I:%M:%S %p'))"


CALENDAR = """
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
    year(d) AS year, quarter(d) AS quarter, 'Q' || quarter(d) AS quarter_name, month(d) AS month,
    strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short,
    (dayofyear(d) + dayofweek(date_trunc('year', d)) - 1) // 7 + 1 AS week_of_year,
    day(d) AS day_of_month, dayofweek(d) + 1 AS day_of_week, strftime(d, '%A') AS day_name,
    dayofweek(d) IN (0, 6) AS is_weekend, false AS is_holiday
  FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS d)
)"""

AGENCY = """
dim_agency AS (
  SELECT row_number() OVER (ORDER BY agency_code) AS agency_key, agency_code,
    CASE WHEN CAST(substr(agency_code, 8) AS INTEGER) % 2 = 0
         THEN 'Agency of nation ' || substr(agency_code, 8) ELSE coalesce(raw_name, agency_code) END AS agency_name,
    'City Agency' AS department, 2 + 3 * (CAST(substr(agency_code, 8) AS INTEGER) % 10) AS sla_days,
    true AS is_active
  FROM (SELECT upper(trim(agency)) AS agency_code, min(trim(agency_name)) AS raw_name
        FROM raw WHERE agency IS NOT NULL AND trim(agency) <> '' GROUP BY 1)
)"""


def mean6(c: str) -> str:
    """Mean of a decimal(9,6): first to 10 places, then to 6, halves away from zero."""
    micro = f"sum(CAST({c} * 1000000 AS HUGEINT))"
    ten = f"((2 * abs({micro}) * 10000 + count({c})) // (2 * count({c})))"
    six = f"((2 * {ten} + 10000) // 20000)"
    sign = f"CASE WHEN {micro} < 0 THEN -1 ELSE 1 END"
    return f"CAST(CAST({six} * {sign} AS DECIMAL(18,0)) / 1000000 AS DECIMAL(9,6))"


LOCATION = f"""
all_locations AS (
  SELECT upper(trim(borough)) AS borough, min(coalesce(trim(community_board), '')) AS community_board,
    min(coalesce(trim(incident_zip), '')) AS zip_code,
    CASE WHEN count(lat) > 0 THEN {mean6("lat")} END AS latitude,
    CASE WHEN count(lon) > 0 THEN {mean6("lon")} END AS longitude
  FROM (SELECT *, TRY_CAST(trim(latitude) AS DECIMAL(9,6)) AS lat, TRY_CAST(trim(longitude) AS DECIMAL(9,6)) AS lon
        FROM raw)
  WHERE borough IS NOT NULL AND upper(trim(borough)) NOT IN ('UNSPECIFIED', '')
  GROUP BY upper(trim(borough)), upper(coalesce(trim(community_board), '')), upper(coalesce(trim(incident_zip), ''))
),
judged_locations AS (
  SELECT *, CASE WHEN latitude IS NULL OR longitude IS NULL THEN 'NULL_AVG_COORDINATES'
                 WHEN NOT (latitude BETWEEN 40.4 AND 40.9 AND longitude BETWEEN -74.3 AND -73.7)
                 THEN 'OUT_OF_RANGE_AVG_COORDINATES' END AS error_type
  FROM all_locations
),
dim_location AS (
  SELECT row_number() OVER (ORDER BY borough, community_board, zip_code) AS location_key, borough, community_board,
    zip_code, latitude, longitude, CAST(NULL AS VARCHAR) AS neighborhood
  FROM judged_locations WHERE error_type IS NULL
)"""

COMPLAINT = """
dim_complaint_type AS (
  SELECT row_number() OVER (ORDER BY complaint_type, descriptor) AS complaint_key, complaint_type, descriptor,
    CASE WHEN complaint_type LIKE '%RING%' THEN 'Rings' WHEN complaint_type LIKE '%WIDGET%' THEN 'Widgets'
         WHEN complaint_type LIKE '%BOLT%' OR complaint_type LIKE '%PLATE%' THEN 'Fixings'
         WHEN complaint_type LIKE '%HOT%' THEN 'Heat' ELSE 'Other' END AS category
  FROM (SELECT upper(trim(complaint_type)) AS complaint_type, min(coalesce(trim(descriptor), '')) AS descriptor
        FROM raw WHERE complaint_type IS NOT NULL AND trim(complaint_type) <> ''
        GROUP BY upper(trim(complaint_type)), upper(coalesce(trim(descriptor), '')))
)"""

STATUS = """CASE
  WHEN status IS NULL OR trim(status) = '' THEN 'Unspecified'
  WHEN upper(trim(status)) IN ('CLOSED', 'CLOSE', 'RESOLVED') THEN 'Closed'
  WHEN upper(trim(status)) IN ('OPEN', 'OPENED') THEN 'Open'
  WHEN upper(trim(status)) IN ('PENDING', 'HOLD', 'ON HOLD') THEN 'Pending'
  WHEN upper(trim(status)) IN ('IN PROGRESS', 'IN-PROGRESS', 'INPROGRESS', 'STARTED') THEN 'In Progress'
  WHEN upper(trim(status)) IN ('ASSIGNED', 'DISPATCHED') THEN 'Assigned'
  WHEN upper(rtrim(status)) = 'UNSPECIFIED' THEN 'Unspecified'
  ELSE status END"""
ALLOWED = "('OPEN', 'CLOSED', 'PENDING', 'IN PROGRESS', 'UNSPECIFIED', 'ASSIGNED')"

FACT = f"""
parsed AS (
  SELECT r.*, {ts("r.created_date")} AS created, {ts("r.closed_date")} AS closed, {STATUS.replace("status", "r.status")} AS norm_status,
    a.agency_key, l.location_key, t.complaint_key
  FROM raw_landed r
  LEFT JOIN dim_agency a ON upper(trim(r.agency)) = a.agency_code
  LEFT JOIN dim_location l ON upper(trim(r.borough)) = l.borough
    AND upper(coalesce(trim(r.incident_zip), '')) = upper(l.zip_code)
    AND upper(coalesce(trim(r.community_board), '')) = upper(l.community_board)
  LEFT JOIN dim_complaint_type t ON upper(trim(r.complaint_type)) = t.complaint_type
    AND upper(coalesce(trim(r.descriptor), '')) = upper(t.descriptor)
),
tagged AS (
  SELECT *, CAST(strftime(created, '%Y%m%d') AS INTEGER) AS date_key, CASE
      WHEN unique_key IS NULL OR trim(unique_key) = '' THEN 'NULL_UNIQUE_KEY'
      WHEN trim(coalesce(borough, '')) <> '' AND trim(coalesce(incident_zip, '')) <> '' AND latitude IS NOT NULL
           AND longitude IS NOT NULL AND trim(coalesce(city, '')) = '' THEN 'CITY_MISSING'
      WHEN created IS NULL THEN 'INVALID_CREATED_DATE'
      WHEN year(created) NOT BETWEEN 1995 AND 2001 THEN 'DATE_OUT_OF_RANGE'
      WHEN closed < created THEN 'NEGATIVE_RESOLUTION'
      WHEN upper(rtrim(norm_status)) NOT IN {ALLOWED} THEN 'INVALID_STATUS'
      WHEN agency_key IS NULL THEN 'NO_DIM_AGENCY_MATCH'
      WHEN location_key IS NULL THEN 'NO_DIM_LOCATION_MATCH'
      WHEN complaint_key IS NULL THEN 'NO_DIM_COMPLAINT_MATCH' END AS row_error
  FROM parsed
),
judged AS (
  SELECT *, CASE WHEN row_error IS NOT NULL THEN row_error
      WHEN row_number() OVER (PARTITION BY row_error IS NULL, upper(trim(unique_key))
        ORDER BY created DESC, closed DESC NULLS LAST, status DESC NULLS LAST, agency DESC NULLS LAST,
          borough DESC NULLS LAST, incident_zip DESC NULLS LAST, complaint_type DESC NULLS LAST,
          descriptor DESC NULLS LAST, latitude DESC NULLS LAST, longitude DESC NULLS LAST,
          community_board DESC NULLS LAST) > 1 THEN 'DUPLICATE_IN_BATCH' END AS error_type
  FROM tagged
),
fact AS (
  SELECT trim(unique_key) AS unique_key, date_key, agency_key, location_key, complaint_key, created AS created_date,
    closed AS closed_date, norm_status AS status, datediff('day', created, closed) AS resolution_days,
    year(created) AS year
  FROM judged WHERE error_type IS NULL
)"""

MART = """
mart AS (
  SELECT f.unique_key, f.created_date, f.closed_date, f.status, f.resolution_days, d.year, d.quarter_name, d.month,
    d.month_name, d.month_short, d.day_name, d.is_weekend, d.is_holiday, a.agency_code, a.agency_name, a.department,
    a.sla_days, l.borough, l.community_board, l.zip_code, l.latitude, l.longitude, l.neighborhood,
    t.complaint_type, t.descriptor, t.category,
    CASE WHEN f.resolution_days > a.sla_days THEN 1 ELSE 0 END AS is_sla_breach,
    CASE WHEN f.status <> 'Closed' THEN datediff('day', f.created_date, DATE '2002-01-01') END AS days_open_if_pending,
    CASE WHEN f.resolution_days IS NULL THEN 'Open' WHEN f.resolution_days = 0 THEN 'Same Day'
         WHEN f.resolution_days <= 3 THEN '1-3 Days' WHEN f.resolution_days <= 7 THEN '4-7 Days'
         WHEN f.resolution_days <= 30 THEN '8-30 Days' ELSE 'Over 30 Days' END AS resolution_bucket
  FROM fact f JOIN dim_date d USING (date_key) JOIN dim_agency a USING (agency_key)
  JOIN dim_location l USING (location_key) JOIN dim_complaint_type t USING (complaint_key)
)"""


def over(form: str, body: str, *more: str) -> str:
    """`body` over the whole warehouse of one form ('clean' or 'untidy')."""
    raw = CLEAN if form == "clean" else UNTIDY
    parts = [LINES, raw, LANDED, CALENDAR, AGENCY, LOCATION, COMPLAINT, FACT, MART, *more]
    return "WITH " + ",".join(parts) + body


def pct(part: str, whole: str, places: int = 1) -> str:
    """Percentage to some places, halves up, in whole numbers; NULL over nothing."""
    scale = 10**places
    return f"(2 * 100 * {scale} * ({part}) + ({whole})) // nullif(2 * ({whole}), 0) / {scale}.0"


def dec(c: str, places: int) -> str:
    """Fixed decimals as text, halves away from zero."""
    return f"CAST(CAST(round(CAST({c} AS DECIMAL(30,8)), {places}) AS DECIMAL(30,{places})) AS VARCHAR)"


def magnitude(c: str) -> str:
    return (
        f"CASE WHEN abs({c}) >= 1000000 THEN {dec(f'({c}) / 1000000', 2)} || 'M' "
        f"WHEN abs({c}) >= 1000 THEN {dec(f'({c}) / 1000', 2)} || 'K' ELSE {dec(c, 2)} END"
    )


CLOSED = "count(*) FILTER (status = 'Closed')"
OPEN = "count(*) FILTER (status <> 'Closed')"
RES = "resolution_days IS NOT NULL AND resolution_days <> 0"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif({b}, 0))"


MEASURES = {
    "total_requests": "nullif(count(*), 0)",
    "total_closed": f"nullif({CLOSED}, 0)",
    "total_open": f"nullif({OPEN}, 0)",
    "sla_breaches": "nullif(count(*) FILTER (is_sla_breach = 1), 0)",
    "sla_breached_count": "nullif(count(*) FILTER (is_sla_breach = 1), 0)",
    "within_sla_count": "nullif(count(*) FILTER (is_sla_breach = 0), 0)",
    "closure_rate": f"nullif({CLOSED}, 0) / CAST(nullif(count(*), 0) AS DOUBLE)",
    "sla_breach_rate": f"nullif(count(*) FILTER (is_sla_breach = 1), 0) / CAST(nullif({CLOSED}, 0) AS DOUBLE)",
    "sla_breach_rate_open": f"nullif(count(*) FILTER (is_sla_breach = 1), 0) / CAST(nullif({OPEN}, 0) AS DOUBLE)",
    "avg_resolution_days": f"avg(resolution_days) FILTER ({RES})",
    "avg_days_open": "avg(days_open_if_pending) FILTER (status <> 'Closed')",
    "oldest_open_case": "max(days_open_if_pending) FILTER (status <> 'Closed')",
    "stale_over_90": "nullif(count(*) FILTER (status <> 'Closed' AND days_open_if_pending > 90), 0)",
    "stale_over_90_rate": "nullif(count(*) FILTER (status <> 'Closed' AND days_open_if_pending > 90), 0)"
    f" / CAST(nullif({OPEN}, 0) AS DOUBLE)",
    "stale_90_to_180": "nullif(count(*) FILTER (status <> 'Closed' AND days_open_if_pending > 90"
    " AND days_open_if_pending <= 180), 0)",
    "stale_180_to_365": "nullif(count(*) FILTER (status <> 'Closed' AND days_open_if_pending > 180"
    " AND days_open_if_pending <= 365), 0)",
    "stale_over_365": "nullif(count(*) FILTER (status <> 'Closed' AND days_open_if_pending > 365), 0)",
    "avg_days_waiting_vs_sla": "avg(days_open_if_pending) FILTER (status <> 'Closed') - avg(sla_days)",
}


def measure_list(names: list[str]) -> str:
    return ", ".join(f"{MEASURES[n]} AS {n}" for n in names)


def typed(columns: str, sql: str) -> str:
    """The query with its output columns in agreed types: s text, i whole, f number, d day, t time."""
    shapes = {
        "s": "CAST({c} AS VARCHAR)",
        "i": "CAST({c} AS BIGINT)",
        "f": "round(CAST({c} AS DOUBLE), 6)",
        "d": "strftime({c}, '%Y-%m-%d')",
        "t": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
    }
    shown = []
    for item in columns.split():
        name, kind = item.rsplit(":", 1)
        quoted = f'"{name}"'
        shown.append(f"{shapes[kind].format(c=quoted)} AS {quoted}")
    return f"SELECT {', '.join(shown)} FROM ({sql}) AS q"
