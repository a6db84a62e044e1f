"""Order tables seen as service requests: one request per order line.

The clean form loads without rejects; the untidy form drives every check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicmart.functions.rules import Settings
from civicmart.sources.raw import RAW_COLUMNS

# The calendar, the report date and the rules the order tables are loaded with.
AS_OF = "2002-01-01"
FIRST_DAY, LAST_DAY = "1995-01-01", "2001-12-31"
PART_RULES = [("RING", "Rings"), ("WIDGET", "Widgets"), ("BOLT", "Fixings"), ("PLATE", "Fixings"), ("HOT", "Heat")]
NATIONS = 25


def order_settings() -> Settings:
    """Rules for order data; nation k has a target of 2 + 3 * (k mod 10) days."""
    return Settings(
        first_day=FIRST_DAY,
        last_day=LAST_DAY,
        agency_names={f"NATION_{k}": f"Agency of nation {k}" for k in range(0, NATIONS, 2)},
        sla_days={f"NATION_{k}": 2 + 3 * (k % 10) for k in range(NATIONS)},
        category_rules=PART_RULES,
        report_years=(1997, 1999),
    )


def read_tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{folder}/{n}.parquet") for n in names]


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their order, customer, part, supplier, nations and region.

    Text that an order or a customer gives to all its lines is made before they meet (`created`, `lat`, `lon`). Orders
    get their customer before their lines, and lines their part while they are narrow, so that of large tables the lines move twice.
    """
    line, orders, customer, part, supplier, nation, region = read_tables(
        spark, folder, "lineitem", "orders", "customer", "part", "supplier", "nation", "region"
    )
    used = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"]
    line = line.select(*used)
    orders = orders.withColumn("created", _iso(F.col("o_orderdate")))
    key = F.col("c_custkey")
    customer = customer.withColumns({"lat": _decimal_text("40.45", key, 400), "lon": _decimal_text("-74.25", key, 500)})
    home = nation.select(
        F.col("n_nationkey").alias("c_nationkey"),
        F.col("n_name").alias("home_nation"),
        F.col("n_regionkey").alias("r_regionkey"),
    )
    seat = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("seat_nation"))
    orders = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "created")
    ordered = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return (
        line
        .join(part, line.l_partkey == part.p_partkey)
        .join(ordered, line.l_orderkey == orders.o_orderkey)
        .join(home, "c_nationkey")
        .join(region, "r_regionkey")
        .join(supplier, line.l_suppkey == supplier.s_suppkey)
        .join(seat, "s_nationkey")
    )


def _iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS")


def _decimal_text(base: str, key: Column, modulus: int) -> Column:
    return (F.lit(base).cast("decimal(9,3)") + (key % modulus).cast("decimal(9,0)") / 1000).cast(
        "decimal(9,6)"
    ).cast("string")


def _whole(c: Column) -> Column:
    return c.cast("bigint")


def clean_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Request rows that pass every check."""
    c = F.col
    closed = F.date_add(F.to_date(c("o_orderdate")), (_whole(c("l_quantity")) - 1).cast("int"))
    fields = {
        "unique_key": F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.date_format("l_shipdate", "yyyyMMdd"), _whole(c("l_quantity")),
        ),
        "created_date": c("created"),
        "closed_date": F.when(c("o_orderstatus") == "F", _iso(closed.cast("timestamp_ntz"))),
        "agency": c("seat_nation"),
        "agency_name": c("seat_nation"),
        "complaint_type": c("p_name"),
        "descriptor": c("p_brand"),
        "location_type": c("p_type"),
        "incident_zip": F.lpad(c("c_nationkey").cast("string"), 5, "0"),
        "incident_address": c("c_name"),
        "city": c("home_nation"),
        "borough": c("r_name"),
        "latitude": c("lat"),
        "longitude": c("lon"),
        "status": F.when(c("o_orderstatus") == "F", "Closed")
        .when(c("o_orderstatus") == "O", "Open")
        .otherwise("Pending"),
        "resolution_description": c("o_orderpriority"),
        "community_board": c("c_mktsegment"),
    }
    return order_lines(spark, folder).select(*[e.alias(n) for n, e in fields.items()])


def untidy_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Request rows with every fault the load has to find."""
    c = F.col
    line = c("l_linenumber")
    created = c("created")
    us_form = F.date_format("o_orderdate", "MM/dd/yyyy hh:mm:ss a")
    order, customer = c("l_orderkey"), c("c_custkey")
    fields = {
        "unique_key": F.when(order % 89 == 0, F.lit(" ")).otherwise(F.concat_ws("-", "l_orderkey", "l_linenumber")),
        "created_date": F.when(order % 97 == 0, F.lit(None))
        .when(order % 101 == 0, F.lit("not a date"))
        .when(order % 5 == 0, us_form)
        .otherwise(created),
        "closed_date": F.when(c("o_orderstatus") == "F", _iso(c("l_shipdate"))),
        "agency": F.when(c("l_suppkey") % 31 == 0, F.lit("  "))
        .when(line == 3, F.concat(F.lit(" "), F.lower("seat_nation")))
        .otherwise(c("seat_nation")),
        "agency_name": F.when(line == 2, F.upper(F.concat(c("seat_nation"), F.lit(" Office")))).otherwise(
            F.concat(F.lit(" "), c("seat_nation"), F.lit(" office "))
        ),
        "complaint_type": F.when(c("l_partkey") % 61 == 0, F.lit(None))
        .when(line % 2 == 0, F.upper("p_name"))
        .otherwise(c("p_name")),
        "descriptor": F.when(c("p_size") == 1, F.lit(None)).when(c("p_size") == 2, F.lit(" ")).otherwise(c("p_brand")),
        "location_type": c("p_type"),
        "incident_zip": F.when(customer % 41 == 0, F.lit(None)).otherwise(
            F.lpad(c("c_nationkey").cast("string"), 5, "0")
        ),
        "incident_address": c("c_name"),
        "city": F.when(customer % 47 == 0, F.lit("")).otherwise(c("home_nation")),
        "borough": F.when(customer % 33 == 0, F.lit("Unspecified")).otherwise(
            F.when(line == 5, F.lower("r_name")).otherwise(c("r_name"))
        ),
        "latitude": F.when(customer % 53 == 0, F.lit("0"))
        .when(c("c_nationkey") == 7, F.lit("n/a"))
        .when((c("c_nationkey") == 9) & (c("c_mktsegment") == "BUILDING"), F.lit("12.5"))
        .otherwise(c("lat")),
        "longitude": F.when(customer % 53 == 0, F.lit("0")).otherwise(c("lon")),
        "status": F.when(line == 1, F.when(c("o_orderstatus") == "F", "resolved").otherwise("opened"))
        .when(line == 2, F.lit("ON HOLD"))
        .when((line == 3) & (order % 7 == 0), F.lit("Bogus"))
        .when(line == 4, F.lit(None))
        .when(line == 5, F.lit(" in-progress "))
        .when(line == 6, F.lit("unspecified"))
        .otherwise(F.when(c("o_orderstatus") == "F", "CLOSED").otherwise("Dispatched")),
        "resolution_description": c("o_orderpriority"),
        "community_board": F.when(customer % 43 == 0, F.lit(None)).otherwise(c("c_mktsegment")),
    }
    return order_lines(spark, folder).select(*[e.cast("string").alias(n) for n, e in fields.items()])
