"""Warehouse tables: schemas, reads, writes, staging refresh and reset."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicmart.session import PACKING, drop_path, open_files
from civicmart.sources.lease import Lease
from civicmart.sources.packs import CLOSED, drop_packs, pack, with_packs
from civicmart.sources.raw import RAW_COLUMNS, select_known, with_audit

#: Seconds that a writer waits for another one to end.
WAIT = 3600.0

_ERROR_TEXT = ", ".join(
    f"{c} string"
    for c in [
        "raw_agency", "raw_borough", "raw_complaint", "raw_created", "raw_closed",
        "raw_latitude", "raw_longitude", "raw_status",
    ]
)
SCHEMAS = {
    "raw_requests": ", ".join(f"{c} string" for c in RAW_COLUMNS)
    + ", source_year int, stg_load_date timestamp, stg_error_message string, stg_row_id bigint,"
    " stg_batch_id bigint, load_id string",
    "staged_loads": "load_id string, stg_batch_id bigint",
    "processed_loads": "load_id string, stg_batch_id bigint, log_id bigint",
    "dim_loads": "load_id string, step_name string, mark string",
    "dim_date": "date_key int, full_date date, year int, quarter int, quarter_name string, month int,"
    " month_name string, month_short string, week_of_year int, day_of_month int, day_of_week int,"
    " day_name string, is_weekend boolean, is_holiday boolean",
    "dim_agency": "agency_key int, agency_code string, agency_name string, department string,"
    " sla_days int, is_active boolean",
    "dim_location": "location_key int, borough string, community_board string, zip_code string,"
    " latitude decimal(9,6), longitude decimal(9,6), neighborhood string",
    "dim_complaint_type": "complaint_key int, complaint_type string, descriptor string, category string",
    "fact_service_requests": "request_key bigint, unique_key string, date_key int, agency_key int,"
    " location_key int, complaint_key int, created_date timestamp_ntz, closed_date timestamp_ntz,"
    " status string, resolution_days int, dw_created_date timestamp, dw_batch_id bigint, year int",
    "fact_keys": "dedup_key string, log_id bigint, key_set int, bucket int",
    "key_sets": "key_set int, depth int",
    "touched_months": "year int, month int, log_id bigint",
    "summary_loads": "log_id bigint, mark string",
    "profile_values": "column_name string, value string, value_id int",
    "load_bits": "load_id string, column_name string, page bigint, bits binary",
    "load_profiles": "load_id string, total_rows bigint, null_keys bigint, null_agency bigint, null_borough bigint, null_dates bigint",
    "fact_loads": "log_id bigint, state string, mark string",
    "legacy_location": "location_key int, borough string, community_board string, zip_code string, city string,"
    " latitude decimal(9,6), longitude decimal(9,6)",
    "etl_log": "log_id bigint, batch_id bigint, step_name string, step_number int, status string,"
    " rows_read bigint, rows_inserted bigint, rows_rejected bigint, rows_skipped bigint,"
    " start_time timestamp, end_time timestamp, duration_sec bigint, error_message string,"
    " run_by string, server_name string",
    "etl_errors": "error_id bigint, log_id bigint, batch_id bigint, step_name string,"
    f" unique_key string, error_type string, error_message string, {_ERROR_TEXT},"
    " created_at timestamp",
}
DIMENSIONS = ["dim_date", "dim_agency", "dim_location", "dim_complaint_type"]
FACT = "fact_service_requests"
STAGING = "raw_requests"
#: Rows of the fact from which on a write is not rebalanced.
UNMOVED = 2_000_000
#: Years of the fact, or buckets of keys, that a task writes side by side.
OPEN = 16
#: Every writer of the small tables has a partition of its own.
PARTITIONS = {
    FACT: ["year"], "fact_keys": ["key_set", "bucket"], STAGING: ["load_id"], "etl_log": ["log_id"], "etl_errors": ["log_id"], "staged_loads": ["load_id"],
    "processed_loads": ["log_id"], "dim_loads": ["mark"], "fact_loads": ["mark"], "key_sets": ["key_set"], "touched_months": ["log_id"],
    "summary_loads": ["mark"], "load_bits": ["load_id"], "load_profiles": ["load_id"],
}
#: Tables whose partitions are joined into packs, by the partition's column.
PACKED = {
    name: PARTITIONS[name][0]
    for name in (
        "etl_log", "etl_errors", "staged_loads", "processed_loads", "dim_loads", "fact_loads", "touched_months", "summary_loads", "load_bits", "load_profiles",
    )
}


def create_tables(spark: SparkSession, root: str) -> None:
    """Empty tables where there are none yet."""
    with ThreadPoolExecutor(len(SCHEMAS)) as pool:
        list(pool.map(lambda name: _write_empty(spark, root, name, "ignore"), SCHEMAS))


def _write_empty(spark: SparkSession, root: str, name: str, mode: str) -> None:
    empty = spark.createDataFrame([], T.StructType.fromDDL(SCHEMAS[name])).coalesce(1)
    by = PARTITIONS.get(name, [])
    if mode == "overwrite" and name in PACKED:
        drop_packs(spark, root, name)
    writer = empty.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(f"{root}/{name}")


def _own_rows(spark: SparkSession, root: str, name: str) -> DataFrame:
    schema = T.StructType.fromDDL(SCHEMAS[name])
    return spark.read.schema(schema).parquet(f"{root}/{name}").select(*schema.fieldNames())


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table with its declared schema, its packs included."""
    if name in PACKED:
        return with_packs(_own_rows(spark, root, name), root, name, PACKED[name])
    return spark.read.schema(T.StructType.fromDDL(SCHEMAS[name])).parquet(f"{root}/{name}")


def pack_tables(spark: SparkSession, root: str, closed: float = CLOSED) -> dict[str, int]:
    """Joins the closed partitions of the small tables into packs: partitions packed per table."""
    with ThreadPoolExecutor(len(PACKED)) as pool:
        done = pool.map(lambda name: pack(spark, lambda: _own_rows(spark, root, name), root, name, PACKED[name], closed), PACKED)
        return dict(zip(PACKED, done, strict=True))


def save_table(df: DataFrame, root: str, name: str, mode: str = "append", rows: int = 0) -> None:
    """Write in the declared column order and types, partitioned where the table is.

    Partitioned tables are rebalanced on the partition column first: adaptive execution then
    splits a crowded year over many files and joins thin ones, so no year yields tiny files. A fact of
    at least `UNMOVED` rows has enough in every task to be written from where it is.
    """
    schema = T.StructType.fromDDL(SCHEMAS[name])
    shaped = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    by = PARTITIONS.get(name, [])
    if name == "fact_keys" or name == FACT and rows < UNMOVED:
        shaped = shaped.hint("rebalance", *by)
    writer = shaped.write.mode(mode).option("compression", PACKING)
    if not by:
        writer.parquet(f"{root}/{name}")
        return
    with open_files(df.sparkSession, OPEN):
        writer.partitionBy(*by).parquet(f"{root}/{name}")


def save_batch(df: DataFrame, root: str, name: str, by: str, value: int | str) -> None:
    """One partition of a table, replaced as a whole.

    Writers of different partitions never share a folder, so steps can run side by side, and
    writing again replaces what the same step or micro-batch wrote before.
    """
    schema = T.StructType.fromDDL(SCHEMAS[name])
    rows = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name != by])
    rows.write.mode("overwrite").parquet(f"{root}/{name}/{by}={value}", compression=PACKING)


def save_batches(df: DataFrame, root: str, name: str, by: str) -> None:
    """Several partitions of a table in one write; those that `df` has rows of are replaced as a whole."""
    schema = T.StructType.fromDDL(SCHEMAS[name])
    rows = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(f"{root}/{name}")


def save_row(spark: SparkSession, root: str, name: str, values: tuple, by: str, value: int | str) -> None:
    """One row as a partition of its own."""
    schema = T.StructType.fromDDL(SCHEMAS[name])
    row = spark.range(1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, schema.fields, strict=True)])
    save_batch(row, root, name, by, value)


def load_staging(df: DataFrame, root: str, batch_id: int, refresh: bool = True, wait: float = WAIT) -> dict[str, int]:
    """Write request rows to staging under a load id of their own and reconcile: rows that landed against rows read.

    `refresh` clears what was staged before, as one overwrite; otherwise the rows are added. Either
    way they are unread, whatever their batch number. A load sees them once they have all landed; a refresh waits
    for a load that is running, up to `wait` seconds.
    """
    if refresh:
        lease = Lease(df.sparkSession, root).take(wait)
        try:
            return _staged(df, root, batch_id, True)
        finally:
            lease.release()
    return _staged(df, root, batch_id, False)


def _staged(df: DataFrame, root: str, batch_id: int, refresh: bool) -> dict[str, int]:
    load_id = uuid.uuid4().hex
    spark = df.sparkSession
    known = select_known(df)
    if "source_year" not in known.columns:
        known = known.withColumn("source_year", F.lit(None).cast("int"))
    counted = Observation()
    staged = with_audit(known, batch_id, load_id).observe(counted, F.count(F.lit(1)).alias("n"))
    if refresh:
        drop_partitions(spark, root, STAGING)
    save_batch(staged, root, STAGING, "load_id", load_id)  # one folder, so nothing is sorted by it
    landed = read_table(spark, root, STAGING).filter(F.col("load_id") == load_id).count()
    # A source without rows is optimised away with its counter, and is cheap to count.
    read = counted.get["n"] if landed else known.count()
    if landed != read:
        raise RuntimeError(f"{landed} rows of batch {batch_id} landed, {read} were read")
    if refresh:
        _write_empty(spark, root, "staged_loads", "overwrite")
    publish_load(spark, root, load_id, batch_id)
    return {"rows_read": read, "rows_landed": landed}


def drop_partitions(spark: SparkSession, root: str, name: str) -> None:
    """Deletes all rows of a partitioned table."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/{PARTITIONS[name][0]}=*")
    for found in where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where) or []:
        drop_path(spark, found.getPath().toString())


def publish_load(spark: SparkSession, root: str, load_id: str, batch_id: int) -> None:
    """Lets loads see what has landed under a load id. Until then its rows are not pending, so no load takes a part."""
    save_row(spark, root, "staged_loads", (load_id, batch_id), "load_id", load_id)


def publish_loads(spark: SparkSession, root: str, load_ids: list[str], batch_id: int) -> None:
    """Lets loads see what has landed under some load ids."""
    if load_ids:
        rows = spark.createDataFrame([(i, batch_id) for i in load_ids], SCHEMAS["staged_loads"])
        save_batches(rows, root, "staged_loads", "load_id")


def read_staging(spark: SparkSession, root: str) -> DataFrame:
    """Staged rows with the processed flag.

    The flag is kept per load in a small table of its own, so marking rows as processed never
    rewrites them, and that table is joined, not collected.
    """
    done = read_table(spark, root, "processed_loads").select("load_id", F.lit(True).alias("_done")).distinct()
    rows = read_table(spark, root, STAGING).join(done, "load_id", "left")
    return rows.withColumn("stg_is_processed", F.col("_done").isNotNull()).drop("_done")


def pending_loads(spark: SparkSession, root: str) -> DataFrame:
    """Loads that have landed whole and are not marked as processed: load_id and stg_batch_id."""
    done = read_table(spark, root, "processed_loads").select("load_id")
    return read_table(spark, root, "staged_loads").join(done, "load_id", "left_anti")


def rows_of_loads(spark: SparkSession, root: str, loads: DataFrame) -> DataFrame:
    """Staged rows of the given loads."""
    rows = read_table(spark, root, STAGING).join(loads.select("load_id"), "load_id", "left_semi")
    return rows.withColumn("stg_is_processed", F.lit(False))


def reset_warehouse(spark: SparkSession, root: str, reset_flag: bool = False, clear_log: bool = False, wait: float = WAIT) -> DataFrame:
    """Empty the fact, then the dimensions; on request also the flag and the audit tables. A load that runs is
    waited for, up to `wait` seconds."""
    names = [FACT, "fact_keys", "key_sets", "fact_loads", "legacy_location", *DIMENSIONS, "dim_loads", "touched_months", "summary_loads"]
    names += ["processed_loads"] if reset_flag else []
    names += ["etl_errors", "etl_log"] if clear_log else []
    lease = Lease(spark, root).take(wait)
    try:
        for name in names:
            _write_empty(spark, root, name, "overwrite")
    finally:
        lease.release()
    return table_counts(spark, root, [*DIMENSIONS, FACT])


def table_counts(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    from civicmart.operators.sets import union_counts

    return union_counts({n: read_table(spark, root, n) for n in names})
