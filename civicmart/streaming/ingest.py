"""Request files as they arrive: resumable ingest, checks and fact load per micro-batch."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from civicmart.functions.dates import parse_ts
from civicmart.functions.text import is_blank, norm_key
from civicmart.operators.fact import CHECK_ORDER, first_error, parsed, row_checks, tag_rows
from civicmart.plans.warehouse import StepCounts, Warehouse, log_step, run_all
from civicmart.sources.raw import RAW_SCHEMA, select_known, trim_all, with_audit
from civicmart.sources.tables import STAGING, publish_load, read_table, save_batch


def read_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000, multiline: bool = False) -> DataFrame:
    """Request files of a folder as a stream; empty fields are NULL.

    The progress of the read lives in the query's checkpoint, so a stopped run goes on with the
    first file it has not finished. A stream has one schema: a file whose header differs from it
    stops the query instead of being misread. `multiline` allows line breaks inside quotes and
    reads each file in one task.
    """
    rows = (
        spark.readStream.schema(RAW_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multiline)
        .option("escape", '"')
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    return rows.select([F.nullif(F.col(c), F.lit("")).alias(c) for c in RAW_SCHEMA.names])


def ingest_stream(wh: Warehouse, folder: str, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Land every file not seen before in staging, then stop.

    Each micro-batch owns one staging partition and replaces it, so a batch that is replayed
    after a crash lands once.
    """

    def land(batch: DataFrame, epoch: int) -> None:
        _stage(wh, batch, epoch, checkpoint)

    return _run(read_stream(wh.spark, folder, files_per_batch), land, checkpoint)


def load_stream(wh: Warehouse, folder: str, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Land, validate and load every file not seen before, then stop.

    A micro-batch is a normal incremental load: rows are checked, keys the fact already has are
    skipped and logged, and copies inside the batch are resolved. A replayed batch finds its
    keys in the fact, so nothing is loaded twice.
    """

    def load(batch: DataFrame, epoch: int) -> None:
        _stage(wh, batch, epoch, checkpoint)
        run_all(wh, epoch)

    return _run(read_stream(wh.spark, folder, files_per_batch), load, checkpoint)


def _stage(wh: Warehouse, batch: DataFrame, epoch: int, checkpoint: str) -> None:
    """Land one micro-batch under (query, epoch): a replay keeps that load id, another stream never has it."""
    query = F.get_json_object("value", "$.id")
    query_id = wh.spark.read.text(f"{checkpoint}/metadata").select(query).first()[0]
    load_id = f"{query_id}-{epoch}"
    known = select_known(batch).withColumn("source_year", F.lit(None).cast("int"))
    save_batch(with_audit(trim_all(known), epoch, load_id), wh.root, STAGING, "load_id", load_id)
    publish_load(wh.spark, wh.root, load_id, epoch)


def _run(rows: DataFrame, each, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def checked_stream(rows: DataFrame, wh: Warehouse) -> DataFrame:
    """The checks that need only the row, on a stream: reason and message, or NULL."""
    identity = {"stg_row_id": F.lit(None).cast("bigint"), "load_id": F.lit(None).cast("string")}
    tagged = parsed(rows.withColumns(identity))
    reason, message = first_error(row_checks(wh.settings))
    return tagged.withColumn("error_type", reason).withColumn("error_message", message)


OBSERVED = "checks"
#: Every reason a row alone or with its dimensions can be rejected for.
REASONS = CHECK_ORDER[:9]


def judged_stream(rows: DataFrame, wh: Warehouse) -> DataFrame:
    """All checks and dimension keys on a stream: the rows of a batch load's check, with counts observed.

    The dimensions are the tables as they stand when a micro-batch begins to read them; none is collected. Every
    micro-batch counts its rows by reason on the way, without a second pass.
    """
    identity = {"stg_row_id": F.lit(None).cast("bigint"), "load_id": F.lit(None).cast("string")}
    tagged = tag_rows(rows.withColumns(identity), wh.dims("dim_agency", "dim_location", "dim_complaint_type"), wh.settings)
    per_reason = [F.count_if(F.col("error_type") == reason).alias(reason) for reason in REASONS]
    return tagged.observe(OBSERVED, F.count(F.lit(1)).alias("rows_read"), F.count_if(F.col("error_type").isNull()).alias("VALID"), *per_reason)


class CheckCounts(StreamingQueryListener):
    """What the micro-batches of one query observed, by their number."""

    def __init__(self, wanted: str | None = None):
        self.wanted, self.held = wanted, {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.take(event.progress)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def take(self, progress) -> None:
        counts = progress.observedMetrics.get(OBSERVED)
        if counts is not None and counts["rows_read"]:
            self.held[str(progress.id), progress.batchId] = counts.asDict()

    def of(self, query_id: str) -> dict[int, dict]:
        return {batch: counts for (query, batch), counts in sorted(self.held.items()) if query == query_id}


def check_stream(wh: Warehouse, folder: str, checkpoint: str, out: str, files_per_batch: int = 1000) -> dict[int, dict]:
    """Check every file not seen before, write the judged rows to `out`, log each micro-batch as a step, then stop.

    Returns the counts by micro-batch. The log row of a micro-batch has a number of its own that follows from the
    query and the batch, so a replayed batch replaces it.
    """
    spark = wh.spark
    counts = CheckCounts()
    spark.streams.addListener(counts)
    try:
        rows = judged_stream(read_stream(spark, folder, files_per_batch), wh)
        query = (
            rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        for progress in query.recentProgress:
            counts.take(progress)
        last, until = query.lastProgress, time.monotonic() + 30
        while last and last.numInputRows and last.batchId not in counts.of(str(query.id)) and time.monotonic() < until:
            time.sleep(0.1)  # events arrive after the query has ended
    finally:
        spark.streams.removeListener(counts)
    seen = counts.of(str(query.id))
    for batch, found in seen.items():
        rejected = found["rows_read"] - found["VALID"]
        log_step(wh, query_log_id(str(query.id), batch), batch, "checked_stream", 0, "SUCCESS", StepCounts(found["rows_read"], 0, rejected, 0))
    return seen


def query_log_id(query_id: str, batch: int) -> int:
    """A number for one micro-batch of one query."""
    return (int(query_id.replace("-", "")[:8], 16) << 30) + batch


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_ever(rows: DataFrame, spread: int = 8) -> DataFrame:
    """The first row of each key over all time, whatever its dates; rows without a key all stay.

    Late and undated rows count like any other, since no event time is asked for. State holds every key ever seen,
    so keep it on disk (`state_on_disk`). Copies are first dropped among rows that were read by the same share of
    tasks, which leaves at most `spread` rows of a crowded key, ever, to meet in one task.
    """
    keyed = rows.withColumn("dedup_key", norm_key(F.col("unique_key")))
    blank = is_blank(F.col("unique_key"))
    parted = keyed.filter(~blank).withColumn("_part", F.spark_partition_id() % spread)
    once = parted.dropDuplicates(["dedup_key", "_part"]).drop("_part").dropDuplicates(["dedup_key"])
    return once.unionByName(keyed.filter(blank))


def state_on_disk(spark: SparkSession) -> None:
    """State of streams that are started from now on is kept in RocksDB instead of the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def first_of_key(rows: DataFrame, delay: str) -> DataFrame:
    """The first row of each key, while copies arrive at most `delay` apart in event time.

    State holds only the keys inside the watermark, which suits a feed whose copies come close together. Rows
    without a readable creation date have no event time; `first_ever` takes them, and copies of any age.
    """
    timed = rows.withColumns(
        {"event_time": parse_ts(F.col("created_date")).cast("timestamp"), "dedup_key": norm_key(F.col("unique_key"))}
    )
    return timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["dedup_key"])


def staged_batches(wh: Warehouse) -> DataFrame:
    """Rows per landed load; a stream's loads are its micro-batches."""
    rows = read_table(wh.spark, wh.root, STAGING)
    return rows.groupBy("load_id", "stg_batch_id").agg(F.count(F.lit(1)).alias("rows_landed"))
