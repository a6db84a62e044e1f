"""The warehouse load: five logged steps from staging to fact, and its summaries."""

from __future__ import annotations

import getpass
import platform
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import copy_context
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timezone
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicmart.functions.dates import duration_sec
from civicmart.functions.rules import Settings
from civicmart.functions.text import norm_key
from civicmart.operators import dims as D
from civicmart.operators import fact as FA
from civicmart.operators.joins import already_loaded
from civicmart.operators.sets import split_by_tag
from civicmart.session import PACKING, cut, drop_path, scratch
from civicmart.sources.lease import Lease
from civicmart.sources.packs import CLOSED
from civicmart.sources.tables import (
    DIMENSIONS,
    FACT,
    SCHEMAS,
    WAIT,
    create_tables,
    pack_tables,
    pending_loads,
    read_staging,
    read_table,
    rows_of_loads,
    save_batch,
    save_row,
    save_table,
)

# The steps in order; a step's number is its place.
STEPS = ["dim_date", "dim_agency", "dim_location", "dim_complaint_type", "fact_service_requests"]


@dataclass(frozen=True)
class Warehouse:
    """Tables below one root folder, loaded and read with one set of rules.

    Inside a run `lease` is its right to write, and `loads` the staged loads that all its steps read.
    """

    spark: SparkSession
    root: str
    settings: Settings = field(default_factory=Settings)
    lease: Lease | None = None
    loads: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        df = read_table(self.spark, self.root, name)
        return D.refresh_sla(df, self.settings) if name == "dim_agency" else df

    def dims(self, *names: str) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in (names or DIMENSIONS)}

    @property
    def fact(self) -> DataFrame:
        return self.table(FACT)

    @property
    def fact_keys(self) -> FA.StoredKeys:
        """Normalised keys of the requests in the fact, from the table kept beside it."""
        done = self.table("fact_loads").filter("state = 'DONE'").select("log_id").distinct()
        number, depth = key_set(self)
        rows = self.table("fact_keys").filter(F.col("key_set") == number)
        return FA.StoredKeys(rows.join(done, "log_id", "left_semi").select("dedup_key", "bucket"), depth)

    @property
    def staging(self) -> DataFrame:
        return read_staging(self.spark, self.root)

    @property
    def pending(self) -> DataFrame:
        """Staged rows that the run, or else the next one, has to load."""
        return rows_of_loads(self.spark, self.root, self.pending_loads)

    @property
    def pending_loads(self) -> DataFrame:
        return self.loads if self.loads is not None else pending_loads(self.spark, self.root)


def create_warehouse(spark: SparkSession, root: str, settings: Settings | None = None) -> Warehouse:
    """The warehouse below a root folder; tables that are not there yet are made empty."""
    create_tables(spark, root)
    return Warehouse(spark, root, settings or Settings())


@contextmanager
def exclusive(wh: Warehouse, wait: float = WAIT) -> Iterator[Warehouse]:
    """The warehouse with the right to write to it. A run that has it passes it on; any other waits for its turn."""
    if wh.lease:
        yield wh
        return
    lease = Lease(wh.spark, wh.root).take(wait)
    try:
        yield replace(wh, lease=lease)
    finally:
        lease.release()


def alone(step: Callable[..., StepCounts]) -> Callable[..., StepCounts]:
    """A step that writes: under the lease, on loads that are fixed before it reads anything."""

    @wraps(step)
    def run(wh: Warehouse, *args, **kwargs) -> StepCounts:
        with exclusive(wh) as own:
            return step(with_loads(own), *args, **kwargs)

    return run


def with_loads(wh: Warehouse) -> Warehouse:
    """The warehouse with the loads that are pending now. What lands later is left to the next run."""
    return wh if wh.loads is not None else replace(wh, loads=cut(wh.pending_loads, "loads"))


@dataclass
class StepCounts:
    read: int = 0
    inserted: int = 0
    rejected: int = 0
    skipped: int = 0


def today_batch() -> int:
    return int(date.today().strftime("%Y%m%d"))


def logged_step(wh: Warehouse, batch_id: int, name: str, fn: Callable[[int], StepCounts]) -> StepCounts:
    """Run one step; its log row goes from STARTED to SUCCESS or FAILED, and failures are re-raised."""
    number = STEPS.index(name) + 1
    log_id = time.time_ns() // 1000 * 10 + number
    start = datetime.now(timezone.utc)

    def log(status: str, counts: StepCounts | None, error: str | None) -> None:
        log_step(wh, log_id, batch_id, name, number, status, counts, start, error)

    log("STARTED", None, None)
    try:
        counts = fn(log_id)
    except Exception as e:
        log("FAILED", None, str(e))
        raise
    log("SUCCESS", counts, None)
    return counts


def log_step(
    wh: Warehouse, log_id: int, batch_id: int, name: str, number: int, status: str, counts: StepCounts | None,
    start: datetime | None = None, error: str | None = None,
) -> None:
    """One row of the audit log; writing it again under its number replaces it."""
    now = datetime.now(timezone.utc)
    end = None if status == "STARTED" else now
    got = counts or StepCounts()
    row = (
        log_id, batch_id, name, number, status,
        *((got.read, got.inserted, got.rejected, got.skipped) if counts else (None,) * 4),
        start or now, end, None if end is None else duration_sec(F.lit(start or now), F.lit(end)), error, getpass.getuser(), platform.node(),
    )
    save_row(wh.spark, wh.root, "etl_log", row, "log_id", log_id)


@alone
def load_dim_date(wh: Warehouse, log_id: int, batch_id: int) -> StepCounts:
    existing = wh.table("dim_date")
    before = existing.count()
    save_table(D.build_dim_date(wh.spark, wh.settings, existing).coalesce(1), wh.root, "dim_date")
    return StepCounts(inserted=wh.table("dim_date").count() - before, skipped=before)


def _save_members(wh: Warehouse, name: str, key: str, fresh: DataFrame, order: list[str]) -> int:
    """Number the new members, append them, and count what the table gained."""
    before, last = D.rows_and_max_key(wh.table(name), key)
    numbered = D.assign_keys(fresh, key, order, last)
    wh.lease.check()
    save_table(numbered, wh.root, name)
    return wh.table(name).count() - before


def _log_errors(wh: Warehouse, rejects: DataFrame, log_id: int, batch_id: int, step: str) -> int:
    """Log every rejected row, and how many there were."""
    save_batch(FA.error_rows(rejects, log_id, batch_id, step), wh.root, "etl_errors", "log_id", log_id)
    return wh.table("etl_errors").filter(F.col("log_id") == log_id).count()


@alone
def load_dim_agency(wh: Warehouse, log_id: int, batch_id: int) -> StepCounts:
    pending, existing = wh.pending, wh.table("dim_agency")
    staged = cut(D.staged_agencies(pending), "agencies")
    read = staged.count()
    skipped = already_loaded(staged, existing, ["agency_code"]).count()
    fresh = D.new_agencies(staged, wh.settings, existing)
    added = _save_members(wh, "dim_agency", "agency_key", fresh, ["agency_code"])
    rejected = _log_errors(wh, D.agency_rejects(pending), log_id, batch_id, "dim_agency")
    _covered(wh, log_id, "dim_agency")
    return StepCounts(read, added, rejected, skipped)


@alone
def load_dim_location(wh: Warehouse, log_id: int, batch_id: int) -> StepCounts:
    grouped = D.staged_locations(wh.pending, wh.settings)
    tagged = cut(grouped.withColumn("error_type", D.location_error(wh.settings)), "locations")
    valid, failed = split_by_tag(tagged)
    read = tagged.count()
    fresh = D.new_locations(valid.drop("error_type"), wh.table("dim_location"))
    order = ["borough", "community_board", "zip_code"]
    added = _save_members(wh, "dim_location", "location_key", fresh, order)
    rejects = D.location_rejects(failed.drop("error_type"), wh.settings)
    rejected = _log_errors(wh, rejects, log_id, batch_id, "dim_location")
    _covered(wh, log_id, "dim_location")
    return StepCounts(read, added, rejected, read - added - rejected)


@alone
def load_dim_complaint_type(wh: Warehouse, log_id: int, batch_id: int) -> StepCounts:
    pending, existing = wh.pending, wh.table("dim_complaint_type")
    staged = cut(D.staged_complaints(pending), "complaints")
    read = staged.count()
    fresh = D.new_complaints(staged, wh.settings, existing)
    order = ["complaint_type", "descriptor"]
    added = _save_members(wh, "dim_complaint_type", "complaint_key", fresh, order)
    rejected = _log_errors(wh, D.complaint_rejects(pending), log_id, batch_id, "dim_complaint_type")
    _covered(wh, log_id, "dim_complaint_type")
    return StepCounts(read, added, rejected, read - added)


def _covered(wh: Warehouse, log_id: int, step: str) -> None:
    """Notes which loads a dimension has taken in."""
    rows = wh.loads.select("load_id", F.lit(step).alias("step_name"), F.lit(None).cast("string").alias("mark"))
    save_batch(rows.coalesce(1), wh.root, "dim_loads", "mark", f"{log_id}-{step}")


def covered_loads(wh: Warehouse) -> DataFrame:
    """Pending loads that all three dimensions have taken in. Others wait: their rows might miss a member."""
    steps = wh.table("dim_loads").join(wh.pending_loads, "load_id", "left_semi")
    whole = steps.groupBy("load_id").agg(F.countDistinct("step_name").alias("n")).filter(F.col("n") == len(DIMENSIONS) - 1)
    return wh.pending_loads.join(whole, "load_id", "left_semi")


@alone
def load_fact(wh: Warehouse, log_id: int, batch_id: int, strict: bool = True) -> StepCounts:
    """Validate, match, deduplicate and insert all pending rows; log every rejected row.

    Rows of loads that a dimension has not read yet are left to the next run. Rows already in the fact count both
    as skipped and as rejected. If the job dies after the insert, the next run finds the keys in the fact and adds
    nothing twice. `strict=False` is the older load, which leaves rows out without logging them; they count as rejected.
    """
    settle_keys(wh, log_id)
    done = cut(covered_loads(wh).withColumn("log_id", F.lit(log_id)), "loads")
    pending = rows_of_loads(wh.spark, wh.root, done)
    if strict:
        resolved = FA.resolve(pending, wh.dims(*DIMENSIONS[1:]), wh.fact_keys, wh.settings)
        accepted, rejected = split_by_tag(resolved)
        found = {r[0]: r[1] for r in resolved.groupBy("error_type").count().collect()}  # one row per reason
        inserted = found.pop(None, 0)
        read, left_out = inserted + sum(found.values()), sum(found.values())
    else:
        places = wh.table("legacy_location")
        _, last = D.rows_and_max_key(places, "location_key")
        fresh = FA.new_legacy_locations(pending, places)
        save_table(D.assign_keys(fresh, "location_key", FA.LEGACY_PLACE, last), wh.root, "legacy_location")
        dims = wh.dims("dim_agency", "dim_complaint_type") | {"dim_location": wh.table("legacy_location")}
        loose = cut(FA.loose_fact_rows(pending, dims, wh.fact_keys), "loose-rows")
        accepted = loose.withColumnsRenamed({"created_date": "created", "closed_date": "closed"})
        read, inserted, found = pending.count(), loose.count(), {}
        left_out = read - inserted
    wh.lease.check()
    if inserted:
        spread_keys(wh, coming=inserted)
        keys = accepted.select(norm_key(F.col("unique_key")).alias("dedup_key"), F.lit(log_id).alias("log_id"))
        _save_keys(wh, keys, log_id)
        _touched(wh, accepted, log_id)
        wh.lease.check()
        save_table(FA.fact_rows(accepted, batch_id), wh.root, FACT, rows=inserted)
        _mark(wh, log_id, "DONE")
    if strict and left_out:
        _log_errors(wh, rejected, log_id, batch_id, FACT)
    save_batch(done.coalesce(1), wh.root, "processed_loads", "log_id", log_id)
    return StepCounts(read, inserted, left_out, found.get("DUPLICATE_UNIQUE_KEY", 0))


def _touched(wh: Warehouse, accepted: DataFrame, log_id: int) -> None:
    """The months that a load adds rows to, noted before it does; stored summaries are brought up to date from it."""
    months = accepted.select(F.year("created").alias("year"), F.month("created").alias("month"), F.lit(log_id).alias("log_id")).distinct()
    save_batch(months.coalesce(1), wh.root, "touched_months", "log_id", log_id)


def _mark(wh: Warehouse, log_id: int, state: str) -> None:
    """One more state of a load of the fact: KEYS written, rows DONE as well, or DROPPED."""
    save_row(wh.spark, wh.root, "fact_loads", (log_id, state, None), "mark", f"{log_id}-{state}")


def key_set(wh: Warehouse) -> tuple[int, int]:
    """Number and depth of the set of keys in use."""
    last = wh.table("key_sets").agg(F.max(F.struct("key_set", "depth")).alias("s")).first().s
    return (last.key_set, last.depth) if last else (0, 0)


def _save_keys(wh: Warehouse, keys: DataFrame, log_id: int) -> None:
    """Keys are marked before and written before the rows they stand for."""
    _mark(wh, log_id, "KEYS")
    number, depth = key_set(wh)
    save_table(keys.withColumns({"key_set": F.lit(number), "bucket": FA.key_bucket(F.col("dedup_key"), depth)}), wh.root, "fact_keys")


def spread_keys(wh: Warehouse, always: bool = False, coming: int = 0) -> bool:
    """Deals the keys out into more buckets once they hold too many; `always` also to join their files.

    A load does so before it writes its own keys, `coming` of them, so that these are written once.
    The new set is written whole and then named; until then the old one counts. Every key is
    written anew as often as the table doubles, so this costs about one more write of each.
    """
    number, depth = key_set(wh)
    done = wh.table("fact_loads").filter("state = 'DONE'").select("log_id").distinct()
    held = wh.table("fact_keys").filter(F.col("key_set") == number).join(done, "log_id", "left_semi")
    wanted = max(depth, FA.key_depth(held.count() + coming))
    if wanted == depth and not always:
        return False
    fresh = held.select("dedup_key", F.lit(0).cast("bigint").alias("log_id"), FA.key_bucket(F.col("dedup_key"), wanted).alias("bucket"))
    wh.lease.check()
    fresh.hint("rebalance", "bucket").sortWithinPartitions("bucket", "dedup_key").write.mode("overwrite").partitionBy("bucket").parquet(f"{wh.root}/fact_keys/key_set={number + 1}", compression=PACKING)
    _mark(wh, 0, "DONE")
    save_row(wh.spark, wh.root, "key_sets", (number + 1, wanted), "key_set", number + 1)
    drop_path(wh.spark, f"{wh.root}/fact_keys/key_set={number}")
    return True


def compact(wh: Warehouse, closed: float = CLOSED) -> dict[str, int]:
    """Joins small files: partitions of the log, the marks and the rejected rows that were last written over
    `closed` seconds ago, and the files of the key buckets. Says how many partitions of each table it packed.

    Reports may read meanwhile; loads wait.
    """
    with exclusive(wh) as own:
        found = pack_tables(own.spark, own.root, closed)
        if own.table("fact_keys").limit(1).count():
            spread_keys(own, always=True)
        return found


def settle_keys(wh: Warehouse, log_id: int) -> None:
    """After a load that died between its keys and its mark: its keys that the fact has are kept, the others go.

    Only then is the fact scanned.
    """
    ended = wh.table("fact_loads").filter("state <> 'KEYS'").select("log_id")
    broken = wh.table("fact_loads").join(ended, "log_id", "left_anti").select("log_id").distinct()
    ids = [r[0] for r in broken.collect()]  # loads that died since the last one that ended
    if not ids:
        return
    keys = wh.table("fact_keys").filter(F.col("log_id").isin(ids)).select("dedup_key")
    stored = wh.fact.select(norm_key(F.col("unique_key")).alias("dedup_key"))
    held = cut(stored.join(keys, "dedup_key", "left_semi").distinct(), "held-keys")
    own = log_id * 10  # a load of its own, apart from the one that follows
    _save_keys(wh, held.withColumn("log_id", F.lit(own)), own)
    _mark(wh, own, "DONE")
    for broken_id in ids:
        _mark(wh, broken_id, "DROPPED")


LOADERS = {
    "dim_date": load_dim_date,
    "dim_agency": load_dim_agency,
    "dim_location": load_dim_location,
    "dim_complaint_type": load_dim_complaint_type,
    "fact_service_requests": load_fact,
}


def run_all(wh: Warehouse, batch_id: int | None = None, wait: float = WAIT, fact: bool = True) -> dict[str, StepCounts]:
    """All five steps, on the loads that are pending when it begins; without `fact` the dimensions only.

    The dimensions do not depend on each other and load side by side; the fact follows when all of them are done.
    A failed step is logged and stops the run. One run at a time: another one waits, up to `wait` seconds.
    """
    batch = today_batch() if batch_id is None else batch_id
    with scratch(wh.spark), exclusive(wh, wait) as own, ThreadPoolExecutor(len(STEPS) - 1) as pool:
        own = with_loads(own)

        def run(name: str) -> StepCounts:
            return logged_step(own, batch, name, lambda log_id: LOADERS[name](own, log_id, batch))

        # Each thread gets the context, and with it the scratch folder, of this run.
        started = {name: pool.submit(copy_context().run, run, name) for name in STEPS[:-1]}
        counts = {name: done.result() for name, done in started.items()}
        return counts | ({STEPS[-1]: run(STEPS[-1])} if fact else {})


def run_summary(log: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Every step run of a batch, in step order."""
    rows = log if batch_id is None else log.filter(F.col("batch_id") == batch_id)
    shown = [
        "step_number", "step_name", "status", "rows_read", "rows_inserted", "rows_skipped", "rows_rejected",
        "duration_sec", "error_message", "log_id",
    ]
    return rows.select(*shown).orderBy("step_number", "log_id")


def error_summary(errors: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Rejected rows per step and reason with one example message."""
    rows = errors if batch_id is None else errors.filter(F.col("batch_id") == batch_id)
    per_message = rows.groupBy("step_name", "error_type", "error_message").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_message.groupBy("step_name", "error_type")
        .agg(F.sum("n").alias("error_count"), F.min("error_message").alias("example_message"))
        .orderBy("step_name", F.desc("error_count"), "error_type")
    )
