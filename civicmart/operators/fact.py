"""Fact load: row checks, dimension match, exact deduplication."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicmart.functions.dates import date_key, parse_coord, parse_ts, resolution_days
from civicmart.functions.rules import Settings, in_calendar, normalise_status, valid_status
from civicmart.functions.text import blank_norm_key, error_text, is_blank, norm_key
from civicmart.operators.joins import attach_by_coords, attach_dims
from civicmart.operators.sets import split_by_tag
from civicmart.session import cut

# Reject reasons in the order the checks run; the first that fails is reported.
CHECK_ORDER = [
    "NULL_UNIQUE_KEY", "CITY_MISSING", "INVALID_CREATED_DATE", "DATE_OUT_OF_RANGE",
    "NEGATIVE_RESOLUTION", "INVALID_STATUS", "NO_DIM_AGENCY_MATCH", "NO_DIM_LOCATION_MATCH",
    "NO_DIM_COMPLAINT_MATCH", "DUPLICATE_UNIQUE_KEY", "DUPLICATE_IN_BATCH",
]
STAGED_COLUMNS = [
    "load_id", "stg_row_id", "unique_key", "created_date", "closed_date", "agency", "borough", "incident_zip",
    "complaint_type", "descriptor", "latitude", "longitude", "status", "city", "community_board",
]
# Of two rows with one key, the later created one stays; these settle ties, greatest value first.
KEEP_ORDER = [
    "created", "closed", "raw_status", "raw_agency", "raw_borough", "raw_zip", "raw_complaint",
    "raw_descriptor", "raw_latitude", "raw_longitude", "raw_board", "load_id", "stg_row_id",
]
# Stored keys lie in 2^depth buckets of their hash; a set of keys that outgrows this many per bucket is dealt out anew.
KEYS_PER_BUCKET = 1 << 20
# Rows of repeated keys that meet the rows wherever these are read; with more of them the judged rows are stored once instead.
MARKS_MET = 100_000
# Pages of 32,768 bits, one bit per checked row, that are sent to every task with the decisions on repeats; more of them meet the rows by page.
PAGES_SENT = 1 << 14
# Messages of the two checks of repeats.
REPEAT_MESSAGES = {
    "DUPLICATE_UNIQUE_KEY": "unique_key already exists in fact_service_requests — skipped",
    "DUPLICATE_IN_BATCH": "unique_key occurs again in this batch — another row was kept",
}


def parsed(staged: DataFrame) -> DataFrame:
    """Staged rows with parsed dates, date key and normalised status next to the raw text."""
    rows = staged.select(*STAGED_COLUMNS).withColumns(
        {"created": parse_ts(F.col("created_date")), "closed": parse_ts(F.col("closed_date"))}
    )
    return rows.withColumns(
        {"date_key": date_key(F.col("created")), "norm_status": normalise_status(F.col("status"))}
    )


def row_checks(settings: Settings) -> list[tuple[str, Column, Column]]:
    """(reason, failing test, message) of each check that needs only the row itself."""
    low, high = settings.key_range
    years = f"{settings.first_day[:4]}-{settings.last_day[:4]}"
    present = ~is_blank(F.col("borough")) & ~is_blank(F.col("incident_zip"))
    present &= F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return [
        (
            "NULL_UNIQUE_KEY",
            is_blank(F.col("unique_key")),
            F.lit("unique_key is NULL or blank — cannot load to fact table"),
        ),
        (
            "CITY_MISSING",
            present & is_blank(F.col("city")),
            F.lit("borough, incident_zip, latitude and longitude present but city is NULL/blank"),
        ),
        (
            "INVALID_CREATED_DATE",
            F.col("created").isNull(),
            error_text("created_date cannot be parsed as DATETIME: [", F.col("created_date"), "]"),
        ),
        (
            "DATE_OUT_OF_RANGE",
            ~in_calendar(F.col("date_key"), low, high),
            error_text(
                "created_date ", F.col("created_date"), " produces date_key ", F.col("date_key"),
                f" not in dim_date ({years})",
            ),
        ),
        (
            "NEGATIVE_RESOLUTION",
            F.col("closed") < F.col("created"),
            error_text(
                "closed_date [", F.col("closed_date"), "] is before created_date [", F.col("created_date"), "]"
            ),
        ),
        (
            "INVALID_STATUS",
            ~valid_status(F.col("norm_status")),
            error_text(
                "status value [", F.col("norm_status"),
                "] not in allowed list (Open/Closed/Pending/In Progress/Assigned/Unspecified)",
            ),
        ),
    ]


def match_checks() -> list[tuple[str, Column, Column]]:
    return [
        (
            "NO_DIM_AGENCY_MATCH",
            F.col("agency_key").isNull(),
            error_text("agency code [", F.col("agency"), "] not found in dim_agency"),
        ),
        (
            "NO_DIM_LOCATION_MATCH",
            F.col("location_key").isNull(),
            F.lit("borough/zip/lat/long combo not found in dim_location"),
        ),
        (
            "NO_DIM_COMPLAINT_MATCH",
            F.col("complaint_key").isNull(),
            F.lit("complaint_type/descriptor combo not found in dim_complaint_type"),
        ),
    ]


def first_error(checks: list[tuple[str, Column, Column]]) -> tuple[Column, Column]:
    """Reason and message of the first failing check; both NULL when all pass."""
    reason = F.coalesce(*[F.when(test, F.lit(name)) for name, test, _ in checks])
    message = F.lit(None).cast("string")
    for name, _, text in reversed(checks):
        message = F.when(F.col("error_type") == name, text).otherwise(message)
    return reason, message


def tag_rows(staged: DataFrame, dims: dict[str, DataFrame], settings: Settings) -> DataFrame:
    """Every staged row with its dimension keys and the first failing check, if any.

    No row leaves the frame, and with broadcast dimensions nothing is shuffled.
    """
    checks = row_checks(settings) + match_checks()
    matched = attach_dims(parsed(staged), dims)
    reason, message = first_error(checks)
    tagged = matched.withColumn("error_type", reason).withColumn("error_message", message)
    mapped = F.col("error_type").isin(CHECK_ORDER[6:9])
    return tagged.select(
        "load_id", "stg_row_id", "unique_key", "created", "closed", "date_key",
        "agency_key", "location_key", "complaint_key",
        F.col("norm_status").alias("status"),
        F.col("agency").alias("raw_agency"),
        F.col("borough").alias("raw_borough"),
        F.col("incident_zip").alias("raw_zip"),
        F.col("complaint_type").alias("raw_complaint"),
        F.col("descriptor").alias("raw_descriptor"),
        F.col("community_board").alias("raw_board"),
        F.col("created_date").alias("raw_created"),
        F.col("closed_date").alias("raw_closed"),
        F.col("latitude").alias("raw_latitude"),
        F.col("longitude").alias("raw_longitude"),
        F.when(mapped, F.col("norm_status")).otherwise(F.col("status")).alias("raw_status"),
        "error_type", "error_message",
    )


class StoredKeys(NamedTuple):
    """The fact's normalised keys (dedup_key, bucket) and the number of bits of their hash that a bucket stands for."""

    rows: DataFrame
    depth: int


def key_bucket(key: Column, depth: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << depth)).cast("int")


def key_depth(keys: int) -> int:
    """The least depth at which buckets hold no more than `KEYS_PER_BUCKET` keys on average."""
    return max(0, -(-keys // KEYS_PER_BUCKET) - 1).bit_length()


def key_counts(keyed: DataFrame) -> DataFrame:
    """Rows per key. Each task first counts its own rows, so a crowded key costs one row per task."""
    return keyed.groupBy("dedup_key").agg(F.count(F.lit(1)).alias("copies"))


def known_keys(counts: DataFrame, keys: StoredKeys) -> DataFrame:
    """Keys of the batch that the fact has.

    Of the stored keys only the buckets of the batch are read. A bucket has a bounded size whatever the history
    holds, so a small batch reads as much of a long history as of a short one.
    """
    buckets = [r[0] for r in counts.select(key_bucket(F.col("dedup_key"), keys.depth)).distinct().collect()]  # at most 2^depth
    near = keys.rows.filter(F.col("bucket").isin(buckets)).select("dedup_key")
    return near.join(counts.select("dedup_key"), "dedup_key", "left_semi").distinct()


def repeated_keys(counts: DataFrame, keys: StoredKeys) -> DataFrame:
    """Keys that need a decision: in the fact already, or more than once in the batch."""
    known = known_keys(counts, keys).withColumn("_loaded", F.lit(True))
    is_loaded = F.col("_loaded").isNotNull()
    flagged = counts.join(known, "dedup_key", "left").filter(is_loaded | (F.col("copies") > 1))
    return flagged.select("dedup_key", is_loaded.alias("is_loaded"), "copies")


def verdicts(met: DataFrame) -> DataFrame:
    """The rows that must go, by their identity, with the reason.

    `met` holds only rows of repeated keys, and of them only what the decision needs. A key the fact
    has loses all its rows, any other key keeps the greatest.
    """
    fresh = met.filter(~F.col("is_loaded"))
    winners = fresh.groupBy("dedup_key").agg(F.max(F.struct(*KEEP_ORDER)).alias("w"))
    winners = winners.select("dedup_key", F.col("w.load_id").alias("_load"), F.col("w.stg_row_id").alias("_row"))
    kept = (F.col("load_id") == F.col("_load")) & (F.col("stg_row_id") == F.col("_row"))
    beaten = fresh.join(winners, "dedup_key").filter(~kept)
    mark = lambda rows, reason: rows.select("load_id", "stg_row_id", F.lit(reason).alias("mark"))
    return mark(met.filter("is_loaded"), "DUPLICATE_UNIQUE_KEY").unionByName(mark(beaten, "DUPLICATE_IN_BATCH"))


def for_verdicts(tagged: DataFrame) -> DataFrame:
    """Checked rows with what the decision on repeats needs; of rows that failed only the reason is left."""
    passed = F.col("error_type").isNull()
    names = dict.fromkeys(["unique_key", "status", *KEEP_ORDER])
    return tagged.select(*[F.when(passed, F.col(n)).alias(n) for n in names], "error_type", F.lit(None).cast("string").alias("error_message"))


def resolve(staged: DataFrame, dims: dict[str, DataFrame], keys: StoredKeys, settings: Settings, whole: bool = True) -> DataFrame:
    """All staged rows, each with its final verdict in `error_type` (NULL: goes to the fact).

    Who asks for the verdicts alone (`whole=False`) gets them without messages and without the text of failed rows.

    `keys` are the fact's keys from before the load. The checked rows are stored once, each with a number of its own.
    Few rows of repeated keys are decided on as narrow rows and come back to the full rows by row identity, which no two
    rows share, wherever the result is read; that is cheaper than a second copy of the rows. Many, which would shuffle the
    rows at every read, come back as bits by row number, so that no full row is shuffled, and only the rows that passed the
    checks are stored again.
    """
    tagged = tag_rows(staged, dims, settings)
    checked = cut((tagged if whole else for_verdicts(tagged)).withColumn("_at", F.monotonically_increasing_id()), "checked")
    candidates, failed = split_by_tag(checked)
    keyed = candidates.select(norm_key(F.col("unique_key")).alias("dedup_key"), *KEEP_ORDER)
    if keys.rows.limit(1).count():
        repeated = cut(repeated_keys(cut(key_counts(keyed), "counts"), keys), "repeated")
        copies = _copies(repeated)
    else:  # a first load has no stored keys to meet
        repeated, copies = _repeated_in_batch(keyed)
    if copies > MARKS_MET:
        rows = _decided(candidates, repeated)
        judged = cut(_marked(rows).select(*checked.columns).drop("_at"), "judged")
        # A reason that Catalyst knows is there: who asks for the rows without one does not read the failed ones.
        return judged.unionByName(failed.withColumn("error_type", F.coalesce(F.col("error_type"), F.lit(""))).drop("_at"))
    met = cut(keyed.join(repeated.drop("copies"), "dedup_key"), "met")
    marks = cut(verdicts(met), "marks")
    return _marked(checked.join(marks, ["load_id", "stg_row_id"], "left")).drop("mark", "_at")


def _copies(repeated: DataFrame) -> int:
    return repeated.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]


def _repeated_in_batch(keyed: DataFrame) -> tuple[DataFrame | None, int]:
    """Keys that occur more than once in the batch, and how many rows they have; of many rows only the number.

    Rows are counted by a hash of their key, and only those whose hash repeats by the key itself.
    """
    hashed = F.xxhash64("dedup_key").alias("_hash")
    near = cut(keyed.groupBy(hashed).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1), "near")
    copies = _copies(near)
    if copies > MARKS_MET:
        return None, copies
    rows = keyed.select("dedup_key", hashed).join(near.select("_hash"), "_hash", "left_semi")
    repeated = key_counts(rows).filter(F.col("copies") > 1).select("dedup_key", F.lit(False).alias("is_loaded"), "copies")
    return cut(repeated, "repeated"), copies


def _decided(candidates: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """The rows that passed the checks, with the verdict on repeats in `mark`. Without `repeated` no key is in the fact."""
    rows = candidates.withColumn("dedup_key", norm_key(F.col("unique_key")))
    loaded = None if repeated is None else repeated.filter("is_loaded").select("dedup_key")
    mark = F.lit(None).cast("string")
    if repeated is None or repeated.filter("NOT is_loaded").limit(1).count():
        rows = with_bit(rows, staying(rows), "_stays")
        mark = F.when(~F.col("_stays"), "DUPLICATE_IN_BATCH")
    if loaded is not None and loaded.limit(1).count():
        known = candidates.select(norm_key(F.col("unique_key")).alias("dedup_key"), "_at").join(loaded, "dedup_key", "left_semi")
        rows = with_bit(rows, known.select("_at"), "_loaded")
        mark = F.when(F.col("_loaded"), "DUPLICATE_UNIQUE_KEY").otherwise(mark)
    return rows.withColumn("mark", mark)


def staying(rows: DataFrame) -> DataFrame:
    """The number of the row of each key that stays.

    Rows meet as a hash of their key and one of all they hold, besides their identity, and each task first joins its own, so a
    crowded key costs one row per task. Where all rows of a hash hold the same, their identity decides.
    Only of keys whose rows differ the rows themselves are compared, by the key and not its hash.
    """
    own = [n for n in rows.columns if n not in ("load_id", "stg_row_id", "_at")]
    holds = F.xxhash64(F.array(*[F.col(n).isNull() for n in own]), *own)  # a hash passes over what is missing
    met = rows.select(F.xxhash64("dedup_key").alias("_hash"), holds.alias("_holds"), F.struct("load_id", "stg_row_id", "_at").alias("_own"))
    per_hash = met.groupBy("_hash").agg(F.min("_holds").alias("_least"), F.max("_holds").alias("_most"), F.max("_own").alias("_own"))
    same = F.col("_least") == F.col("_most")
    found = cut(per_hash.select(F.when(~same, F.col("_hash")).alias("_hash"), F.when(same, F.col("_own._at")).alias("_at")), "per-hash")
    differ, alike = found.filter(F.col("_hash").isNotNull()).select("_hash"), found.filter(F.col("_at").isNotNull()).select("_at")
    if not differ.limit(1).count():
        return alike
    unlike = rows.select("dedup_key", *KEEP_ORDER, "_at", F.xxhash64("dedup_key").alias("_hash")).join(differ, "_hash", "left_semi")
    winners = unlike.groupBy("dedup_key").agg(F.max(F.struct(*KEEP_ORDER, "_at")).alias("w"))
    return alike.unionByName(winners.select(F.col("w._at").alias("_at")))


def with_bit(rows: DataFrame, numbers: DataFrame, name: str) -> DataFrame:
    """The rows with a column that says whether their number `_at` is among these.

    The numbers travel as bits in pages of 32,768. Row numbers are dense, so a page stands for about as many rows.
    """
    page, place = F.bitmap_bucket_number("_at"), F.bitmap_bit_position("_at")
    pages = cut(numbers.groupBy(page.alias("_page")).agg(F.bitmap_construct_agg(place).alias("_bits")), f"pages{name}")
    pages = F.broadcast(pages) if pages.count() <= PAGES_SENT else pages
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.expr("shiftright(_byte, cast(_place % 8 as int)) & 1") == 1, F.lit(False))
    met = rows.withColumns({"_page": page, "_place": place}).join(pages, "_page", "left")
    return met.withColumn("_byte", byte).withColumn(name, is_set).drop("_page", "_place", "_bits", "_byte")


def _marked(rows: DataFrame) -> DataFrame:
    """Checked rows with the verdict on repeats in `mark` taken into reason, message and status."""
    mark = F.col("mark")
    message = F.coalesce(*[F.when(mark == reason, F.lit(text)) for reason, text in REPEAT_MESSAGES.items()])
    # The log shows the mapped status for rows that reached the check of repeats.
    return rows.withColumns(
        {
            "error_type": F.coalesce(F.col("error_type"), mark),
            "error_message": F.coalesce(F.col("error_message"), message),
            "raw_status": F.when(mark.isNotNull(), F.col("status")).otherwise(F.col("raw_status")),
        }
    )


def fact_rows(accepted: DataFrame, batch_id: int) -> DataFrame:
    """Accepted rows in the shape of the fact table.

    `request_key` is a hash of the business key, which stays the identity of a request.
    """
    return accepted.select(
        F.xxhash64(norm_key(F.col("unique_key"))).alias("request_key"),
        F.trim(F.col("unique_key")).alias("unique_key"),
        "date_key", "agency_key", "location_key", "complaint_key",
        F.col("created").alias("created_date"),
        F.col("closed").alias("closed_date"),
        "status",
        resolution_days(F.col("created"), F.col("closed")).alias("resolution_days"),
        F.current_timestamp().alias("dw_created_date"),
        F.lit(batch_id).cast("bigint").alias("dw_batch_id"),
        F.year(F.col("created")).alias("year"),
    )


def error_rows(rejected: DataFrame, log_id: int, batch_id: int, step: str) -> DataFrame:
    """Rejected rows in the shape of the error log; columns a step lacks are NULL."""
    names = [
        "unique_key", "error_type", "error_message", "raw_agency", "raw_borough", "raw_complaint",
        "raw_created", "raw_closed", "raw_latitude", "raw_longitude", "raw_status",
    ]
    shown = [F.col(c) if c in rejected.columns else F.lit(None).cast("string").alias(c) for c in names]
    return rejected.select(
        F.monotonically_increasing_id().alias("error_id"),
        F.lit(log_id).cast("bigint").alias("log_id"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.lit(step).alias("step_name"),
        *shown,
        F.current_timestamp().alias("created_at"),
    )


def stage_counts(resolved: DataFrame) -> DataFrame:
    """Rows per verdict; rows that go to the fact are LOADED."""
    tag = F.coalesce(F.col("error_type"), F.lit("LOADED"))
    return resolved.groupBy(tag.alias("outcome")).agg(F.count(F.lit(1)).alias("row_count"))


def loose_fact_rows(staged: DataFrame, dims: dict[str, DataFrame], keys: StoredKeys) -> DataFrame:
    """The older one-pass load: inner joins by coordinates, guards, no error log, one row per key.

    Rows that miss a guard or a dimension are left out without a reason, and so are keys the fact
    has. The status is only trimmed, with 'Unknown' for a missing one. Of copies of a key the latest
    created stays, whatever number of positions it matches.
    """
    day = F.datediff(F.to_date(parse_ts(F.col("closed_date"))), F.to_date(parse_ts(F.col("created_date"))))
    guarded = staged.filter(
        F.col("unique_key").isNotNull()
        & F.col("agency").isNotNull()
        & F.col("borough").isNotNull()
        & (norm_key(F.col("borough")) != "UNSPECIFIED")
        & parse_ts(F.col("created_date")).isNotNull()
        & (F.coalesce(day, F.lit(0)) >= 0)
    )
    agency = dims["dim_agency"].select("agency_key", norm_key(F.col("agency_code")).alias("_agency"))
    complaint = dims["dim_complaint_type"].select(
        "complaint_key",
        norm_key(F.col("complaint_type")).alias("_complaint"),
        norm_key(F.col("descriptor")).alias("_descriptor"),
    )
    keyed = guarded.withColumns(
        {
            "_agency": norm_key(F.col("agency")),
            "_complaint": norm_key(F.col("complaint_type")),
            "_descriptor": norm_key(F.col("descriptor")),
        }
    )
    matched = attach_by_coords(
        keyed.join(agency, "_agency").join(complaint, ["_complaint", "_descriptor"]), least_of_position(dims["dim_location"])
    )
    created = parse_ts(F.col("created_date"))
    rows = matched.select(
        norm_key(F.col("unique_key")).alias("dedup_key"),
        "load_id", "stg_row_id",
        F.col("unique_key"),
        date_key(created).alias("date_key"),
        "agency_key", "location_key", "complaint_key",
        created.alias("created_date"),
        parse_ts(F.col("closed_date")).alias("closed_date"),
        F.trim(F.coalesce(F.col("status"), F.lit("Unknown"))).alias("status"),
    )
    matched = cut(rows, "loose")
    known = known_keys(key_counts(matched), keys)
    fresh = matched.join(known, "dedup_key", "left_anti")
    # Decided on what orders the rows and tells them apart; a row may have matched several positions.
    order = ["created_date", "closed_date", "status", "load_id", "stg_row_id"]
    place = (-F.col("location_key")).alias("_place")
    best = fresh.groupBy("dedup_key").agg(F.max(F.struct(*order, place)).alias("b"))
    kept = best.select(F.col("b.load_id").alias("load_id"), F.col("b.stg_row_id").alias("stg_row_id"), (-F.col("b._place")).alias("location_key"))
    identity = ["load_id", "stg_row_id", "location_key"]
    return matched.join(kept, identity, "left_semi").drop("dedup_key", "load_id", "stg_row_id")


def least_of_position(location: DataFrame) -> DataFrame:
    """One location per position that rows are matched by, the least key. Places that differ in board or city share
    a position; a row that met them all would be there as often, and the least key is the one that stays."""
    zip_code = blank_norm_key(F.col("zip_code"))
    return location.groupBy("borough", zip_code.alias("zip_code"), "latitude", "longitude").agg(F.min("location_key").alias("location_key"))


LEGACY_PLACE = ["borough", "community_board", "zip_code", "city", "latitude", "longitude"]


def new_legacy_locations(staged: DataFrame, existing: DataFrame) -> DataFrame:
    """Places of staged rows that the older load's own location table does not have."""
    fresh = staged_legacy_locations(staged)
    known = existing.select(*[F.col(c).alias(f"_{c}") for c in LEGACY_PLACE])
    same = F.lit(True)
    for c in LEGACY_PLACE:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return fresh.join(known, same, "left_anti")


def staged_legacy_locations(staged: DataFrame) -> DataFrame:
    """Locations of the older load: one row per distinct place and position."""
    rows = staged.filter(F.col("borough").isNotNull() & (norm_key(F.col("borough")) != "UNSPECIFIED"))
    return rows.select(
        norm_key(F.col("borough")).alias("borough"),
        F.trim(F.col("community_board")).alias("community_board"),
        F.trim(F.col("incident_zip")).alias("zip_code"),
        F.trim(F.col("city")).alias("city"),
        parse_coord(F.col("latitude")).alias("latitude"),
        parse_coord(F.col("longitude")).alias("longitude"),
    ).distinct()
