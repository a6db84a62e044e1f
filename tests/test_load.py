"""The warehouse load, check by check."""

import pytest
from conftest import GOOD, column
from pyspark.sql import functions as F

from civicmart.functions.rules import Settings, legacy_settings
from civicmart.operators import dims as D
from civicmart.operators import fact as FA
from civicmart.plans import verify as V
from civicmart.plans import warehouse as W
from civicmart.plans.mart import register_views, service_requests_mart, write_summaries
from civicmart.session import cut, fresh_path
from civicmart.sources import tables as T
from civicmart.sources.raw import RAW_COLUMNS, RAW_SCHEMA

BAD_ROWS = {
    "NULL_UNIQUE_KEY": {"unique_key": "  "},
    "CITY_MISSING": {"unique_key": "10", "city": " "},
    "INVALID_CREATED_DATE": {"unique_key": "11", "created_date": "not a date"},
    "DATE_OUT_OF_RANGE": {"unique_key": "12", "created_date": "2019-12-31T00:00:00.000", "closed_date": None},
    "NEGATIVE_RESOLUTION": {"unique_key": "13", "closed_date": "2024-05-20T07:13:59.000"},
    "INVALID_STATUS": {"unique_key": "14", "status": "Bogus"},
    "NO_DIM_AGENCY_MATCH": {"unique_key": "15", "agency": None},
    "NO_DIM_LOCATION_MATCH": {"unique_key": "16", "borough": "Unspecified"},
    "NO_DIM_COMPLAINT_MATCH": {"unique_key": "17", "complaint_type": None},
}


def loaded(spark, folder, rows, batch=20240601, settings=None):
    wh = W.create_warehouse(spark, folder, settings)
    T.load_staging(rows, folder, batch)
    return wh, W.run_all(wh, batch)


def errors(wh):
    return dict(column(wh.table("etl_errors").filter(F.col("step_name") == T.FACT), "unique_key", "error_type"))


EVERY_FAULT = {"created_date": "x", "status": "Bogus", "agency": None, "borough": None}
MORE_ROWS = [
    {},
    {"unique_key": "1", "status": "Open", "created_date": "2024-05-19T07:14:00.000"},
    {**EVERY_FAULT, "unique_key": "20"},
    {**EVERY_FAULT, "unique_key": "21", "created_date": "2024-05-20T07:14:00.000"},
    {"unique_key": "22", "city": None, "latitude": None},
    {"unique_key": "23", "closed_date": "soon"},
    {
        "unique_key": "24", "agency": " nypd ", "borough": "brooklyn ", "complaint_type": "NOISE - residential",
        "descriptor": " banging/pounding", "community_board": "02 brooklyn",
    },
    {"unique_key": "25", "descriptor": None, "complaint_type": "Rodent"},
    {"unique_key": "26", "descriptor": " ", "complaint_type": "rodent"},
    {"unique_key": "27", "agency": "ZZ", "agency_name": "Zed B"},
    {"unique_key": "28", "agency": "zz", "agency_name": "Zed A"},
    {"unique_key": "29", "agency": "HPD", "status": "close", "borough": "QUEENS", "incident_zip": "1", "latitude": None},
    {"unique_key": "30", "borough": "QUEENS", "incident_zip": "2", "latitude": "10"},
    {"unique_key": "31", "closed_date": None, "status": "Open"},
    {"unique_key": "32", "closed_date": "2024-05-20T23:00:00.000"},
    {"unique_key": "33", "created_date": "05/20/2024 07:14:00 AM"},
]
REJECTED = {change["unique_key"]: reason for reason, change in BAD_ROWS.items()} | {
    "1": "DUPLICATE_IN_BATCH", "20": "INVALID_CREATED_DATE", "21": "INVALID_STATUS",
    "29": "NO_DIM_LOCATION_MATCH", "30": "NO_DIM_LOCATION_MATCH",
}


@pytest.fixture(scope="module")
def mixed(spark):
    """One load of every kind of row: the warehouse and its step counts."""
    rows = [tuple({**GOOD, **change}[n] for n in RAW_COLUMNS) for change in [*BAD_ROWS.values(), *MORE_ROWS]]
    return loaded(spark, fresh_path(spark, "mixed"), spark.createDataFrame(rows, RAW_SCHEMA))


def fact_row(wh, key):
    return wh.fact.filter(F.col("unique_key") == key).first()


def test_every_check_names_its_reason(mixed):
    wh, counts = mixed
    assert errors(wh) == REJECTED
    assert sorted(column(wh.fact, "unique_key")) == ["1", "22", "23", "24", "25", "26", "27", "28", "31", "32", "33"]
    assert counts[T.FACT] == W.StepCounts(25, 11, 14, 0)


def test_later_created_row_stays(mixed):
    assert fact_row(mixed[0], "1").status == "Closed"


def test_bad_closing_date_keeps_the_row_open(mixed):
    row = fact_row(mixed[0], "23")
    assert (row.closed_date, row.resolution_days) == (None, None)


def test_both_date_forms_load(mixed):
    assert fact_row(mixed[0], "33").created_date == fact_row(mixed[0], "1").created_date


def test_messages_show_the_raw_text(mixed):
    logged = mixed[0].table("etl_errors").filter(F.col("step_name") == T.FACT)
    got = {r.unique_key: (r.error_message, r.raw_status) for r in logged.collect()}
    assert got["15"] == ("agency code [NULL] not found in dim_agency", "Closed")
    assert got["29"][1] == "Closed"
    assert got["14"][0].startswith("status value [Bogus] not in allowed list")
    assert got["11"][0] == "created_date cannot be parsed as DATETIME: [not a date]"
    assert got["12"][0] == "created_date 2019-12-31T00:00:00.000 produces date_key 20191231 not in dim_date (2020-2030)"


def test_matching_ignores_case_and_blanks(mixed):
    wh, _ = mixed
    odd, plain = fact_row(wh, "24"), fact_row(wh, "1")
    for key in ("agency_key", "location_key", "complaint_key"):
        assert odd[key] == plain[key]
    assert wh.table("dim_location").count() == 1


def test_null_and_empty_descriptor_are_one_member(mixed):
    wh, _ = mixed
    assert column(wh.table("dim_complaint_type").filter("complaint_type = 'RODENT'"), "descriptor", "category") == [("", "Environment")]


def test_one_agency_row_for_two_spellings(mixed):
    zed = mixed[0].table("dim_agency").filter("agency_code = 'ZZ'")
    assert column(zed, "agency_name", "sla_days") == [("Zed A", 10)]


def test_rejected_areas_are_logged(mixed):
    wh, counts = mixed
    logged = wh.table("etl_errors").filter("step_name = 'dim_location'")
    assert sorted(column(logged, "error_type")) == ["NULL_AVG_COORDINATES", "OUT_OF_RANGE_AVG_COORDINATES"]
    assert "avg_lat=10.000000" in "".join(column(logged, "error_message"))
    assert counts["dim_location"] == W.StepCounts(3, 1, 2, 0)


def test_mart_rows(mixed):
    mart = service_requests_mart(mixed[0], "2024-06-20").filter(F.col("unique_key").isin("1", "31", "32"))
    got = {r.unique_key: (r.is_sla_breach, r.days_open_if_pending, r.resolution_bucket, r.category) for r in mart.collect()}
    assert got == {
        "1": (1, None, "4-7 Days", "Noise"), "31": (0, 31, "Open", "Noise"), "32": (0, None, "Same Day", "Noise"),
    }


def test_views_and_stored_summaries(spark, mixed):
    wh, _ = mixed
    register_views(wh, "2024-06-20")
    assert spark.sql("SELECT count(*) FROM vw_service_requests WHERE is_sla_breach = 1").first()[0] == 6
    write_summaries(wh)
    stored = spark.read.parquet(f"{wh.root}/agency_summary")
    assert sorted(column(stored, "agency_code", "total_requests")) == [("NYPD", 9), ("ZZ", 2)]
    assert spark.sql("SELECT sum(total_requests) FROM vw_borough_summary").first()[0] == 11


def test_older_rules(spark, requests_of, folder):
    rules = legacy_settings()
    rows = requests_of({"agency": "DCAS", "agency_name": "Citywide", "complaint_type": "Water System"})
    agency = D.new_agencies(D.staged_agencies(rows), rules, spark.createDataFrame([], "agency_code string")).first()
    assert (agency.agency_name, agency.sla_days) == ("Citywide", 10)
    none = spark.createDataFrame([], "complaint_type string, descriptor string")
    assert D.new_complaints(D.staged_complaints(rows), rules, none).first().category == "Housing"


def test_quality_checks_hold(mixed):
    wh, _ = mixed
    for report in (V.orphan_counts(wh), V.uniqueness(wh), V.required_values(wh)):
        assert {r.violations for r in report.collect()} == {0}


def test_sla_targets_apply_to_stored_agencies(spark, mixed):
    later = W.Warehouse(spark, mixed[0].root, Settings(sla_days={"NYPD": 9}))
    assert column(later.table("dim_agency").filter("agency_code = 'NYPD'"), "sla_days") == [9]


def test_zero_coordinates_enter_the_mean_unless_switched_off(spark, requests_of):
    rows = requests_of({"latitude": "40.0", "longitude": "-74.0"}, {"latitude": "0", "longitude": "0"})
    plain = D.staged_locations(rows, Settings()).first()
    assert (float(plain.latitude), float(plain.longitude)) == (20.0, -37.0)
    nulled = D.staged_locations(rows, Settings(zero_as_null=True)).first()
    assert (float(nulled.latitude), float(nulled.longitude)) == (40.0, -74.0)


def test_every_rejected_row_is_logged(spark, requests_of, folder):
    rows = requests_of(*[{"unique_key": str(i), "agency": None} for i in range(1500)])
    wh, counts = loaded(spark, folder, rows)
    assert counts["dim_agency"].rejected == 1500
    assert wh.table("etl_errors").filter("step_name = 'dim_agency'").count() == 1500


def test_incremental_loads(spark, requests_of, folder):
    wh, _ = loaded(spark, folder, requests_of({}, {"unique_key": "2"}), batch=1)
    again = W.run_all(wh, 1)
    assert again[T.FACT] == W.StepCounts(0, 0, 0, 0)
    T.load_staging(requests_of({"status": "Open"}, {"unique_key": "3", "agency": "HPD"}), folder, 2, refresh=False)
    counts = W.run_all(wh, 2)
    assert counts[T.FACT] == W.StepCounts(2, 1, 1, 1)
    assert counts["dim_agency"] == W.StepCounts(2, 1, 0, 1)
    assert counts["dim_date"].inserted == 0
    assert sorted(column(wh.fact, "unique_key", "dw_batch_id")) == [("1", 1), ("2", 1), ("3", 2)]
    assert sorted(column(wh.table("dim_agency"), "agency_key", "agency_code")) == [(1, "NYPD"), (2, "HPD")]
    assert errors(wh) == {"1": "DUPLICATE_UNIQUE_KEY"}
    T._write_empty(spark, folder, "processed_loads", "overwrite")
    # The job died after the insert: no batch was marked as processed.
    assert W.run_all(wh, 3)[T.FACT] == W.StepCounts(4, 0, 4, 4)
    assert wh.fact.count() == 3


def test_failed_step_is_logged_and_raised(spark, folder):
    wh = W.create_warehouse(spark, folder)

    def broken(log_id):
        raise ValueError("no such thing")

    with pytest.raises(ValueError):
        W.logged_step(wh, 5, "dim_agency", broken)
    row = W.run_summary(wh.table("etl_log"), 5).first()
    assert (row.step_number, row.status, row.error_message) == (2, "FAILED", "no such thing")


def test_reset_clears_and_reload_fills(spark, requests_of, folder):
    wh, _ = loaded(spark, folder, requests_of({}, {"unique_key": "2"}), batch=1)
    counts = T.reset_warehouse(spark, folder, reset_flag=True)
    assert {r.table_name: r.total_rows for r in counts.collect()} == dict.fromkeys([*T.DIMENSIONS, T.FACT], 0)
    assert wh.table("etl_log").count() == 5
    W.run_all(wh, 1)
    assert wh.fact.count() == 2
    T.reset_warehouse(spark, folder, clear_log=True)
    assert wh.table("etl_log").count() == 0
    assert wh.pending.count() == 0


def test_loose_load(spark, requests_of, folder):
    """The older load matches positions of its own, keeps one row per key and counts what it leaves out."""
    wh = W.create_warehouse(spark, folder)
    rows = requests_of(
        {"status": None}, {"unique_key": "2", "descriptor": None}, {"unique_key": "3", "created_date": "x"},
        {"unique_key": "4", "closed_date": "2024-05-19T00:00:00.000"}, {"unique_key": "5", "latitude": "40.7"},
        {"unique_key": " 5", "created_date": "2024-05-21T07:14:00.000", "status": "Open"},
        {"unique_key": "6", "city": "Elsewhere"},
    )

    def run(batch):
        T.load_staging(rows, folder, batch)
        for name in W.STEPS[:-1]:
            W.LOADERS[name](wh, batch, batch)
        return W.load_fact(wh, batch * 10, batch, strict=False)

    assert run(1) == W.StepCounts(7, 3, 4, 0)
    assert sorted(column(wh.fact, "unique_key", "status")) == [("1", "Unknown"), ("5", "Open"), ("6", "Closed")]
    assert wh.table("legacy_location").count() == 3
    assert run(2) == W.StepCounts(7, 0, 7, 0)
    assert wh.table("legacy_location").count() == 3


def test_two_refreshes_under_one_batch_number(spark, requests_of, folder):
    wh = W.create_warehouse(spark, folder)
    for key in ("a", "c"):
        T.load_staging(requests_of({"unique_key": key}, {"unique_key": key + "2"}), folder, 20240601)
        assert W.run_all(wh, 20240601)[T.FACT] == W.StepCounts(2, 2, 0, 0)
    assert wh.fact.count() == 4


def test_two_appends_under_one_batch_number(spark, requests_of, folder):
    wh = W.create_warehouse(spark, folder)
    for key in ("a", "b"):
        assert T.load_staging(requests_of({"unique_key": key}), folder, 5, refresh=False) == {"rows_read": 1, "rows_landed": 1}
    assert W.run_all(wh, 5)[T.FACT] == W.StepCounts(2, 2, 0, 0)


def test_pending_batches_that_share_a_key(spark, requests_of, folder):
    wh = W.create_warehouse(spark, folder)
    T.load_staging(requests_of({"unique_key": "K"}), folder, 1, refresh=False)
    T.load_staging(requests_of({"unique_key": "k ", "status": "Open"}, {"unique_key": "L"}), folder, 2, refresh=False)
    assert W.run_all(wh, 2)[T.FACT] == W.StepCounts(3, 2, 1, 0)
    assert sorted(k.upper() for k in column(wh.fact, "unique_key")) == ["K", "L"]
    assert list(errors(wh).values()) == ["DUPLICATE_IN_BATCH"]


def test_load_that_died_between_keys_and_rows(spark, requests_of, folder):
    wh, _ = loaded(spark, folder, requests_of({"unique_key": "a"}), batch=1)
    keys = spark.createDataFrame([("A", 77), ("LOST", 77)], "dedup_key string, log_id bigint")
    W._save_keys(wh, keys, 77)  # no mark follows
    T.load_staging(requests_of({"unique_key": "lost"}, {"unique_key": "a"}), folder, 2)
    assert W.run_all(wh, 2)[T.FACT] == W.StepCounts(2, 1, 1, 1)
    T.load_staging(requests_of({"unique_key": "lost"}), folder, 3)
    assert W.run_all(wh, 3)[T.FACT] == W.StepCounts(1, 0, 1, 1)
    assert sorted(column(wh.fact, "unique_key")) == ["a", "lost"]


def test_a_load_does_not_scan_the_fact(spark, requests_of, folder):
    wh, _ = loaded(spark, folder, requests_of({}), batch=1)
    counts = FA.key_counts(wh.staging.select(F.upper("unique_key").alias("dedup_key")))
    plan = FA.known_keys(counts, wh.fact_keys)._jdf.queryExecution().toString()
    assert "fact_keys" in plan and T.FACT not in plan
    assert "bucket" in plan.split("PartitionFilters: [")[1]
    assert "stg_batch_id IN" not in wh.pending._jdf.queryExecution().toString()


def test_scratch_goes_and_a_session_without_a_folder_is_refused(spark, monkeypatch):
    from civicmart import session as S

    with S.scratch(spark):
        kept = S.fresh_path(spark, "x")
        cut(spark.range(3), "y")
    folder = kept.rsplit("/", 1)[0]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    class Plain:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("Context", (), {"applicationId": "none"})

    with pytest.raises(RuntimeError):
        S.work_dir(Plain)


def test_crowded_key_resolves_as_brute_force(spark, requests_of, folder):
    """A third of all rows share one key."""
    states = ["Open", "Closed", "Pending", "Assigned"]
    changes = []
    for i in range(120):
        key = "hot" if i % 3 == 0 else f"k{i % 50}"
        changes.append({
            "unique_key": f" {key}" if i % 7 == 0 else key, "created_date": f"2024-05-{1 + i % 11:02d}T07:14:00.000",
            "closed_date": None, "status": states[i % 4],
        })
    wh, counts = loaded(spark, folder, requests_of(*changes).repartition(4))
    got = {r.unique_key.upper(): r.status for r in wh.fact.collect()}
    best = {}
    for ch in changes:
        key = ch["unique_key"].strip().upper()
        best[key] = max(best.get(key, ("", "")), (ch["created_date"], ch["status"]))
    assert got == {k: v[1] for k, v in best.items()}
    assert counts[T.FACT].inserted + counts[T.FACT].rejected == 120
    again = FA.stage_counts(FA.resolve(wh.staging, wh.dims(*T.DIMENSIONS[1:]), wh.fact_keys, wh.settings))
    assert column(again, "outcome", "row_count") == [("DUPLICATE_UNIQUE_KEY", 120)]


def test_exact_copies_keep_one(spark, requests_of, folder):
    wh, counts = loaded(spark, folder, requests_of(*[{}] * 30).repartition(4))
    assert wh.fact.count() == 1
    assert counts[T.FACT].rejected == 29


def test_keys_are_consecutive_over_partitions(spark):
    rows = cut(spark.range(500).select(F.format_string("%05d", F.col("id") * 7919 % 500).alias("code")), "codes")
    many = D.assign_keys(rows, "k", ["code"], 10).orderBy("code")
    assert column(many, "k") == list(range(11, 511))


def test_summaries_follow_the_loads(spark, requests_of, folder):
    from civicmart.plans import mart as PM

    wh, _ = loaded(spark, folder, requests_of({}, {"unique_key": "2", "created_date": "2024-04-01T00:00:00.000"}), batch=1)
    assert PM.refresh_summaries(wh) == [(2024, 4), (2024, 5)]
    T.load_staging(requests_of({"unique_key": "3", "status": "Open", "closed_date": None}), folder, 2)
    W.run_all(wh, 2)
    assert PM.refresh_summaries(wh) == [(2024, 5)] and PM.refresh_summaries(wh) == []
    for name, build in PM.SUMMARIES.items():
        stored, full = PM.stored_summary(wh, name), build(wh)
        assert sorted(map(str, stored.select(full.columns).collect())) == sorted(map(str, full.collect()))
        assert stored.filter("month = 5").agg(F.sum("total_requests")).first()[0] == 2


def test_a_first_load_writes_its_keys_once(spark, requests_of, folder, monkeypatch):
    monkeypatch.setattr(FA, "KEYS_PER_BUCKET", 4)
    wrote = []
    save = W.save_table
    monkeypatch.setattr(W, "save_table", lambda df, root, name, *rest, **more: (wrote.append(name), save(df, root, name, *rest, **more)))
    wh = W.create_warehouse(spark, folder)
    for first in (0, 20):
        T.load_staging(requests_of(*[{"unique_key": str(first + i)} for i in range(20)]), wh.root, 1)
        W.run_all(wh, 1)
        depth = wh.fact_keys.depth
        assert depth == FA.key_depth(first + 20)
        own = wh.table("fact_keys").filter(f"key_set = {W.key_set(wh)[0]} AND log_id > 0")
        assert own.count() == 20 and own.select("bucket").distinct().count() > 4  # this load's keys lie where they were first written
    assert wrote.count("fact_keys") == 2 and wh.fact.count() == 40


def test_many_rejected_repeats_meet_the_rows_once(spark, requests_of, folder, monkeypatch):
    cuts = []
    cut = FA.cut
    monkeypatch.setattr(FA, "cut", lambda df, name: (cuts.append(name), cut(df, name))[1])
    wh = W.create_warehouse(spark, folder)
    rows = requests_of(*[{"unique_key": str(i // 2), "status": "Open" if i % 2 else "Closed"} for i in range(40)])
    for most, stored in ((1000, False), (5, True)):
        monkeypatch.setattr(FA, "MARKS_MET", most)
        cuts.clear()
        T.load_staging(rows, wh.root, 1)
        found = W.run_all(wh, 1)[T.FACT]
        assert ("judged" in cuts) == stored
        assert (found.read, found.inserted, found.rejected) == (40, 0 if stored else 20, 40 if stored else 20)
    assert wh.fact.count() == 20


def test_many_repeats_are_judged_as_few_and_failed_rows_stay_where_they_are(spark, requests_of, folder, monkeypatch):
    """Decided by key, only rows that passed the checks are stored again; every verdict is that of the other way."""
    changes = [
        {"unique_key": f"k{i // 3}", "status": ["Open", "Closed", "Bogus"][i % 3], "created_date": f"2024-05-{1 + i % 4:02d}T07:14:00.000", "closed_date": None}
        for i in range(60)
    ]
    stored = {}
    cut = FA.cut
    monkeypatch.setattr(FA, "cut", lambda df, name: stored.setdefault(name, cut(df, name)))
    wh = W.create_warehouse(spark, folder)
    T.load_staging(requests_of(*changes[:30]), wh.root, 1)
    W.run_all(wh, 1)
    T.load_staging(requests_of(*changes, {}, {}).repartition(3), wh.root, 2)
    for name in W.STEPS[1:-1]:
        W.LOADERS[name](wh, 50 + W.STEPS.index(name), 2)
    judged = {}
    for most in (1000, 3):
        monkeypatch.setattr(FA, "MARKS_MET", most)
        stored.clear()
        rows = FA.resolve(wh.pending, wh.dims(*T.DIMENSIONS[1:]), wh.fact_keys, wh.settings)
        judged[most] = sorted(map(tuple, rows.select(*sorted(rows.columns)).collect()), key=repr)
        counts = dict(column(rows.groupBy("error_type").count(), "error_type", "count"))
        assert counts == {None: 11, "INVALID_STATUS": 20, "DUPLICATE_UNIQUE_KEY": 20, "DUPLICATE_IN_BATCH": 11}
        accepted = rows.filter("error_type IS NULL")._jdf.queryExecution().optimizedPlan().toString()
        assert ("Union" in accepted) is False and rows.count() == 62
    assert judged[1000] == judged[3] and stored["judged"].count() == 42


def test_places_that_share_a_position_meet_a_row_once(spark, requests_of, folder):
    """The older load joins a row with one place, the one it keeps, and not with all that share its position."""
    wh = W.create_warehouse(spark, folder)
    T.load_staging(requests_of(*[{"unique_key": str(i), "community_board": f"{i:02d} B", "city": f"C{i}"} for i in range(8)]), wh.root, 1)
    for number, name in enumerate(W.STEPS[:-1]):
        W.LOADERS[name](wh, number, 1)
    places = FA.new_legacy_locations(wh.pending, wh.table("legacy_location"))
    numbered = D.assign_keys(places, "location_key", FA.LEGACY_PLACE, 0)
    assert numbered.count() == 8 and column(FA.least_of_position(numbered), "location_key") == [1]
    assert W.load_fact(wh, 5, 1, strict=False) == W.StepCounts(8, 8, 0, 0)
    assert column(wh.fact.select("location_key").distinct(), "location_key") == [1]
