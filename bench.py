"""Time the headline queries.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Loading the warehouse from the
order tables is timed as one entry per form; the report queries then read the stored tables.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from civicmart.session import get_session  # noqa: E402

HEADLINE = [
    "parsed_dates", "status_mapping", "text_categories", "staging_profile", "location_averages",
    "dimension_matches", "stage_row_counts", "reload_rejects_loaded_keys", "loose_load", "service_requests_mart",
    "agency_summary", "borough_summary", "fact_profile", "top_complaints", "borough_volume",
    "agency_sla_performance", "monthly_trend", "newest_requests", "unique_members", "orphan_rows",
    "measures_by_agency_year", "year_comparison", "yoy_by_month", "running_totals", "to_date_cards", "vs_citywide",
    "oldest_case_by_borough", "display_measures", "borough_share", "month_by_year", "agency_matrix",
    "resolution_buckets", "breach_rate_by_agency", "top_zips", "weekend_split", "borough_table",
    "top_complaint_types", "category_by_month", "open_by_agency", "open_by_age", "open_by_day", "open_case_cards",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench", f"local[{cores}]", spark__sql__shuffle__partitions=cores, spark__driver__memory="16g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    from checks import registry

    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    for form in registry.FORMS:
        timed(f"load_{form}_warehouse", lambda form=form: registry.warehouse(spark, folder, form))
    for name in HEADLINE:
        run = registry.QUERIES[name].run
        timed(name, lambda run=run: run(spark, folder).write.format("noop").mode("overwrite").save())
    result = {
        "metric": "total_seconds_loads_and_report_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
