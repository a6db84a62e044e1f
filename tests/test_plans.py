"""What the physical plans must look like."""

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from checks import registry
from civicmart.operators import fact as FA
from civicmart.operators import joins as J
from civicmart.operators import measures as M
from civicmart.plans import mart as PM
from civicmart.plans import reports as R
from civicmart.plans import verify as V
from civicmart.session import work_dir
from civicmart.sources import adapter as A
from civicmart.sources import tables as T


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def wh(spark):
    return registry.warehouse(spark, DATA)


@pytest.fixture(scope="module")
def mart(spark, wh):
    return registry.mart(spark, DATA)


def test_year_filter_prunes_partitions_and_columns(wh, mart):
    text = plan(R.category_totals(mart, {"year": 1998}))
    assert "PartitionFilters: [isnotnull(year" in text and "= 1998" in text
    assert "unique_key" not in text.split("fact_service_requests")[1].split("ReadSchema")[1].split("\n")[0]


def test_status_filter_reaches_the_scan(wh):
    assert "EqualTo(status,Closed)" in plan(V.agency_sla_performance(wh))


def test_small_dimensions_broadcast_and_large_ones_shuffle(spark, wh):
    def joined():
        return J.star(wh.fact, wh.dims("dim_location")).groupBy("borough").count()

    assert "BroadcastHashJoin" in plan(joined())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(joined())
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
        assert sorted(tuple(r) for r in joined().collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_row_checks_do_not_shuffle(wh):
    tagged = FA.tag_rows(wh.staging, wh.dims(*T.DIMENSIONS[1:]), wh.settings)
    text = plan(tagged)
    assert "Exchange hashpartitioning" not in text and "BatchEvalPython" not in text


def test_top_n_limits_each_task_first(mart):
    assert "WindowGroupLimit" in plan(R.top_complaint_types(mart))


def test_no_query_crosses_rows(spark):
    for name in ("year_comparison", "running_totals", "open_case_cards", "report_titles", "vs_citywide", "stage_row_counts"):
        text = plan(registry.QUERIES[name].run(spark, DATA))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_requests_are_read_once_for_all_periods(mart, spark):
    text = plan(R.running_totals(mart, registry.calendar(spark, DATA)))
    assert text.count("fact_service_requests]") == 1


def test_work_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert work_dir(spark) == (named.rstrip("/") if named else work_dir(spark))


def test_fact_is_stored_by_year(spark, wh):
    years = [r[0] for r in wh.fact.select("year").distinct().collect()]
    files = wh.fact.select(F.input_file_name().alias("f")).distinct().count()
    assert len(years) == 7 and files <= 14


def test_a_page_scans_the_fact_once_and_equals_its_visuals(spark, mart):
    where = {"year": 1998, "status": "Closed"}
    for visual, df in R.overview_page(mart, where).items():
        by, names = R.OVERVIEW[visual]
        own = M.measures(mart, names, by, where)
        assert sorted(map(repr, df.collect())) == sorted(map(repr, own.collect())), visual
        assert T.FACT not in plan(df)
    columns = list(dict.fromkeys(c for by, _ in R.OVERVIEW.values() for c in by))
    parts = M.needed_parts([m for _, names in R.OVERVIEW.values() for m in names])
    sets = [by for by, _ in R.OVERVIEW.values()]
    one = plan(M.reduce_rows(mart, parts, columns, where, [F.grouping_id().alias("_set")], sets))
    assert sum(T.FACT in line for line in one.split("\n") if line.startswith("Location: ")) == 1


def test_a_filter_on_the_calendar_prunes_years(wh):
    days = wh.table("dim_date").filter("full_date >= '1998-12-01' AND full_date < '1999-01-01'")
    rows = J.star(wh.fact, {"dim_date": days})
    assert "dynamicpruning" in plan(rows)
    assert rows.count() == wh.fact.filter("date_key BETWEEN 19981201 AND 19981231").count() > 0


def test_refreshed_summaries_read_touched_months_only(spark, wh):
    text = plan(PM.agency_summary(wh, [(1997, 3), (1998, 12)]))
    assert "year#" in text.split("PartitionFilters: [")[1].split("]")[0] and "1997,1998" in text.replace(" ", "")
    assert "GreaterThanOrEqual(date_key,19970300)" in text


def test_orders_meet_customers_before_their_lines(spark):
    """Wide lines are not shuffled for the customer: no order line lies below that join."""
    tree = A.untidy_requests(spark, DATA)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = [len(line) - len(line.lstrip(" :+-")) for line in tree]
    [at] = [i for i, line in enumerate(tree) if "Join Inner" in line and "o_custkey" in line]
    below = next((i for i in range(at + 1, len(tree)) if depth[i] <= depth[at]), len(tree))
    assert "c_custkey" in "".join(tree[at:below]) and not any("l_orderkey" in line for line in tree[at:below])
