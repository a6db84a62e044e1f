"""Files, staging and reset."""

import pytest
from conftest import GOOD, column
from pyspark.sql import functions as F

from civicmart.plans.warehouse import create_warehouse
from civicmart.sources import raw as R
from civicmart.sources import tables as T


def write_text(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


HEADER = ",".join(R.RAW_COLUMNS)


def line(**changes):
    row = {**GOOD, **changes}
    return ",".join('"' + row[n].replace('"', '""') + '"' if set(row[n]) & set(',"\n') else row[n] for n in R.RAW_COLUMNS)


def test_files_are_text_and_empty_is_null(spark, tmp_path):
    write_text(tmp_path / "requests_2023.csv", "\n".join([HEADER, line(unique_key="007", closed_date="", incident_zip="01234")]) + "\n")
    row = R.read_raw(spark, str(tmp_path)).first()
    assert (row.unique_key, row.closed_date, row.incident_zip, row.source_year) == ("007", None, "01234", 2023)


def test_columns_go_by_name_per_year(spark, tmp_path):
    write_text(tmp_path / "requests_2022.csv", "\n".join([HEADER, line(unique_key="a")]) + "\n")
    write_text(tmp_path / "requests_2023.csv", "status,unique_key,extra\nOpen,b,x\n")
    with pytest.warns(UserWarning, match="missing columns"):
        got = R.read_raw(spark, str(tmp_path))
    assert sorted(column(got, "unique_key", "status", "agency")) == [("a", "Closed", "NYPD"), ("b", "Open", None)]


def test_files_of_one_year_go_by_their_own_header(spark, tmp_path):
    (tmp_path / "requests_2022.csv").mkdir()
    write_text(tmp_path / "requests_2022.csv" / "part-0.csv", "\n".join([HEADER, line(unique_key="a")]) + "\n")
    back = ",".join(reversed(R.RAW_COLUMNS))
    write_text(tmp_path / "requests_2022.csv" / "part-1.csv", "\n".join([back, ",".join(reversed(line(unique_key="b").split(",")))]) + "\n")
    write_text(tmp_path / "requests_2022.csv" / "part-2.csv", "status,unique_key\nOpen,c\n")
    write_text(tmp_path / "requests_2022.csv" / "part-3.csv", "")
    with pytest.warns(UserWarning, match="missing columns"):
        got = R.read_raw(spark, str(tmp_path))
    assert sorted(column(got, "unique_key", "status", "agency")) == [("a", "Closed", "NYPD"), ("b", "Closed", "NYPD"), ("c", "Open", None)]


def test_no_file_is_an_error_before_staging_is_touched(spark, tmp_path):
    write_text(tmp_path / "requests_2022.csv", "\n".join([HEADER, line()]) + "\n")
    with pytest.raises(FileNotFoundError):
        R.read_raw(spark, str(tmp_path), [2019])


def test_quotes_commas_and_line_breaks_inside_a_value(spark, tmp_path):
    note = 'He said "no",\nthen left'
    write_text(tmp_path / "requests_2023.csv", "\n".join([HEADER, line(resolution_description=note), line(unique_key="2")]) + "\n")
    got = R.read_raw(spark, str(tmp_path), multiline=True)
    assert sorted(column(got, "unique_key", "resolution_description")) == [("1", note), ("2", "Done")]


def test_year_choice(spark, tmp_path):
    for year in (2021, 2022, 2024):
        write_text(tmp_path / f"requests_{year}.csv", "\n".join([HEADER, line(unique_key=str(year))]) + "\n")
    write_text(tmp_path / "notes.csv", "x\n1\n")
    assert sorted(column(R.read_raw(spark, str(tmp_path)), "unique_key")) == ["2021", "2022", "2024"]
    chosen = R.pick_years((2022, 2024), latest=2026)
    assert chosen == [2022, 2023, 2024]
    with pytest.warns(UserWarning, match="2023"):
        assert sorted(column(R.read_raw(spark, str(tmp_path), (2022, 2024)), "source_year")) == [2022, 2024]
    assert column(R.read_raw(spark, str(tmp_path), 2021), "unique_key") == ["2021"]
    assert R.pick_years(2020, latest=2026) == [2020]
    assert R.pick_years(None) is None


@pytest.mark.parametrize("years", [2009, (2024, 2023), (2020, 2099), [2005]])
def test_years_out_of_range(years):
    with pytest.raises(ValueError):
        R.pick_years(years, latest=2026)


def test_missing_columns_warn_and_become_null(spark, requests_of):
    with pytest.warns(UserWarning, match="community_board"):
        known = R.select_known(requests_of({}).drop("community_board").withColumn("extra", F.lit(1)))
    assert known.columns == R.RAW_COLUMNS
    assert known.first().community_board is None


def test_year_slice_is_half_open_and_ordered(spark, requests_of):
    rows = requests_of(
        {"unique_key": "c", "created_date": "2024-12-31T23:59:59.000"},
        {"unique_key": "a", "created_date": "2024-01-01T00:00:00.000"},
        {"unique_key": "x", "created_date": "2025-01-01T00:00:00.000"},
        {"unique_key": "y", "created_date": "2023-12-31T23:59:59.000"},
    )
    assert column(R.slice_year(rows, 2024), "unique_key") == ["a", "c"]


def test_trim_all_touches_text_only(spark):
    rows = spark.createDataFrame([(" a ", 1)], "x string, n int")
    assert tuple(R.trim_all(rows).first()) == ("a", 1)


def test_staging_refresh_and_append(spark, requests_of, folder):
    wh = create_warehouse(spark, folder)
    assert T.load_staging(requests_of({}, {}), folder, 1) == {"rows_read": 2, "rows_landed": 2}
    assert T.load_staging(requests_of({}), folder, 2, refresh=False) == {"rows_read": 1, "rows_landed": 1}
    assert sorted(column(wh.staging, "stg_batch_id")) == [1, 1, 2]
    T.load_staging(requests_of({}), folder, 3)
    assert column(wh.staging, "stg_batch_id") == [3]
    assert column(wh.pending, "stg_is_processed") == [False]


def test_empty_source_stages_nothing(spark, requests_of, folder):
    create_warehouse(spark, folder)
    assert T.load_staging(requests_of({}).limit(0), folder, 1) == {"rows_read": 0, "rows_landed": 0}


def test_row_ids_differ_and_stay(spark, requests_of, folder):
    wh = create_warehouse(spark, folder)
    T.load_staging(requests_of({}, {}, {}).repartition(3), folder, 1)
    first = sorted(column(wh.staging, "stg_row_id"))
    assert len(set(first)) == 3
    assert sorted(column(wh.staging, "stg_row_id")) == first


def test_files_with_one_header_are_one_scan(spark, folder):
    for year in (2021, 2022, 2023):
        rows = spark.range(40).selectExpr("CAST(id AS string) AS unique_key", "'x' AS agency", f"'{year - 1000}' AS source_year")
        rows.repartition(4).write.option("header", True).csv(f"{folder}/requests_{year}.csv")
    with pytest.warns(UserWarning, match="missing"):
        got = R.read_raw(spark, folder, (2021, 2022))
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    assert sorted(column(got.groupBy("source_year").count(), "source_year", "count")) == [(2021, 40), (2022, 40)]
