"""Reading raw request files: every column text, unknown columns left out."""

from __future__ import annotations

import warnings
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of a request file in file order, and the first year on offer.
RAW_COLUMNS = [
    "unique_key", "created_date", "closed_date", "agency", "agency_name", "complaint_type",
    "descriptor", "location_type", "incident_zip", "incident_address", "city", "borough",
    "latitude", "longitude", "status", "resolution_description", "community_board",
]
FIRST_YEAR = 2010
#: The year in the name of a request file, or of the folder that its part files are in.
FILE_YEAR = r"_(\d{4})\.csv(/[^/]*)?$"
#: Files whose first line is read at the same time.
OPENED = 32

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])


def pick_years(
    years: int | tuple[int, int] | list[int] | None, latest: int | None = None, first: int = FIRST_YEAR
) -> list[int] | None:
    """One year, a (first, last) range or a list, checked against the years on offer."""
    if years is None:
        return None
    latest = latest or date.today().year
    if isinstance(years, int):
        wanted = [years]
    elif isinstance(years, tuple):
        begin, end = years
        if begin > end:
            raise ValueError(f"start year {begin} must be <= end year {end}")
        wanted = list(range(begin, end + 1))
    else:
        wanted = sorted(set(years))
    outside = [y for y in wanted if not first <= y <= latest]
    if outside:
        raise ValueError(f"years {outside} must be between {first} and {latest}")
    return wanted


def files_of_years(spark: SparkSession, folder: str) -> dict[int, list[str]]:
    """Files per year of every `…_YYYY.csv`, a file or a folder of part files. Only names are read."""
    files = spark.read.format("binaryFile").load(f"{folder}/*_[0-9][0-9][0-9][0-9].csv")
    year = F.regexp_extract("path", FILE_YEAR, 1).cast("int")
    found: dict[int, list[str]] = {}
    for y, path in files.select(year, "path").collect():  # one row per file
        found.setdefault(y, []).append(path)
    return {y: sorted(paths) for y, paths in sorted(found.items())}


def header_of(spark: SparkSession, path: str) -> str:
    """The first line of a file; no more of it is read."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    opened = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(opened, "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def hand_over(spark: SparkSession, source: str, target: str) -> bool:
    """Moves a finished folder to where it is awaited, so that no reader meets half of it; False where there is none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path(source)):
        return False
    fs.mkdirs(path(target).getParent())
    if not fs.rename(path(source), path(target)):
        raise RuntimeError(f"{source} was not moved to {target}")
    return True


def read_raw(
    spark: SparkSession, folder: str, years: int | tuple[int, int] | list[int] | None = None, multiline: bool = False,
    first_year: int = FIRST_YEAR,
) -> DataFrame:
    """Per-year CSVs of a folder with a `source_year`: known columns by name, text, empty as NULL.

    `years` is one year, a (first, last) range, a list or everything; a wanted year without a file
    adds nothing and is warned of. Every file goes by its own header: files with the same header are
    read together, by one scan whatever their years, others may order their columns differently or lack some.
    Other years' files are never opened. With `multiline` a quoted value may hold line breaks, and a file is read by one
    task; without it files split.
    """
    found = files_of_years(spark, folder)
    wanted = pick_years(years, first=first_year) or list(found)
    absent = [y for y in wanted if y not in found]
    if len(absent) == len(wanted):
        raise FileNotFoundError(f"no request file in {folder} for years {years or 'of any kind'}")
    if absent:
        warnings.warn(f"no request file for years {absent}", stacklevel=2)
    paths = [path for year in wanted for path in found.get(year, [])]
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(OPENED) as pool:
        for path, header in zip(paths, pool.map(lambda path: header_of(spark, path), paths), strict=True):
            groups.setdefault(header, []).append(path)
    reader = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"').option("enforceSchema", False)

    def one(same: list[str]) -> DataFrame:
        year = F.regexp_extract(F.col("_metadata.file_path"), FILE_YEAR, 1).cast("int")
        known = select_known(reader.csv(same).withColumn("source_year", year))
        return known.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in RAW_COLUMNS], "source_year")

    parts = [one(same) for header, same in groups.items() if header]
    if not parts:
        return spark.createDataFrame([], RAW_SCHEMA).withColumn("source_year", F.lit(None).cast("int"))
    return reduce(DataFrame.unionByName, parts)


def select_known(df: DataFrame) -> DataFrame:
    """The known columns; one that is missing becomes NULL text with a warning."""
    missing = [c for c in RAW_COLUMNS if c not in df.columns]
    if missing:
        warnings.warn(f"missing columns in request file: {missing}", stacklevel=2)
    extra = [c for c in ("source_year",) if c in df.columns]
    known = [F.lit(None).cast("string").alias(c) if c in missing else F.col(c) for c in RAW_COLUMNS]
    return df.select(*known, *extra)


def slice_year(df: DataFrame, year: int) -> DataFrame:
    """Requests created in [year, year + 1), oldest first.

    ISO text compares as dates do, so the range test works on the raw column and can be pushed
    to the scan. The key breaks ties, so that one crowded timestamp still spreads over tasks.
    """
    low, high = f"{year}-01-01T00:00:00", f"{year + 1}-01-01T00:00:00"
    c = F.col("created_date")
    return df.filter((c >= low) & (c < high)).orderBy("created_date", "unique_key")


def trim_all(df: DataFrame) -> DataFrame:
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select([F.trim(F.col(c)).alias(c) if c in text else F.col(c) for c in df.columns])


def with_audit(df: DataFrame, batch_id: int, load_id: str | Column) -> DataFrame:
    """Staging columns: load time, batch, processed flag, error text, load and row number.

    `load_id` belongs to one write and is never used again; `stg_row_id` is unique inside it and,
    once written, never changes. Together they are the identity of a staged row. The batch is a
    label that several writes may share.
    """
    return df.withColumns(
        {
            "stg_load_date": F.current_timestamp(),
            "stg_batch_id": F.lit(batch_id).cast("bigint"),
            "stg_is_processed": F.lit(False),
            "stg_error_message": F.lit(None).cast("string"),
            "stg_row_id": F.monotonically_increasing_id(),
            "load_id": F.lit(load_id),
        }
    )
