"""Set operations: unions of counts, date series, splits, distinct rows, top-n."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F



def union_counts(tables: dict[str, DataFrame], flag: str | None = None) -> DataFrame:
    """One row per table: rows and, where the table has the flag column, its true/false split."""

    def counts(name: str, df: DataFrame) -> DataFrame:
        columns = [F.count(F.lit(1)).alias("total_rows")]
        if flag and flag in df.columns:
            columns += [
                F.count_if(F.col(flag)).alias("processed"),
                F.count_if(~F.col(flag)).alias("pending"),
            ]
        return df.agg(*columns).withColumn("table_name", F.lit(name))

    parts = [counts(n, df) for n, df in tables.items()]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    wanted = [c for c in ("table_name", "total_rows", "processed", "pending") if c in merged.columns]
    return merged.select(*wanted)


def date_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day, both ends included."""
    span = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(span).alias("full_date"))


def split_by_tag(df: DataFrame, tag: str = "error_type") -> tuple[DataFrame, DataFrame]:
    """Rows without a tag, and rows with one."""
    return df.filter(F.col(tag).isNull()), df.filter(F.col(tag).isNotNull())


def distinct_by(df: DataFrame, keys: dict[str, Column], keep: dict[str, Column] | None = None) -> DataFrame:
    """One row per combination of `keys`; `keep` columns take their least value in the group.

    An aggregate, not a window. The least of a text needs a sort, so the rows are first reduced
    by hash to distinct combinations, and only those few are sorted. The test of their number, which always
    holds, keeps Catalyst from taking the first step out as idle, which would sort every row.
    """
    every = {**keys, **(keep or {})}
    rows = df.select(*[c.alias(n) for n, c in every.items()])
    if not keep:
        return rows.distinct()
    distinct = rows.groupBy(*every).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 0)
    return distinct.groupBy(*keys).agg(*[F.min(n).alias(n) for n in keep])


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows; the order must name enough columns to settle ties."""
    return df.orderBy(*order).limit(n)


def top_n_with_ties(df: DataFrame, measure: str, n: int) -> DataFrame:
    """Rows ranked in the first n by the measure, ties kept.

    Spark limits each task to its own first n ranks before they meet in one.
    """
    ranked = df.withColumn("rank", F.rank().over(Window.orderBy(F.col(measure).desc())))
    return ranked.filter(F.col("rank") <= n)


def share_of_total(df: DataFrame, measure: str, out: str = "pct_of_total", places: int = 2) -> DataFrame:
    """Percent of the column total, for an aggregated frame of one row per group."""
    total = F.sum(measure).over(Window.partitionBy())
    exact = F.col(measure).cast("decimal(18,0)") * 100 / F.nullif(total, F.lit(0))
    return df.withColumn(out, exact.cast(f"decimal(5,{places})"))
