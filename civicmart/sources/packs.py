"""Small tables with a folder per writer, joined into few files.

A table such as the audit log gets a partition from every step and micro-batch. `pack` writes the rows of
partitions that are closed into one pack below `_packs`, together with the names of these partitions. A reader
leaves out a partition whose name is in a pack, so at no moment is a row seen twice or missed, whatever
is dropped when. Partitions are dropped by the run after the one that packed them, so a reader that
had listed them before still finds them.

Packs are named by the runs they cover and joined as a binary counter carries: two of a size become one. After n runs
about log2(n) packs are left, and a row has been written as often.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicmart.session import drop_path

#: Seconds after which a partition counts as closed. A stream repeats its last micro-batch only, and soon.
CLOSED = 86400.0
_NAME = re.compile(r"pack=(\d+)-(\d+)")


def _listed(spark: SparkSession, folder: str) -> list[tuple[str, float]]:
    """Names in a folder with the seconds since each was written; a folder that is not there has none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    now = time.time()
    return [(s.getPath().getName(), now - s.getModificationTime() / 1000) for s in files.listStatus(path)]


def _folder(root: str, name: str) -> str:
    return f"{root}/_packs/{name}"


def packs(spark: SparkSession, root: str, name: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Packs in use, and packs that a later one holds or that were never finished."""
    folder = _folder(root, name)
    found = sorted((int(m[1]), int(m[2])) for n, _ in _listed(spark, folder) if (m := _NAME.fullmatch(n)))
    whole = [p for p in found if any(n == "_SUCCESS" for n, _ in _listed(spark, f"{folder}/pack={p[0]}-{p[1]}"))]
    used = [p for p in whole if not any(q != p and q[0] <= p[0] and p[1] <= q[1] for q in whole)]
    return used, [p for p in found if p not in used]


def _rows(spark: SparkSession, root: str, name: str, schema: T.StructType, used: list[tuple[int, int]]) -> DataFrame:
    """Rows of packs with the partition each came from; a row without content names the partition itself."""
    whole = T.StructType([*schema.fields, T.StructField("_part", T.StringType()), T.StructField("_row", T.BooleanType())])
    return spark.read.schema(whole).parquet(*[f"{_folder(root, name)}/pack={a}-{b}" for a, b in used])


def with_packs(rows: DataFrame, root: str, name: str, by: str) -> DataFrame:
    """A table's own partitions and its packs as one."""
    spark, schema = rows.sparkSession, rows.schema
    used, _ = packs(spark, root, name)
    if not used:
        return rows
    held = _rows(spark, root, name, schema, used)
    names = held.filter(~F.col("_row")).select("_part")
    own = rows.join(names, rows[by].cast("string") == names["_part"], "left_anti")
    return own.unionByName(held.filter("_row").select(*schema.fieldNames()))


def pack(spark: SparkSession, read: Callable[[], DataFrame], root: str, name: str, by: str, closed: float = CLOSED) -> int:
    """Packs the partitions of a table that were last written over `closed` seconds ago, and says how many.

    `read` gives the table's own partitions as they are then. One run at a time, which the warehouse's lease sees to. A run that dies
    leaves what it had not finished to the next one. The names of the partitions since the last run go
    through the driver, their rows do not.
    """
    schema = read().schema
    used, stale = packs(spark, root, name)
    here = {n.split("=", 1)[1]: age for n, age in _listed(spark, f"{root}/{name}") if n.startswith(f"{by}=")}
    names = spark.createDataFrame([(n,) for n in here], "_part string")
    if used:
        held = _rows(spark, root, name, schema, used).filter(~F.col("_row")).select("_part")
        packed = {r[0] for r in names.join(held, "_part", "left_semi").collect()}  # of the partitions since the last run
    else:
        packed = set()
    for part in packed:
        drop_path(spark, f"{root}/{name}/{by}={part}")
    for a, b in stale:
        drop_path(spark, f"{_folder(root, name)}/pack={a}-{b}")
    fresh = sorted(n for n, age in here.items() if age >= closed and n not in packed)
    if not fresh:
        return 0
    run = used[-1][1] + 1 if used else 1
    start, joined = run, []
    for a, b in reversed(used):
        if b - a + 1 > run - start + 1:
            break
        start = a
        joined.append((a, b))
    marks = spark.createDataFrame([(n,) for n in fresh], "_part string")
    wanted = read().withColumn("_part", F.col(by).cast("string")).join(marks, "_part", "left_semi").withColumn("_row", F.lit(True))
    empty = marks.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], "_part", F.lit(False).alias("_row"))
    new = wanted.unionByName(empty)
    if joined:
        new = new.unionByName(_rows(spark, root, name, schema, joined))
    new.hint("rebalance").write.parquet(f"{_folder(root, name)}/pack={start}-{run}")
    return len(fresh)


def drop_packs(spark: SparkSession, root: str, name: str) -> None:
    drop_path(spark, _folder(root, name))
