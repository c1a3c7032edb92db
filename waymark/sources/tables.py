"""Parquet tables with a declared schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.schemas import check_schema
from waymark.sources.staging import staged


def read_table(spark: SparkSession, path: str, schema: T.StructType, name: str) -> DataFrame:
    """Read a (partitioned) Parquet table and hold it to its contract.

    The types come from the files and directory names, so a table of another shape fails
    here with the columns named, and not in the middle of a job.
    """
    found = spark.read.option("basePath", path).parquet(path)
    wanted = {f.name: f.dataType for f in schema}
    # Directory names may be read as another type than declared (a city called "1770").
    casts = {
        f.name: F.col(f.name).cast(wanted[f.name])
        for f in found.schema
        if f.name in wanted
        and isinstance(wanted[f.name], T.StringType)
        and isinstance(f.dataType, T.IntegralType)
    }
    return check_schema(found.withColumns(casts) if casts else found, schema, name)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    rebalance: bool = True,
    only_partitions: bool = False,
) -> None:
    """Overwrite a Parquet table, optionally in Hive-style directories.

    Rows are rebalanced on the directory columns first: a small directory gets one file
    instead of one per task, and adaptive execution cuts a directory holding a large part
    of the table into files of the advisory size, so no single task has to write it.
    ``rebalance=False`` spares the shuffle when ``df`` already arrives in that order.
    ``only_partitions`` overwrites the directories ``df`` has rows for and leaves the others.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if only_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def replace_window(
    df: DataFrame, path: str, first: dt.date, last: dt.date, column: str = "date"
) -> None:
    """Put ``df`` in the place of all that a table stored by ``column`` has of a date window.

    Days ``df`` has rows for are overwritten, days of the window without any are emptied, and
    all others stay. The rows are staged before the table is touched, so that a failure while
    they are made leaves it as it was, and they may come from the table itself. Rows outside
    the window are an error.
    """
    spark = df.sparkSession
    rows = staged(df, "window")
    # No more days than the window has.
    outside = ~F.col(column).between(F.lit(first), F.lit(last)) | F.col(column).isNull()
    if not rows.where(outside).isEmpty():
        raise ValueError(f"rows outside the window from {first} to {last}")
    days = {r[0] for r in rows.select(column).distinct().collect()}
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if days or not files.exists(folder):
        write_table(rows, path, [column], only_partitions=True)
    day = first
    while day <= last:
        stale = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={day.isoformat()}")
        if day not in days and files.exists(stale):
            files.delete(stale, True)
        day += dt.timedelta(days=1)
