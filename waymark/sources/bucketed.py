"""Tables stored by user: in buckets of a hash of the user, each sorted.

What joins or groups such a table by user reads the buckets as they are: the stored side needs
no exchange, and two tables with equally many buckets meet bucket by bucket. A note beside the
files says how they are stored, so that any session can open them as such; read as plain
Parquet they are the same rows.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.schemas import check_schema
from waymark.sources.tables import read_table

BUCKETS = 64

_NOTE = "_buckets"


def write_bucketed(
    df: DataFrame, path: str, by: str = "user_id", buckets: int = BUCKETS
) -> None:
    """Overwrite a table in ``buckets`` files by a hash of ``by``, sorted by it."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, by).write.mode("overwrite")
    try:
        writer.bucketBy(buckets, by).sortBy(by).option("path", path).saveAsTable(name)
    finally:
        # The files are the caller's; only the name goes.
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    note = spark.range(1).select(F.lit(by).alias("by"), F.lit(buckets).alias("buckets"))
    note.coalesce(1).write.mode("overwrite").json(f"{path}/{_NOTE}")


def stored_buckets(spark: SparkSession, path: str) -> tuple[str, int] | None:
    """The column and number of buckets a table is stored by, or None of a plain one."""
    note = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_NOTE}")
    if not note.getFileSystem(spark._jsc.hadoopConfiguration()).exists(note):
        return None
    found = spark.read.schema("by string, buckets int").json(f"{path}/{_NOTE}").first()
    return found["by"], found["buckets"]


def open_table(spark: SparkSession, path: str, schema: T.StructType, name: str) -> DataFrame:
    """A table held to its contract, by its buckets if it is stored in them.

    A join on the bucket column and others takes the buckets as they are only in a session
    that allows it (``waymark.session.join_by_user``).
    """
    by = stored_buckets(spark, path)
    if by is None:
        return read_table(spark, path, schema, name)
    column, buckets = by
    table = f"{name}_{hashlib.md5(path.encode()).hexdigest()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (path '{path}') "
        f"CLUSTERED BY ({column}) SORTED BY ({column}) INTO {buckets} BUCKETS"
    )
    return check_schema(spark.table(table), schema, name)
