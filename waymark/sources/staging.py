"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read again, so that what follows neither computes it anew nor
    depends on the executors that did.

    The folder is the one named in ``spark.checkpoint.dir``, or else the warehouse; the files go
    when the session's JVM ends.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
