"""Session settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC: event times are UTC until they are shown in a city's zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def join_by_user(spark: SparkSession) -> SparkSession:
    """Let a join on the user and more columns use tables that are stored by user, instead of
    exchanging both sides by all of its columns."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark
