"""Expiry of old days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kickflow.functions.dates import days_between
from kickflow.sinks.tables import drop_days, partition_days

# Fixed value: age in days beyond which a day expires.
DEFAULT_MAX_AGE = 30


def expired_days(
    spark: SparkSession, table: str, as_of: str, max_age: int = DEFAULT_MAX_AGE
) -> DataFrame:
    """Days of the table that are more than ``max_age`` days older than ``as_of``."""
    days = partition_days(spark, table)
    return days.where(days_between(F.col("ds"), F.lit(as_of)) > max_age)


def expire(
    spark: SparkSession,
    table: str,
    as_of: str,
    max_age: int = DEFAULT_MAX_AGE,
    enable_delete: bool = True,
) -> list[str]:
    """Drop the expired days, or only list them when ``enable_delete`` is off."""
    days = sorted(row.ds for row in expired_days(spark, table, as_of, max_age).collect())
    if enable_delete:
        drop_days(spark, table, days)
    return days
