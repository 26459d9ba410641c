"""Rows and table names out of a database or the session catalogue."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# JDBC driver classes and the catalogue query.
DRIVERS = {
    "crate": "io.crate.client.jdbc.CrateDriver",
    "postgres": "org.postgresql.Driver",
}
TABLES_SQL = "SELECT table_schema, table_name FROM information_schema.tables"


def jdbc_options(
    url: str,
    sql: str,
    driver: str,
    split: tuple[str, str, str, int] | None = None,
    options: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC read; ``split`` is column, lower, upper bound and partitions."""
    chosen = {**(options or {}), "url": url, "driver": DRIVERS.get(driver, driver)}
    if split is None:
        return {**chosen, "query": sql}
    column, lower, upper, partitions = split
    return {
        **chosen,
        "dbtable": f"({sql}) t",
        "partitionColumn": column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(partitions),
    }


def query_rows(spark: SparkSession, url: str, sql: str, driver: str, **more) -> DataFrame:
    """Rows of a query run by the database; give ``split`` for a large result."""
    return spark.read.format("jdbc").options(**jdbc_options(url, sql, driver, **more)).load()


def database_tables(spark: SparkSession, url: str, driver: str, **more) -> DataFrame:
    return query_rows(spark, url, TABLES_SQL, driver, **more)


def catalog_tables(spark: SparkSession, schema: str) -> DataFrame:
    """Tables of one schema of the session catalogue."""
    return (
        spark.sql(f"SHOW TABLES IN `{schema}`")
        .where(~F.col("isTemporary"))
        .select(F.col("namespace").alias("table_schema"), F.col("tableName").alias("table_name"))
    )
