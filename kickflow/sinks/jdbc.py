"""JDBC tables: replace the slice of one day and its week, then append."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import closing
from typing import Any

from pyspark.sql import DataFrame

from kickflow.functions.nested import arrays_to_json, fill_text_nulls
from kickflow.sources.database import DRIVERS, query_rows

# The slice the sink replaces, and the number of connections.
DROP_SLICE_SQL = (
    "DELETE FROM {table} WHERE ds = '{ds}' AND "
    "ts = date_trunc('week', '+07:00', date_format('%Y-%m-%d', '+07:00', '{ds}'))"
)
CONNECTIONS = 10

Connect = Callable[[], Any]


def run_statement(connect: Connect, sql: str) -> None:
    """Run one statement in the target database and commit; the only step without Spark."""
    with closing(connect()) as connection:
        cursor = connection.cursor()
        cursor.execute(sql)
        connection.commit()
        cursor.close()


def table_has_rows(df: DataFrame, url: str, table: str, driver: str) -> bool:
    probe = query_rows(df.sparkSession, url, f"SELECT * FROM {table} LIMIT 1", driver)
    return not probe.isEmpty()


def prepared(df: DataFrame, connections: int = CONNECTIONS) -> DataFrame:
    """Flat columns, text nulls filled, one partition per connection."""
    return fill_text_nulls(arrays_to_json(df)).repartition(connections)


def replace_slice(
    df: DataFrame,
    url: str,
    table: str,
    ds: str,
    driver: str,
    connect: Connect,
    connections: int = CONNECTIONS,
    drop_sql: str | None = None,
) -> None:
    """Delete the slice of ``ds`` if the table holds anything, then append ``df``.

    Delete and append are two transactions: after a failure in between, run it again.
    """
    if table_has_rows(df, url, table, driver):
        run_statement(connect, drop_sql or DROP_SLICE_SQL.format(table=table, ds=ds))
    append(df, url, table, driver, connections)


def append(
    df: DataFrame, url: str, table: str, driver: str, connections: int = CONNECTIONS
) -> None:
    (
        prepared(df, connections)
        .write.mode("append")
        .option("driver", DRIVERS.get(driver, driver))
        .jdbc(url, table)
    )
