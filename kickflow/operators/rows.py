"""Reply to rows, or to one error row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAD_ELEMENT_POLICIES = ("truncate", "skip")


def row_status(record: Column) -> Column:
    """HTTP status of a row; NULL for an error row of a reply that came with 200."""
    status = F.col("status_code")
    return F.when(record.isNotNull() | (status != 200), status)


def rows_or_error(replies: DataFrame, found: Column, on_bad: str = "truncate") -> DataFrame:
    """One row per record of ``found``, an array of structs, in column ``record``.

    A reply without status 200 or without an array gives one error row, an empty
    array gives none. A NULL element is a bad one: with ``truncate`` it becomes
    the error row and what follows it is left out, with ``skip`` it is left out
    alone. No shuffle: rows come straight out of their reply.
    """
    if on_bad not in BAD_ELEMENT_POLICIES:
        raise ValueError(f"on_bad must be one of {BAD_ELEMENT_POLICIES}")
    parsed = replies.withColumn("found", F.when(F.col("status_code") == 200, found))
    array = F.col("found")
    if on_bad == "skip":
        kept = F.filter(array, lambda e: e.isNotNull())
    else:
        bad_at = F.array_position(F.transform(array, lambda e: e.isNull()), True)
        kept = F.when(bad_at > 0, F.slice(array, 1, bad_at.cast("int"))).otherwise(array)
    error = F.array(F.lit(None).cast(parsed.schema["found"].dataType.elementType))
    return parsed.select(
        "key", "ds", "status_code", F.explode(F.coalesce(kept, error)).alias("record")
    ).withColumn("status_code", row_status(F.col("record")))
