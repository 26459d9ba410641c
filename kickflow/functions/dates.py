"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEK_ZONE = "+07:00"


def week_start(ds: Column, zone: str = WEEK_ZONE) -> Column:
    """Instant at which the week of ``ds`` starts in ``zone``; session zone UTC."""
    local = F.from_utc_timestamp(ds.cast("timestamp"), zone)
    return F.to_utc_timestamp(F.date_trunc("week", local), zone)


def days_between(earlier: Column, later: Column) -> Column:
    return F.datediff(later.cast("date"), earlier.cast("date"))
