"""Time helpers; every relative-time rule takes its "now" as an argument."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the payload writes ISO-8601 with six fraction digits and an offset.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def moment(as_of: Column | datetime | None) -> Column:
    """``as_of`` as a column; None means the current time."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def newest(df: DataFrame, col: str) -> Column:
    """The latest value of a column as an uncorrelated scalar subquery."""
    return df.agg(F.max(col)).scalar()


def parse_event_time(text: Column) -> Column:
    """The instant a text names; NULL if neither Spark nor the declared pattern reads it.

    Where both read a text they agree. Spark's own reading comes first as it is much faster.
    """
    return F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT)))


def lookback_days(hours: float) -> int:
    """Whole days to step back from today's midnight to cover ``hours``."""
    return int(hours / 24 + 1)


def ago(as_of: Column | datetime | None, interval: str) -> Column:
    return moment(as_of) - F.expr(f"INTERVAL {interval}")
