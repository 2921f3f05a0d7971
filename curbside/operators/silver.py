"""Cleaning, quality flags and removal of duplicates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbside import settings as S
from curbside.functions.timing import lookback_days, moment, parse_event_time
from curbside.schemas import SILVER

NEWEST_FIRST = ("ingestion_ts", "kafka_offset", "kafka_partition")


def quality_flags() -> dict[str, Column]:
    """One flag per rule, in SQL three-valued logic: an unknown event type gives NULL.

    NaN sorts above every number, so a NaN fare or distance is out of range.
    """
    fare, distance = F.col("fare_amount"), F.col("trip_distance")
    flags = {
        "dq_invalid_event_type": ~F.col("event_type").isin(*S.EVENT_TYPES),
        "dq_fare_out_of_range": (fare < 0) | (fare > S.FARE_MAX),
        "dq_distance_out_of_range":
            (distance < S.DISTANCE_MIN_KM) | (distance > S.DISTANCE_MAX_KM),
        "dq_null_driver": F.col("driver_id").isNull(),
        "dq_null_rider": F.col("rider_id").isNull(),
    }
    return flags


def flag_quality(df: DataFrame) -> DataFrame:
    """Adds the five flags and their disjunction; expects fares and distances imputed."""
    flags = quality_flags()
    any_flag = None
    for name in flags:
        any_flag = F.col(name) if any_flag is None else any_flag | F.col(name)
    return df.withColumns(flags).withColumn("has_data_quality_issue", any_flag)


def clean(bronze: DataFrame, time_fallback: Column | None = None) -> DataFrame:
    """Normalised values, quality flags, derived columns. Narrow: no shuffle.

    ``time_fallback`` stands in for an event time that cannot be read (default: now).
    The message position is kept for ``deduplicate``; ``to_silver`` drops it.
    """
    event_ts = F.coalesce(parse_event_time(F.col("event_timestamp")), moment(time_fallback))
    normalised = bronze.withColumns({
        "event_ts": event_ts,
        "city": F.initcap(F.trim("city")),
        "trip_distance": F.coalesce("trip_distance", F.lit(0.0)),
        "fare_amount": F.coalesce("fare_amount", F.lit(0.0)),
    })
    return flag_quality(normalised).withColumns({
        "event_date": F.to_date("event_ts"),
        "event_hour": F.hour("event_ts"),
        "event_minute": F.minute("event_ts"),
        "net_fare": F.round(F.col("fare_amount") * S.DRIVER_SHARE, 2),
        "silver_processed_ts": F.current_timestamp(),
        "silver_version": F.lit(S.SILVER_VERSION),
    })


def deduplicate(df: DataFrame, keys=S.SILVER_KEYS, newest_first=NEWEST_FIRST) -> DataFrame:
    """The newest record per key; message position breaks ties of the ingestion time.

    Spark limits each group to one row before the shuffle (WindowGroupLimit), so a key
    with very many records sends one row per input partition.
    """
    order = [F.desc(c) for c in newest_first if c in df.columns]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def to_silver(df: DataFrame) -> DataFrame:
    """Exactly the declared columns, so that no helper column reaches storage."""
    return df.select(*SILVER.names)


def silver_from_bronze(bronze: DataFrame, time_fallback: Column | None = None) -> DataFrame:
    return to_silver(deduplicate(clean(bronze, time_fallback)))


def enforce_schema(df: DataFrame, required: list[str]) -> DataFrame:
    """Only the required columns, in that order; ValueError names the missing ones."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df.select(*required)


def add_schema_version(df: DataFrame, version: str = S.SCHEMA_VERSION) -> DataFrame:
    return df.withColumn("schema_version", F.lit(version))


def since_cutoff(as_of: Column | datetime | None, hours: float) -> Column:
    """Midnight of as_of's day, less the days needed to cover ``hours``."""
    return F.date_sub(F.to_date(moment(as_of)), lookback_days(hours))


def recent(silver: DataFrame, as_of: Column | datetime | None = None, hours: float = 2) -> DataFrame:
    """Rows since the cutoff.

    The bound on event_date is implied by the one on event_ts; it lets Spark prune the
    partitions of the stored table.
    """
    start = since_cutoff(as_of, hours)
    return silver.filter((F.col("event_date") >= start) & (F.col("event_ts") >= start))
