"""The batch run that refreshes the aggregate tables from stored silver."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.operators.gold import AGGREGATE_DAYS, AGGREGATES
from curbside.operators.silver import recent, since_cutoff
from curbside.schemas import GOLD
from curbside.sources.sinks import overwrite_days

# Columns any aggregate reads; the rest of silver is not cached.
NEEDED = ("ride_id", "driver_id", "city", "event_type", "trip_distance", "fare_amount", "net_fare",
          "surge_multiplier", "event_ts", "event_date", "has_data_quality_issue")

# Windows that began before the cutoff would be incomplete: an earlier run has stored them whole.
# The cutoff is a midnight, so it never cuts a day.
WINDOWED = ("city_ride_metrics", "driver_utilization", "surge_pricing")


def gold_since(silver: DataFrame, as_of: Column | datetime | None, hours: float,
               tables: tuple[str, ...] = tuple(AGGREGATES)) -> dict[str, DataFrame]:
    """The aggregates of rows since the cutoff, without windows that began before it."""
    rows = recent(silver, as_of, hours).select(*NEEDED)
    cutoff = since_cutoff(as_of, hours).cast("timestamp")
    frames = {name: AGGREGATES[name](rows) for name in tables}
    return {name: df.filter(F.col("window_start") >= cutoff) if name in WINDOWED else df
            for name, df in frames.items()}


def run_gold(silver: DataFrame, root: str, as_of: Column | datetime | None = None,
             since_hours: float = 2, cache: bool = True,
             tables: tuple[str, ...] = tuple(AGGREGATES)) -> None:
    """Compute whole days since the cutoff and put them in the place of what is stored for them.

    Repeating a run changes nothing. A day that has no rows any more keeps what it had.
    """
    as_of = datetime.now(timezone.utc) if as_of is None else as_of
    rows = silver.select(*NEEDED)
    if cache:
        rows = recent(rows, as_of, since_hours).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, df in gold_since(rows, as_of, since_hours, tables).items():
            overwrite_days(df, f"{root}/{name}", AGGREGATE_DAYS[name])
    finally:
        if cache:
            rows.unpersist()


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored aggregate; a filter on its day reads the partitions of these days only."""
    return spark.read.schema(GOLD[name]).parquet(f"{root}/{name}").select(*GOLD[name].names)
