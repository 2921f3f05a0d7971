"""Earlier states, from bronze that only grows: one instant by a filter, many by validity intervals."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbside import settings as S
from curbside.functions.timing import moment
from curbside.operators.bronze import accepted
from curbside.operators.silver import NEWEST_FIRST, clean, deduplicate, to_silver
from curbside.schemas import SILVER

FROM, TO, DAY = "valid_from", "valid_to", "valid_day"


def silver_as_of(bronze: DataFrame, at: Column | datetime | None, time_fallback: Column | None = None) -> DataFrame:
    """Silver as it was at an instant: the newest record per key of those ingested until then.

    The bound on event_date, the day of ingestion, is implied and prunes stored bronze.
    """
    until = moment(at)
    known = bronze.filter((F.col("event_date") <= F.to_date(until)) & (F.col("ingestion_ts") <= until))
    return to_silver(deduplicate(clean(accepted(known), time_fallback)))


def validity_intervals(bronze: DataFrame, time_fallback: Column | None = None) -> DataFrame:
    """Each silver record with the time during which it was the newest of its key.

    It holds from its ingestion until that of the next record of the key, which is not part of the
    interval; the present one has no end. A record that another one of the same instant replaces
    never held. The state at an instant is the records whose interval contains it.
    """
    oldest_first = Window.partitionBy(*S.SILVER_KEYS).orderBy(*NEWEST_FIRST)
    cleaned = clean(accepted(bronze), time_fallback)
    held = cleaned.withColumns({FROM: F.col("ingestion_ts"), TO: F.lead("ingestion_ts").over(oldest_first)})
    return held.filter(f"{TO} IS NULL OR {FROM} < {TO}").select(*SILVER.names, FROM, TO)


def store_intervals(intervals: DataFrame, path: str) -> None:
    """By the day on which they begin, so that a state reads no days after it."""
    intervals.withColumn(DAY, F.to_date(FROM)).hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(path)


def read_intervals(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def states_at(intervals: DataFrame, instants: DataFrame, at: str = "at") -> DataFrame:
    """Every row of ``instants`` with the records that were valid then; ``instants`` has a timestamp ``at``.

    An interval meets the days between the first and the last instant on which it was valid, and an
    instant its own day, so the join is on days, and only what begins and ends within a day is
    compared. The result grows with instants times state, so aggregate it, as ``counts_at`` does.
    """
    bounds = instants.agg(F.to_date(F.min(at)).alias("first"), F.to_date(F.max(at)).alias("last"))
    first, last = bounds.select("first").scalar(), bounds.select("last").scalar()
    begin = F.greatest(F.to_date(FROM), first)
    end = F.least(F.coalesce(F.to_date(TO), last), last)
    spread = intervals.filter(F.to_date(FROM) <= last)
    if DAY in intervals.columns:
        spread = spread.filter(F.col(DAY) <= last)
    spread = spread.withColumn("_day", F.explode(F.when(begin <= end, F.sequence(begin, end))))
    wanted = instants.withColumn("_day", F.to_date(at))
    return spread.join(wanted, "_day").filter(
        (F.col(FROM) <= F.col(at)) & (F.col(TO).isNull() | (F.col(at) < F.col(TO)))).drop("_day")


def counts_at(intervals: DataFrame, instants: DataFrame, *keys: str, at: str = "at") -> DataFrame:
    """How many records were valid at each instant, by the given columns of either side."""
    return states_at(intervals.select(*{FROM, TO, *(x for x in (DAY, *keys) if x in intervals.columns)}), instants, at).groupBy(
        at, *keys).agg(F.count("*").alias("rides"))
