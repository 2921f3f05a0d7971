"""Windowed aggregates in append mode, over records that the stream itself deduplicates.

The first record of a key that arrives counts; its repeats are dropped for as long as the watermark
has not passed its event time by the delay, which bounds the state. A window is written once, when
the watermark has passed its end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curbside import settings as S
from curbside.operators import gold
from curbside.operators.silver import clean
from curbside.sources.sinks import write_batch
from curbside.streaming.pipeline import _start, _stream_id

LATE_PARTITIONS = ("event_date",)


def first_arrivals(records: DataFrame, delay: str, time_fallback: Column | None = None, event_type: str | None = None) -> DataFrame:
    """Cleaned records with a watermark, without repeats of a key. Records behind the watermark are dropped.

    All records move the watermark; with ``event_type`` only those of one type are kept and remembered.
    """
    marked = clean(records, time_fallback).withWatermark("event_ts", delay)
    if event_type is not None:
        # Always true, but not deterministic: Spark would move the filter below the watermark, where other types would not count.
        always = F.rand(0) + 1 >= 1
        marked = marked.filter((F.col("event_type") == event_type) == always)
    return marked.dropDuplicatesWithinWatermark(list(S.SILVER_KEYS))


def closed_city_metrics(records: DataFrame, time_fallback: Column | None = None) -> DataFrame:
    """City metrics of a stream of accepted records, for closed windows."""
    return gold.city_totals(gold.city_rides(gold.usable(first_arrivals(records, S.CITY_WATERMARK, time_fallback))))


def closed_driver_utilization(records: DataFrame, time_fallback: Column | None = None) -> DataFrame:
    """Driver utilisation of a stream of accepted records, for closed sliding windows."""
    rows = gold.usable(first_arrivals(records, S.DRIVER_WATERMARK, time_fallback)).filter(F.col("driver_id").isNotNull())
    return gold.driver_totals(gold.driver_rides(rows))


def demand_with_supply(demand: DataFrame, supply: DataFrame, time_fallback: Column | None = None) -> DataFrame:
    """Closed windows of demand with their supply: two streams of accepted records, joined by window and city.

    Both sides carry a watermark. A window without supply is written, with no active drivers, once
    the watermarks of both sides have passed it; a NULL city has no supply.
    """
    asked = gold.demand_counts(gold.usable(first_arrivals(demand, S.SURGE_WATERMARK, time_fallback, S.REQUESTED)))
    active = gold.supply_counts(gold.usable(first_arrivals(supply, S.SURGE_WATERMARK, time_fallback, S.ASSIGNED)))
    return asked.join(active, ["win", "city"], "left").select(
        "win", "city", "ride_requests", "avg_surge_multiplier", F.coalesce("drivers_active", F.lit(0).cast("long")).alias("drivers_active"))


def start_split_by_watermark(records: DataFrame, path: str, checkpoint: str, delay: str, window: str, name: str | None = None,
                             trigger: dict | None = None, time_fallback: Column | None = None) -> StreamingQuery:
    """Append cleaned records to ``path``/on_time, and those whose window had closed before their batch to ``path``/late.

    The watermark of a batch follows from the records of the batches before it: the latest event
    time less ``delay``. Each batch records the one it leaves in ``path``/watermarks, so a replayed
    batch is split as before, and late rows are data instead of being lost in an aggregate.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            limit = None
            if batch_id:
                limit = spark.read.parquet(f"{path}/watermarks/batch_id={batch_id - 1}").first().latest
            latest = batch.agg(F.max("event_ts")).first()[0]
            latest = max((x for x in (limit, latest) if x is not None), default=None)
            closed = F.lit(False)
            if limit is not None:
                closed = F.window("event_ts", window)["end"] <= F.lit(limit) - F.expr(f"INTERVAL {delay}")
            marked = batch.withColumn("_late", F.coalesce(closed, F.lit(False)))
            for part, late in (("late", True), ("on_time", False)):
                rows = marked.filter(F.col("_late") == late).drop("_late")
                write_batch(rows, f"{path}/{part}", _stream_id(batch), batch_id, LATE_PARTITIONS)
            spark.createDataFrame([(latest,)], "latest timestamp").coalesce(1).write.mode("overwrite").parquet(
                f"{path}/watermarks/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return _start(clean(records, time_fallback), split, checkpoint, name, trigger)


def accounting(on_time: DataFrame, late: DataFrame, closed: DataFrame) -> DataFrame:
    """Per city and minute: usable records in closed windows, in open ones and late ones; they add up to ``records``."""
    def counted(rows: DataFrame, name: str) -> DataFrame:
        return gold.usable(rows).groupBy(F.window("event_ts", S.CITY_WINDOW)["start"].alias("window_start"), "city").agg(
            F.count("*").alias("n")).withColumn("kind", F.lit(name))
    kinds = counted(on_time, "on_time").unionByName(counted(late, "late")).unionByName(
        closed.select("window_start", "city", F.col("total_rides").alias("n"), F.lit("closed").alias("kind")))
    return kinds.groupBy("window_start", "city").pivot("kind", ["closed", "late", "on_time"]).agg(F.sum("n")).na.fill(0, ["closed", "late", "on_time"]).select(
        "window_start", "city", "closed", "late", (F.col("on_time") - F.col("closed")).alias("open"),
        (F.col("on_time") + F.col("late")).alias("records"))
