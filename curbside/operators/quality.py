"""Rates, counts and checks over the stored layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside import settings as S
from curbside.functions.numeric import percent
from curbside.functions.timing import moment


def _since(as_of: Column | datetime | None, hours: float | None, days: int | None) -> Column:
    if days is not None:
        return F.date_sub(F.to_date(moment(as_of)), days)
    return moment(as_of) - F.make_dt_interval(secs=F.lit(int(hours * 3600)))


def dead_letter_rate(bronze: DataFrame, dead: DataFrame, as_of: Column | datetime | None = None,
                     hours: float | None = 1, days: int | None = None,
                     threshold: float = S.DEAD_LETTER_MAX_PCT) -> DataFrame:
    """One row: counts, share of rejects and whether it exceeds the threshold.

    ``days`` counts from a midnight instead of the last ``hours``. The bound on event_date
    (the ingestion day) is implied and prunes partitions.
    """
    start = _since(as_of, hours, days)
    def part(df, dead_flag):
        return df.filter((F.col("event_date") >= F.to_date(start)) & (F.col("ingestion_ts") >= start)
                         ).select(F.lit(dead_flag).alias("is_dead"))
    return (
        part(bronze, False).unionAll(part(dead, True))
        .agg(F.count_if(~F.col("is_dead")).alias("bronze_count"),
             F.count_if("is_dead").alias("dead_letter_count"))
        .withColumn("dead_letter_pct", percent(
            "dead_letter_count", F.col("bronze_count") + F.col("dead_letter_count")))
        .withColumns({"threshold_pct": F.lit(threshold),
                      "alert_triggered": F.col("dead_letter_pct") > threshold})
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, row_count; an empty table counts 0."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
              for n, df in tables.items()]
    return reduce(DataFrame.unionAll, counts)


def pipeline_metrics(bronze: DataFrame, silver: DataFrame, city_metrics: DataFrame) -> DataFrame:
    """One row: rows per layer and the share of flagged silver rows."""
    labelled = (
        bronze.select(F.lit("b").alias("layer"), F.lit(False).alias("flagged"))
        .unionAll(silver.select(F.lit("s"), "has_data_quality_issue"))
        .unionAll(city_metrics.select(F.lit("g"), F.lit(False))))
    in_layer = lambda x: F.col("layer") == x
    return labelled.agg(
        F.count_if(in_layer("b")).alias("bronze_row_count"),
        F.count_if(in_layer("s")).alias("silver_row_count"),
        F.count_if(in_layer("g")).alias("gold_city_row_count"),
        F.count_if(in_layer("s") & F.col("flagged")).alias("flagged"),
    ).select("bronze_row_count", "silver_row_count", "gold_city_row_count",
             percent("flagged", "silver_row_count").alias("silver_dq_issue_rate"))


def nonempty_check(tables: Mapping[str, DataFrame]) -> DataFrame:
    return row_counts(tables).withColumn("ok", F.col("row_count") > 0)


def duplicate_keys(df: DataFrame, keys: Sequence[str] = S.SILVER_KEYS) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def quality_counts() -> tuple[Column, Column]:
    """Valid and flagged records, for an aggregate or an observation."""
    flagged = F.col("has_data_quality_issue")
    return F.count_if(~flagged).alias("valid_count"), F.count_if(flagged).alias("flagged_count")


def batch_quality(df: DataFrame) -> DataFrame:
    """One row: valid and flagged records, from a single pass."""
    return df.agg(*quality_counts())
