"""Reports over the stored tables.

``as_of`` stands for "now": a datetime, a column, or None for the current time. Bounds on a
window's start are paired with the implied bound on its date, so that partitions are pruned.
Where the order of a result is not unique, the keys of the row decide.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbside import settings as S
from curbside.functions.numeric import mean, ratio, total
from curbside.functions.timing import ago, moment

AsOf = Column | datetime | None


def _today(as_of: AsOf) -> Column:
    return F.to_date(moment(as_of))


def _windows_since(gold: DataFrame, as_of: AsOf, interval: str) -> DataFrame:
    start = ago(as_of, interval)
    return gold.filter(
        (F.col("window_start_date") >= F.to_date(start)) & (F.col("window_start") >= start))


def _sum2(col: str) -> Column:
    return F.round(total(col), 2)


def _avg2(col: str) -> Column:
    return F.round(mean(col), 2)


def city_dashboard(city_metrics: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Rides, revenue and fares per city over the last 15 minutes."""
    return (
        _windows_since(city_metrics, as_of, "15 MINUTES").groupBy("city")
        .agg(F.sum("total_rides").alias("rides_last_15min"),
             F.sum("completed_rides").alias("completed_rides"),
             _avg2("avg_fare").alias("avg_fare_usd"),
             _sum2("total_gross_revenue").alias("gross_revenue_usd"),
             _avg2("avg_surge_multiplier").alias("avg_surge"),
             _avg2("completion_rate").alias("completion_rate_pct"))
        .orderBy(F.desc("rides_last_15min"), "city")
    )


def _status(tier: Column) -> Column:
    out = None
    for name, label in S.SURGE_STATUS.items():
        out = (F.when if out is None else out.when)(tier == name, label)
    return out.otherwise(S.SURGE_STATUS_REST)


def surge_alerts(surge: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Windows of the last 10 minutes in which surge was triggered."""
    return (
        _windows_since(surge, as_of, "10 MINUTES").filter("surge_triggered")
        .select("city", "window_start", "ride_requests", "drivers_active", "demand_supply_ratio",
                "recommended_surge_multiplier", "surge_tier",
                _status(F.col("surge_tier")).alias("surge_status"))
        .orderBy(F.desc("demand_supply_ratio"), "city", "window_start")
    )


def driver_leaderboard(drivers: DataFrame, as_of: AsOf = None, top: int = 20) -> DataFrame:
    """The day's drivers by mean efficiency score, among those who completed a trip."""
    return (
        drivers.filter(F.col("window_start_date") == _today(as_of)).groupBy("driver_id", "city")
        .agg(_avg2("efficiency_score").alias("avg_efficiency_score"),
             F.sum("trips_completed").alias("total_completed_trips"),
             _sum2("total_earnings").alias("total_earnings_usd"),
             _avg2("utilization_rate").alias("avg_utilization_pct"),
             _avg2("avg_earnings_per_trip").alias("avg_earnings_per_trip"))
        .filter("total_completed_trips > 0")
        .orderBy(F.desc("avg_efficiency_score"), "driver_id", "city").limit(top)
    )


def hourly_revenue(city_metrics: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Rides and revenue per city and hour over the last 24 hours."""
    return (
        _windows_since(city_metrics, as_of, "24 HOURS")
        .groupBy("city", F.date_trunc("hour", "window_start").alias("hour_bucket"))
        .agg(F.sum("total_rides").alias("total_rides"),
             F.sum("completed_rides").alias("completed_rides"),
             _sum2("total_gross_revenue").alias("gross_revenue_usd"),
             _sum2("total_net_revenue").alias("net_revenue_usd"),
             _avg2("avg_fare").alias("avg_fare_usd"),
             _avg2("avg_surge_multiplier").alias("avg_surge_multiplier"))
        .orderBy("city", "hour_bucket")
    )


def funnel_conversion(funnel: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The day's rides per stage and conversion rates per city."""
    return (
        funnel.filter(F.col("event_date") == _today(as_of)).groupBy("city")
        .agg(F.sum("stage_1_requested").alias("total_requested"),
             F.sum("stage_2_assigned").alias("total_assigned"),
             F.sum("stage_3_started").alias("total_started"),
             F.sum("stage_4_completed").alias("total_completed"),
             F.sum("stage_5_payment").alias("total_payments"),
             _avg2("assignment_rate").alias("avg_assignment_rate_pct"),
             _avg2("completion_rate").alias("avg_completion_rate_pct"),
             _avg2("payment_rate").alias("avg_payment_rate_pct"))
        .withColumn("end_to_end_conversion_pct",
                    F.round(ratio("total_payments", "total_requested") * 100, 2))
        .orderBy(F.desc("end_to_end_conversion_pct"), "city")
    )


def demand_gap(surge: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Mean demand, supply and unmet demand per city over the last hour."""
    return (
        _windows_since(surge, as_of, "1 HOUR").groupBy("city")
        .agg(F.max("window_start").alias("latest_window"),
             F.avg("ride_requests").alias("avg_ride_requests"),
             F.avg("drivers_active").alias("avg_drivers_active"),
             mean("demand_supply_ratio").alias("avg_demand_supply_ratio"),
             F.round(F.avg(F.col("ride_requests") - F.col("drivers_active")), 0)
             .alias("avg_unmet_demand"),
             F.count_if("surge_triggered").alias("surge_trigger_count"),
             F.mode("surge_tier", deterministic=True).alias("dominant_surge_tier"))
        .orderBy(F.desc("avg_demand_supply_ratio"), "city")
    )


def week_over_week(current: DataFrame, prior: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Revenue per city over the last week against the week before.

    ``prior`` is the table as it was a week ago, or the same table. Both weeks are ranges of
    eight days and include the day seven days back.
    """
    def revenue(df, start, end, name):
        day = F.col("window_start_date")
        return (df.filter(day.between(F.date_sub(_today(as_of), start), F.date_sub(_today(as_of), end)))
                .groupBy("city").agg(total("total_gross_revenue").alias(name)))
    change = F.col("this_week") - F.col("prior_week")
    return (
        revenue(current, 7, 0, "this_week").join(revenue(prior, 14, 7, "prior_week"), "city", "left")
        .select("city",
                F.round("this_week", 2).alias("revenue_this_week_usd"),
                F.round("prior_week", 2).alias("revenue_prior_week_usd"),
                F.round(change, 2).alias("revenue_delta_usd"),
                F.round(ratio(change, "prior_week") * 100, 2).alias("revenue_growth_pct"))
        .orderBy(F.desc("revenue_growth_pct"), "city")
    )


def dead_letter_daily(dead: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Rejected records per day and reason over the last seven days."""
    reasons = {"NULL_RIDE_ID": "null_ride_id_count", "NULL_EVENT_TYPE": "null_event_type_count",
               "SCHEMA_MISMATCH": "schema_mismatch_count"}
    return (
        dead.filter(F.col("event_date") >= F.date_sub(_today(as_of), 7)).groupBy("event_date")
        .agg(F.count("*").alias("dead_letter_count"),
             *[F.count_if(F.col("dead_letter_reason") == r).alias(n) for r, n in reasons.items()])
        .orderBy(F.desc("event_date"))
    )


def peak_hours(city_metrics: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Busiest and quietest hour of day per city over 30 days, by mean rides per window."""
    hourly = (
        city_metrics.filter(F.col("window_start_date") >= F.date_sub(_today(as_of), 30))
        .groupBy("city", F.hour("window_start").alias("hour_of_day"))
        .agg(F.avg("total_rides").alias("mean_rides"))
    )
    by_city = Window.partitionBy("city")
    ranked = hourly.select(
        "city", "hour_of_day", F.round("mean_rides", 1).alias("rides"),
        F.row_number().over(by_city.orderBy(F.desc("mean_rides"), "hour_of_day")).alias("peak"),
        F.row_number().over(by_city.orderBy("mean_rides", "hour_of_day")).alias("off_peak"))
    def first(rank, col):
        return F.max(F.when(F.col(rank) == 1, F.col(col)))
    return (
        ranked.groupBy("city")
        .agg(first("peak", "hour_of_day").alias("peak_hour"),
             first("peak", "rides").alias("peak_rides_per_hr"),
             first("off_peak", "hour_of_day").alias("off_peak_hour"),
             first("off_peak", "rides").alias("off_peak_rides_per_hr"))
        .orderBy(F.desc("peak_rides_per_hr"), "city")
    )


def bronze_profile(bronze: DataFrame, top: int = 50) -> DataFrame:
    """The latest days' largest groups of city and event type."""
    return (
        bronze.groupBy("event_date", "city", "event_type")
        .agg(F.count("*").alias("event_count"), _avg2("fare_amount").alias("avg_fare"))
        .orderBy(F.desc("event_date"), F.desc("event_count"), "city", "event_type").limit(top)
    )


def dead_letter_reasons(dead: DataFrame, as_of: AsOf = None, today_only: bool = False) -> DataFrame:
    if today_only:
        dead = dead.filter(F.col("event_date") == _today(as_of))
    return (dead.groupBy("dead_letter_reason").agg(F.count("*").alias("record_count"))
            .orderBy(F.desc("record_count"), "dead_letter_reason"))


def quality_summary(silver: DataFrame) -> DataFrame:
    """Records per combination of flags and their share of all records."""
    return silver.sparkSession.sql(
        """
        SELECT has_data_quality_issue, dq_invalid_event_type, dq_fare_out_of_range,
               dq_distance_out_of_range, dq_null_driver, dq_null_rider,
               count(*) AS record_count,
               round(count(*) * 100D / sum(count(*)) OVER (), 2) AS pct_of_total
        FROM {silver}
        GROUP BY ALL
        ORDER BY record_count DESC
        """, silver=silver)


def city_last_hour(city_metrics: DataFrame, as_of: AsOf = None) -> DataFrame:
    return (
        _windows_since(city_metrics, as_of, "1 HOUR").groupBy("city")
        .agg(F.sum("total_rides").alias("rides_last_hour"),
             _sum2("total_gross_revenue").alias("gross_revenue_usd"),
             _avg2("avg_fare").alias("avg_fare"),
             _avg2("avg_surge_multiplier").alias("avg_surge"),
             _avg2("completion_rate").alias("completion_rate_pct"))
        .orderBy(F.desc("rides_last_hour"), "city")
    )


def surge_recent(surge: DataFrame, as_of: AsOf = None, interval: str | None = "15 MINUTES") -> DataFrame:
    """Triggered windows of the last minutes, or of all time with ``interval=None``."""
    if interval:
        surge = _windows_since(surge, as_of, interval)
    return (
        surge.filter("surge_triggered")
        .select("city", "surge_tier", "demand_supply_ratio", "recommended_surge_multiplier",
                "window_start")
        .orderBy(F.desc("demand_supply_ratio"), "city", "window_start")
    )


def driver_short(drivers: DataFrame, as_of: AsOf = None, top: int = 20) -> DataFrame:
    return (
        drivers.filter(F.col("window_start_date") == _today(as_of)).groupBy("driver_id", "city")
        .agg(_avg2("efficiency_score").alias("efficiency_score"),
             F.sum("trips_completed").alias("trips_completed"),
             _sum2("total_earnings").alias("total_earnings_usd"))
        .filter("trips_completed > 0")
        .orderBy(F.desc("efficiency_score"), "driver_id", "city").limit(top)
    )


def event_type_counts(bronze: DataFrame) -> DataFrame:
    return (bronze.groupBy("event_type").agg(F.count("*").alias("record_count"))
            .orderBy(F.desc("record_count"), "event_type"))


def quality_averages(silver: DataFrame) -> DataFrame:
    return silver.groupBy("has_data_quality_issue").agg(
        F.count("*").alias("records"), _avg2("fare_amount").alias("avg_fare"),
        _avg2("trip_distance").alias("avg_distance_km"))


def rides_by_city(silver: DataFrame) -> DataFrame:
    return silver.groupBy("city").agg(F.count("*").alias("rides"))


def point_lookup(silver: DataFrame, day: Column | str, city: str, ride_id: str) -> DataFrame:
    """Records of one ride; the day and the city prune partitions."""
    day = F.lit(day).cast("date") if isinstance(day, str) else day
    return silver.filter(
        (F.col("event_date") == day) & (F.col("city") == city) & (F.col("ride_id") == ride_id))
