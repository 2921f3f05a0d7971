"""The four aggregate tables.

The windowed ones aggregate twice: first per ride (or driver) within the window, then per
window. This gives exact distinct counts in batch and in append-mode streams alike. No task
or state row ever holds a set: the first step is keyed by ride, and both steps combine
before their shuffle, so a city with a large share of all rows is spread over all tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside import settings as S
from curbside.functions.numeric import exact, mean, mean_of, percent, ratio, total_of
from curbside.schemas import CITY_RIDE_METRICS, DRIVER_UTILIZATION, FUNNEL_ANALYSIS, SURGE_PRICING


def usable(silver: DataFrame) -> DataFrame:
    """Rows without a quality issue; a NULL flag is not usable either."""
    return silver.filter(~F.col("has_data_quality_issue"))


def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def _one(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _with_window(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "window_start": F.col("win.start"),
        "window_end": F.col("win.end"),
        "window_start_date": F.to_date("win.start"),
        "gold_processed_ts": F.current_timestamp(),
    })


def city_measures() -> dict[str, Column]:
    """What each record adds to its ride's sums within a window; money and distances as exact decimals."""
    earning = F.col("event_type").isin(S.COMPLETED, S.PAID)
    completed_fare = F.when(_is(S.COMPLETED), F.col("fare_amount"))
    return {
        "events": F.lit(1),
        "completed": _one(_is(S.COMPLETED)),
        "requested": _one(_is(S.REQUESTED)),
        "paid": _one(_is(S.PAID)),
        "gross": exact(F.when(earning, F.col("fare_amount")).otherwise(0.0)),
        "net": exact(F.when(earning, F.col("net_fare")).otherwise(0.0)),
        "fares": exact(completed_fare),
        "fares_n": _one(completed_fare.isNotNull()),
        "km": exact("trip_distance"),
        "km_n": _one(F.col("trip_distance").isNotNull()),
        "surge": exact("surge_multiplier"),
        "surge_n": _one(F.col("surge_multiplier").isNotNull()),
    }


def city_rides(records: DataFrame) -> DataFrame:
    """Sums per window, city and ride, of a batch or of a stream with a watermark."""
    return records.groupBy(F.window("event_ts", S.CITY_WINDOW).alias("win"), "city", "ride_id").agg(
        *(F.sum(x).alias(name) for name, x in city_measures().items()),
        F.max("fare_amount").alias("fare_hi"), F.min("fare_amount").alias("fare_lo"))


def city_totals(rides: DataFrame) -> DataFrame:
    """The measures of a window from those of its rides."""
    per_window = rides.groupBy("win", "city").agg(
        F.sum("events").alias("total_rides"),
        F.count("ride_id").alias("unique_rides"),
        F.sum("completed").alias("completed_rides"),
        F.sum("requested").alias("requested_rides"),
        F.sum("paid").alias("payment_events"),
        total_of("gross").alias("total_gross_revenue"),
        total_of("net").alias("total_net_revenue"),
        mean_of("fares", "fares_n").alias("avg_fare"),
        F.max("fare_hi").alias("max_fare"),
        F.min("fare_lo").alias("min_fare"),
        mean_of("km", "km_n").alias("avg_distance_km"),
        total_of("km").alias("total_distance_km"),
        mean_of("surge", "surge_n").alias("avg_surge_multiplier"),
    )
    rated = _with_window(per_window).withColumn(
        "completion_rate", percent("completed_rides", "requested_rides"))
    return rated.select(*CITY_RIDE_METRICS.names)


def city_ride_metrics(silver: DataFrame) -> DataFrame:
    """Counts, revenue, fares, distances and surge per city and minute."""
    return city_totals(city_rides(usable(silver).withWatermark("event_ts", S.CITY_WATERMARK)))


def driver_measures() -> dict[str, Column]:
    """What each record adds to the sums of its driver's ride within a window."""
    return {
        "events": F.lit(1),
        "assigned": _one(_is(S.ASSIGNED)),
        "completed": _one(_is(S.COMPLETED)),
        "earned": exact(F.when(_is(S.PAID), F.col("fare_amount")).otherwise(0.0)),
        "km": exact("trip_distance"),
        "km_n": _one(F.col("trip_distance").isNotNull()),
    }


def driver_rides(records: DataFrame) -> DataFrame:
    """Sums per sliding window, driver, city and ride."""
    window = F.window("event_ts", S.DRIVER_WINDOW, S.DRIVER_SLIDE).alias("win")
    return records.groupBy(window, "driver_id", "city", "ride_id").agg(*(F.sum(x).alias(name) for name, x in driver_measures().items()))


def driver_totals(rides: DataFrame) -> DataFrame:
    """The measures of a driver, city and window from those of the rides."""
    per_window = rides.groupBy("win", "driver_id", "city").agg(
        F.count("ride_id").alias("unique_rides"),
        F.sum("assigned").alias("trips_assigned"),
        F.sum("completed").alias("trips_completed"),
        total_of("earned").alias("total_earnings"),
        mean_of("km", "km_n").alias("avg_distance_km"),
    )
    return score_drivers(_with_window(per_window)).select(*DRIVER_UTILIZATION.names)


def driver_utilization(silver: DataFrame) -> DataFrame:
    """Trips, earnings and score per driver and city over sliding windows."""
    known = usable(silver).filter(F.col("driver_id").isNotNull())
    return driver_totals(driver_rides(known.withWatermark("event_ts", S.DRIVER_WATERMARK)))


def score_drivers(df: DataFrame) -> DataFrame:
    """Utilisation, earnings per trip and the 0-100 score from counts and earnings."""
    earnings_mark = F.least(
        F.col("avg_earnings_per_trip") / S.EARNINGS_FULL_MARK * 100, F.lit(100.0))
    return df.withColumns({
        "utilization_rate": percent("trips_completed", "trips_assigned"),
        "avg_earnings_per_trip": F.round(ratio("total_earnings", "trips_completed"), 2),
    }).withColumn("efficiency_score", F.round(
        F.col("utilization_rate") * S.UTILIZATION_WEIGHT + earnings_mark * S.EARNINGS_WEIGHT, 2))


def demand_counts(records: DataFrame) -> DataFrame:
    """Requests per window and city, of a batch or of a stream with a watermark."""
    return records.filter(_is(S.REQUESTED)).groupBy(F.window("event_ts", S.SURGE_WINDOW).alias("win"), "city").agg(
        F.count("*").alias("ride_requests"), mean("surge_multiplier").alias("avg_surge_multiplier"))


def surge_demand(silver: DataFrame) -> DataFrame:
    return demand_counts(usable(silver).withWatermark("event_ts", S.SURGE_WATERMARK))


def surge_supply(silver: DataFrame) -> DataFrame:
    return (
        usable(silver).filter(_is(S.ASSIGNED))
        .withWatermark("event_ts", S.SURGE_WATERMARK)
        .groupBy(F.window("event_ts", S.SURGE_WINDOW).alias("win"), "city")
        .agg(F.count_distinct("driver_id").alias("drivers_active"))
    )


def supply_counts(records: DataFrame) -> DataFrame:
    """Distinct assigned drivers per window and city in two steps, as streams have no distinct counts."""
    per_driver = records.filter(_is(S.ASSIGNED)).groupBy(
        F.window("event_ts", S.SURGE_WINDOW).alias("win"), "city", "driver_id").agg(F.count("*").alias("assignments"))
    return per_driver.groupBy("win", "city").agg(F.count("driver_id").alias("drivers_active"))


def demand_supply_join(silver: DataFrame) -> DataFrame:
    """Demand with its supply, as a join of the two aggregates (batch only).

    ``demand_supply`` gives the same rows from one scan; this form is its cross-check.
    """
    demand, supply = surge_demand(silver), surge_supply(silver)
    joined = demand.join(supply, ["win", "city"], "left")
    return joined.withColumn("drivers_active", F.coalesce("drivers_active", F.lit(0)))


def surge_measures() -> dict[str, Column]:
    """What each record adds to the sums of its driver within a window."""
    requested = _is(S.REQUESTED)
    return {
        "requests": _one(requested),
        "assignments": _one(_is(S.ASSIGNED)),
        "surge": exact(F.when(requested, F.col("surge_multiplier"))),
        "surge_n": _one(requested & F.col("surge_multiplier").isNotNull()),
    }


def wanted_or_supplied(records: DataFrame) -> DataFrame:
    return records.filter(F.col("event_type").isin(S.REQUESTED, S.ASSIGNED))


def surge_drivers(records: DataFrame) -> DataFrame:
    """Sums per window, city and driver."""
    return records.groupBy(F.window("event_ts", S.SURGE_WINDOW).alias("win"), "city", "driver_id").agg(
        *(F.sum(x).alias(name) for name, x in surge_measures().items()))


def paired(drivers: DataFrame) -> DataFrame:
    """Requests and active drivers of windows that have requests.

    A NULL city has no supply, as it would match nothing in a join.
    """
    active = (F.col("assignments") > 0) & F.col("driver_id").isNotNull() & F.col("city").isNotNull()
    return drivers.groupBy("win", "city").agg(
        F.sum("requests").alias("ride_requests"),
        F.count_if(active).alias("drivers_active"),
        mean_of("surge", "surge_n").alias("avg_surge_multiplier"),
    ).filter("ride_requests > 0")


def demand_supply(silver: DataFrame) -> DataFrame:
    """Requests and distinct assigned drivers per city and window that has requests."""
    return paired(surge_drivers(wanted_or_supplied(usable(silver)).withWatermark("event_ts", S.SURGE_WATERMARK)))


def _by_step(pick, rest) -> Column:
    ratio_ = F.col("demand_supply_ratio")
    start = F.when(ratio_ > S.SURGE_STEPS[0][0], pick(S.SURGE_STEPS[0]))
    return reduce(lambda c, s: c.when(ratio_ > s[0], pick(s)), S.SURGE_STEPS[1:], start).otherwise(rest)


def price_surge(pairs: DataFrame) -> DataFrame:
    """Ratio, trigger, tier and recommended multiplier from requests and active drivers."""
    return pairs.withColumn(
        "demand_supply_ratio", F.round(ratio("ride_requests", "drivers_active"), 2)
    ).withColumns({
        "surge_triggered": F.col("demand_supply_ratio") > S.SURGE_STEPS[-1][0],
        "recommended_surge_multiplier": _by_step(lambda s: F.lit(s[2]), S.SURGE_FLOOR[1]),
        "surge_tier": _by_step(lambda s: F.lit(s[1]), S.SURGE_FLOOR[0]),
    })


def surge_totals(drivers: DataFrame) -> DataFrame:
    """Ratio, tier and price of a window and city from the sums of drivers."""
    return price_surge(_with_window(paired(drivers))).select(*SURGE_PRICING.names)


def surge_pricing(silver: DataFrame) -> DataFrame:
    return surge_totals(surge_drivers(wanted_or_supplied(usable(silver)).withWatermark("event_ts", S.SURGE_WATERMARK)))


def funnel_analysis(silver: DataFrame) -> DataFrame:
    """Distinct rides per stage, day and city (batch only); a stage nobody reached is NULL."""
    stages = {
        S.REQUESTED: "stage_1_requested",
        S.ASSIGNED: "stage_2_assigned",
        S.STARTED: "stage_3_started",
        S.COMPLETED: "stage_4_completed",
        S.PAID: "stage_5_payment",
    }
    counted = (
        usable(silver)
        .groupBy("event_date", "city")
        .pivot("event_type", list(stages))
        .agg(F.count_distinct("ride_id"))
        .withColumnsRenamed(stages)
    )
    return counted.withColumns({
        "assignment_rate": percent("stage_2_assigned", "stage_1_requested"),
        "completion_rate": percent("stage_4_completed", "stage_2_assigned"),
        "payment_rate": percent("stage_5_payment", "stage_4_completed"),
        "gold_processed_ts": F.current_timestamp(),
    }).select(*FUNNEL_ANALYSIS.names)


AGGREGATES = {
    "city_ride_metrics": city_ride_metrics,
    "driver_utilization": driver_utilization,
    "surge_pricing": surge_pricing,
    "funnel_analysis": funnel_analysis,
}

#: The column that names the day of a stored row.
AGGREGATE_DAYS = {
    "city_ride_metrics": "window_start_date",
    "driver_utilization": "window_start_date",
    "surge_pricing": "window_start_date",
    "funnel_analysis": "event_date",
}
