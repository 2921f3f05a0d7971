import pytest
from pyspark.sql import functions as F

from curbside import schemas
from curbside.operators import gold as G
from helpers import naive, physical_plan, silver, ts


def at(minute, second=0):
    return ts(f"2024-01-15 10:{minute:02}:{second:02}")


def test_city_metrics(spark):
    df = silver(
        spark,
        {"ride_id": "R1", "event_ts": at(0, 1)},
        {"ride_id": "R1", "event_type": "trip_completed", "event_ts": at(0, 59), "fare_amount": 10.0, "net_fare": 8.2},
        {"ride_id": "R2", "event_type": "payment_completed", "event_ts": at(0, 30), "fare_amount": 30.0, "net_fare": 24.6},
        {"ride_id": "R3", "event_ts": at(1)},
        {"ride_id": "R4", "event_ts": at(0), "has_data_quality_issue": True},
        {"ride_id": "R5", "event_ts": at(0), "has_data_quality_issue": None},
    )
    out = G.city_ride_metrics(df)
    assert out.columns == schemas.CITY_RIDE_METRICS.names
    a, b = out.orderBy("window_start").collect()
    assert (a.window_start, a.window_end) == (naive("2024-01-15 10:00:00"), naive("2024-01-15 10:01:00"))
    assert (a.total_rides, a.unique_rides, a.completed_rides, a.requested_rides, a.payment_events) == (3, 2, 1, 1, 1)
    assert (a.total_gross_revenue, a.total_net_revenue, a.avg_fare) == (40.0, 32.8, 10.0)
    assert (a.min_fare, a.max_fare, a.avg_distance_km, a.total_distance_km) == (10.0, 30.0, 5.0, 15.0)
    assert a.completion_rate == 100.0
    assert (b.total_rides, b.avg_fare, b.total_gross_revenue, b.completion_rate) == (1, None, 0.0, 0.0)


def test_completion_rate_may_exceed_100(spark):
    df = silver(spark, *[{"ride_id": f"R{i}", "event_type": "trip_completed"} for i in range(3)], {"ride_id": "R9"})
    assert G.city_ride_metrics(df).first().completion_rate == 300.0


def test_driver_windows_slide(spark):
    df = silver(spark, {"event_type": "driver_assigned", "event_ts": at(7)}, {"driver_id": None, "event_ts": at(7)})
    starts = [r.window_start for r in G.driver_utilization(df).orderBy("window_start").collect()]
    assert starts == [naive(f"2024-01-15 {t}:00") for t in ("09:55", "10:00", "10:05")]


@pytest.mark.parametrize("earned, score", [(50.0, 100.0), (60.0, 100.0), (25.0, 80.0)])
def test_driver_score_is_capped(spark, earned, score):
    df = silver(
        spark, {"event_type": "driver_assigned"}, {"event_type": "trip_completed"},
        {"event_type": "payment_completed", "fare_amount": earned})
    row = G.driver_utilization(df).first()
    assert (row.unique_rides, row.trips_assigned, row.trips_completed) == (1, 1, 1)
    assert (row.total_earnings, row.avg_earnings_per_trip, row.utilization_rate) == (earned, earned, 100.0)
    assert row.efficiency_score == score


@pytest.mark.parametrize("requests, drivers, tier, multiplier", [
    (150, 100, "NORMAL", 1.0), (151, 100, "MODERATE", 1.5), (200, 100, "MODERATE", 1.5),
    (201, 100, "HIGH", 2.0), (300, 100, "HIGH", 2.0), (301, 100, "EXTREME", 2.5),
    (1, 0, "NORMAL", 1.0), (4, 0, "EXTREME", 2.5)])
def test_surge_steps(spark, requests, drivers, tier, multiplier):
    pairs = spark.createDataFrame([(requests, drivers)], "ride_requests long, drivers_active long")
    row = G.price_surge(pairs).first()
    assert (row.surge_tier, row.recommended_surge_multiplier) == (tier, multiplier)
    assert row.surge_triggered == (tier != "NORMAL")
    assert row.demand_supply_ratio == requests / max(drivers, 1)


def test_surge_equals_the_join_form(spark):
    df = silver(
        spark,
        {"ride_id": "a", "driver_id": "D1"}, {"ride_id": "b", "driver_id": "D2", "surge_multiplier": 2.0},
        {"ride_id": "c", "driver_id": "D1", "event_type": "driver_assigned"},
        {"ride_id": "d", "driver_id": "D1", "event_type": "driver_assigned"},
        {"ride_id": "e", "city": "Miami"},
        {"ride_id": "f", "city": "Denver", "event_type": "driver_assigned"},
        {"ride_id": "g", "city": None}, {"ride_id": "h", "city": None, "event_type": "driver_assigned"},
        {"ride_id": "i", "event_ts": at(5)}, {"ride_id": "j", "event_type": "trip_started"})
    cols = ["win", "city", "ride_requests", "drivers_active", "avg_surge_multiplier"]
    single = G.demand_supply(df).select(*cols)
    joined = G.demand_supply_join(df).select(*cols)
    rows = sorted(map(tuple, single.collect()), key=repr)
    assert rows == sorted(map(tuple, joined.collect()), key=repr)
    assert [(r[1], r[2], r[3], r[4]) for r in rows] and len(rows) == 4
    by_city = {r[1]: r[2:] for r in rows if r[0].start.minute == 0}
    assert by_city == {"New York": (2, 1, 1.5), "Miami": (1, 0, 1.0), None: (1, 0, 1.0)}


def test_funnel_gaps(spark):
    df = silver(
        spark,
        {"event_type": "driver_assigned"}, {"ride_id": "R2", "event_type": "driver_assigned"},
        {"event_type": "trip_completed"}, {"ride_id": "R2", "event_type": "trip_completed", "event_ts": at(1)})
    row = G.funnel_analysis(df).first()
    assert row.stage_1_requested is None and row.stage_2_assigned == 2 and row.stage_5_payment is None
    assert (row.assignment_rate, row.completion_rate, row.payment_rate) == (200.0, 100.0, None)


def test_distinct_counts_shuffle_by_ride_first(spark):
    plan = physical_plan(G.city_ride_metrics(silver(spark, {})))
    assert plan.count("Exchange") == 2
    inner = plan[plan.rindex("Exchange"):].split("\n")[0]
    assert "ride_id" in inner and "city" in inner


def test_surge_reads_silver_once(spark, tmp_path):
    path = str(tmp_path / "s")
    silver(spark, {}).write.parquet(path)
    plan = physical_plan(G.surge_pricing(spark.read.parquet(path)))
    assert plan.count("FileScan") == 1
    schema = plan[plan.index("ReadSchema"):]
    assert "rider_id" not in schema and "net_fare" not in schema


def test_sums_do_not_depend_on_partitioning(spark):
    rows = [{"ride_id": f"R{i}", "event_type": "trip_completed", "fare_amount": 0.1 * (i % 97), "trip_distance": i * 0.37}
            for i in range(500)]
    df = silver(spark, *rows)
    results = {tuple(G.city_ride_metrics(df.repartition(n, F.col(c))).drop("gold_processed_ts").first())
               for n, c in ((1, "ride_id"), (3, "fare_amount"), (7, "trip_distance"))}
    assert len(results) == 1
