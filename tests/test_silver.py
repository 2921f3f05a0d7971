import math

import pytest
from pyspark.sql import functions as F

from curbside.operators import silver as V
from curbside.schemas import SILVER
from helpers import bronze, naive, physical_plan, silver, ts

FLAGS = ["dq_invalid_event_type", "dq_fare_out_of_range", "dq_distance_out_of_range",
         "dq_null_driver", "dq_null_rider", "has_data_quality_issue"]


def one(spark, **changes):
    return V.clean(bronze(spark, changes), F.col("ingestion_ts")).first()


@pytest.mark.parametrize("text, want", [
    ("2024-01-15T10:00:00.123456+00:00", "2024-01-15 10:00:00.123456"),
    ("2024-01-15T10:00:00+00:00", "2024-01-15 10:00:00"),
    ("2024-01-15T12:00:00.000001+02:00", "2024-01-15 10:00:00.000001"),
    ("2024-01-15T10:00:00.123456Z", "2024-01-15 10:00:00.123456"),
    ("x", "2024-01-15 10:00:05"), (None, "2024-01-15 10:00:05"), ("", "2024-01-15 10:00:05"),
])
def test_event_time(spark, text, want):
    assert one(spark, event_timestamp=text).event_ts == naive(want)


def test_event_time_defaults_to_now(spark):
    df = V.clean(bronze(spark, {"event_timestamp": "x"}))
    assert df.filter(F.abs(F.unix_seconds("event_ts") - F.unix_seconds(F.current_timestamp())) < 600).count()


@pytest.mark.parametrize("raw, want", [
    ("  new york ", "New York"), ("NEW YORK", "New York"), ("denver", "Denver"), (None, None), ("", "")])
def test_city(spark, raw, want):
    assert one(spark, city=raw).city == want


@pytest.mark.parametrize("changes, flagged", [
    ({}, []),
    ({"event_type": "ride_rated"}, [0]),
    ({"fare_amount": None}, []),
    ({"fare_amount": 0.0}, []), ({"fare_amount": 5000.0}, []), ({"fare_amount": 5000.01}, [1]),
    ({"fare_amount": -1.0}, [1]), ({"fare_amount": math.nan}, [1]),
    ({"trip_distance": None}, [2]), ({"trip_distance": 0.09}, [2]), ({"trip_distance": 0.1}, []),
    ({"trip_distance": 500.0}, []), ({"trip_distance": 500.01}, [2]), ({"trip_distance": math.nan}, [2]),
    ({"driver_id": None}, [3]), ({"rider_id": None}, [4]),
])
def test_flags(spark, changes, flagged):
    row = one(spark, **changes)
    want = [i in flagged for i in range(5)] + [bool(flagged)]
    assert [row[f] for f in FLAGS] == want


def test_unknown_event_type_gives_null_flags(spark):
    row = one(spark, event_type=None)
    assert row.dq_invalid_event_type is None and row.has_data_quality_issue is None
    assert one(spark, event_type=None, driver_id=None).has_data_quality_issue is True


@pytest.mark.parametrize("fare, net", [(1.75, 1.43), (20.0, 16.4), (0.0, 0.0), (None, 0.0)])
def test_net_fare(spark, fare, net):
    assert one(spark, fare_amount=fare).net_fare == net


def test_derived_columns(spark):
    row = one(spark, event_timestamp="2024-01-14T23:59:01.000000+00:00")
    assert (str(row.event_date), row.event_hour, row.event_minute) == ("2024-01-14", 23, 59)
    assert row.silver_version == "1.0" and row.silver_processed_ts is not None


def test_deduplicate_keeps_newest(spark):
    t = ts("2024-01-15 10:00:05")
    df = bronze(
        spark, {"kafka_offset": 1, "fare_amount": 1.0}, {"kafka_offset": 2, "fare_amount": 2.0},
        {"event_type": "trip_started", "kafka_offset": 9, "fare_amount": 3.0},
        {"event_type": "trip_started", "kafka_offset": 3, "ingestion_ts": ts("2024-01-15 11:00:00"),
         "fare_amount": 4.0},
        {"ride_id": "R2", "kafka_partition": 1, "fare_amount": 5.0, "ingestion_ts": t},
        {"ride_id": "R2", "kafka_partition": 2, "fare_amount": 6.0, "ingestion_ts": t})
    got = {(r.ride_id, r.event_type): r.fare_amount for r in V.deduplicate(df).collect()}
    assert got == {("R1", "ride_requested"): 2.0, ("R1", "trip_started"): 4.0, ("R2", "ride_requested"): 6.0}


def test_deduplicate_limits_groups_before_the_shuffle(spark):
    plan = physical_plan(V.deduplicate(bronze(spark, {})))
    assert plan.count("Exchange") == 1
    partial = plan.index("Partial")
    assert "WindowGroupLimit" in plan and plan.index("Exchange") < partial


def test_cleaning_does_not_shuffle(spark):
    assert "Exchange" not in physical_plan(V.clean(bronze(spark, {})))


def test_declared_columns_only(spark):
    assert V.silver_from_bronze(bronze(spark, {})).columns == SILVER.names


def test_enforce_schema(spark):
    df = bronze(spark, {})
    assert V.enforce_schema(df, ["city", "ride_id"]).columns == ["city", "ride_id"]
    with pytest.raises(ValueError, match="nope"):
        V.enforce_schema(df, ["city", "nope"])


def test_recent_counts_in_days(spark):
    df = silver(spark, *[
        {"ride_id": str(d), "event_ts": ts(f"2024-01-{d:02} 23:00:00"), "event_date": ts(f"2024-01-{d:02}").date()}
        for d in range(10, 16)])
    def days(hours):
        return sorted(r.ride_id for r in V.recent(df, ts("2024-01-15 05:00:00"), hours).collect())
    assert days(2) == ["14", "15"]
    assert days(24) == ["13", "14", "15"]


def test_recent_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "silver")
    silver(spark, {}).write.partitionBy("event_date", "city").parquet(path)
    plan = physical_plan(V.recent(spark.read.parquet(path), ts("2024-01-15 05:00:00")))
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "event_date" in filters
