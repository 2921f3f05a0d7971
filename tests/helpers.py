"""Small hand-written inputs."""

from datetime import datetime, timezone

from curbside import schemas


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def naive(text: str) -> datetime:
    return datetime.fromisoformat(text)


def frame(spark, schema, *rows):
    """Rows given as dicts; missing columns are NULL."""
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def messages(spark, *values, start=0, topic="ride-events"):
    rows = [
        {"key": b"k", "value": None if v is None else v.encode(), "topic": topic, "partition": 0,
         "offset": start + i, "timestamp": ts("2024-01-15 10:00:00")}
        for i, v in enumerate(values)]
    return frame(spark, schemas.MESSAGE, *rows)


BRONZE_ROW = {
    "ride_id": "R1", "driver_id": "D1", "rider_id": "P1", "city": "New York",
    "event_type": "ride_requested", "trip_distance": 5.0, "fare_amount": 20.0,
    "surge_multiplier": 1.0, "event_timestamp": "2024-01-15T10:00:00.000000+00:00",
    "schema_version": "1.0", "ingestion_ts": ts("2024-01-15 10:00:05"), "kafka_offset": 1,
    "kafka_partition": 0, "kafka_topic": "ride-events",
}


def bronze(spark, *changes):
    return frame(spark, schemas.BRONZE, *[BRONZE_ROW | c for c in changes])


SILVER_ROW = {
    "ride_id": "R1", "driver_id": "D1", "rider_id": "P1", "city": "New York",
    "event_type": "ride_requested", "trip_distance": 5.0, "fare_amount": 20.0, "net_fare": 16.4,
    "surge_multiplier": 1.0, "event_ts": ts("2024-01-15 10:00:00"),
    "event_date": ts("2024-01-15").date(), "event_hour": 10, "event_minute": 0,
    "has_data_quality_issue": False, "dq_fare_out_of_range": False,
    "ingestion_ts": ts("2024-01-15 10:00:05"), "silver_version": "1.0",
}


def silver(spark, *changes):
    return frame(spark, schemas.SILVER, *[SILVER_ROW | c for c in changes])


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
