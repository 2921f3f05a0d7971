import json

from pyspark.sql import functions as F

from curbside.operators import bronze as B
from curbside.schemas import BRONZE
from helpers import messages, physical_plan

GOOD = {"ride_id": "R1", "driver_id": "D1", "rider_id": "P1", "city": "Miami",
        "event_type": "trip_completed", "trip_distance": 12.4, "fare_amount": 28.5,
        "surge_multiplier": 1.5, "timestamp": "2026-03-15T09:31:00.123456+00:00",
        "kafka_partition_key": "Miami", "schema_version": "1.0"}


def parse(spark, *values):
    return B.parse_events(messages(spark, *values), F.col("timestamp")).orderBy("kafka_offset").collect()


def test_good_record(spark):
    df = B.parse_events(messages(spark, json.dumps(GOOD)))
    assert df.schema == BRONZE or df.columns == BRONZE.names
    row = df.first()
    assert (row.ride_id, row.fare_amount, row.event_timestamp) == ("R1", 28.5, GOOD["timestamp"])
    assert row.raw_value == json.dumps(GOOD) and row.raw_key == "k" and row.kafka_topic == "ride-events"


def test_faulty_payloads(spark):
    rows = parse(
        spark, json.dumps(GOOD | {"fare_amount": "INVALID"}), json.dumps(GOOD | {"fare_amount": "12.5"}),
        "{bad", None, "[]", json.dumps(GOOD | {"vehicle_type": "van"}), "")
    assert len(rows) == 7
    for r in rows[:2]:
        assert r.fare_amount is None and r.ride_id == "R1" and r.trip_distance == 12.4
    for r in rows[2:5] + rows[6:]:
        assert r.ride_id is None and r.event_type is None and r.city is None
    assert rows[5].ride_id == "R1" and "van" in rows[5].raw_value


def test_triage_partitions_its_input(spark):
    values = [json.dumps(GOOD), json.dumps(GOOD | {"ride_id": None}),
              json.dumps(GOOD | {"event_type": None}), json.dumps({}), "{bad", None]
    df = B.parse_events(messages(spark, *values))
    ok, bad = B.accepted(df), B.rejected(df)
    assert ok.count() == 1 and bad.count() == 5
    reasons = [r.dead_letter_reason for r in bad.orderBy("kafka_offset").collect()]
    assert reasons == ["NULL_RIDE_ID", "NULL_EVENT_TYPE"] + ["NULL_RIDE_ID"] * 3
    strict = [r.dead_letter_reason for r in B.rejected(df, strict_reasons=True)
              .orderBy("kafka_offset").collect()]
    assert strict == ["NULL_RIDE_ID", "NULL_EVENT_TYPE", "SCHEMA_MISMATCH", "SCHEMA_MISMATCH",
                      "NULL_RIDE_ID"]


def test_payload_is_parsed_once(spark):
    df = B.accepted(B.parse_events(messages(spark, json.dumps(GOOD))))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert "Exchange" not in physical_plan(df)
