"""Declared schemas of the message record, its payload and every stored table."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, NUMBER, LONG, INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
FLAG, TIME, DATE, BYTES = T.BooleanType(), T.TimestampType(), T.DateType(), T.BinaryType()

# The names, types and order of all columns.

MESSAGE = T.StructType([
    T.StructField("key", BYTES),
    T.StructField("value", BYTES),
    T.StructField("topic", TEXT),
    T.StructField("partition", INT),
    T.StructField("offset", LONG),
    T.StructField("timestamp", TIME),
])

PAYLOAD = T.StructType([
    T.StructField("ride_id", TEXT),
    T.StructField("driver_id", TEXT),
    T.StructField("rider_id", TEXT),
    T.StructField("city", TEXT),
    T.StructField("event_type", TEXT),
    T.StructField("trip_distance", NUMBER),
    T.StructField("fare_amount", NUMBER),
    T.StructField("surge_multiplier", NUMBER),
    T.StructField("timestamp", TEXT),
    T.StructField("kafka_partition_key", TEXT),
    T.StructField("schema_version", TEXT),
])

BRONZE = T.StructType([
    T.StructField("ride_id", TEXT),
    T.StructField("driver_id", TEXT),
    T.StructField("rider_id", TEXT),
    T.StructField("city", TEXT),
    T.StructField("event_type", TEXT),
    T.StructField("trip_distance", NUMBER),
    T.StructField("fare_amount", NUMBER),
    T.StructField("surge_multiplier", NUMBER),
    T.StructField("event_timestamp", TEXT),
    T.StructField("schema_version", TEXT),
    T.StructField("raw_value", TEXT),
    T.StructField("raw_key", TEXT),
    T.StructField("ingestion_ts", TIME),
    T.StructField("kafka_offset", LONG),
    T.StructField("kafka_partition", INT),
    T.StructField("kafka_topic", TEXT),
    T.StructField("event_date", DATE),
])

DEAD_LETTER = T.StructType(BRONZE.fields + [T.StructField("dead_letter_reason", TEXT)])

SILVER = T.StructType([
    T.StructField("ride_id", TEXT),
    T.StructField("driver_id", TEXT),
    T.StructField("rider_id", TEXT),
    T.StructField("city", TEXT),
    T.StructField("event_type", TEXT),
    T.StructField("trip_distance", NUMBER),
    T.StructField("fare_amount", NUMBER),
    T.StructField("net_fare", NUMBER),
    T.StructField("surge_multiplier", NUMBER),
    T.StructField("event_ts", TIME),
    T.StructField("event_date", DATE),
    T.StructField("event_hour", INT),
    T.StructField("event_minute", INT),
    T.StructField("schema_version", TEXT),
    T.StructField("has_data_quality_issue", FLAG),
    T.StructField("dq_invalid_event_type", FLAG),
    T.StructField("dq_fare_out_of_range", FLAG),
    T.StructField("dq_distance_out_of_range", FLAG),
    T.StructField("dq_null_driver", FLAG),
    T.StructField("dq_null_rider", FLAG),
    T.StructField("ingestion_ts", TIME),
    T.StructField("silver_processed_ts", TIME),
    T.StructField("silver_version", TEXT),
])

CITY_RIDE_METRICS = T.StructType([
    T.StructField("window_start", TIME),
    T.StructField("window_end", TIME),
    T.StructField("window_start_date", DATE),
    T.StructField("city", TEXT),
    T.StructField("total_rides", LONG),
    T.StructField("unique_rides", LONG),
    T.StructField("completed_rides", LONG),
    T.StructField("requested_rides", LONG),
    T.StructField("payment_events", LONG),
    T.StructField("total_gross_revenue", NUMBER),
    T.StructField("total_net_revenue", NUMBER),
    T.StructField("avg_fare", NUMBER),
    T.StructField("max_fare", NUMBER),
    T.StructField("min_fare", NUMBER),
    T.StructField("avg_distance_km", NUMBER),
    T.StructField("total_distance_km", NUMBER),
    T.StructField("avg_surge_multiplier", NUMBER),
    T.StructField("completion_rate", NUMBER),
    T.StructField("gold_processed_ts", TIME),
])

DRIVER_UTILIZATION = T.StructType([
    T.StructField("window_start", TIME),
    T.StructField("window_end", TIME),
    T.StructField("window_start_date", DATE),
    T.StructField("driver_id", TEXT),
    T.StructField("city", TEXT),
    T.StructField("unique_rides", LONG),
    T.StructField("trips_assigned", LONG),
    T.StructField("trips_completed", LONG),
    T.StructField("total_earnings", NUMBER),
    T.StructField("avg_distance_km", NUMBER),
    T.StructField("utilization_rate", NUMBER),
    T.StructField("avg_earnings_per_trip", NUMBER),
    T.StructField("efficiency_score", NUMBER),
    T.StructField("gold_processed_ts", TIME),
])

SURGE_PRICING = T.StructType([
    T.StructField("window_start", TIME),
    T.StructField("window_end", TIME),
    T.StructField("window_start_date", DATE),
    T.StructField("city", TEXT),
    T.StructField("ride_requests", LONG),
    T.StructField("drivers_active", LONG),
    T.StructField("avg_surge_multiplier", NUMBER),
    T.StructField("demand_supply_ratio", NUMBER),
    T.StructField("surge_triggered", FLAG),
    T.StructField("recommended_surge_multiplier", NUMBER),
    T.StructField("surge_tier", TEXT),
    T.StructField("gold_processed_ts", TIME),
])

FUNNEL_ANALYSIS = T.StructType([
    T.StructField("event_date", DATE),
    T.StructField("city", TEXT),
    T.StructField("stage_1_requested", LONG),
    T.StructField("stage_2_assigned", LONG),
    T.StructField("stage_3_started", LONG),
    T.StructField("stage_4_completed", LONG),
    T.StructField("stage_5_payment", LONG),
    T.StructField("assignment_rate", NUMBER),
    T.StructField("completion_rate", NUMBER),
    T.StructField("payment_rate", NUMBER),
    T.StructField("gold_processed_ts", TIME),
])

AUDIT = T.StructType([
    T.StructField("run_ts", TEXT),
    T.StructField("layer", TEXT),
    T.StructField("batch_id", LONG),
    T.StructField("rows_in", LONG),
    T.StructField("rows_out", LONG),
    T.StructField("duration_sec", NUMBER),
    T.StructField("status", TEXT),
    T.StructField("error_message", TEXT),
])

GOLD = {
    "city_ride_metrics": CITY_RIDE_METRICS,
    "driver_utilization": DRIVER_UTILIZATION,
    "surge_pricing": SURGE_PRICING,
    "funnel_analysis": FUNNEL_ANALYSIS,
}
