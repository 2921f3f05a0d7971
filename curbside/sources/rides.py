"""Ride events and ride messages derived from the shared ``events`` table.

A pure projection, so it works on a batch and on a stream. Faults are placed by residues
of ``event_id``; time is compressed sixty-fold around a fixed start and moved by 18 hours, so
that thirty days of events fill twelve hours across one midnight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside import settings as S
from curbside.schemas import PAYLOAD

# Fixed values of the projection.
START_MICROS = 1704067200000000
SHIFT_MICROS = 64800000000
STAGE_OF = {"view": S.REQUESTED, "click": S.ASSIGNED, "signup": S.STARTED,
            "purchase": S.COMPLETED, "error": S.PAID}
SURGE_OF = {"New York": 1.5, "Chicago": 1.2, "Miami": 1.6, "Denver": 1.0}


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _case(key: str, mapping: dict) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v!r}" + ("D" if isinstance(v, float) else "")
                    for k, v in mapping.items())
    return f"CASE {key} {arms} END"


def ride_events(events: DataFrame) -> DataFrame:
    """Payload fields, message position and ingestion time per event; no shuffle."""
    base = events.selectExpr(
        "event_id", "user_id", "event_type AS kind", "value",
        "cast(get_json_object(props, '$.k') AS int) AS k",
        "event_id div 8 AS ride",
        f"timestamp_micros({START_MICROS} + (unix_micros(cast(ts AS timestamp)) - {START_MICROS})"
        f" div 60 + {SHIFT_MICROS}) AS event_time",
        """CASE WHEN event_id div 8 % 2 = 0 THEN 'New York' WHEN event_id div 8 % 3 = 0 THEN 'Chicago'
                WHEN event_id div 8 % 5 = 0 THEN 'Miami' ELSE 'Denver' END AS town""")
    return base.selectExpr(
        "CASE WHEN event_id % 97 <> 0 THEN concat('RIDE-', ride) END AS ride_id",
        "CASE WHEN event_id % 53 <> 0 THEN concat('DRV-', user_id % 6) END AS driver_id",
        "CASE WHEN event_id % 59 <> 0 THEN concat('RDR-', user_id) END AS rider_id",
        "CASE WHEN event_id % 7 = 0 THEN concat('  ', lower(town), ' ') ELSE town END AS city",
        f"""CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 0 THEN 'ride_rated'
                 ELSE {_case("kind", STAGE_OF)} END AS event_type""",
        """CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 67 = 0 THEN k * 1000D
                ELSE k / 2D END AS trip_distance""",
        """CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_id % 73 = 0 THEN -1D
                WHEN event_id % 79 = 0 THEN 99999D ELSE value END AS fare_amount""",
        f"{_case('town', SURGE_OF)} AS surge_multiplier",
        # Lower-case x prints +00:00 where upper-case X prints Z.
        """date_format(event_time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx") AS event_timestamp""",
        f"'{S.SCHEMA_VERSION}' AS schema_version",
        "event_time",
        "timestampadd(SECOND, cast(event_id % 600 AS int), event_time) AS ingestion_ts",
        "event_id AS kafka_offset",
        "cast(event_id % 10 AS int) AS kafka_partition",
        f"'{S.TOPIC}' AS kafka_topic")


def messages(rides: DataFrame) -> DataFrame:
    """Message records with a JSON payload; ``timestamp`` carries the ingestion time."""
    fields = {"timestamp": "event_timestamp", "kafka_partition_key": "city"}
    payload = F.struct(*[F.col(fields.get(n, n)).alias(n) for n in PAYLOAD.names])
    return rides.select(
        F.col("city").cast("binary").alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("ingestion_ts").alias("timestamp"),
    )


def damaged(records: DataFrame) -> DataFrame:
    """The messages with faults by offset: broken JSON, quoted fares, times without a fraction or unreadable."""
    text, offset = F.col("value").cast("string"), F.col("offset")
    value = (F.when(offset % 11 == 0, F.concat(F.lit("{bad "), text))
             .when(offset % 13 == 0, F.regexp_replace(text, r'"fare_amount":([-0-9.E]+)', '"fare_amount":"$1"'))
             .when(offset % 17 == 0, F.regexp_replace(text, r"\.\d{6}\+00:00", "+00:00"))
             .when(offset % 19 == 0, F.regexp_replace(text, r'"timestamp":"[^"]*"', '"timestamp":"x"'))
             .otherwise(text))
    return records.withColumn("value", value.cast("binary"))


def extended(records: DataFrame) -> DataFrame:
    """The messages of which every third carries two fields more: a tip, and the version of an app."""
    offset = F.col("offset")
    more = F.concat(F.lit(',"tip":'), (offset % 10 / 2).cast("string"), F.lit(',"app":{"version":"'), (offset % 4).cast("string"), F.lit('"}}'))
    text = F.col("value").cast("string")
    return records.withColumn("value", F.when(offset % 3 == 0, F.concat(F.regexp_replace(text, r"\}$", ""), more)).otherwise(text).cast("binary"))
