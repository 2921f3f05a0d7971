"""Streaming sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from curbside import schemas
from curbside import settings as S
from curbside.operators.silver import deduplicate

BATCH_FOLDERS = [T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType())]


def kafka_options(servers: str, topic: str = S.TOPIC, group: str | None = None,
                  security: str = "PLAINTEXT", max_offsets: int = S.MAX_OFFSETS_PER_TRIGGER,
                  **extra: str) -> dict[str, str]:
    """Options of Spark's Kafka source: from the earliest offset, rate limited, loss tolerated."""
    # What the source is set to.
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(max_offsets),
        "failOnDataLoss": "false",
        "kafka.session.timeout.ms": "30000",
        "kafka.request.timeout.ms": "60000",
    }
    if group:
        options["kafka.group.id"] = group
    if security.startswith("SASL_"):
        options |= {"kafka.security.protocol": security, "kafka.sasl.mechanism": "PLAIN"}
    return options | extra


def read_event_stream(spark: SparkSession, format: str = "kafka",
                      options: Mapping[str, str] | None = None, path: str | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Message records from Kafka (needs Spark's Kafka package) or from files of them."""
    reader = spark.readStream.format(format).options(**dict(options or {}))
    if format != "kafka":
        reader = reader.schema(schemas.MESSAGE)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path) if path else reader.load()


def read_bronze_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                       options: Mapping[str, str] | None = None) -> DataFrame:
    """New bronze files as a stream. Bronze only grows, so new files are the change feed.

    On a folder with a long history pass ``maxFileAge`` or ``cleanSource`` in ``options``,
    so that Spark does not keep track of every file it ever saw.
    """
    schema = T.StructType(schemas.BRONZE.fields + BATCH_FOLDERS)
    reader = spark.readStream.schema(schema).options(**dict(options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path).select(*schemas.BRONZE.names)


def read_silver_records(spark: SparkSession, path: str) -> DataFrame:
    """All records that silver batches appended, replaced ones among them."""
    schema = T.StructType(schemas.SILVER.fields + BATCH_FOLDERS)
    return spark.read.schema(schema).parquet(path).select(*schemas.SILVER.names)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The newest record of each key."""
    return deduplicate(read_silver_records(spark, path))
