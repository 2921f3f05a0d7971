"""Message bytes to typed records, and the split into accepted and rejected records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.functions.timing import moment
from curbside.schemas import BRONZE, PAYLOAD


def parse_events(messages: DataFrame, ingestion_ts: Column | None = None) -> DataFrame:
    """Typed bronze columns from message records, batch or streaming.

    Payload fields that do not fit their type become NULL; a payload that is not a JSON
    object becomes all NULL. Apply this to the stream itself rather than inside a batch
    callback: the ingestion time is then the same when a batch is replayed.
    """
    text = F.col("value").cast("string")
    fields = messages.select(
        # As a generator the parse runs once per record; a plain column would be parsed again
        # in every filter that Spark moves below the projection.
        F.inline(F.array(F.from_json(text, PAYLOAD))),
        text.alias("raw_value"),
        F.col("key").cast("string").alias("raw_key"),
        moment(ingestion_ts).alias("ingestion_ts"),
        F.col("offset").alias("kafka_offset"),
        F.col("partition").alias("kafka_partition"),
        F.col("topic").alias("kafka_topic"),
    )
    return (
        fields.withColumnRenamed("timestamp", "event_timestamp")
        .withColumn("event_date", F.to_date("ingestion_ts"))
        .select(*BRONZE.names)
    )


RESCUED = "rescued"


def rescued_fields(text: Column) -> Column:
    """The payload fields that the schema does not know, as a VARIANT object; NULL where there are none.

    A payload that is not a JSON object has no fields.
    """
    fields = F.try_parse_json(text).try_cast("map<string,variant>")
    others = F.map_filter(fields, lambda name, _: ~name.isin(*PAYLOAD.names))
    return F.when(F.size(others) > 0, F.to_variant_object(others))


def parse_rescued(messages: DataFrame, ingestion_ts: Column | None = None) -> DataFrame:
    """Bronze columns and ``rescued``: a field that a producer adds is kept with its type until a schema takes it up."""
    parsed = parse_events(messages, ingestion_ts)
    return parsed.withColumn(RESCUED, rescued_fields(F.col("raw_value")))


def has_required_fields() -> Column:
    return F.col("ride_id").isNotNull() & F.col("event_type").isNotNull()


def accepted(bronze: DataFrame) -> DataFrame:
    return bronze.filter(has_required_fields())


# Why a record is rejected.
NO_RIDE, NO_TYPE, UNREAD = "NULL_RIDE_ID", "NULL_EVENT_TYPE", "SCHEMA_MISMATCH"


def reject_reason(strict: bool = False) -> Column:
    """``strict`` reports a payload of which no field could be read as SCHEMA_MISMATCH.

    Without it such a record reads NULL_RIDE_ID, as its ride_id is NULL too.
    """
    reason = F.when(F.col("ride_id").isNull(), NO_RIDE).when(F.col("event_type").isNull(), NO_TYPE)
    if not strict:
        return reason.otherwise(UNREAD)
    fields = ["event_timestamp" if n == "timestamp" else n
              for n in PAYLOAD.names if n != "kafka_partition_key"]
    unread = F.col("raw_value").isNotNull() & F.coalesce(
        *[F.col(n).cast("string") for n in fields]).isNull()
    return F.when(unread, UNREAD).otherwise(reason)


def rejected(bronze: DataFrame, strict_reasons: bool = False) -> DataFrame:
    return bronze.filter(~has_required_fields()).withColumn(
        "dead_letter_reason", reject_reason(strict_reasons))
