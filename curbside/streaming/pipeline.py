"""Streaming bronze and silver."""

from __future__ import annotations

import logging
import time
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from curbside import settings as S
from curbside.operators.bronze import accepted, has_required_fields, parse_events, rejected
from curbside.operators.quality import quality_counts
from curbside.operators.silver import NEWEST_FIRST, clean, deduplicate, to_silver
from curbside.operators.retraction import KEPT
from curbside.schemas import SILVER
from curbside.sources.sinks import log_run, write_batch
from curbside.streaming.kept import RECORD, apply_images, newest_changes

log = logging.getLogger(__name__)


def _start(df: DataFrame, handler, checkpoint: str, name: str, trigger: dict | None):
    """Streams switch adaptive execution off; plans within a batch keep no state and need it to divide large partitions."""
    def adaptive(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        handler(batch, batch_id)

    return _run(df.writeStream.foreachBatch(adaptive), checkpoint, name, trigger)


def _run(writer: DataStreamWriter, checkpoint: str, name: str | None, trigger: dict | None):
    """A query without a name may run several times in one session."""
    writer = writer.queryName(name) if name else writer
    return (writer.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": S.TRIGGER})).start())


def _stream_id(batch: DataFrame) -> str:
    """Id of the running query; it lives in the checkpoint, so restarts keep it."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"


def start_bronze(messages: DataFrame, events_path: str, dead_letter_path: str, checkpoint: str,
                 name: str | None = "bronze_ride_events", trigger: dict | None = None,
                 ingestion_ts: Column | None = None, strict_reasons: bool = False,
                 audit_path: str | None = None) -> StreamingQuery:
    """Parse messages, append accepted records and, where there are any, rejected ones."""

    def write(batch: DataFrame, batch_id: int) -> None:
        started = time.time()
        stream_id = _stream_id(batch)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        counts = Observation()
        try:
            # The write counts what passes through it; no job is run for that.
            seen = batch.observe(counts, F.count("*").alias("n"), F.count_if(has_required_fields()).alias("ok"))
            write_batch(accepted(seen), events_path, stream_id, batch_id, S.BRONZE_PARTITIONS)
            n, ok = counts.get["n"], counts.get["ok"]
            if ok < n:
                write_batch(rejected(batch, strict_reasons), dead_letter_path, stream_id, batch_id,
                            S.DEAD_LETTER_PARTITIONS)
        finally:
            batch.unpersist()
        log.info("bronze batch %d: %d in, %d accepted", batch_id, n, ok)
        if audit_path:
            log_run(batch.sparkSession, audit_path, layer="bronze", batch_id=batch_id, rows_in=n,
                    rows_out=ok, duration_sec=time.time() - started)

    parsed = parse_events(messages, ingestion_ts).observe(
        "bronze", F.count("*").alias("rows_in"), F.count_if(has_required_fields()).alias("rows_good"))
    return _start(parsed, write, checkpoint, name, trigger)


def start_silver(bronze: DataFrame, silver_path: str, checkpoint: str,
                 name: str | None = "silver_ride_events", trigger: dict | None = None,
                 time_fallback: Column | None = None, audit_path: str | None = None) -> StreamingQuery:
    """Clean each batch, keep its newest record per key and append it; ``read_silver`` gives the newest of all.

    A replayed batch replaces what it wrote before. Only what silver needs is read: a batch is handed over
    as rows, of which Spark computes every column of the stream.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        started = time.time()
        counts = Observation()
        rows = to_silver(deduplicate(batch)).observe(counts, *quality_counts())
        write_batch(rows, silver_path, _stream_id(batch), batch_id, S.SILVER_PARTITIONS)
        valid, flagged = counts.get["valid_count"], counts.get["flagged_count"]
        log.info("silver batch %d: %d valid, %d flagged", batch_id, valid, flagged)
        if audit_path:
            log_run(batch.sparkSession, audit_path, layer="silver", batch_id=batch_id, rows_in=valid + flagged, rows_out=valid + flagged,
                    duration_sec=time.time() - started)

    cleaned = clean(bronze, time_fallback).select(*SILVER.names, *(x for x in NEWEST_FIRST if x not in SILVER.names)).observe(
        "silver", F.count("*").alias("rows_in"), F.count_if(~F.col("has_data_quality_issue")).alias("rows_good"))
    return _start(cleaned, append, checkpoint, name, trigger)


def start_gold(bronze: DataFrame, root: str, checkpoint: str, name: str | None = "gold_aggregates", trigger: dict | None = None,
               time_fallback: Column | None = None, tables: Sequence[str] = tuple(KEPT)) -> StreamingQuery:
    """Keep aggregates up with a stream of accepted records, whose newest one for each key counts.

    Each batch adds what its records change: it writes the hours that it touches, and reads of the
    history the newest record of each key. ``root`` belongs to one checkpoint. Read the result with ``read_kept``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        apply_images(newest_changes(batch, f"{root}/_newest", batch_id), root, batch_id, tables)

    # A batch is handed over as rows, of which Spark computes every column of the stream.
    return _start(clean(bronze, time_fallback).select(*RECORD.names), write, checkpoint, name, trigger)


def start_aggregate(aggregate: DataFrame, path: str, checkpoint: str, name: str | None,
                    trigger: dict | None = None) -> StreamingQuery:
    """Append closed windows of a streaming aggregate to parquet files, exactly once.

    ``aggregate`` is one of the windowed functions of ``operators.gold`` over a stream.
    """
    writer = aggregate.writeStream.outputMode("append").format("parquet").option("path", path)
    return _run(writer, checkpoint, name, trigger)
