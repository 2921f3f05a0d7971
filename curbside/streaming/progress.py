"""Progress of streaming queries as rows."""

from __future__ import annotations

import json
import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from curbside.sources.sinks import append_evolving

PROGRESS = T.StructType([
    T.StructField("query_id", T.StringType()),
    T.StructField("query_name", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("num_input_rows", T.LongType()),
    T.StructField("input_rows_per_sec", T.DoubleType()),
    T.StructField("processed_rows_per_sec", T.DoubleType()),
    T.StructField("watermark", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("checked_at", T.StringType()),
])

#: One row for each micro-batch and observation in it.
OBSERVED = T.StructType([
    T.StructField("observation", T.StringType()),
    *PROGRESS.fields,
    T.StructField("metrics", T.MapType(T.StringType(), T.LongType())),
])

# A query without input is called stalled once it has got past its first batches.
STALL_AFTER_BATCH = 5


def progress_row(query_id, name, progress: dict | None, active: bool = True, error=None) -> tuple:
    p = progress or {}
    def number(key):
        value = p.get(key) or 0
        return float(value) if value == value else 0.0
    return (
        str(query_id), name, active, int(p.get("batchId", -1)), int(p.get("numInputRows") or 0),
        number("inputRowsPerSecond"), number("processedRowsPerSecond"),
        (p.get("eventTime") or {}).get("watermark", "N/A"), error,
        datetime.now(timezone.utc).isoformat(),
    )


class ProgressLog(StreamingQueryListener):
    """Keeps for each query its latest progress record and, once it ended, how it did."""

    def __init__(self):
        self._latest: dict[str, tuple] = {}
        self._ended: dict[str, tuple] = {}
        self._names: dict[str, str | None] = {}
        self._observed: list[tuple] = []

    def onQueryStarted(self, event):
        self._names[str(event.id)] = event.name

    def onQueryProgress(self, event):
        p = event.progress
        self._names[str(p.id)] = p.name
        row = self._latest[str(p.id)] = progress_row(p.id, p.name, json.loads(p.json))
        for name, metrics in (p.observedMetrics or {}).items():
            self._observed.append((name, *row, {k: int(v or 0) for k, v in metrics.asDict().items()}))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._ended[str(event.id)] = progress_row(
            event.id, self._names.pop(str(event.id), None), None, False, event.exception)

    def wait_for(self, query: StreamingQuery, seconds: float = 30) -> None:
        """Until the end of a query has been reported: reports come some time after the fact."""
        until = time.monotonic() + seconds
        while str(query.id) not in self._ended and time.monotonic() < until:
            time.sleep(0.05)

    def append_observed(self, spark: SparkSession, path: str) -> None:
        """Append what the micro-batches since the last call were observed to hold."""
        rows, self._observed = self._observed, []
        if rows:
            append_evolving(spark.createDataFrame(rows, OBSERVED).coalesce(1), path)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [*self._latest.values(), *self._ended.values()]
        return with_health(spark.createDataFrame(rows, PROGRESS))


def active_queries(spark: SparkSession) -> DataFrame:
    """One row per running query with its latest progress."""
    rows = []
    for q in spark.streams.active:
        last = q.lastProgress
        rows.append(progress_row(q.id, q.name, json.loads(last.json) if last else None, q.isActive))
    return with_health(spark.createDataFrame(rows, PROGRESS))


def with_health(progress: DataFrame) -> DataFrame:
    return progress.withColumns({
        "stopped": ~F.col("is_active"),
        "stalled": F.col("is_active") & (F.col("input_rows_per_sec") == 0)
                   & (F.col("batch_id") > STALL_AFTER_BATCH),
    })
