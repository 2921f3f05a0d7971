"""Append sinks: evolving schema, replay-safe batches, audit rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from curbside.schemas import AUDIT


def append_evolving(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append; a later batch may have more columns than an earlier one."""
    spread = df.hint("rebalance", *partition_by)
    writer = spread.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """All columns any batch had; rows of batches without one read NULL there."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_batch(df: DataFrame, path: str, stream_id: str, batch_id: int,
                partition_by: Sequence[str]) -> None:
    """One batch in a folder of its own. Writing the same batch again replaces it."""
    spread = df.hint("rebalance", *partition_by)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *partition_by).parquet(f"{path}/stream={stream_id}/batch_id={batch_id}")


def overwrite_days(df: DataFrame, path: str, day: str) -> None:
    """Replace the partitions of the days that ``df`` has rows of; other days stay."""
    df.hint("rebalance", day).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that are close in the columns in one partition, and so in one file, in order."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def _ranks(df: DataFrame, columns: Sequence[str], bits: int) -> list[Column]:
    """Roughly how far along its column a value lies, in so many bits; NULL comes first.

    A value of many rows takes up the ranks of all of them, so the upper bits divide the rows. Text is compared by its first seven bytes after the beginning that all values share.
    All columns are measured in one pass, and before it the ends of all texts in another.
    """
    texts = [x for x in columns if isinstance(df.schema[x].dataType, StringType)]
    ends = df.agg(*(f(x) for x in texts for f in (F.min, F.max))).first() if texts else ()
    shared = {x: len(commonprefix([ends[2 * n] or "", ends[2 * n + 1] or ""])) for n, x in enumerate(texts)}

    def value(column: str) -> Column:
        if column not in shared:
            return F.col(column).cast("double")
        start = F.substring(F.substring(column, shared[column] + 1, 7).cast("binary"), 1, 7)
        return F.conv(F.rpad(F.hex(start), 14, "0"), 16, 10).cast("double")

    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    bounds = df.agg(*(F.percentile_approx(value(x), shares, 100 << bits) for x in columns)).first()
    return [sum((F.when(value(x) > at, 1).otherwise(0) for at in found or []), F.lit(0)) for x, found in zip(columns, bounds)]


def z_clustered(df: DataFrame, columns: Sequence[str], files: int, bits: int = 4) -> DataFrame:
    """Rows in ``files`` partitions, each of which is narrow in every one of the columns.

    The bits of the columns' ranks are interleaved, so that all columns share in the order. ``df`` is read
    four times: pass stored rows.
    """
    ranks = _ranks(df, columns, bits)
    key = F.lit(0)
    for bit in reversed(range(bits)):
        for rank in ranks:
            key = key * 2 + F.shiftright(rank, bit).bitwiseAND(F.lit(1))
    ordered = df.withColumn("_z", key).repartitionByRange(files, "_z", *columns)
    return ordered.sortWithinPartitions("_z", *columns).drop("_z")


def log_run(spark: SparkSession, path: str, **row) -> None:
    """Append one row to the audit log, given by the names of its columns."""
    row = {"run_ts": datetime.now(timezone.utc).isoformat(), "status": "SUCCESS", "error_message": ""} | row
    append_evolving(spark.createDataFrame([tuple(row.get(n) for n in AUDIT.names)], AUDIT).coalesce(1), path)


def write_lookup(df: DataFrame, path: str, key: str, partition_by: Sequence[str], row_group_bytes: int = 8 << 20) -> None:
    """A table for point lookups: sorted by the key within its partitions, in small row groups with bloom filters.

    A lookup reads the partitions that its filter names, and in them the row groups whose range and
    bloom filter admit the key.
    """
    spread = df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, key)
    writer = spread.write.mode("overwrite").partitionBy(*partition_by)
    writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.block.size", row_group_bytes).parquet(path)


def look_up(table: DataFrame, keys: DataFrame, key: str, most: int = 1000) -> DataFrame:
    """The rows of a table whose key occurs in ``keys``, each once.

    Up to ``most`` distinct keys are sent along with the scan, where they skip row groups; beyond
    that the table is joined with them, and only Spark's own runtime filter narrows the scan.
    """
    wanted = keys.select(key).distinct().filter(f"{key} IS NOT NULL")
    few = [r[0] for r in wanted.limit(most + 1).collect()]
    if len(few) <= most:
        return table.filter(table[key].isin(few))
    return table.join(wanted, key, "left_semi").select(*table.columns)
