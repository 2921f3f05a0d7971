"""Catalog: databases, declared tables, registration, properties, listings, preview."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbside import schemas
from curbside import settings as S

_COMMENTS = {
    "ride_id": "ride identifier", "driver_id": "driver identifier",
    "rider_id": "rider identifier", "trip_distance": "kilometres", "fare_amount": "US dollars",
    "net_fare": "fare less the platform share", "event_timestamp": "event time as sent, ISO-8601",
    "raw_value": "payload as received", "kafka_offset": "message offset",
    "event_ts": "event time, UTC", "dead_letter_reason": "why the record was rejected",
}

DECLARED: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "ride_events_raw": (schemas.BRONZE, S.BRONZE_PARTITIONS),
    "ride_events_dead_letter": (schemas.DEAD_LETTER, S.DEAD_LETTER_PARTITIONS),
    "ride_events_clean": (schemas.SILVER, S.SILVER_PARTITIONS),
    **{name: (schema, S.GOLD_PARTITIONS[name]) for name, schema in schemas.GOLD.items()},
}


def _quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_databases(spark: SparkSession, names: S.Names = S.Names()) -> None:
    for db in names.databases:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(db)}")


def create_table(spark: SparkSession, name: str, schema: T.StructType,
                 partition_by: tuple[str, ...] = (), location: str | None = None) -> None:
    """An empty partitioned parquet table; does nothing if it exists."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" COMMENT {_text(_COMMENTS[f.name])}" if f.name in _COMMENTS else "")
        for f in schema.fields)
    sql = f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING parquet"
    if partition_by:
        sql += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
    if location:
        sql += f" LOCATION {_text(location)}"
    spark.sql(sql)


def init_tables(spark: SparkSession, root: str | None = None, names: S.Names = S.Names()) -> list[str]:
    """All databases and declared tables; safe to repeat. Returns the table names."""
    create_databases(spark, names)
    created = []
    for name, (schema, parts) in DECLARED.items():
        create_table(spark, names.table(name), schema, parts, f"{root}/{name}" if root else None)
        created.append(names.table(name))
    return created


def register_files(spark: SparkSession, name: str, path: str) -> None:
    """An external table over parquet files that exist, with their partitions."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} USING parquet LOCATION {_text(path)}")
    partitioned = any(c.isPartition for c in spark.catalog.listColumns(name))
    if partitioned:
        spark.catalog.recoverPartitions(name)


def set_properties(spark: SparkSession, name: str, properties: dict[str, str]) -> None:
    pairs = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {_quoted(name)} SET TBLPROPERTIES ({pairs})")


def list_databases(spark: SparkSession, like: str = "*") -> DataFrame:
    return spark.sql(f"SHOW DATABASES LIKE {_text(like)}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {_quoted(database)}")


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    return df.limit(rows)


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str) -> DataFrame:
    """A table in buckets of its keys: joins and upserts by these keys do not move it.

    The rows are dealt to the buckets first, so that there is one sorted file for each.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def table_detail(tables: Mapping[str, DataFrame]) -> DataFrame:
    """For each table of files: its files, bytes, rows, and when a file was last written."""
    def detail(name: str, df: DataFrame) -> DataFrame:
        files = df.select("_metadata").groupBy("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").agg(
            F.count("*").alias("n"))
        return files.agg(F.lit(name).alias("table_name"), F.count("*").alias("num_files"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("size_in_bytes"),
                         F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.max("file_modification_time").alias("last_modified"))
    return reduce(DataFrame.unionAll, [detail(name, df) for name, df in tables.items()])


def table_stats(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """table_name, row_count, latest_ts: rows of each table and the latest value of its time column."""
    stats = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"), F.max(F.col(time).cast("timestamp")).alias("latest_ts"))
             for name, (df, time) in tables.items()]
    return reduce(DataFrame.unionAll, stats)
