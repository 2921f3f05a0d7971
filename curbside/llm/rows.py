"""How the operators of this folder name rows, read batches and keep intermediate tables."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.session import reach_workers, remove, shared_folder, small_batches

#: Bytes of text that a task holds at once; a longer single text is held alone.
BLOCK_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` written to the shared folder and read again: cut lineage that survives executors."""
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    found = frame.sparkSession.read.schema(frame.schema).parquet(path)
    found.stored_in = path
    return found


def discard(*frames: DataFrame) -> None:
    """Removes the files of stored frames that no later plan reads."""
    for frame in frames:
        remove(frame.sparkSession, frame.stored_in)


def keyed(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, row, text): the columns an operator works on, so that other columns cannot clash.

    ``row`` tells rows with one id and different texts apart; both are never NULL, so joins on
    them need no null test. Rows without an id get the smallest long as ``doc``.
    """
    return docs.select(doc_of(ident).alias("doc"), row_of(ident, text).alias("row"),
                       F.col(text).cast("string").alias("text"))


NO_ID = -(1 << 63)


def doc_of(ident: str = "doc_id") -> Column:
    return F.coalesce(F.col(ident).cast("long"), F.lit(NO_ID))


def row_of(ident: str = "doc_id", text: str = "text") -> Column:
    return F.xxhash64(F.col(ident).cast("long"), F.col(text).cast("string"))


def rest_of(docs: DataFrame, text: str = "text") -> Column:
    """All columns but the text as one, so that none clashes with those of an operator."""
    return F.struct(*(f"`{x}`" for x in docs.columns if x != text)).alias("rest")


def restored(frame: DataFrame, like: DataFrame, text: Column, name: str = "text") -> DataFrame:
    """The columns of ``like`` from ``rest`` and a text."""
    return frame.select(*(text.alias(x) if x == name else F.col("rest")[x].alias(x) for x in like.columns))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 of a column, NULL as an empty text."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut and joined into blocks of about ``limit`` bytes of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = [x or 0 for x in pc.binary_length(batch.column(column)).to_pylist()]
        start = 0
        for at, length in enumerate(lengths):
            if size and size + length > limit:
                held.append(batch.slice(start, at - start))
                whole, held = joined(held), []
                yield whole
                size, start, whole = 0, at, None
                give_back()
            size += length
        held.append(batch.slice(start))
    if any(x.num_rows for x in held):
        yield joined(held)
    held = []
    give_back()


def give_back() -> None:
    """Returns free memory to the system: a worker lives on beside the JVM and the next tasks' workers."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    whole = pa.Table.from_batches(held).combine_chunks()
    return whole.to_batches()[0] if whole.num_rows else held[0]


def partitions(frame: DataFrame) -> int:
    """The session's number of shuffle partitions, which its owner sizes for the input."""
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranges(rows: DataFrame, n: int) -> tuple[Column, int]:
    """The number of the range that a row lies in by (doc, row), and how many ranges there are.

    About ``n`` ranges of equal numbers of rows. An id of more rows than a range has is divided by
    ``row``, a hash, so that no id makes a range larger than others; only rows that are the same in
    both stay together. The bounds, and the ids that are divided, are at most ``n`` numbers each,
    found by halving.
    """
    found = rows.agg(F.count("*").alias("n"), F.percentile_approx("doc", [i / n for i in range(1, n)] or [0.5], 10 * n + 1000).alias("cuts")).first()
    hot = rows.groupBy("doc").agg(F.count("*").alias("n")).where(F.col("n") * n > found["n"]).collect()
    parts = {r["doc"]: -(-r["n"] * n // found["n"]) for r in hot}
    cuts = sorted({*(found["cuts"] or []), *parts})
    extra = [parts.get(x, 0) for x in cuts] + [0]
    first = [0]
    for x in extra[:-1]:
        first.append(first[-1] + 1 + x)
    bounds = F.lit(cuts) if cuts else F.array().cast("array<bigint>")
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))] or [1]
    below = F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) < F.col("doc"), at + step).otherwise(at))
    divided = F.get(F.lit(extra), below)
    share = F.least(F.floor((F.col("row") / F.lit(2.0 ** 64) + 0.5) * divided), divided - 1)
    place = F.get(F.lit(first), below) + F.when((divided > 0) & (F.get(bounds, below) == F.col("doc")), 1 + share).otherwise(0)
    return place.cast("int"), first[-1] + 1
