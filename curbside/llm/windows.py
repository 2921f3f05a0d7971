"""Which windows of words start in an earlier document: exchanged in packed form, by ranges of hashes.

A block of texts sends each bucket one row with all its hashes for that bucket. A hash that
several documents of a block hold is sent for the smallest of them only, as the block itself
knows about the others; so a passage in a third of all documents costs one entry for each block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.rows import NO_ID

#: Entries that a bucket gets on average, so that its task needs some 200 MB at any input size.
BUCKET = 3_000_000

SENT = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("rows", pa.binary()),
                  ("counts", pa.binary()), ("places", pa.binary()), ("keys", pa.binary()),
                  ("settled", pa.bool_())])
SENT_SQL = "bucket int, docs binary, rows binary, counts binary, places binary, keys binary, settled boolean"
PLACES_SQL = "doc long, row long, places binary"
PLACES = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("places", pa.binary())])


def packed(bucket: int, docs: np.ndarray, rows: np.ndarray, places: np.ndarray, keys: np.ndarray,
           settled: bool) -> tuple:
    """One row to send; entries of one text lie together, by place."""
    heads = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (docs[1:] != docs[:-1])])
    steps = np.diff(places, prepend=0)
    steps[heads] = places[heads]
    return (bucket, docs[heads].tobytes(), rows[heads].tobytes(),
            np.diff(np.r_[heads, len(rows)]).astype(np.uint32).tobytes(),
            steps.astype(np.uint32).tobytes(), keys.tobytes(), settled)


def unpacked(docs: bytes, rows: bytes, counts: bytes, places: bytes) -> tuple[np.ndarray, ...]:
    counts = np.frombuffer(counts, np.uint32)
    steps = np.frombuffer(places, np.uint32).astype(np.int64)
    sums = np.cumsum(steps)
    heads = np.cumsum(counts) - counts
    places = sums - np.repeat(sums[heads] - steps[heads], counts)
    return (np.repeat(np.frombuffer(docs, np.int64), counts),
            np.repeat(np.frombuffer(rows, np.int64), counts), places)


def runs(order: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal keys start in ``order``, and the run of each entry."""
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        sorted_key = key[order]
        new[1:] |= sorted_key[1:] != sorted_key[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1


def sorted_by(key: np.ndarray, *more: np.ndarray) -> np.ndarray:
    return np.lexsort((*more[::-1], key)) if more else np.argsort(key, kind="stable")


def requests(docs: np.ndarray, rows: np.ndarray, places: np.ndarray, high: np.ndarray,
             low: np.ndarray | None, buckets: int, owners: bool) -> Iterator[tuple]:
    """Rows to send for the windows of a block, given by text and place in ascending order.

    Without ``low`` keys are shortened to 32 bits besides the bucket. Settled rows hold windows
    that need no answer: those of later documents (``owners``) or all that are repeated.
    """
    if not len(high):
        return
    order = sorted_by(high) if low is None else sorted_by(high, low)
    start, run = runs(order, *([high] if low is None else [high, low]))
    first = np.minimum.reduceat(docs[order], start)
    last = np.maximum.reduceat(docs[order], start)
    mine = np.empty(len(order), bool)
    mine[order] = docs[order] == first[run]
    repeated = np.empty(len(order), bool)
    repeated[order] = (first != last)[run]
    done = repeated & ~mine if owners else repeated
    if done.any():
        yield packed(int(high[0] % np.uint64(buckets)), docs[done], rows[done], places[done],
                     np.empty(0, np.uint32), True)
    bucket = ((high >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    asked = np.flatnonzero(mine)
    asked = asked[np.argsort(bucket[asked], kind="stable")]
    edges = np.flatnonzero(np.r_[True, np.diff(bucket[asked]) != 0, True]) if len(asked) else []
    for a, b in zip(edges[:-1], edges[1:]):
        at = asked[a:b]
        keys = high[at].astype(np.uint32) if low is None else np.column_stack([high[at], low[at]])
        yield packed(int(bucket[at[0]]), docs[at], rows[at], places[at], keys, False)


def answers(owners: bool, wide: bool, shards: int) -> Callable[[pa.Table], pa.Table]:
    """For a bucket: the windows that later documents repeat (``owners``), or all repeated ones."""

    def answer(sent: pa.Table) -> pa.Table:
        parts = {True: [], False: []}
        keys = []
        for row in sent.to_pylist():
            parts[row["settled"]].append(unpacked(*(row[x] for x in ("docs", "rows", "counts", "places"))))
            if not row["settled"]:
                keys.append(np.frombuffer(row["keys"], np.uint64 if wide else np.uint32))
        found = list(parts[True])
        if keys:
            docs, rows, places = (np.concatenate(x) for x in zip(*parts[False]))
            key = np.concatenate(keys)
            if wide:
                high, low = key.reshape(-1, 2).T
                order = np.lexsort((low, high))
                start, run = runs(order, high, low)
            else:
                order = np.argsort(key, kind="stable")
                start, run = runs(order, key)
            first = np.minimum.reduceat(docs[order], start)
            last = np.maximum.reduceat(docs[order], start)
            hit = (first != last)[run]
            if owners:
                hit &= docs[order] != first[run]
            at = order[hit]
            found.append((docs[at], rows[at], places[at]))
        return for_shards(*(np.concatenate(x) for x in zip(*found)), shards)

    return answer


def for_shards(docs: np.ndarray, rows: np.ndarray, places: np.ndarray, shards: int) -> pa.Table:
    """Found windows for each shard of the texts, in packed form."""
    shard = rows % shards
    order = np.lexsort((places, rows, docs, shard))
    docs, rows, places, shard = docs[order], rows[order], places[order], shard[order]
    edges = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]) if len(docs) else np.zeros(1, int)
    return pa.Table.from_batches([to_send(
        packed(int(shard[x]), docs[x:y], rows[x:y], places[x:y], np.empty(0, np.uint32), True)
        for x, y in zip(edges[:-1], edges[1:]))])


def by_text(found: pa.Table) -> pa.Table:
    """The windows of a shard, one row for each text."""
    docs, rows, places = (np.concatenate(x) for x in zip(*(
        unpacked(*(row[x] for x in ("docs", "rows", "counts", "places"))) for row in found.to_pylist())))
    order = np.lexsort((places, rows, docs))
    docs, rows, places = docs[order], rows[order], places[order].astype(np.uint32)
    new = np.r_[True, (rows[1:] != rows[:-1]) | (docs[1:] != docs[:-1])]
    keep = new | np.r_[True, places[1:] != places[:-1]]
    heads = np.flatnonzero(new[keep])
    docs, rows, raw = docs[keep][heads], rows[keep][heads], places[keep].tobytes()
    return pa.table({"doc": pa.array(docs), "row": pa.array(rows), "places": pa.array(
        [raw[4 * x:4 * y] for x, y in zip(heads.tolist(), [*heads[1:].tolist(), len(raw) // 4])], pa.binary())}, PLACES)


def exchanged(sent: DataFrame, answer: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """(doc, row, places): one row for each text with any window found by ``answer``, places ascending."""
    found = sent.groupBy("bucket").applyInArrow(answer, SENT_SQL)
    return found.groupBy("bucket").applyInArrow(by_text, PLACES_SQL)


def to_send(rows: Iterable[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(SENT)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, SENT)], schema=SENT)


def gathered(places: bytes | None) -> np.ndarray:
    return np.frombuffer(places or b"", np.uint32).astype(np.int64)


def copies(rows: DataFrame) -> DataFrame:
    """(doc, row, first): documents whose whole text a smaller document has."""
    digest = rows.where(F.col("doc") != NO_ID).select("doc", "row", F.sha2("text", 256).alias("digest"))
    first = digest.groupBy("digest").agg(F.min("doc").alias("first"), F.count("*").alias("n"))
    return digest.join(first.where("n > 1"), "digest").where("doc > first").select("doc", "row", "first")


def covered(n_words: int, starts: np.ndarray, words: int) -> np.ndarray:
    """Which words windows of ``words`` words cover that start at the given places."""
    change = np.zeros(n_words + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + words, n_words), -1)
    return np.cumsum(change[:-1]) > 0


def spans(cover: np.ndarray) -> tuple[list[int], list[int]]:
    """Runs of covered words: their first words and their lengths."""
    edge = np.flatnonzero(np.diff(np.r_[0, cover.astype(np.int8), 0]))
    return edge[0::2].tolist(), (edge[1::2] - edge[0::2]).tolist()
