"""Documents drawn so that their words are distributed as those of a target, by importance weights.

Texts stay UTF-8 bytes: one translation of 256 bytes lower-cases and blanks what separates words,
and the hash of a run of words is the checksum of its bytes, extended word by word from the
checksum of the run without its last word. Buckets of hashes are counted for both sides; a
document's weight is the mean of its features' logarithmic gains, and Gumbel noise from its id
turns the highest scores into a draw without replacement.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbside.llm.rows import blocks, partitions, stored, texts_of

BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 10, 2024
#: Bytes of a text that are split into words at once.
PIECE = 1 << 20
#: Lower-cases A-Z and turns all other ASCII characters than letters and digits into spaces.
TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 32 for c in range(256))
PLACE_BITS = 33  # monotonically_increasing_id counts the rows of a partition in so many bits


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    clean = text.translate(TABLE)
    at = 0
    while at < len(clean):
        stop = clean.find(b" ", at + PIECE)
        stop = len(clean) if stop < 0 else stop
        yield clean[at:stop].split()
        at = stop


def run_hashes(words: list[bytes], carried: list[bytes], longest: int) -> list[int]:
    """Checksums of all runs of 1 to ``longest`` words that end in ``words``, which follow ``carried``."""
    whole = carried + words
    sums = list(map(crc32, whole))
    out = sums[len(carried):]
    for size in range(2, longest + 1):
        sums = [crc32(word, crc32(b" ", seed)) for seed, word in zip(sums, whole[size - 1:])]
        out += sums[max(0, len(carried) - size + 1):]
    return out


def text_runs(text: bytes, longest: int) -> Iterator[tuple[int, list[int]]]:
    """For pieces of a text: the number of words and the checksums of the runs that end there."""
    carried: list[bytes] = []
    for words in word_pieces(text):
        yield len(words), run_hashes(words, carried, longest)
        carried = (carried + words)[-(longest - 1):] if longest > 1 else []


def counted(longest: int, buckets: int) -> Callable:
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How often each bucket occurs in a partition: one row for each at most."""
        found: Counter[int] = Counter()
        for block in blocks(batches):
            for text in texts_of(block):
                for _, sums in text_runs(text, longest):
                    for value, n in Counter(sums).items():
                        found[value % buckets] += n
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.int32()), pa.array(found.values(), pa.int64())], ["bucket", "n"])

    return count


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    return texts.select("text").mapInArrow(counted(longest, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """floor(1000 ln) of each bucket's share of the target over its share of the documents, both smoothed by one."""
    sides = bucket_counts(docs, longest, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).union(
        bucket_counts(target, longest, buckets).select("bucket", F.lit(0).cast("long"), "n"))
    sides = sides.union(docs.sparkSession.range(buckets).selectExpr("cast(id as int)", "0L", "0L"))
    each = sides.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    whole = Window.partitionBy()  # over as many rows as there are buckets
    ratio = ((F.col("t") + 1).cast("double") * (F.sum("s").over(whole) + buckets).cast("double")
             / ((F.col("s") + 1).cast("double") * (F.sum("t").over(whole) + buckets).cast("double")))
    gains = each.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")).toArrow()
    out = np.empty(buckets, np.int64)
    out[gains.column("bucket").to_numpy()] = gains.column("gain").to_numpy()
    return out


def weighed(longest: int, gains: np.ndarray) -> Callable:
    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc, row, n_words, n_features, weight) for each text."""
        for block in blocks(batches):
            rows = []
            for text in texts_of(block):
                n_words = n_features = total = 0
                for n, sums in text_runs(text, longest):
                    n_words += n
                    n_features += len(sums)
                    total += int(gains[np.array(sums, np.int64) % len(gains)].sum()) if sums else 0
                rows.append((n_words, n_features, total // n_features if n_features else 0))
            n_words, n_features, weight = (pa.array(x, pa.int64()) for x in zip(*rows))
            yield pa.RecordBatch.from_arrays([block.column("doc"), block.column("row"), n_words, n_features, weight],
                                             ["doc", "row", "n_words", "n_features", "weight"])

    return weigh


def noise(seed: int, doc: Column) -> Column:
    """Gumbel noise in thousandths, from a hash of the seed and the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(scored: DataFrame, percent: int) -> DataFrame:
    """``rank`` among eligible rows for the drawn ones, by ranges of scores that are numbered one after the other.

    Rows that are alike are told apart by their place in ``scored``, so that no range is crowded.
    """
    order = [F.desc("eligible"), F.desc("score"), "doc", "row", "place"]
    in_order = scored.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(
        partitions(scored), *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ranges = stored(in_order.select("doc", "n_features", "weight", "score", "eligible", F.shiftright("at", PLACE_BITS).alias("part"),
                                    (F.col("at") % (1 << PLACE_BITS)).alias("at")), "ranked")
    sizes = ranges.groupBy("part").agg(F.count("*").alias("n"), F.count_if("eligible").alias("eligible_rows"))
    # One row for each range.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
                          F.floor(F.sum("eligible_rows").over(Window.partitionBy()) * percent / 100).alias("drawn"))
    rank = F.col("start") + F.col("at") + 1
    return ranges.join(F.broadcast(starts), "part").withColumn("rank", F.when(F.col("eligible") & (rank <= F.col("drawn")), rank))


def resampled(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
              percent: int = PERCENT, seed: int = SEED, ident: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for each row of ``docs``; ``rank`` is NULL for rows not drawn.

    Words are runs of ASCII letters, lower-cased, digits and characters beyond ASCII; features are
    all runs of 1 to ``longest`` words, repeats counted. All texts of both tables count, in
    ``buckets`` buckets, which bounds what reaches the driver and is sent to the tasks. Of the rows
    with ``least_words`` words, ``percent`` in a hundred are drawn: those with the highest scores,
    ties to the smaller id, then by text. A NULL or empty text has no feature and weight 0. Repeated
    rows count, and are ranked, one by one. Rows without an id count in the distribution but have no
    score and are neither drawn nor counted among those to draw from. An empty table gives no rows,
    an empty target smoothed shares. Long texts are split a megabyte at a time.
    """
    whole = F.col(text).cast("string")
    own = docs.select(F.col(ident).cast("long").alias("doc"), F.xxhash64(whole).alias("row"), whole.alias("text"))
    wanted = target.select(F.col(target_text).cast("string").alias("text"))
    gains = bucket_gains(own, wanted, longest, buckets)
    weights = own.mapInArrow(weighed(longest, gains), "doc long, row long, n_words long, n_features long, weight long")
    scored = stored(weights.withColumn("score", F.col("weight") + noise(seed, F.col("doc"))).withColumn(
        "eligible", F.col("doc").isNotNull() & (F.col("n_words") >= least_words)), "weights")
    return ranked(scored, percent).select(F.col("doc").alias("doc_id"), "n_features", "weight", "score", "rank")
