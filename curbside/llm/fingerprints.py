"""Document fingerprints: one-permutation MinHash with optimal densification and packed low bits.

Each shingle is hashed once. Its hash falls into one of the bins, each of which keeps its smallest.
An empty bin takes over the value of the first bin that is not empty in an order of its own, which
depends on nothing but its number. Of each value the low 8 bits are kept; two fingerprints agree in
a bin by chance once in 256 times, which the likeness is corrected for.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curbside.llm.columns import let, picked, word_hashes
from curbside.llm.rows import doc_of, partitions, ranges, row_of

BINS = 128
BIN_SHIFT = 63 - 7
BITS = 8
PROBES = 6
SHINGLE = 5
_orders = np.random.default_rng(77).integers(0, BINS, (PROBES, BINS))


def bin_of(value: Column) -> Column:
    return F.shiftright(value, BIN_SHIFT).cast("int")


def minima(hashes: Column) -> Column:
    """The smallest value of each bin that has any, in the order of the bins."""
    positive = F.transform(hashes, lambda x: F.shiftrightunsigned(x, 1))
    return let(F.sort_array(positive), lambda s: F.filter(s, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(s, i - 1)))))


def densified(found: Column) -> Column:
    """A value for each bin: its own, or that of another bin by a fixed order of probes."""
    bins = F.transform(found, bin_of)

    def filled(bins: Column) -> Column:
        def value(i: Column) -> Column:
            own = F.get(found, F.array_position(bins, i).cast("int") - 1)
            probes = [F.get(found, F.array_position(bins, F.get(F.lit(order.tolist()), i)).cast("int") - 1)
                      for order in _orders]
            # Rarely needed: the bin whose hash with this one is smallest.
            rest = F.array_min(F.transform(found, lambda x: F.struct(F.xxhash64(i, bin_of(x)).alias("rank"),
                                                                     x.alias("x"))))["x"]
            return F.coalesce(own, *probes, rest)

        return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value)

    return let(bins, filled)


def low_bits(text: Column, words: int = SHINGLE) -> Column:
    """The low bits of each bin; an empty array for a text without words.

    Shingles are ``words`` consecutive words in lower case; shorter texts have one of all their words.
    """
    def shingles(hashes: Column) -> Column:
        return F.when(F.size(hashes) >= words, picked(hashes, list(range(words)), words)).when(
            F.size(hashes) > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>"))

    found = let(let(word_hashes(text), shingles), minima)
    return let(found, lambda m: F.when(F.size(m) == 0, F.array().cast("array<smallint>")).otherwise(
        F.transform(densified(m), lambda x: F.pmod(x, F.lit(1 << BITS)).cast("smallint"))))


def packed(bits: Column) -> Column:
    """A fingerprint as text: two hexadecimal digits for each bin."""
    return F.lower(F.array_join(F.transform(bits, lambda x: F.substring(F.hex(x.cast("int") + 256), 2, 2)), ""))


def likeness(a: Column, b: Column) -> Column:
    """The estimated Jaccard similarity of two texts by their low bits, 0 to 1."""
    chance = 2.0 ** -BITS
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(BINS))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when(
        (F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(
            F.greatest(F.lit(0.0), (same - chance) / (1 - chance)))


def fingerprints(docs: DataFrame, ident: str = "doc_id", text: str = "text", words: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint): one for each row; equal for equal texts, empty without words, as for NULL.

    Repeated rows get a row each, an empty table gives none. Other columns are not looked at. Texts
    are worked on whole, whatever their length.
    """
    return docs.select(F.col(ident).alias("doc_id"), packed(low_bits(F.col(text).cast("string"), words)).alias("fingerprint"))


def with_next(rows: DataFrame, columns: list[str], describe: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Described rows of (doc, row, ...) with ``next``, a struct of the columns of the row after each; the first after the last.

    Rows are dealt out by ranges, four for each partition, and each range is ordered by itself. A range's last row is
    joined with the first row of the next range.
    """
    place, _ = ranges(rows, 4 * partitions(rows))
    spread = describe(rows).withColumn("range", place)
    # One row for each range.
    firsts = sorted(spread.select("range", "doc", "row").groupBy("range").agg(F.min(F.struct("doc", "row")).alias("x")).select("range", "x.doc", "x.row").collect())
    after = [(a[0], b[1], b[2]) for a, b in zip(firsts, firsts[1:] + firsts[:1])]
    edges = rows.sparkSession.createDataFrame(after, "range int, doc long, row long")
    heads = (describe(rows.join(F.broadcast(edges), ["doc", "row"])).groupBy("range")
             .agg(F.first(F.struct(*columns)).alias("head")))
    order = Window.partitionBy("range").orderBy("doc", "row")
    return (spread.withColumn("after", F.lead(F.struct(*columns)).over(order)).join(heads, "range")
            .withColumn("next", F.coalesce("after", "head")).drop("after", "head", "range"))


def edited_fingerprints(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has the first floor(n_chars / 4) code points of the next document's text, or
    all it has, in place of as many at the end. The next document is the next row by id; rows with
    one id are ordered by a hash, rows without one come first, and repeated rows follow each other.
    NULL counts as an empty text. Other columns are not looked at; an empty table gives no rows.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(ident).alias("doc_id"), doc_of(ident).alias("doc"), row_of(ident, text).alias("row"),
                       whole.alias("text"))
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    both = with_next(rows, ["text", "bits"], lambda x: x.withColumn("bits", low_bits(F.col("text")))).withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next.text"), F.lit(1), cut)))
    bits = both.withColumn("edited_bits", low_bits(F.col("edited")))
    return bits.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       packed(F.col("bits")).alias("fingerprint"), packed(F.col("edited_bits")).alias("edited_fingerprint"),
                       likeness(F.col("bits"), F.col("edited_bits")).alias("near_edited"),
                       likeness(F.col("bits"), F.col("next.bits")).alias("near_next"))
