"""Substring dedup by level-wise doubling.

Windows of a short length that only one document holds are given up. Those repeated are extended
to twice the length, compared again, and so on until the wanted length is reached or no candidates
survive. Lower levels may let windows pass by a hash collision; the last one compares 128 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm import windows as W
from curbside.llm.rows import NO_ID, blocks, keyed, texts_of
from curbside.llm.words import inner_starts, levels, window_hashes, word_hashes, word_spans


def first_level(words: int, buckets: int, owners: bool) -> Callable:
    """Sends every window of the first length."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            yield W.to_send(sent_windows(block, words, None, buckets, owners))

    return send


def next_level(have: int, want: int, buckets: int, owners: bool) -> Callable:
    """Sends the windows of the next length whose two halves were both found repeated."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            yield W.to_send(sent_windows(block, want, want - have, buckets, owners))

    return send


def sent_windows(block: pa.RecordBatch, words: int, shift: int | None, buckets: int,
                 owners: bool) -> Iterator[tuple]:
    hashes, bounds = word_hashes(texts_of(block))
    starts, text = inner_starts(bounds, words)
    if shift is not None:
        found = np.zeros(len(hashes) + shift, bool)
        for head, places in zip(bounds[:-1], block.column("places").to_pylist()):
            found[head + W.gathered(places)] = True
        alive = found[starts] & found[starts + shift]
        starts, text = starts[alive], text[alive]
    docs = block.column("doc").to_numpy()[text]
    rows = block.column("row").to_numpy()[text]
    has_id = docs != NO_ID
    starts, text, docs, rows = (x[has_id] for x in (starts, text, docs, rows))
    high = window_hashes(hashes, words)[starts]
    low = window_hashes(hashes, words, 1)[starts] if owners else None
    return W.requests(docs, rows, starts - bounds[:-1][text], high, low, buckets, owners)


def word_total(rows: DataFrame) -> int:
    """About how many words the texts have, for the number of buckets."""
    return int(rows.agg(F.sum(F.length("text"))).first()[0] or 0) // 6


def repeated_windows(rows: DataFrame, words: int, base: int) -> DataFrame:
    """(doc, row, places): windows of ``words`` words that also start in a smaller document."""
    steps = levels(words, base)
    buckets = 1 + word_total(rows) // W.BUCKET
    alone = rows.join(W.copies(rows), ["doc", "row"], "left_anti") if steps[1:] else rows
    found = None
    for i, want in enumerate(steps):
        last = want == words
        if found is None:
            sent = alone.mapInArrow(first_level(want, buckets, last), W.SENT_SQL)
        else:
            sent = rows.join(found, ["doc", "row"]).mapInArrow(
                next_level(steps[i - 1], want, buckets, last), W.SENT_SQL)
        found = W.exchanged(sent, W.answers(last, last, buckets))
    return found


def cut_texts(words: int) -> Callable:
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            whole, starts, ends, bounds = word_spans(texts_of(block))
            out: dict[str, list] = {x: [] for x in ("n_words", "n_removed", "span_starts", "span_words", "kept")}
            for i, (places, copy) in enumerate(zip(block.column("places").to_pylist(),
                                                   block.column("copy").to_pylist())):
                a, b = int(bounds[i]), int(bounds[i + 1])
                n = b - a
                cover = np.full(n, n >= words) if copy else W.covered(n, W.gathered(places), words)
                left = np.flatnonzero(~cover) + a
                out["n_words"].append(n)
                out["n_removed"].append(n - len(left))
                for name, value in zip(("span_starts", "span_words"), W.spans(cover)):
                    out[name].append(value)
                out["kept"].append(b" ".join(whole[s:e] for s, e in zip(starts[left].tolist(),
                                                                       ends[left].tolist())))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string())
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), *(pa.array(v, k) if k != pa.string() else
                                           pa.array(v, pa.binary()).cast(k)
                                           for v, k in zip(out.values(), kinds))],
                ["doc_id", *out])

    return cut


def cut_repeats(docs: DataFrame, rows: DataFrame, found: DataFrame, words: int,
                ident: str = "doc_id") -> DataFrame:
    """The texts without the words that the found windows cover, and the spans taken out."""
    whole = W.copies(rows).select("doc", "row", F.lit(True).alias("copy"))
    kind = docs.schema[ident].dataType.simpleString()
    both = (rows.join(found, ["doc", "row"], "left").join(whole, ["doc", "row"], "left")
            .select(F.when(F.col("doc") != NO_ID, F.col("doc")).cast(kind).alias("doc_id"), "text",
                    "places", F.coalesce("copy", F.lit(False)).alias("copy")))
    return both.mapInArrow(cut_texts(words), f"doc_id {kind}, n_words long, n_removed long, "
                           "span_starts array<long>, span_words array<long>, kept string")


def substring_dedup(docs: DataFrame, words: int = 50, base: int = 25, ident: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, span_starts, span_words, kept) for each row of ``docs``.

    Words are runs of characters other than ASCII white space. Removed is each word that a window
    of ``words`` words covers whose words also start, in this order, in a document with a smaller
    id. ``base`` is the length to start from. NULL counts as an empty text; shorter texts lose
    nothing; rows with one id count as one document, and rows without an id are left whole and
    compared with nothing. Copies of a whole text are settled by its digest. Repeated rows get a
    row each, an empty table gives none. Other columns are not looked at. Texts are read in blocks
    of some megabytes, a longer one as a block by itself.
    """
    rows = keyed(docs, ident, text)
    return cut_repeats(docs, rows, repeated_windows(rows, words, base), words, ident)
