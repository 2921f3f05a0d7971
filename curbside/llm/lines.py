"""Line dedup: the first document that holds a line keeps it.

Hashes of line keys are dealt out by ranges of their value and sorted by document; each task
streams over its range and sees a line's first document first. Results are compressed bitmaps
of the lines to keep, one for each document, which :func:`apply_bitmaps` puts to use.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.rows import NO_ID, blocks, doc_of, keyed, partitions, rest_of, row_of, texts_of

FOUND = "high long, low long, doc long, row long, lines binary, sure boolean"
FOUND_ARROW = pa.schema([("high", pa.int64()), ("low", pa.int64()), ("doc", pa.int64()),
                         ("row", pa.int64()), ("lines", pa.binary()), ("sure", pa.bool_())])


def line_key(line: bytes) -> bytes:
    """A line without white space at its ends, A-Z in lower case."""
    return line.strip().lower()


def code_points(text: bytes) -> int:
    return len(text.decode("utf-8", "replace"))


def lines_found(batches: Iterable[pa.RecordBatch], shortest: int) -> Iterator[pa.RecordBatch]:
    """For each line key of a block, where its smallest document has it (to be compared with
    other blocks) and where later documents of the block have it (which lose it for sure)."""
    for block in blocks(batches):
        docs, rows = (block.column(x).to_pylist() for x in ("doc", "row"))
        seen: dict[bytes, list[tuple[int, int, int]]] = {}
        for at, text in enumerate(texts_of(block)):
            if docs[at] == NO_ID:
                continue
            own: dict[bytes, list[int]] = {}
            for place, line in enumerate(text.split(b"\n")):
                key = line_key(line)
                if len(key) >= shortest and (len(key) >= 4 * shortest or code_points(key) >= shortest):
                    own.setdefault(key, []).append(place)
            for key, places in own.items():
                seen.setdefault(key, []).append((docs[at], rows[at], places))
        out: dict[str, list] = {x: [] for x in FOUND_ARROW.names}
        sure: dict[tuple[int, int], list[int]] = {}
        for key, held in seen.items():
            first = min(x[0] for x in held)
            digest = xxhash.xxh3_128_digest(key)
            for doc, row, places in held:
                if doc != first:
                    sure.setdefault((doc, row), []).extend(places)
                    continue
                for name, value in zip(out, (int.from_bytes(digest[:8], "little", signed=True),
                                             int.from_bytes(digest[8:], "little", signed=True),
                                             doc, row, np.array(places, np.uint32).tobytes(), False)):
                    out[name].append(value)
        for (doc, row), places in sure.items():
            for name, value in zip(out, (0, 0, doc, row, np.array(places, np.uint32).tobytes(), True)):
                out[name].append(value)
        yield pa.RecordBatch.from_pydict(out, FOUND_ARROW)


def after_first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by hash and document, those whose document is not the first of the hash."""
    last, first = None, None
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for i, (high, low, doc) in enumerate(zip(*(batch.column(x).to_pylist()
                                                   for x in ("high", "low", "doc")))):
            if (high, low) != last:
                last, first = (high, low), doc
            keep[i] = doc != first
        yield batch.select(["doc", "row", "lines"]).filter(pa.array(keep))


def dropped_lines(docs: DataFrame, ident: str, text: str, shortest: int) -> DataFrame:
    """(doc, row, lines): for each document that loses any, the numbers of its lost lines."""
    found = keyed(docs, ident, text).mapInArrow(lambda x: lines_found(x, shortest), FOUND)
    n = partitions(docs)
    ranges = F.floor((F.shiftrightunsigned(F.col("high"), 33) * n) / F.lit(1 << 31)).cast("int")
    # Sure rows need no comparing; they are dealt out by row so that none of them meet.
    streamed = (found.repartitionById(n, F.when(F.col("sure"), F.pmod("row", F.lit(n)).cast("int"))
                                      .otherwise(ranges))
                .sortWithinPartitions("sure", "high", "low", "doc"))
    lost = streamed.mapInArrow(after_first_or_sure, "doc long, row long, lines binary")
    return lost.groupBy("doc", "row").agg(F.collect_list("lines").alias("lines"))


def after_first_or_sure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def compared() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sure = batch.column("sure")
            settled.append(batch.filter(sure).select(["doc", "row", "lines"]))
            yield batch.filter(pc.invert(sure))

    settled: list[pa.RecordBatch] = []
    for out in after_first(compared()):
        yield from settled
        settled.clear()
        yield out


def bitmaps_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, keeps = [], []
        for n, lines in zip(batch.column("n_lines").to_pylist(), batch.column("lines").to_pylist()):
            keep = np.ones(n, bool)
            for part in lines or ():
                keep[np.frombuffer(part, np.uint32)] = False
            counts.append(n - int(keep.sum()))
            keeps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(x) for x in ("doc", "row", "n_lines")), pa.array(counts, pa.int64()),
             pa.array(keeps, pa.binary())], ["doc", "row", "n_lines", "n_dropped", "keep"])


def keep_bitmaps(docs: DataFrame, ident: str = "doc_id", text: str = "text",
                 shortest: int = 10) -> DataFrame:
    """(doc, row, n_lines, n_dropped, keep) for each row of ``docs``.

    A line's key is the line stripped of ASCII white space with A-Z in lower case. Keys of at
    least ``shortest`` code points that two or more documents hold lose all their lines except in
    the document with the smallest id. ``keep`` is a zlib-compressed bitmap of the lines, first
    line in the highest bit. NULL and empty texts have one empty line, which stays. Rows with one
    id count as one document; repeated rows get equal bitmaps. Rows without an id keep all lines.
    Within a block of texts only the smallest document of a line is sent on, so a line that a
    third of all documents hold becomes one row for each block, streamed from a sorted run.
    """
    counts = docs.select(doc_of(ident).alias("doc"), row_of(ident, text).alias("row"),
                         line_count(text).alias("n_lines")).distinct()
    lost = dropped_lines(docs, ident, text, shortest)
    return counts.join(lost, ["doc", "row"], "left").mapInArrow(
        bitmaps_of, "doc long, row long, n_lines long, n_dropped long, keep binary")


def line_count(text: str = "text"):
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return (F.length(value) - F.length(F.replace(value, F.lit("\n"))) + 1).cast("long")


def kept_text(text: str | None, n_lines: int, keep: bytes) -> str:
    """The lines that a bitmap keeps, joined by line feeds."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines)
    if bits.all():
        return text or ""
    return "\n".join(x for x, bit in zip((text or "").split("\n"), bits.tolist()) if bit)


def texts_kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [kept_text(*x) for x in zip(*(batch.column(c).to_pylist()
                                              for c in ("text", "n_lines", "keep")))]
        yield batch.drop_columns(["text", "keep"]).append_column("kept", pa.array(texts, pa.string()))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, ident: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """(rest, n_lines, n_dropped, kept) for each row of ``docs``; ``rest`` holds its other columns."""
    own = docs.select(rest_of(docs, text), doc_of(ident).alias("doc"), row_of(ident, text).alias("row"),
                      F.col(text).cast("string").alias("text"))
    both = own.join(bitmaps, ["doc", "row"]).select("rest", "text", "n_lines", "n_dropped", "keep")
    kind = both.schema["rest"].dataType.simpleString()
    return both.mapInArrow(texts_kept, f"rest {kind}, n_lines long, n_dropped long, kept string")


def line_dedup(docs: DataFrame, ident: str = "doc_id", text: str = "text",
               shortest: int = 10) -> DataFrame:
    """``apply_bitmaps`` of ``keep_bitmaps``, which say what becomes of NULLs and repeated rows.

    An empty table gives no rows. Other columns come along in ``rest``, whatever their names. Texts
    are read in blocks of some megabytes, a longer one as a block by itself.
    """
    return apply_bitmaps(docs, keep_bitmaps(docs, ident, text, shortest), ident, text)
