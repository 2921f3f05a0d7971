"""Packing documents into training sequences by order-preserving dynamic programming.

The ids of a partition's documents form one row, in the table's order. Windows are cut out of it
one after another, at the ends of documents or sentences, so that padding plus a penalty for each
document cut in two is smallest. The best start for each cut lies at the head of a monotone queue.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.rows import blocks, texts_of
from curbside.llm.tokens import ENCODED_BYTES, default_path, encoder, with_end

#: Penalties in tokens of padding: for a window, a cut after a sentence and one within it.
WINDOW, SENTENCE, WITHIN = 2, 4, 16
#: Windows of these lengths need no padding either.
EXACT = (256, 512, 1024)
#: Within a sentence, a cut may lie after so many tokens.
STEP = 32
#: Tokens that are packed together.
BUFFER = 1 << 20

OUT = pa.schema([("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                 ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def sentence_ends(path: str) -> np.ndarray:
    """For each id, whether its token ends a sentence."""
    codes = encoder(path)
    ends = np.zeros(codes.size, bool)
    for token, i in codes.whole.get_vocab().items():
        mark = token.removesuffix("</w>")
        ends[i] = bool(mark) and mark[0] in ".!?" and not any(x.isalnum() for x in mark)
    return ends


def cut_places(n: int, doc_ends: np.ndarray, sentences: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where windows may end in a row of ``n`` ids, from 0 on, and the penalty there."""
    places = np.unique(np.concatenate([[0], doc_ends, sentences, [n]]))
    wide = np.flatnonzero(np.diff(places) > STEP)
    within = [np.arange(places[i] + STEP, places[i + 1], STEP) for i in wide]
    places = np.unique(np.concatenate([places, *within]))
    penalty = np.full(len(places), WITHIN)
    penalty[np.isin(places, sentences)] = SENTENCE
    penalty[np.isin(places, doc_ends)] = 0
    return places, penalty


def best_cuts(places: np.ndarray, penalty: np.ndarray, size: int) -> list[int]:
    """The window ends with the smallest sum of padding and penalties, as indices of places."""
    exact: dict[int, list[int]] = {}
    for length in EXACT:
        if length < size:
            at = np.searchsorted(places, places - length)
            for j in np.flatnonzero((places[at] == places - length) & (places >= length)).tolist():
                exact.setdefault(j, []).append(int(at[j]))
    spots, fines = places.tolist(), (penalty + WINDOW).tolist()
    cost, origin = [0.0] * len(spots), [0] * len(spots)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, len(spots)):
        place = spots[j]
        while spots[queue[0][1]] < place - size:
            queue.popleft()
        value, source = queue[0]
        best = value + size - place
        for i in exact.get(j, ()):
            if cost[i] < best:
                best, source = cost[i], i
        cost[j], origin[j] = best + fines[j], source
        key = cost[j] + place
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts = []
    j = len(spots) - 1
    while j:
        cuts.append(j)
        j = origin[j]
    return cuts[::-1]


class Packer:
    """Packs the documents of one partition as they come."""

    def __init__(self, size: int, ends: np.ndarray) -> None:
        self.size, self.ends = size, ends
        self.next = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple[object, int, int]] = []  # id, ids in all, ids packed before
        self.held = 0

    def add(self, docs: list, ids: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append(ids)
        self.docs.extend(zip(docs, counts.tolist(), [0] * len(docs)))
        self.held += len(ids)

    def pack(self, last: bool) -> tuple[list, dict[str, list]]:
        """Pieces of all windows, or of all but the last, whose ids stay for the next call."""
        ids = np.concatenate(self.parts)
        doc_ends = np.cumsum([n - before for _, n, before in self.docs])
        places, penalty = cut_places(len(ids), doc_ends, np.flatnonzero(self.ends[ids]) + 1)
        stops = places[best_cuts(places, penalty, self.size)]
        if not last:
            stops = stops[:-1]
        until = int(stops[-1]) if len(stops) else 0
        names: list = []
        out: dict[str, list] = {x: [] for x in OUT.names}
        edges = np.unique(np.concatenate([stops, doc_ends[doc_ends <= until]]))
        begins = np.r_[0, edges[:-1]] if len(edges) else edges
        owner = np.searchsorted(doc_ends, begins, "right")
        window = np.searchsorted(stops, begins, "right")
        window_begin = np.r_[0, stops][window] if len(edges) else edges
        heads = np.r_[0, doc_ends]
        for a, b, doc, w, wa in zip(*(x.tolist() for x in (begins, edges, owner, window, window_begin))):
            name, n, before = self.docs[doc]
            names.append(name)
            for key, value in zip(out, (before + a - int(heads[doc]), b - a, zlib.crc32(ids[a:b].tobytes()),
                                        n, self.next + w, a - wa)):
                out[key].append(value)
        self.next += len(stops)
        gone = int(np.searchsorted(doc_ends, until, "right"))
        left = self.docs[gone:]
        if left:
            name, n, before = left[0]
            left[0] = (name, n, before + until - int(heads[gone]))
        self.docs, self.parts, self.held = left, [ids[until:]], len(ids) - until
        return names, out


def packer(size: int, path: str, end: int):
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, work, kind = encoder(path), Packer(size, sentence_ends(path)), None

        def batch(last: bool) -> pa.RecordBatch:
            names, out = work.pack(last)
            return pa.RecordBatch.from_arrays(
                [pa.array(names, kind), *(pa.array(v, pa.int64()) for v in out.values())], ["doc_id", *out])

        for block in blocks(batches, "text", ENCODED_BYTES):
            kind = block.column("doc_id").type
            ids, counts = with_end(*codes.encode(texts_of(block)), end)
            work.add(block.column("doc_id").to_pylist(), ids.astype(np.uint32), counts)
            if work.held >= BUFFER:
                yield batch(False)
        if work.held:
            yield batch(True)

    return pack


def pack_documents(docs: DataFrame, size: int = 2048, path: str | None = None, end: int = 1,
                   ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): the pieces of all sequences.

    A document's ids are those of the tokenizer at ``path`` and ``end``; NULL and empty texts have
    that one id, and repeated rows and rows without an id are packed as they are. Documents keep
    the order of the table's partitions, which are read without a shuffle; each is packed by itself
    as a stream, so at most one window of a partition is cut short. ``sequence_id`` is unique. An
    empty table gives no pieces. Other columns are not looked at. Texts are read in blocks of some
    megabytes, a longer one as a block by itself.
    """
    frame = docs.select(F.col(ident).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = dict(frame.dtypes)["doc_id"]
    return frame.mapInArrow(packer(size, path or default_path(), end),
                            f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                            "sequence_id long, offset long")
