"""Substring dedup by a sparse suffix array.

Of all suffixes of the texts only those are kept that begin at minimisers: words whose hash is the
smallest in some window around them. Equal passages choose equal places, so both keep a suffix there.
Suffixes that begin with words that no other document has go no further. The others are sorted, by
hashes of their first words and then word by word; neighbours are compared, which gives how far they
agree to the right, and those that agree far enough are told apart by the words to their left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from curbside.llm import windows as W
from curbside.llm.rows import NO_ID, blocks, keyed, texts_of
from curbside.llm.substrings import cut_repeats, word_total
from curbside.llm.words import inner_starts, mixed, window_hashes, word_hashes

def shape(words: int) -> tuple[int, int, int]:
    """Window of the minimisers, their length in words, and words that a suffix is sorted by.

    The first ``window`` places of a passage of ``words`` words choose a minimiser without looking
    at a word outside it, and from there on it has all the words that suffixes are sorted by.
    """
    gram = max(1, min(4, words // 8))
    window = max(1, (words - gram + 1) // 2)
    return window, gram, words - window + 1


def owners(hashes: np.ndarray, bounds: np.ndarray, words: int) -> np.ndarray:
    """For each place at which a window of ``words`` words lies within its text, the minimiser that it chooses; else -1."""
    window, gram, _ = shape(words)
    starts, _ = inner_starts(bounds, gram)
    heads, _ = inner_starts(bounds, words)
    found = np.full(len(hashes), -1)
    if len(heads):
        value = np.full(len(hashes), np.uint64((1 << 64) - 1))
        value[starts] = mixed(window_hashes(hashes, gram) + np.uint64(1))[starts]
        found[heads] = last_smallest(value, window)[heads]
    return found


def last_smallest(value: np.ndarray, window: int) -> np.ndarray:
    """For each place, where the smallest of the ``window`` values from it on stands, the last of equal ones."""
    at = np.arange(len(value))
    have = 1
    while have < window:
        step = min(have, window - have)
        a, b = at[:-step] if step else at, at[step:]
        at = np.where(value[b] <= value[a], b, a)
        have += step
    return at


def first_words(hashes: np.ndarray, places: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the words that suffixes begin with, one of either half."""
    _, _, depth = shape(words)
    half = (depth + 1) // 2
    if not len(places):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return window_hashes(hashes, half)[places], window_hashes(hashes, depth - half, 1)[places + half]


def sparse_suffixes(words: int, buckets: int) -> Callable:
    """Sends the suffixes at minimisers, by two hashes of the words that they begin with."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            hashes, bounds = word_hashes(texts_of(block))
            places = np.unique(owners(hashes, bounds, words))
            places = places[places >= 0]
            text = np.searchsorted(bounds, places, "right") - 1
            docs = block.column("doc").to_numpy()
            keep = docs[text] != NO_ID
            places, text = places[keep], text[keep]
            high, low = first_words(hashes, places, words)
            # The bucket follows from both halves, so that no common beginning fills one.
            yield W.to_send(W.requests(docs[text], block.column("row").to_numpy()[text], places - bounds[:-1][text],
                                       mixed(high ^ mixed(low)), low, buckets, False))

    return send


def surroundings(words: int, buckets: int) -> Callable:
    """Sends suffixes that another document has too, with the words around those that they begin with.

    A suffix is sent with its windows: those that choose it, by how far to its left they begin. Of
    suffixes of a block that agree in all words only that of the smallest document is sent.
    """

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window, _, depth = shape(words)
        for block in blocks(batches):
            hashes, bounds = word_hashes(texts_of(block))
            chosen = owners(hashes, bounds, words)
            found = [head + W.gathered(x) for head, x in zip(bounds[:-1].tolist(), block.column("places").to_pylist())]
            text = np.repeat(np.arange(len(found)), [len(x) for x in found])
            at = np.concatenate([np.empty(0, np.int64), *found])
            docs, rows = (block.column(x).to_numpy()[text] for x in ("doc", "row"))
            # 48 bits of each word; 0 stands for none.
            word = np.append((hashes >> np.uint64(16)) | np.uint64(1), np.uint64(0))
            left = at[:, None] - np.arange(1, window)
            right = at[:, None] + np.arange(depth, words)
            around = word[np.column_stack([np.where(left >= bounds[text][:, None], left, -1),
                                           np.where(right < bounds[text + 1][:, None], right, -1)])]
            begin = at[:, None] - np.arange(window)
            owned = (begin >= bounds[text][:, None]) & (chosen[np.maximum(begin, 0)] == at[:, None])
            mask = (owned << np.arange(window)).sum(1).astype(np.uint32)
            high, low = first_words(hashes, at, words)
            yield W.to_send(suffix_rows(docs, rows, at - bounds[:-1][text], high, low, mask, around, buckets))

    return send


def suffix_rows(docs: np.ndarray, rows: np.ndarray, places: np.ndarray, high: np.ndarray, low: np.ndarray, mask: np.ndarray,
                around: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Rows to send, one for each bucket; windows that a smaller document of the block has need no answer."""
    if not len(docs):
        return
    key = high ^ mixed(low)
    whole = mixed(key + mask)
    for column in around.T:
        whole = mixed(whole ^ column)
    order = np.argsort(whole, kind="stable")
    start, run = W.runs(order, whole)
    first = np.empty(len(order), np.int64)
    first[order] = np.minimum.reduceat(docs[order], start)[run]
    later = docs != first
    bucket = ((mixed(key) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    if later.any():
        entry, back = np.nonzero(mask[later, None] >> np.arange(32) & 1)
        entry = np.flatnonzero(later)[entry]
        at = places[entry] - back
        order = np.lexsort([at, rows[entry], docs[entry]])
        entry, at = entry[order], at[order]
        yield W.packed(int(bucket[0]), docs[entry], rows[entry], at, np.empty(0, np.uint32), True)
    sent = np.flatnonzero(~later)
    sent = sent[np.argsort(bucket[sent], kind="stable")]
    edges = np.flatnonzero(np.r_[True, np.diff(bucket[sent]) != 0, True])
    for a, b in zip(edges[:-1], edges[1:]):
        at = sent[a:b]
        keys = np.column_stack([high[at].view(np.uint8).reshape(-1, 8), low[at].view(np.uint8).reshape(-1, 8), mask[at].view(np.uint8).reshape(-1, 4),
                                around[at].view(np.uint8).reshape(len(at), -1, 8)[:, :, :6].reshape(len(at), -1)])
        yield W.packed(int(bucket[at[0]]), docs[at], rows[at], places[at], keys, False)


def unpacked_keys(raw: np.ndarray) -> tuple[np.ndarray, ...]:
    """high, low, mask and surrounding words of suffixes."""
    high, low, mask = (np.ascontiguousarray(raw[:, a:b]).view(t).ravel() for a, b, t in ((0, 8, np.uint64), (8, 16, np.uint64), (16, 20, np.uint32)))
    around = np.zeros((len(raw), (raw.shape[1] - 20) // 6, 8), np.uint8)
    around[:, :, :6] = raw[:, 20:].reshape(len(raw), -1, 6)
    return high, low, mask, around.view(np.uint64).reshape(len(raw), -1)


def neighbours(words: int, shards: int) -> Callable[[pa.Table], pa.Table]:
    """For a bucket: the windows that a smaller document has, from its suffixes in order."""
    window, _, depth = shape(words)
    width = 20 + 6 * (window - 1 + words - depth)

    def compare(sent: pa.Table) -> pa.Table:
        settled, parts, keys = [], [], []
        for row in sent.to_pylist():
            (settled if row["settled"] else parts).append(W.unpacked(*(row[x] for x in ("docs", "rows", "counts", "places"))))
            if not row["settled"]:
                keys.append(np.frombuffer(row["keys"], np.uint8).reshape(-1, width))
        if parts:
            docs, rows, places = (np.concatenate(x) for x in zip(*parts))
            settled += repeated(docs, rows, places, *unpacked_keys(np.concatenate(keys)), window)
        return W.for_shards(*(np.concatenate(x) for x in zip(*settled)), shards)

    return compare


def repeated(docs: np.ndarray, rows: np.ndarray, places: np.ndarray, high: np.ndarray, low: np.ndarray, mask: np.ndarray,
             around: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(docs, rows, places) of windows that begin 0, 1, 2 ... words to the left of their suffix."""
    left, right = around[:, :window - 1], around[:, window - 1:]
    order = np.lexsort([*right.T[::-1], low, high])
    docs, rows, places, high, low, mask, left, right = (x[order] for x in (docs, rows, places, high, low, mask, left, right))
    same = (high[1:] == high[:-1]) & (low[1:] == low[:-1])
    # How many words neighbours share beyond their first ones.
    shared = np.cumprod(right[1:] == right[:-1], axis=1, dtype=np.int8).sum(1, dtype=np.int64) if right.shape[1] else np.zeros(len(same), np.int64)
    before = np.zeros(len(docs), np.uint64)
    for back in range(window):
        if back:
            before = mixed(before + left[:, back - 1])
        run = np.r_[0, np.cumsum(~(same & (shared >= right.shape[1] - back)))]
        at = np.flatnonzero(mask >> np.uint32(back) & np.uint32(1))
        if not len(at):
            continue
        at = at[np.lexsort([before[at], run[at]])]
        start, group = W.runs(at, run, before)
        hit = at[docs[at] != np.minimum.reduceat(docs[at], start)[group]]
        yield docs[hit], rows[hit], places[hit] - back


def shared_passages(rows: DataFrame, words: int) -> DataFrame:
    """(doc, row, places): windows of ``words`` words that also start in a smaller document."""
    buckets = 1 + word_total(rows) // W.BUCKET
    alone = rows.join(W.copies(rows), ["doc", "row"], "left_anti")
    suffixes = W.exchanged(alone.mapInArrow(sparse_suffixes(words, buckets), W.SENT_SQL), W.answers(False, True, buckets))
    around = rows.join(suffixes, ["doc", "row"]).mapInArrow(surroundings(words, buckets), W.SENT_SQL)
    return W.exchanged(around, neighbours(words, buckets))


def suffix_dedup(docs: DataFrame, words: int = 50, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, span_starts, span_words, kept) for each row of ``docs``.

    Removed are the words of passages of at least ``words`` words that a document with a smaller id
    has too; passages lie within one text. NULL counts as an empty text; shorter texts lose nothing;
    rows with one id count as one document; rows without an id are left whole and compared with
    nothing. Copies of a whole text are settled by its digest. Repeated rows get a row each, an
    empty table gives none. Other columns are not looked at. ``words`` is 64 at most, as the
    windows that choose a suffix are kept as bits. Texts are read in blocks of some megabytes, a
    longer one as a block by itself.
    """
    if words > 64:
        raise ValueError("passages of more than 64 words have more windows than bits")
    rows = keyed(docs, ident, text)
    return cut_repeats(docs, rows, shared_passages(rows, words), words, ident)
