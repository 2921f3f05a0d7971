"""Hashes of words and of word windows for whole blocks of texts, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

#: Longer words are hashed by xxhash; shorter ones by tables of random numbers.
LONGEST = 4096
#: Bytes that are hashed at once; a byte takes 40 meanwhile.
PIECE = 1 << 19
_random = np.random.default_rng(20240917)
VALUE = _random.integers(0, 1 << 64, 256, np.uint64)
PLACE = _random.integers(0, 1 << 64, LONGEST, np.uint64) | np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LANES = tuple(_random.integers(0, 1 << 64, (2, 3), np.uint64) | np.uint64(1))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts as one buffer, where its words start and end, and each text's first word.

    A word is a run of bytes other than ASCII white space.
    """
    whole = b" ".join([b"", *texts, b""])
    space = SPACE[np.frombuffer(whole, np.uint8)]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edge[0::2], edge[1::2]
    at = np.cumsum([1, *(len(x) + 1 for x in texts)])
    return whole, starts, ends, np.searchsorted(starts, at)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for every word; text i has the words bounds[i] to bounds[i + 1]."""
    whole, starts, ends, bounds = word_spans(texts)
    return span_hashes(whole, starts, ends), bounds


def span_hashes(whole: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes of the words of a buffer."""
    if len(starts) and (ends - starts).max() > LONGEST:
        words = whole.split()
        hashes = word_hashes([b" ".join(x[:LONGEST] for x in words)])[0]
        for i in np.flatnonzero(ends - starts > LONGEST):
            hashes[i] = xxhash.xxh3_64_intdigest(words[i])
        return hashes
    return hashed_spans(np.frombuffer(whole, np.uint8), starts, ends)


def hashed_spans(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each of the spans, which are ascending, apart and at most LONGEST long."""
    hashes = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + PIECE)))
        begin, stop = starts[first], ends[last - 1]
        lengths = ends[first:last] - starts[first:last]
        inside = np.zeros(stop - begin + 1, np.int8)
        inside[starts[first:last] - begin] = 1
        inside[ends[first:last] - begin] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
        heads = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        place = np.arange(heads[-1] + lengths[-1]) - np.repeat(heads, lengths)
        terms = VALUE[buffer[begin:stop][inside]] * PLACE[place]
        hashes[first:last] = mixed(np.add.reduceat(terms, heads) + lengths.astype(np.uint64))
        first = last
    return hashes


def longer(hashes: np.ndarray, have: int, want: int, lane: int = 0) -> np.ndarray:
    """Hashes of windows of ``want`` words from those of ``have``, which two of them cover."""
    a, b, c = LANES[lane]
    n = max(0, len(hashes) - (want - have))
    return mixed(hashes[:n] * a + mixed(hashes[len(hashes) - n:] * b + c))


def levels(words: int, base: int = 1) -> list[int]:
    """``words`` and its halves, rounded up, down to ``base``; ascending."""
    found = [words]
    while found[0] > base and (found[0] + 1) // 2 >= base and found[0] > 1:
        found.insert(0, (found[0] + 1) // 2)
    return found


def window_hashes(hashes: np.ndarray, words: int, lane: int = 0) -> np.ndarray:
    """The hash of the window of ``words`` words at each place of a row of words."""
    steps = levels(words)
    out = mixed(hashes * LANES[lane][0] + LANES[lane][2])
    for have, want in zip(steps, steps[1:]):
        out = longer(out, have, want, lane)
    return out


def inner_starts(bounds: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Places at which a window lies within one text, and the number of that text."""
    room = np.maximum(np.diff(bounds) - words + 1, 0)
    text = np.repeat(np.arange(len(room)), room)
    heads = np.cumsum(room) - room
    return np.arange(room.sum()) - np.repeat(heads, room) + bounds[:-1][text], text
