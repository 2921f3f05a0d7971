"""Token ids of whole blocks of texts by a tokenizer file of the tokenizers library."""

from __future__ import annotations

import json
import os
import unicodedata
from functools import lru_cache
from itertools import pairwise

import numpy as np
import regex
from tokenizers import Tokenizer, pre_tokenizers

from curbside.llm.words import span_hashes, word_spans

#: Words, by hash, and pieces of words whose ids a worker remembers; it starts anew when they are more.
WORDS, PIECES = 1_500_000, 200_000
#: Bytes of text to encode at once: the larger, the fewer words are new.
ENCODED_BYTES = 8 << 20
#: Bytes of these whose words are looked up at once: arrays of words take some ten times as much.
AT_ONCE = 2 << 20

# The set-up under which texts may be encoded word by word.
WORD_NORMALIZER = ["NFC", ("Replace", r"\s+", " "), "Lowercase"]
WORD_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"


def default_path() -> str:
    """The tokenizer file of the registered queries; other files are given by path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encodes_by_word(config: dict) -> bool:
    """Whether no token spans white space and the rules are the ones that Encoder knows."""
    steps = (config["normalizer"] or {}).get("normalizers", [])
    found = [("Replace", x["pattern"].get("Regex"), x["content"]) if x["type"] == "Replace" else x["type"]
             for x in steps]
    split, *rest = (config["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    return (found == WORD_NORMALIZER and split.get("pattern") == {"Regex": WORD_PIECES}
            and (split["behavior"], split["invert"]) == ("Removed", True)
            and [(x["type"], x["add_prefix_space"], x["use_regex"]) for x in rest] == [("ByteLevel", False, False)]
            and config["model"].get("end_of_word_suffix") == WORD_END
            and all(not (x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"])
                    and not regex.search(r"\s", x["content"]) for x in config["added_tokens"]))


class Encoder:
    """Encodes texts as ``Tokenizer.encode(text, add_special_tokens=False)`` does.

    Where tokens never span white space, each distinct word of a block is encoded once.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.size = self.whole.get_vocab_size()
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self.by_word = encodes_by_word(config)
        if not self.by_word:
            return
        self.special = [x["content"].encode() for x in config["added_tokens"]]
        self.split = regex.compile(WORD_PIECES.replace(r"\s", r"\p{White_Space}") + "| ")
        self.pieces = Tokenizer.from_file(path)
        self.pieces.normalizer = None
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.pieces.encode_special_tokens = True
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for token, i in self.whole.get_vocab().items() if token.endswith(WORD_END)]] = True
        self.known: dict[str, bytes] = {" ": b""}
        self.forget()

    def forget(self) -> None:
        """No word is known: hashes in order, where a word's ids begin, how many there are, all ids."""
        self.hashes, self.ids = np.empty(0, np.uint64), np.empty(0, np.uint32)
        self.offsets, self.counts = np.empty(0, np.int32), np.empty(0, np.int32)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        if not self.by_word:
            found = [np.array(x.ids, np.uint32) for x in self.whole.encode_batch_fast(
                [x.decode("utf-8", "replace") for x in texts], add_special_tokens=False)]
            return np.concatenate([np.empty(0, np.uint32), *found]), np.array([len(x) for x in found], np.int64)
        sizes = np.cumsum([len(x) for x in texts])
        cuts = [0, *(np.flatnonzero(np.diff(sizes // AT_ONCE)) + 1).tolist(), len(texts)]
        ids, counts = zip(*(self.looked_up(texts[a:b]) for a, b in pairwise(cuts)))
        return np.concatenate(ids), np.concatenate(counts)

    def looked_up(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of some texts by their words."""
        whole, starts, ends, bounds = word_spans(texts)
        hashes, first, of = np.unique(span_hashes(whole, starts, ends), return_index=True, return_inverse=True)
        place = self.places(hashes, whole, starts[first], ends[first])
        offset, each = self.offsets[place][of], self.counts[place][of]
        stops = np.cumsum(each, dtype=np.int64)
        at = np.repeat((offset - (stops - each)).astype(np.int32), each)
        at += np.arange(len(at), dtype=np.int32)
        return self.ids[at], np.diff(np.r_[0, stops][bounds])

    def places(self, hashes: np.ndarray, whole: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where the distinct words of a block stand among the known ones, to which new ones are added."""
        if len(self.hashes) > WORDS:
            self.forget()
        place = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        if len(self.hashes):
            new = self.hashes[np.minimum(place, len(self.hashes) - 1)] != hashes
        if new.any():
            ids, counts = self.words([whole[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            merged = np.concatenate([self.hashes, hashes[new]])
            order = np.argsort(merged, kind="stable")
            self.hashes = merged[order]
            self.offsets = np.concatenate([self.offsets, (len(self.ids) + np.cumsum(counts) - counts).astype(np.int32)])[order]
            self.counts = np.concatenate([self.counts, counts.astype(np.int32)])[order]
            self.ids = np.concatenate([self.ids, ids])
            place = np.searchsorted(self.hashes, hashes)
        return place

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, and how many each has."""
        odd = {i: self.whole.encode(x.decode("utf-8", "replace"), add_special_tokens=False).ids
               for i, x in enumerate(words) if b"<|" in x and any(y in x for y in self.special)}
        text = b" ".join(b"." if i in odd else x for i, x in enumerate(words)).decode("utf-8", "replace")
        # A capital sigma becomes the same letter at a word's end as elsewhere.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        pieces = self.split.findall(text + " ")
        if len(self.known) > PIECES:
            self.known = {" ": b""}
        new = list(set(pieces).difference(self.known))
        for at in range(0, len(new), 1000):
            some = new[at:at + 1000]
            ids = np.array(self.pieces.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(stops) != len(some):
                raise ValueError("the tokenizer's words do not end in tokens of their own")
            raw = ids.tobytes()
            self.known.update(zip(some, (raw[a:b] for a, b in zip([0, *stops], stops))))
        parts = [self.known[x] for x in pieces]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        ends = np.cumsum(lengths)[lengths == 0]
        ids = np.frombuffer(b"".join(parts), np.uint32)
        counts = np.diff(ends, prepend=0)
        if odd:
            rows = np.split(ids, ends[:-1])
            for i, own in odd.items():
                rows[i], counts[i] = np.array(own, np.uint32), len(own)
            ids = np.concatenate(rows)
        return ids, counts


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker and file."""
    return Encoder(path)


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each text, and the numbers of ids with it."""
    return np.insert(ids, np.cumsum(counts), np.uint32(end)), counts + 1
