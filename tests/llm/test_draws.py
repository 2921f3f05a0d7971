"""Resampling, byte-pair ids and the filter audit against plain versions of themselves."""

import hashlib
import math
import re
import zlib
from base64 import b64decode
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from curbside.llm import byte_pairs, queries, resampling
from curbside.llm.byte_pairs import Vocabulary, byte_pair_round_trip, decoded, default_path, default_pattern, encoded, merger, splitter
from curbside.llm.filter_audit import filter_audit
from curbside.llm.resampling import resampled, text_runs
from curbside.llm.rows import reach_workers

CLASHING = "doc long, row long, words int, n int, block string, ids string, part int, failed int, weight int, rank int"
TEXTS = ["One word and another one.", None, "", " \n\t ", "ÄÖÜ äöü ẞ straße 12\x0034", "tie tie tie " * 12, "tie tie tie " * 12, "Größe, 東京 12 mal 😀‍!",
         "a-b_c d" * 30, "<|endoftext|> is text", "it's we'll THEY'VE\x1c\x85  end  \n\n ", "x" * 3000, "y " * 400, "#" * 40 + " & CAPITALS ARE HERE"]


@pytest.fixture(autouse=True)
def ready(spark):
    reach_workers(spark)


def docs_of(spark, rows, partitions=3):
    """(doc_id, text, lang) with columns that the operators use themselves."""
    names = [x.split()[0] for x in CLASHING.split(", ")]
    return spark.createDataFrame([(*r, *[None] * len(names)) for r in rows], f"doc_id long, text string, lang string, {CLASHING}").repartition(partitions)


def some_rows():
    rows = [(i, x, ("en", "de", None, "")[i % 4]) for i, x in enumerate(TEXTS * 3)]
    return rows + [(None, "No id here, but words " * 9, "en"), (None, None, None), rows[5], rows[5], (5, "Another text under the same id " * 5, "en"), (40, "z" * 60, "de")]


# -- resampling ------------------------------------------------------------------------------


def plain_features(text, longest):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain_draw(rows, target, longest=1, buckets=10_000, least=20, percent=10, seed=2024):
    bucket = lambda x: zlib.crc32(x.encode()) % buckets
    s = Counter(bucket(x) for _, t, _ in rows for x in plain_features(t, longest)[1])
    t = Counter(bucket(x) for text in target for x in plain_features(text, longest)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for i, text, _ in rows:
        words, found = plain_features(text, longest)
        weight = sum(gain[bucket(x)] for x in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        score = None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, i is not None and len(words) >= least])
    drawn = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0]))
    ranks = {id(x): r + 1 for r, x in enumerate(drawn[:percent * len(drawn) // 100])}
    return [(*x[:4], ranks.get(id(x))) for x in out]


@pytest.mark.parametrize("options", [{}, {"longest": 3, "buckets": 97, "least_words": 2, "percent": 60}, {"least_words": 0, "percent": 100, "seed": 7}])
def test_resampling(spark, options):
    rows = some_rows()
    target = ["One word, straße and more words", None, "", "tie y"]
    bench = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    got = [tuple(r) for r in resampled(docs_of(spark, rows), bench, **options).collect()]
    plain = {"least" if k == "least_words" else k: v for k, v in options.items()}
    # Repeated rows and rows with one id may change places where their scores are equal.
    assert sorted(got, key=repr) == sorted(plain_draw(rows, target, **plain), key=repr)


def test_resampling_of_empty_tables(spark):
    none = docs_of(spark, [])
    assert resampled(none, none).collect() == []
    rows = docs_of(spark, some_rows())
    assert {r.weight for r in resampled(rows, none).collect() if r.n_features} != {0}
    assert resampled(none, rows).collect() == []


def test_most_rows_under_one_id(spark):
    rows = [(1, "the same words again and again " * 5, "en")] * 60 + [(i, "other words " * 20, "en") for i in range(2, 30)]
    got = resampled(docs_of(spark, rows), docs_of(spark, rows[:1]), percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 45))


def test_runs_across_pieces(monkeypatch):
    text = ("Wort, word 12 é" * 40).encode()
    whole = sorted(x for _, sums in text_runs(text, 3) for x in sums)
    monkeypatch.setattr(resampling, "PIECE", 16)
    parts = list(text_runs(text, 3))
    assert len(parts) > 5 and sorted(x for _, sums in parts for x in sums) == whole
    assert whole == sorted(zlib.crc32(x.encode()) for x in plain_features(text.decode(), 3)[1])


# -- byte pairs ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    with open(default_path(), "rb") as file:
        ranks = {b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=default_pattern(), mergeable_ranks=ranks, special_tokens={})


def plain_ids(text):
    return [i for x in splitter(default_pattern()).findall(text) for i in merger(default_path()).encode_ordinary(x)]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet=" \t\n\x0b\x1c\x85 　'stvrelmdabAÄ1٣½#.", max_size=60)))
def test_any_text_has_the_library_s_ids(library, text):
    assert plain_ids(text) == library.encode_ordinary(text)


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet=" \n\x1c\x85 'stvrelABé1#.", max_size=60)))
def test_chunks_are_cut_like_whole_texts(text):
    known = Vocabulary(default_pattern())
    for _ in range(2):  # the second time from memory
        numbers = known.numbers(text)
        words = list(known.number)
        assert [words[i] for i in numbers] == splitter(default_pattern()).findall(text)


def test_long_words_have_the_library_s_ids(library):
    for text in ("ab" * 3000, "a" * 20_000, " " * 5000 + "x", "=" * 4000, "é" * 3000, "hello" * 2000):
        assert plain_ids(text) == library.encode_ordinary(text)


def wanted(library, rows):
    out = []
    for i, text, _ in rows:
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        out.append((i, ids.tobytes(), (text or "").encode()))
    return sorted(out, key=repr)


def test_byte_pairs(spark, library):
    rows = some_rows()
    got = [(r.doc_id, bytes(r.ids), bytes(r.text)) for r in byte_pair_round_trip(docs_of(spark, rows, 7)).collect()]
    assert sorted(got, key=repr) == wanted(library, rows)


def test_blocks_of_few_texts(spark, library):
    rows = some_rows()
    one = byte_pair_round_trip(docs_of(spark, rows), block=64).collect()
    two = decoded(encoded(docs_of(spark, rows), default_path(), default_pattern(), block=64), default_path()).collect()
    for got in (one, two):
        assert sorted(((r.doc_id, bytes(r.ids), bytes(r.text)) for r in got), key=repr) == wanted(library, rows)


def test_a_text_beyond_a_block(spark, library):
    rows = [(1, "Ein langer Text 12 of many words, " * 500_000, "de"), (2, "short", "en")]
    assert len(rows[0][1]) > byte_pairs.BLOCK
    got = [(r.doc_id, bytes(r.ids), bytes(r.text)) for r in byte_pair_round_trip(docs_of(spark, rows, 1)).collect()]
    assert sorted(got, key=repr) == wanted(library, rows)


def test_byte_pairs_of_nothing(spark):
    assert byte_pair_round_trip(docs_of(spark, [])).collect() == []
    only = byte_pair_round_trip(docs_of(spark, [(1, None, None), (1, "", None)])).collect()
    assert [(r.doc_id, bytes(r.ids), bytes(r.text)) for r in only] == [(1, b"", b"")] * 2


def test_unknown_ids_are_an_error(spark):
    rows = spark.createDataFrame([(1, [1, 2]), (2, [60_000])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="not in the table"):
        decoded(rows, default_path()).collect()


# -- filter audit ----------------------------------------------------------------------------


def plain_audit(rows, labels):
    marks = {}
    for i, quality, toxic in labels:
        if i is not None:
            good, bad = marks.get(i, (0, 0))
            marks[i] = max(good, int(quality == 1)), max(bad, int(toxic == 1))
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    docs = []
    for i, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {x for x, bad in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            re.search("[#$%&*|]", t), i is not None and i > first[t])) if bad}
        docs.append((lang or "", fails, *marks.get(i, (0, 0))))
    out = []
    for part in {x[0] for x in docs}:
        own = [x for x in docs if x[0] == part]
        table, removed_by = [], Counter()
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                gone = [x for x in own if f in x[1] and not x[1] & before]
                kept = sum(not x[1] & (before | {f}) for x in own)
                redundant = sum(f in x[1] and bool(x[1] & before) for x in own)
                removed_by[f] += len(gone)
                table.append([part, "".join(order), k + 1, kept, len(gone), redundant, sum(x[1] == {f} for x in own),
                              sum(x[2] for x in gone), sum(x[3] for x in gone)])
        out += [(*x, removed_by[x[1][x[2] - 1]]) for x in table]
    return sorted(out)


def test_filter_audit(spark):
    rows = some_rows() + [(100 + i, " ".join(f"w{x}" for x in range(100 + i)), "en") for i in range(5)] * 2
    labels = [(0, 1, 0), (0, 0, 1), (3, 1, 1), (100, 1, None), (17, None, 1), (None, 1, 1), (101, 1, 0)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = sorted(tuple(r) for r in filter_audit(docs_of(spark, rows), marks).collect())
    assert got == plain_audit(rows, labels)


def test_filter_audit_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(docs_of(spark, []), none).collect() == []
    got = sorted(tuple(r) for r in filter_audit(docs_of(spark, some_rows()), none).collect())
    assert got == plain_audit(some_rows(), [])


def test_one_text_in_most_rows(spark):
    rows = [(i, "one text " * 120, "en") for i in range(300)] + [(None, "one text " * 120, "de")] * 20
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sorted(tuple(r) for r in filter_audit(docs_of(spark, rows), none).collect()) == plain_audit(rows, [])


# -- the registered queries on whole tables ---------------------------------------------------


def test_registered_draw(spark, data):
    docs, bench = (spark.read.parquet(f"{data}/{x}.parquet") for x in ("documents", "benchmark"))
    rows = [(r.doc_id, r.text, None) for r in docs.collect()]
    got = [tuple(r) for r in queries.op11_resampling(spark, data).select("doc_id", "n_features", "weight", "score", "rank").collect()]
    assert sorted(got, key=repr) == sorted(plain_draw(rows, [r.text for r in bench.collect()]), key=repr)


def test_registered_ids(spark, data, library):
    want = {}
    for r in spark.read.parquet(f"{data}/documents.parquet").collect():
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4")
        want[r.doc_id] = len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()
    assert {r.doc_id: tuple(r)[1:] for r in queries.op12_byte_pairs(spark, data).collect()} == want
