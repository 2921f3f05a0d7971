"""Tokens, packing, token files, archives, toxicity and the pipeline."""

import hashlib
import math
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import __spark_entry__ as contract
from curbside.llm import token_files as H
from curbside.llm import warc
from curbside.llm.decontamination import SEEDS
from curbside.llm.packing import best_cuts, pack_documents
from curbside.llm.lines import line_dedup
from curbside.llm.near_copies import near_copies
from curbside.llm.rows import BLOCK_BYTES, NO_ID, ranges, reach_workers, table
from curbside.llm.substrings import substring_dedup
from curbside.llm.suffixes import suffix_dedup
from curbside.llm.tokens import Encoder, default_path
from curbside.llm import toxicity as toxicity_module
from curbside.llm.toxicity import fitted, posterior, stems_of, toxicity, train, with_scores
from curbside.llm.words import word_hashes
from curbside.session import ARROW_BYTES

SCHEMA = "doc_id long, text string, doc long, row string, score double"
ODD_TEXTS = ["Straße ΑΣ ΣΑ İstanbul", "don't we'll ''s x's .'s", "<|endoftext|>a b<|startoftext|>  x", "", " \t\n", "à́ ́b ﬁ Ａ",
             "١٢٣ 中文字 😀😀 a😀b", "\x1c\x1d a\x85b", "z" * 9000 + " end. And more! Yes?"]


@pytest.fixture(autouse=True)
def ready(spark):
    reach_workers(spark)


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(default_path())


@pytest.fixture(scope="module")
def codes():
    return Encoder(default_path())


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 7, "r", None) for i, t in rows], SCHEMA).repartition(3)


def test_ids_are_the_tokenizer_s(codes, plain):
    assert codes.by_word
    ids, counts = codes.encode([x.encode() for x in ODD_TEXTS])
    want = [plain.encode(x, add_special_tokens=False).ids for x in ODD_TEXTS]
    assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn", "Co"]), max_size=40))
def test_any_text_is_encoded_alike(codes, plain, text):
    assert codes.encode([text.encode()])[0].tolist() == plain.encode(text, add_special_tokens=False).ids


def some_texts(n=60, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice(["the", "Of", "longer", "wörter", "x1"]) + rng.choice(["", ".", ","]) for _ in range(rng.randrange(1, 900))]
        rows.append((i, " ".join(words)))
    return rows + [(n, None), (n + 1, "")] + [(n + 2 + i, x) for i, x in enumerate(ODD_TEXTS)] + [(3, "again"), (3, "again"), (None, "no id")]


def ids_of(plain, text):
    return np.array(plain.encode(text or "", add_special_tokens=False).ids + [1], np.uint32)


def test_packing(spark, plain):
    rows = some_texts()
    got = pack_documents(docs_of(spark, rows)).toPandas()
    sequences = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    for _, x in sequences:
        assert x.offset.tolist() == [0, *np.cumsum(x.length)[:-1]] and x.length.sum() <= 2048
    sizes = sequences.length.sum()
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes)
    assert padding < 3 * 2048 + 0.02 * sizes.sum()  # each partition may end with a short window
    for i, text in rows:
        if i in (3, None):
            continue
        ids, own = ids_of(plain, text), got[got.doc_id == i].sort_values("start")
        assert own.length.sum() == len(ids) and set(own.doc_tokens) == {len(ids)}
        for r in own.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    assert got[got.doc_id == 3].length.sum() == sum(len(ids_of(plain, t)) for i, t in rows if i == 3)
    assert got.doc_id.isna().sum() == 1
    assert pack_documents(docs_of(spark, rows).limit(0)).count() == 0


def brute_cost(places, fines, size, exact):
    cost = [0.0] + [float("inf")] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            n = places[j] - places[i]
            if n <= size:
                cost[j] = min(cost[j], cost[i] + (0 if n in exact else size - n) + fines[j])
    return cost[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 300), st.sampled_from([0, 4, 16])), min_size=1, max_size=40))
def test_cuts_are_the_best_ones(steps):
    from curbside.llm.packing import EXACT, WINDOW

    places = np.r_[0, np.cumsum([x for x, _ in steps])]
    penalty = np.array([0, *(y for _, y in steps)])
    cuts = [0, *best_cuts(places, penalty, 600)]
    paid = 0
    for a, b in zip(cuts, cuts[1:]):
        n = places[b] - places[a]
        assert n <= 600
        paid += (0 if n in EXACT else 600 - n) + penalty[b] + WINDOW
    assert paid == brute_cost(places.tolist(), (penalty + WINDOW).tolist(), 600, EXACT) and cuts[-1] == len(places) - 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10 ** 9), min_size=1, max_size=300))
def test_code_lengths(counts):
    counts = np.array(counts)
    lengths = H.code_lengths(counts)
    used = lengths[counts > 0].astype(int)
    assert (lengths[counts == 0] == 0).all() and (used <= 16).all()
    if len(used) > 1:
        assert (used >= 1).all() and sum(2.0 ** -used) == 1.0


def test_code_lengths_are_limited_and_optimal():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987, 1597, 2584, 4181, 6765, 10946])
    assert H.code_lengths(counts).max() == 16
    assert H.code_lengths(np.array([5, 1, 1, 2, 0])).tolist() == [1, 3, 3, 2, 0]
    assert H.canonical_codes(np.array([1, 3, 3, 2, 0], np.uint8)).tolist()[:4] == [0, 6, 7, 2]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=700), min_size=1, max_size=6))
def test_blocks_decode(docs):
    ids, counts = np.array([x for d in docs for x in d], np.uint32), np.array([len(d) for d in docs])
    lengths = H.code_lengths(np.bincount(ids, minlength=50))
    raw, first, inner = H.coded(ids, counts, H.canonical_codes(lengths), lengths)
    heads = np.cumsum(counts) - counts
    checks = b"".join(inner[h:h + n:H.CHECKPOINT].astype(np.uint32).tobytes() for h, n in zip(heads, counts))
    content = b"".join([H.HEADER.pack(H.MAGIC, 2, 0, 9, len(docs), len(ids), len(raw)), np.arange(len(docs), dtype=np.int64).tobytes(),
                        counts.astype(np.uint32).tobytes(), np.diff(first).astype(np.uint32).tobytes(), checks, raw, H.SEPARATOR]) * 2
    found = list(H.headers(content))
    assert len(found) == 2
    for head, at in found:
        _, n, got = H.decoded(content, head, at, H.decode_table(lengths))
        assert n.tolist() == counts.tolist() and got.tolist() == ids.tolist()


def test_token_files(spark, plain):
    rows = some_texts()
    got = H.token_round_trip(docs_of(spark, rows)).toPandas().sort_values("start")
    assert len(got) == len(rows) and got.start.tolist() == [0, *np.cumsum(got.n_tokens)[:-1]]
    assert got.doc_id.fillna(-1).is_monotonic_increasing
    want = sorted((-1 if i is None else i, ids_of(plain, t).tolist()) for i, t in rows)
    assert sorted((int(i), np.frombuffer(x, np.uint32).tolist()) for i, x in zip(got.doc_id.fillna(-1), got.ids)) == want
    assert H.token_round_trip(docs_of(spark, rows).limit(0)).count() == 0


def test_ranges_divide_a_crowded_id(spark):
    rows = [(5, i) for i in range(-3000, 3000)] + [(i, i) for i in range(2000)] + [(NO_ID, i) for i in range(1500)]
    frame = spark.createDataFrame([(a, hash((a, b, "x"))) for a, b in rows], "doc long, row long")
    place, n = ranges(frame, 16)
    found = frame.withColumn("range", place).groupBy("range").agg(F.count("*").alias("n"), F.min(F.struct("doc", "row")).alias("lo"),
                                                                 F.max(F.struct("doc", "row")).alias("hi")).orderBy("range").collect()
    assert sum(r.n for r in found) == len(rows) and max(r.n for r in found) < 3 * len(rows) / 16 and found[-1]["range"] < n
    assert all(tuple(a.hi) < tuple(b.lo) for a, b in zip(found, found[1:]))
    for few in ([], [(1, 1)], [(1, 1), (1, 2)]):
        frame = spark.createDataFrame(few, "doc long, row long")
        place, n = ranges(frame, 4)
        assert sorted(r[0] < n for r in frame.select(place).collect()) == [True] * len(few)


def test_token_files_of_one_id(spark, plain):
    rows = [(1, f"text number {i} of one id") for i in range(300)] + [(2, "two"), (None, None), (0, "")]
    got = token_round(spark, rows)
    assert sum(r.n_tokens for r in got) == sum(len(ids_of(plain, t)) for _, t in rows)
    ends = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None, 0] + [1] * 300 + [2]


def token_round(spark, rows):
    return H.token_round_trip(docs_of(spark, rows)).collect()


def test_one_text_beyond_a_block(spark, plain):
    """Every operator on texts takes one that is larger than what a task holds at once."""
    long = " ".join(f"wort{i % 70_000} Word, and" for i in range(600_000))
    assert len(long) > BLOCK_BYTES
    rows = [(1, long), (2, "short text"), (3, long + " end"), (4, None)]
    docs = docs_of(spark, rows).coalesce(1).persist()
    n_words = len(long.split())
    assert {r.doc_id: r.component_id for r in near_copies(docs).collect()} == {1: 1, 2: 2, 3: 1, 4: 4}
    assert {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup(docs).collect()}[3][0] == n_words + 1
    assert {r.doc_id: (r.n_words, r.n_removed) for r in suffix_dedup(docs).collect()}[3] == (n_words + 1, n_words)
    assert {r.rest.doc_id: r.n_dropped for r in line_dedup(docs).collect()} == {1: 0, 2: 0, 3: 0, 4: 0}
    tokens = {i: len(ids_of(plain, t)) for i, t in rows}
    assert {r.doc_id: r.n_tokens for r in H.token_round_trip(docs).collect()} == tokens
    pieces = pack_documents(docs).collect()
    assert {i: sum(r.length for r in pieces if r.doc_id == i) for i in tokens} == tokens
    marks = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
    assert toxicity(docs, marks).count() == 4
    docs.unpersist()


def test_archives(spark, tmp_path):
    big = "<p>" + "é" * 30_000 + "\r\n\r\nWARC/1.1\r\n"
    pages = [(1, "http://a/x y\r\n", big), (2, None, big), (3, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (7, "http://b", big[:-1]),
             (7, "http://b", big[:-1]), (None, "n", big), (8, "q", "0" * 1000), (9, "q", "0" * 1000), (10, "q", "0" * 999), (11, "q", "0" * 999)]
    frame = spark.createDataFrame([(*x, b"extra") for x in pages], "page_id long, url string, html string, digest binary")
    warc.write_archives(frame, str(tmp_path / "w"))
    got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert len(got) == len(pages) - 1  # a repeated row is one record
    by = {r.page_id: r for r in got}
    for page, _, html in pages:
        raw = (html or "").encode()
        assert (by[page].payload_bytes, by[page].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert by[page].record_type == "revisit" or bytes(by[page].payload) == raw
    assert {r.page_id: r.refers_to for r in got if r.record_type == "revisit"} == {1: 2, 8: 9}
    warc.write_archives(frame.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0


def test_broken_archives():
    parts = warc.segments([("WARC-Type", "response"), ("WARC-Record-ID", warc.name(1, 2))], warc.name(1, 2), warc.HTTP + warc.chunked(b"x" * 9000), 2000)
    content = b"".join(x + warc.END for x in parts)
    found = [(f.get("warc-segment-number"), b) for f, b in warc.records(content)]
    assert [n for n, _ in found] == ["1", "2", "3", "4", "5"]
    whole = b"".join(b for _, b in found)
    assert warc.decoded(whole, hashlib.sha1(b"x" * 9000).hexdigest()) == b"x" * 9000
    with pytest.raises(ValueError):
        warc.decoded(whole, "00")
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc")
    assert warc.unchunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"


def toxic_rows(n=400):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(n):
        words = [f"plain{rng.randrange(300)}" for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(["Idiot,", "grumpf" + rng.choice("abc"), "scum."])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_rows()
    rows += [(1000, None), (1001, ""), (None, "you idiot")]
    marks = spark.createDataFrame([(i, t, "x") for i, t in labels] + [(None, 1, "x"), (5, None, "x")], "doc_id long, toxic int, text string")
    got = {r.doc_id: r for r in toxicity(docs_of(spark, rows), marks).collect()}
    held = [r for r in got.values() if r.doc_id is not None and r.held_out and r.doc_id < 400]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items() if i is not None)
    assert np.mean([r.predicted == (r.doc_id % 5 == 0) for r in held]) > 0.97
    assert got[1000].score == got[1001].score < 0.3 and 0 <= min(r.score for r in got.values()) and got[None].predicted == 1
    again = {r.doc_id: r.score for r in toxicity(docs_of(spark, rows), marks).collect()}
    assert all(abs(again[i] - r.score) < 1e-9 for i, r in got.items())
    none = toxicity(docs_of(spark, rows), marks.limit(0)).collect()
    assert {r.predicted for r in none if r.doc_id is None} == {1} and len(none) == len(rows)
    assert toxicity(docs_of(spark, rows).limit(0), marks).count() == 0
    assert with_scores(docs_of(spark, rows), marks).select("rest.score").distinct().collect() == [(None,)]


def test_the_sample_bounds_rows(spark):
    rows = [(i, f"plain text {i} {n}" + (" idiot" if i == 1 else "")) for i in (1, 4) for n in range(200)] * 2
    assert all(zlib.crc32(str(i).encode()) % 4 != 2 for i, _ in rows)
    marks = spark.createDataFrame([(1, 1), (4, 0)], "doc_id long, toxic int")
    seen = []
    keep = toxicity_module.stored
    toxicity_module.stored = lambda frame, purpose: seen.append(keep(frame, purpose)) or seen[-1]
    try:
        train(docs_of(spark, rows), marks, sample=30)
        train(docs_of(spark, rows), marks)
    finally:
        toxicity_module.stored = keep
    assert [x.count() for x in seen] == [30, 400]


def test_python_gets_rows_by_the_megabyte(spark, data):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    def found():
        table(spark, data, "documents")
        rows = spark.range(400, numPartitions=1).select(F.repeat(F.lit("text "), 10_000).alias("text"))
        return rows.mapInArrow(sizes, "rows long, bytes long").collect()

    mine = spark.conf.get(ARROW_BYTES, None)
    try:
        spark.conf.unset(ARROW_BYTES)
        assert sum(r["rows"] for r in found()) == 400 and max(r["bytes"] for r in found()) < 5 << 20
        spark.conf.set(ARROW_BYTES, "1m")  # its owner's number stays
        assert max(r["bytes"] for r in found()) < 2 << 20
    finally:
        spark.conf.unset(ARROW_BYTES)
        if mine is not None:
            spark.conf.set(ARROW_BYTES, mine)


def test_scores_and_ids_take_little_memory(codes, monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(20_000)]
    texts = [" ".join(rng.choices(words, k=500)) for _ in range(1600)]
    score = toxicity_module.scorer({x[:4]: 0.01 * i for i, x in enumerate(dict.fromkeys(words[:300]))}, -1.0)
    batch = pa.RecordBatch.from_pydict({"text": texts})
    size = sum(map(len, texts))
    want = [codes.encode([x.encode()])[0].tolist() for x in texts[:50]]  # words are known from here on
    codes.encode([x.encode() for x in texts])
    tracemalloc.start()
    try:
        word_hashes([x.encode() for x in texts])
        hashed = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        ids, counts = codes.encode([x.encode() for x in texts])
        encoded = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert hashed < 10 * size and encoded < 11 * size
    assert ids[:counts[:50].sum()].tolist() == [i for x in want for i in x]
    # Words that are forgotten and looked up again count as before.
    scores = [x for out in score([batch]) for x in out.column("score").to_pylist()]
    monkeypatch.setattr(toxicity_module, "WORDS", 1)
    monkeypatch.setattr(toxicity_module, "SCORED_BLOCK", 1 << 14)
    assert scores == [x for out in score([batch]) for x in out.column("score").to_pylist()] and len(set(scores)) > 1


def plain_posterior(votes, q, rounds=12):
    """The same model, one text and voter after the other."""
    n, m = len(votes), len(votes[0])
    weight = [1.0] * m
    for step in range(rounds):
        total = sum(q)
        hit = [min(max((sum(q[i] * votes[i][j] for i in range(n)) + 0.1) / (total + 1), 1e-4), 0.999) for j in range(m)]
        miss = [min(max((sum((1 - q[i]) * votes[i][j] for i in range(n)) + 0.01) / (n - total + 1), 1e-5), 0.999) for j in range(m)]
        prior = min(max(total / n, 1e-3), 0.999)
        q = []
        for row in votes:
            odds = math.log(prior / (1 - prior))
            for j, v in enumerate(row):
                odds += weight[j] * (math.log(hit[j] / miss[j]) if v else math.log((1 - hit[j]) / (1 - miss[j])))
            q.append(1 / (1 + math.exp(-min(max(odds, -30), 30))))
        if step % 5 == 1:
            rest = [[votes[i][j] - q[i] * hit[j] - (1 - q[i]) * miss[j] for i in range(n)] for j in range(m)]
            spread = [math.sqrt(sum(x * x for x in r) / n) + 1e-9 for r in rest]
            for j in range(m):
                each = [sum(a * b for a, b in zip(rest[j], rest[k])) / n / spread[j] / spread[k] for k in range(m)]
                weight[j] = 1 / max(sum(x for x in each if x > 0.15), 1)
            weight[-1] = 1.0
    return q


def test_posterior_and_fit_by_plain_versions():
    rng = np.random.default_rng(2)
    truth = rng.random(60) < 0.3
    votes = np.column_stack([np.where(truth, rng.random(60) < 0.8, rng.random(60) < 0.1) for _ in range(4)] + [truth]).astype(float)
    votes = np.column_stack([votes[:, [0]], votes])
    start = 0.1 + 0.8 * votes[:, -1]
    assert np.allclose(posterior(votes, start)[0], plain_posterior(votes.tolist(), start.tolist()))
    rows = [([j for j in range(5) if row[j]], float(y)) for row, y in zip(votes, start)]
    weights, bias = fitted(rows, 5)

    def loss(w, b):
        z = [b + sum(w[j] for j in found) for found, _ in rows]
        return sum(math.log1p(math.exp(x)) - y * x for x, (_, y) in zip(z, rows)) / len(rows) + 1.5e-6 * sum(x * x for x in w)

    least = loss(weights, bias)
    assert (weights >= 0).all()
    for j in range(5):  # no small step makes it better
        for step in (-0.05, 0.05):
            moved = weights.copy()
            moved[j] = max(0, moved[j] + step)
            assert loss(moved, bias) > least - 1e-6
    assert min(loss(weights, bias - 0.05), loss(weights, bias + 0.05)) > least - 1e-6


def test_label_model():
    rng = np.random.default_rng(0)
    truth = rng.random(3000) < 0.2
    votes = np.column_stack([*(np.where(truth, rng.random(3000) < 0.7, rng.random(3000) < 0.02) for _ in range(4)), truth ^ (rng.random(3000) < 0.05)])
    copied = np.column_stack([votes[:, [0]], votes[:, [0]], votes]).astype(float)
    q, hit, miss = posterior(copied, 0.1 + 0.8 * copied[:, -1])
    assert ((q > 0.5) == truth).mean() > 0.98 and abs(hit[3] - 0.7) < 0.05 and miss[3] < 0.04
    assert list(stems_of("Ab,cdef")) == ["ab ", "cdef ", "cde", "cdef"]


def test_pipeline(spark, data):
    docs = table(spark, data, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, data).cache()
        kept[name] = docs
        if name != "packing":
            assert docs.schema.names == before.schema.names and [f.dataType for f in docs.schema] == [f.dataType for f in before.schema]
            assert set(r.doc_id for r in docs.select("doc_id").collect()) <= set(r.doc_id for r in before.select("doc_id").collect())
    lines = {r.doc_id: r for r in kept["line dedup"].collect()}
    assert all(r.n_chars == len(r.text) for r in lines.values())
    from test_texts import plain_components, plain_lines

    first = [(r.doc_id, r.text) for r in kept["toxicity"].collect()]
    assert {i: r.text for i, r in lines.items()} == {i: x[2] for i, x in plain_lines(first).items()}
    groups = plain_components([(i, r.text) for i, r in lines.items()], 5)
    one = {r.doc_id for r in kept["near copies"].select("doc_id").collect()}
    assert one == {i for i, (_, root) in groups.items() if i == root}
    items = [r.text.lower() for r in table(spark, data, "benchmark").collect()]
    clean = {r.doc_id for r in kept["decontamination"].collect()}
    leaks = {r.doc_id for r in kept["near copies"].collect() if any(x in r.text.lower() for x in items)}
    assert one - clean >= leaks and len(one - clean) <= len(leaks) + 2
    assert {r.doc_id for r in docs.collect()} == clean
    key = lambda df: sorted(tuple(r)[:5] for r in df.select("doc_id", "start", "doc_tokens", "length", "ids_crc32").groupBy("doc_id").sum("length").collect())
    assert key(corpus_pipeline.run(spark, data)) == key(docs)


def test_stages_on_odd_rows(spark, data):
    """Stages keep the columns, whatever their names, and take NULLs, repeated rows and empty tables."""
    schema = "doc_id long, text string, doc long, row string, n int, component string, item_id string"
    passage = " ".join(f"passage{i} is here" for i in range(30))
    rows = [(1, passage), (2, passage + " and more"), (2, passage + " and more"), (None, passage), (None, None), (3, ""), (4, None),
            (5, table(spark, data, "benchmark").where("length(text) > 80").first().text), (5, "a second text")]
    docs = spark.createDataFrame([(i, t, i, "r", 1, "c", "x") for i, t in rows], schema)
    for stage in (corpus_pipeline.one_of_near_copies, corpus_pipeline.not_in_benchmark):
        assert stage(spark, docs.limit(0), data).collect() == []
        assert stage(spark, docs, data).schema == docs.schema
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.one_of_near_copies(spark, docs, data).collect()), key=repr)
    assert kept == sorted({x for x in rows if x[0] != 2}, key=repr)
    clean = [(r.doc_id, r.text) for r in corpus_pipeline.not_in_benchmark(spark, docs, data).collect()]
    assert sorted(clean, key=repr) == sorted((x for x in rows if x != rows[7]), key=repr)


def test_pipeline_drops_texts_whose_item_has_only_common_seeds(spark, tmp_path):
    """Each seed of an item occurs in nine items with smaller ids, none of which overlaps enough with the text."""
    words, items = [f"w{i}" for i in range(10)], []
    for offsets in SEEDS:
        for place in range(3):
            at = {place + x for x in offsets}
            items += [(len(items) + n, " ".join(w if i in at else f"d{len(items)}x{n}x{i}" for i, w in enumerate(words))) for n in range(9)]
    spark.createDataFrame([*items, (1000, " ".join(words))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, "some text " + " ".join(words) + " and more"), (2, "a text of its own")], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.not_in_benchmark(spark, docs, str(tmp_path)).collect()] == [2]


def test_registered():
    names = contract.queries()
    assert {n for n in names if n.startswith("op")} == {
        "op1_substring_dedup", "op2_toxicity", "op3_suffix_dedup", "op4_near_copies", "op5_packing", "op6_token_files",
        "op7_decontamination", "op8_fingerprints", "op9_line_dedup", "op10_warc", "op11_resampling", "op12_byte_pairs",
        "op13_filter_audit"} and "pipeline" in names


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op3_suffix_dedup", "op4_near_copies", "op9_line_dedup", "op10_warc",
                                  "op13_filter_audit"])
def test_equal_to_sql(name, spark, data):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    cursor = con.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    want = sorted(cursor.fetchall(), key=repr)
    assert sorted(map(tuple, contract.queries()[name](spark, data).select(*columns).collect()), key=repr) == want
