"""Operators on texts against plain versions of themselves, with NULLs, empty and repeated rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import regex

from curbside.llm.fingerprints import BINS, edited_fingerprints
from curbside.llm.graph import components
from curbside.llm.lines import kept_text, keep_bitmaps, line_dedup
from curbside.llm.near_copies import CROWDED, DEPTH, TREES, near_copies, region_links, shingle_sets, signature
from curbside.llm.rows import reach_workers
from curbside.llm.substrings import substring_dedup
from curbside.llm.suffixes import suffix_dedup
from curbside.llm.toxicity import train
from curbside.llm.words import LONGEST, levels, window_hashes, word_hashes
from curbside.llm.decontamination import SEEDS, benchmark_overlaps, decontaminate

SCHEMA = "doc_id long, text string, doc long, row string, score double"


@pytest.fixture(autouse=True)
def ready(spark):
    reach_workers(spark)


def docs_of(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 7, "r", None) for i, t in rows], SCHEMA).repartition(3)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def corpus(seed=1, n=60, vocabulary=400, length=160):
    """Random texts, some of which share passages, lines or everything."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", ",", "é"])
    passage = [word() for _ in range(70)]
    texts = []
    for i in range(n):
        body = [word() for _ in range(rng.randrange(1, length))]
        if i % 4 == 0:
            at = rng.randrange(len(body))
            body[at:at] = passage[rng.randrange(0, 15):]
        text = "".join(x + rng.choice([" ", " ", "\n", "\t "]) for x in body)
        texts.append(text)
    for i in range(0, n, 7):
        edited = texts[i].split(" ")
        edited[len(edited) // 2:len(edited) // 2 + 1] = ["changed"]
        texts.append(" ".join(edited))
    texts += [texts[3], texts[4], texts[4], None, "", " \n ", "one", "x " * 5000, "y" * 9000]
    return list(enumerate(texts))


ODD = [(None, "a text without an id"), (None, None), (5, "w1 w2 w3 w4 w5")]


def plain_repeats(rows, size=50):
    first = {}
    windows = {}
    for i, t in rows:
        w = words_of(t)
        for p in range(len(w) - size + 1):
            key = tuple(w[p:p + size])
            windows.setdefault(i, []).append((p, key))
            first[key] = min(i, first.get(key, i))
    out = {}
    for i, t in rows:
        w = words_of(t)
        gone = set()
        for p, key in windows.get(i, ()):
            if first[key] < i:
                gone.update(range(p, p + size))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("dedup", [substring_dedup, suffix_dedup])
def test_repeated_passages(spark, dedup):
    rows = corpus()
    want = plain_repeats(rows)
    got = dedup(docs_of(spark, rows)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == want and len(got) == len(rows)
    assert sum(x[1] for x in want.values()) > 500
    for r in got:
        assert sum(r.span_words) == r.n_removed and len(r.span_starts) == len(r.span_words)


@pytest.mark.parametrize("dedup", [substring_dedup, suffix_dedup])
def test_repeated_passages_of_odd_rows(spark, dedup):
    long = " ".join(f"t{i}" for i in range(60))
    rows = [(None, long), (1, long), (1, long), (2, long), (None, None), (3, None)]
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in dedup(docs_of(spark, rows)).collect()), key=repr)
    assert got == sorted([(None, 60, 0), (1, 60, 0), (1, 60, 0), (2, 60, 60), (None, 0, 0), (3, 0, 0)], key=repr)
    assert dedup(docs_of(spark, rows).where("doc_id > 99")).count() == 0
    with_short = dedup(docs_of(spark, [(1, "a b c d"), (2, "x a b c y")]), words=3).collect()
    assert {r.doc_id: r.kept for r in with_short} == {1: "a b c d", 2: "x y"}


def plain_lines(rows):
    key = lambda line: line.strip(" \t\n\r\x0b\f").translate({c: c + 32 for c in range(65, 91)})
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 10 and len(holders[key(x)]) > 1 and min(holders[key(x)]) < i)]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_lines(spark):
    rng = random.Random(3)
    pool = ["a common line of text", " A Common LINE of text\t", "short", "éééééééééé", "ÉÉÉÉÉÉÉÉÉÉ", "", "another line, seldom"]
    rows = [(i, "\n".join(rng.choice(pool + [f"own line number {i}"]) for _ in range(rng.randrange(1, 9)))) for i in range(80)]
    rows += [(80, None), (81, ""), (82, "\n\n"), (83, rows[0][1])]
    got = line_dedup(docs_of(spark, rows)).select("rest.*", "n_lines", "n_dropped", "kept").collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in got} == plain_lines(rows)
    assert {r.row for r in got} == {"r"}
    bitmaps = {r.doc: (r.n_lines, bytes(r.keep)) for r in keep_bitmaps(docs_of(spark, rows)).collect()}
    assert all(kept_text(t, *bitmaps[i]) == plain_lines(rows)[i][2] for i, t in rows)
    odd = [(None, "a common line of text"), (1, "a common line of text"), (1, "a common line of text"), (1, "a common line of text\nx")]
    assert [r.n_dropped for r in line_dedup(docs_of(spark, odd)).collect()] == [0] * 4
    assert line_dedup(docs_of(spark, rows).limit(0)).count() == 0


def plain_components(rows, words, percent=80):
    sets = {}
    for i, t in rows:
        w = words_of((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[p:p + words]) for p in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("words", [4, 5])
def test_near_copies(spark, words):
    rows = corpus(5, 40)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    for i in range(40):  # a large group, some of it linked only through others
        edited = list(base)
        for _ in range(i % 8):
            edited[rng.randrange(len(edited))] = f"e{rng.randrange(10 ** 6)}"
        rows.append((1000 + i, " ".join(edited)))
    rows += [(2000, "A b C"), (2001, "a B c"), (2002, "a")]
    got = near_copies(docs_of(spark, rows), words=words).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_components(rows, words)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_copies_of_odd_rows(spark):
    text = "one two three four five six seven"
    rows = [(None, text), (3, text), (3, text), (3, "else"), (4, "else"), (5, text), (6, None)]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_copies(docs_of(spark, rows)).collect()), key=repr)
    assert got == sorted([(None, None, True), (3, 3, True), (3, 3, True), (3, 3, True), (4, 3, False), (5, 3, False), (6, 6, True)], key=repr)
    assert near_copies(docs_of(spark, rows).limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}


def test_word_hashes():
    texts = [b"", b" a  b\n", b"a " + b"z" * (LONGEST + 5) + b" b", b"a", "é b".encode()]
    hashes, bounds = word_hashes(texts)
    assert np.diff(bounds).tolist() == [0, 2, 3, 1, 2]
    assert hashes[0] == hashes[2] == hashes[5] and hashes[1] == hashes[4] == hashes[7]
    assert len(set(hashes.tolist())) == 4
    assert levels(50, 25) == [25, 50] and levels(50)[0] == 1
    row = np.arange(200, dtype=np.uint64) % np.uint64(60)
    windows = window_hashes(row, 50)
    assert len(windows) == 151 and (windows[:91] == windows[60:]).all() and len(set(windows[:60].tolist())) == 60


def test_fingerprints(spark):
    rows = [(i, t) for i, t in corpus(8, 60) if i % 5]
    ordered = sorted(rows)
    texts = [t or "" for _, t in ordered]
    got = sorted(edited_fingerprints(docs_of(spark, rows)).collect())
    following = texts[1:] + texts[:1]
    edited = [t[:len(t) - len(t) // 4] + n[:len(t) // 4] for t, n in zip(texts, following)]
    assert [r.edited_sha256 for r in got] == [hashlib.sha256(x.encode()).hexdigest() for x in edited]
    prints = {}
    for r, t in zip(got, texts):
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint and len(r.fingerprint) in (0, 2 * BINS)

    def jaccard(a, b):
        a, b = ({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if (w := x.lower().split()) else set() for x in (a, b))
        return len(a & b) / len(a | b) if a | b else 1.0

    errors = [r.near_edited - jaccard(t, e) for r, t, e in zip(got, texts, edited)]
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.2
    assert max(abs(r.near_next - jaccard(t, n)) for r, t, n in zip(got, texts, following)) < 0.2
    assert all(0 <= r.near_edited <= 1 for r in got)
    alone = edited_fingerprints(docs_of(spark, [(None, None)])).first()
    assert (alone.n_chars, alone.fingerprint, alone.near_edited) == (0, "", 1.0)


def test_decontamination(spark):
    rng = random.Random(2)
    words = [f"word{i}" for i in range(900)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(15, 40)))) for i in range(12)] + [(90, None), (91, ""), (92, "too short")]
    noise = lambda n: " ".join(rng.choice(words) for _ in range(n))
    replaced = items[3][1].split(" ")
    replaced[6] = replaced[13] = "other"
    rows = [(1, noise(80) + " " + items[0][1].upper() + ". " + noise(50)), (2, noise(30) + " " + " ".join(replaced)), (3, noise(200)), (4, None),
            (5, "Too, short!"), (6, "too short a text"), (7, " ".join(items[5][1].split()[:6]) + " " + noise(9)), (None, items[1][1]), (8, items[2][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.contaminated, r.item_id) for r in decontaminate(docs_of(spark, rows), bench).collect()}
    assert got == {1: (True, 0), 2: (True, 3), 3: (False, None), 4: (False, None), 5: (True, 92), 6: (False, None), 7: (False, None),
                   None: (True, 1), 8: (True, 2)}
    assert benchmark_overlaps(docs_of(spark, rows), bench.limit(0)).count() == 0
    assert decontaminate(docs_of(spark, rows).limit(0), bench).count() == 0
    plan = decontaminate(docs_of(spark, rows), bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and "CartesianProduct" not in plan and zlib


def test_toxic_stems_do_not_depend_on_partitions(spark):
    rng = random.Random(6)
    common, rare = [f"common{chr(97 + i)}" for i in range(20)], [f"rare{chr(97 + i)}" for i in range(6)]
    rows, marks = [], []
    for i in range(80):
        toxic = i % 5 == 0
        rows.append((i, " ".join(rng.sample(common, 8) + (rng.sample(rare, 3) if toxic or i % 9 == 0 else []))))
        marks.append((i, int(toxic)))
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cost = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(cost)
    weights = []
    try:
        for parts, each in ((1, before), (80, str(1 << 30))):  # each file is a partition of its own
            spark.conf.set(cost, each)
            weights.append(train(docs.repartition(parts, "doc_id"), labels)[0])
    finally:
        spark.conf.set(cost, before)
    assert list(weights[0]) == list(weights[1])
    assert "rare" in weights[0] and not any(x.startswith("common") for x in weights[0])


def test_decontamination_at_every_place(spark):
    items = [(n, " ".join(f"item{n}word{i}" for i in range(n))) for n in (8, 9, 18)]
    rows, expected = [], {}
    for n, text in items:
        for shift in range(4):
            around = lambda side: " ".join(f"{side}{i}" for i in range(20 + shift))
            rows.append((100 * n + shift, f"{around('a')} {text} {around('b')}"))
            expected[100 * n + shift] = (n, min(n, 18))
    words = items[2][1].split()
    for i in range(18):  # an item of 18 words, two of which were replaced, is worth 10
        for j in range(i):
            text = " ".join("other" if x in (i, j) else word for x, word in enumerate(words))
            for shift in range(2):
                at = 10000 + 100 * i + 4 * j + shift
                rows.append((at, "before " * (3 + shift) + text + " after" * 3))
                expected[at] = 18
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate(docs_of(spark, rows), bench).collect()}
    assert {i for i, r in got.items() if not r.contaminated} == set()
    for i, x in expected.items():
        assert got[i].item_id == (x if isinstance(x, int) else x[0])
        assert isinstance(x, int) or got[i].words == x[1]


def plain_overlaps(rows, items):
    """The best stretch of every document and item over all shifts, where it is enough."""
    words = lambda x: regex.findall(r"[\p{L}\p{N}]+", (x or "").lower())
    out = {}
    for i, text in rows:
        doc = words(text)
        for item_id, item_text in items:
            item, best = words(item_text), 0
            if not item or len(item) <= 3 and item != doc:
                continue
            for shift in range(1 - len(item), len(doc)):
                here = 0
                for j, word in enumerate(item):
                    here = max(0, here + (1 if 0 <= j + shift < len(doc) and doc[j + shift] == word else -3))
                    best = max(best, here)
            if best >= min(10, len(item)):
                out[i, item_id] = best
    return out


def test_decontamination_by_brute_force(spark):
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefghijklmnop") + str(rng.randrange(30))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 14, 20, 30, 30, 12])]
    items += [(50, items[12][1]), (51, items[6][1].upper() + "!"), (52, ""), (53, None)]
    rows = []
    for n in range(90):
        body = [word() for _ in range(rng.randrange(30))]
        part = items[rng.randrange(16)][1].split()
        first = rng.randrange(max(1, len(part) - 10)) if n % 3 == 0 else 0
        part = part[first:]
        if n % 5 == 0 and len(part) > 16:
            part[rng.randrange(len(part))] = "other"
        at = rng.randrange(len(body) + 1)
        rows.append((n, " ".join(body[:at] + part + body[at:])))
    rows += [(200, items[1][1]), (201, items[0][1] + "."), (202, None), (203, ""), (5, rows[5][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc, r.item_id): r.words for r in benchmark_overlaps(docs_of(spark, rows), bench).collect()}
    assert got == plain_overlaps(rows, items) and len(got) > 60
    best = {r.doc_id: (r.item_id, r.words) for r in decontaminate(docs_of(spark, rows), bench).collect() if r.contaminated}
    for i, (item_id, n) in best.items():  # the smallest of the longest
        assert (item_id, n) == min(((y, w) for (x, y), w in got.items() if x == i), key=lambda z: (-z[1], z[0]))


def test_items_with_a_common_stem(spark):
    stem = " ".join(f"stem{i}" for i in range(13))
    items = [(i, f"{stem} " + " ".join(f"own{i}x{j}" for j in range(12))) for i in range(300)]
    rows = [(i, f"some text {i} {stem} and an end of its own {i}") for i in range(300)] + [(1000, "before " + items[77][1] + " after")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = benchmark_overlaps(docs_of(spark, rows), bench).collect()
    assert len(found) <= 2 * len(rows)
    got = {r.doc_id: r for r in decontaminate(docs_of(spark, rows), bench).collect()}
    assert all(r.contaminated for r in got.values())
    assert (got[1000].item_id, got[1000].words) == (77, 25) and (got[5].item_id, got[5].words) == (0, 13)


def test_items_whose_seeds_are_all_common(spark):
    """Each seed of an item occurs in nine items with smaller ids, none of which overlaps enough with the text."""
    words, items = [f"w{i}" for i in range(10)], []
    for offsets in SEEDS:
        for place in range(3):
            at = {place + x for x in offsets}
            items += [(len(items) + n, " ".join(w if i in at else f"d{len(items)}x{n}x{i}" for i, w in enumerate(words))) for n in range(9)]
    bench = spark.createDataFrame([*items, (1000, " ".join(words))], "item_id long, text string")
    rows = [(1, "some text " + " ".join(words) + " and more")]
    got = decontaminate(docs_of(spark, rows), bench).first()
    assert (got.contaminated, got.n_items, got.item_id, got.words) == (True, 1, 1000, 10)


def test_all_items_with_a_common_stem_are_listed(spark):
    stem = " ".join(f"stem{i}" for i in range(13))
    items = [(i, f"{stem} " + " ".join(f"own{i}x{j}" for j in range(12))) for i in range(40)]
    rows = [(i, f"some text {i} {stem} and an end {i}") for i in range(5)] + [(1000, "before " + items[33][1] + " after")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = benchmark_overlaps(docs_of(spark, rows), bench).collect()
    assert {(r.doc, x): r.words for r in found for x in r.item_ids} == plain_overlaps(rows, items) and len(found) == 7
    assert {r.n_items for r in decontaminate(docs_of(spark, rows), bench).collect()} == {40}


def test_near_copies_of_ids_with_two_texts(spark):
    rng = random.Random(3)
    one, two = ([f"{x}{i}" for i in range(120)] for x in "ab")
    near = lambda words: [f"e{rng.random()}" if i in (40, 80) else x for i, x in enumerate(words)]
    rows = [(i, " ".join(x)) for i, x in ((1, one), (1, two), (2, near(one)), (3, near(two)), (4, [f"c{i}" for i in range(50)]))]
    for order in (rows, rows[::-1]):
        got = {(r.doc_id, r.component_id) for r in near_copies(docs_of(spark, order)).collect()}
        assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}


@pytest.mark.parametrize("crowded", [CROWDED, 60_000])
def test_one_link_in_a_template(spark, crowded):
    """Texts of one template, similar to each other at 0.6 to 0.79, two of which are linked: as by comparing all."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(220)]
    edited = lambda words, n: [f"e{rng.random()}" if i in places else x for places in [set(rng.sample(range(8, 212, 6), n))] for i, x in enumerate(words)]
    texts = [edited(base, 7) for _ in range(400)]
    texts.append(edited(texts[123], 2))
    rows = [(i, " ".join(x)) for i, x in enumerate(texts)]
    expected = plain_components(rows, 5)
    linked = [i for i, x in expected.items() if x[1] != i]
    assert 400 in linked
    got = near_copies(docs_of(spark, rows), crowded=crowded).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected


def test_links_of_a_region_join_what_all_links_join():
    rng = np.random.default_rng(3)
    for sides in (None, rng.integers(0, 2, 600)):
        base = rng.integers(0, 1 << 62, 60).astype(np.uint64)
        sets = [np.unique(np.concatenate([base[rng.random(60) < 0.93], rng.integers(0, 1 << 62, 4).astype(np.uint64)])) for _ in range(600)]
        start = rng.integers(0, 400, 600)
        links = region_links(sets, start, sides, 80)
        assert len(links) < 400

        def joined(pairs):
            label = {x: x for x in start.tolist()}
            for a, b in pairs:
                x, y = label[start[a]], label[start[b]]
                label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
            return label

        every = [(a, b) for a in range(600) for b in range(a) if (sides is None or sides[a] != sides[b]) for k in [len(np.intersect1d(sets[a], sets[b]))]
                 if 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k)]
        assert joined(links) == joined(every)


def test_near_copies_of_a_crowded_region(spark):
    rng = random.Random(12)
    base = [f"b{i}" for i in range(300)]

    def edited(words, places):
        return [f"e{rng.randrange(10 ** 9)}" if i in places else x for i, x in enumerate(words)]

    def key(words):
        return np.frombuffer(signature(shingle_sets([" ".join(words).encode()], 5)[0]), ">u4").reshape(TREES, DEPTH)

    grid = range(5, 290, 6)
    used = [sorted(rng.sample(grid, 2)) for _ in range(400)]
    crowd = [edited(base, x) for x in used]
    keys = [key(x) for x in crowd]
    rows_of = Counter((t, d, x[t, :d].tobytes()) for x in keys for t in range(TREES) for d in range(2, DEPTH))
    while True:  # a document linked with a single one of the crowd, their common prefixes short of whole and crowded
        at = rng.randrange(len(crowd))
        single = edited(crowd[at], rng.sample([x for x in grid if x not in used[at]], 6))
        common = np.cumprod(key(single) == keys[at], axis=1).sum(1)
        if common.max() < DEPTH and all(d < 2 or rows_of[t, d, keys[at][t, :d].tobytes()] > 140 for t, d in enumerate(common)):
            break
    apart = [edited(base, rng.sample(grid, 9)) for _ in range(12)]  # in the same regions, linked with nothing
    rows = [(1000 + i, " ".join(x)) for i, x in enumerate([*crowd, *apart])] + [(5000, " ".join(single))]
    expected = plain_components(rows, 5)
    assert expected[5000][1] == 1000 and len({x[1] for x in expected.values()}) > 5
    got = near_copies(docs_of(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected


def test_fingerprints_of_odd_rows(spark):
    assert edited_fingerprints(docs_of(spark, [])).collect() == []
    rows = [(1, "one text of a few words"), (1, "one text of a few words"), (1, "another text under the id"), (None, "no id"), (None, None), (2, "")]
    got = edited_fingerprints(docs_of(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_chars) for r in got if r.doc_id) == [(1, 23), (1, 23), (1, 25), (2, 0)] and len(got) == 6
    assert len({r.fingerprint for r in got if r.doc_id == 1}) == 2
    # The rows form one ring: each edited text is that of a row and its successor.
    order = [x for x in rows if x[0] is None] + [x for x in rows if x[0] == 1] + [rows[5]]
    edits = {hashlib.sha256(((a or "")[:len(a or "") - len(a or "") // 4] + (b or "")[:len(a or "") // 4]).encode()).hexdigest()
             for _, a in order for _, b in order}
    assert {r.edited_sha256 for r in got} <= edits
