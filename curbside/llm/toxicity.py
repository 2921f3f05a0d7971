"""Toxicity by weak supervision.

Many voters, lexicons and patterns, mark texts as toxic or abstain. A generative model estimates how
often each votes in toxic and in clean texts and how far voters repeat each other, and turns votes
into posterior labels. A linear classifier learns these from the words of the texts and scores all.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.rows import blocks, rest_of, stored, texts_of
from curbside.llm.words import span_hashes, word_spans

#: Labelled rows to learn from at most; those with the smallest hashes of id and text.
SAMPLE = 20_000
#: Word stems that the classifier knows at most, and those that vote as learned lexicons.
FEATURES, LEARNED = 4096, 200
#: Bytes of sampled texts that a task takes apart at once: a text has several times as many stems as words.
SAMPLE_BLOCK = 1 << 20
#: Bytes of texts that are scored at once, and words that a task remembers, by hash; it starts anew when they are more.
SCORED_BLOCK, WORDS = 4 << 20, 1 << 19
#: Toxic texts of the sample that a stem must be in.
LEAST_TOXIC = 3
STEMS = range(3, 9)
THRESHOLD = 0.3
#: Correlations below this are taken for chance.
CORRELATED = 0.15

# Words that count against a text in any corpus.
LEXICONS = {
    "insults": ("idiot", "moron", "loser", "clown", "scum", "trash", "fool", "jerk", "creep", "imbecile"),
    "contempt": ("stupid", "pathetic", "worthless", "disgusting", "dumb", "useless", "ugly", "filthy", "vile"),
    "profanity": ("damn", "crap", "bastard", "bullshit", "arse", "ass", "shit", "fuck", "bitch"),
    "threats": ("kill", "die", "hurt", "destroy", "hang", "choke"),
    "german": ("dumm", "dummkopf", "trottel", "abschaum", "versager", "arschloch", "widerlich", "wertlos"),
    "french": ("imbécile", "crétin", "ordure", "minable", "nul", "débile", "connard", "dégoûtant"),
    "spanish": ("imbécil", "estúpido", "basura", "payaso", "inútil", "asqueroso", "patético", "perdedor"),
}
PATTERNS = {
    "you_are": r"\b(?:you|u)(?:'re| are| r)? (?:an? |such an? |all )?(?:idiot|moron|loser|clown|scum|trash|fool|stupid|pathetic|worthless|disgusting|dumb)",
    "shut_up": r"\bshut up\b|\bgo to hell\b|\bget lost\b",
    "wish_harm": r"\b(?:kill|hang|hurt) (?:yourself|you|them)\b|\bhope you die\b",
    "shouting": r"!{3,}|\b[A-ZÀ-Þ]{4,}(?:\s+[A-ZÀ-Þ]{4,}){2,}",
    "masked": r"\b\w+\*{2,}\w*\b|\b\w*[@$]\w*[@$]\w*\b",
}
LEXICON_OF = {word: name for name, words in LEXICONS.items() for word in words}
LETTERS = re.compile(r"[^\W\d_]+")


def stems_of(word: str) -> Iterator[str]:
    """The whole words in a run of characters, marked by a space, and their first letters."""
    for part in LETTERS.findall(word.lower()):
        yield part + " "
        for n in STEMS:
            if len(part) >= n:
                yield part[:n]


def distinct_words(texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of a block and their hashes; the number and the text of each word."""
    whole, starts, ends, bounds = word_spans(texts)
    hashes, first, of = np.unique(span_hashes(whole, starts, ends), return_index=True, return_inverse=True)
    words = [whole[a:b].decode("utf-8", "replace") for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    return words, hashes, of, np.repeat(np.arange(len(texts)), np.diff(bounds))


def stem_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean texts of a block each stem is."""
    for block in blocks(batches, limit=SAMPLE_BLOCK):
        count = {True: Counter(), False: Counter()}
        for text, toxic in zip(texts_of(block), block.column("toxic").to_pylist()):
            stems: set[str] = set()
            for word in set(text.decode("utf-8", "replace").split()):
                stems.update(stems_of(word))
            count[toxic == 1].update(stems)
        # A stem of this block's clean texts alone may be in toxic texts of others.
        stems = list(count[True] | count[False])
        yield pa.RecordBatch.from_pydict({
            "stem": pa.array(stems, pa.string()), "toxic": pa.array([count[True][x] for x in stems], pa.int64()),
            "clean": pa.array([count[False][x] for x in stems], pa.int64())})


def sample_rows(features: list[str]):
    """For each labelled text, the features, lexicons and patterns in it."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {x: i for i, x in enumerate(features)}
        lexicons, patterns = list(LEXICONS), [re.compile(x) for x in PATTERNS.values()]
        for block in blocks(batches, limit=SAMPLE_BLOCK):
            found, votes = [], []
            for raw in texts_of(block):
                text = raw.decode("utf-8", "replace")
                stems: set[str] = set()
                for word in set(text.split()):
                    stems.update(stems_of(word))
                found.append(sorted({number[x] for x in stems if x in number}))
                named = {LEXICON_OF.get(x.rstrip()) for x in stems if x[-1] == " "}
                votes.append([i for i, x in enumerate(lexicons) if x in named]
                             + [len(lexicons) + i for i, x in enumerate(patterns) if x.search(text)])
            yield pa.RecordBatch.from_pydict({
                "features": pa.array(found, pa.list_(pa.int32())), "votes": pa.array(votes, pa.list_(pa.int32())),
                "toxic": block.column("toxic")})

    return find


def posterior(votes: np.ndarray, start: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior labels of texts from their votes (texts by voters), and the voters' rates.

    Expectation maximisation from the labels ``start``. Voters that agree beyond what the label
    explains share one voice: a voter weighs 1 over the sum of its correlations with all voters,
    itself included. The last voter, people, keeps its full weight.
    """
    n, m = votes.shape
    q, weight = start, np.ones(m)
    for step in range(rounds):
        hit = np.clip((q @ votes + 0.1) / (q.sum() + 1), 1e-4, 0.999)
        miss = np.clip(((1 - q) @ votes + 0.01) / ((1 - q).sum() + 1), 1e-5, 0.999)
        prior = float(np.clip(q.mean(), 1e-3, 0.999))
        evidence = votes @ (weight * np.log(hit / miss)) + (1 - votes) @ (weight * np.log((1 - hit) / (1 - miss)))
        q = 1 / (1 + np.exp(-np.clip(np.log(prior / (1 - prior)) + evidence, -30, 30)))
        if step % 5 == 1:
            rest = votes - np.outer(q, hit) - np.outer(1 - q, miss)
            deviation = np.sqrt((rest ** 2).mean(0)) + 1e-9
            correlation = rest.T @ rest / n / np.outer(deviation, deviation)
            weight = 1 / np.maximum(np.where(correlation > CORRELATED, correlation, 0).sum(1), 1)
            weight[-1] = 1
    return q, hit, miss


def fitted(rows: list[tuple[list[int], float]], n_features: int, rounds: int = 500, decay: float = 3e-6
           ) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels, by gradient steps with momentum.

    No weight is below 0: all features speak for the label, and nested ones must not cancel out.
    """
    target = np.array([x[1] for x in rows])
    text = np.repeat(np.arange(len(rows)), [len(x[0]) for x in rows])
    feature = np.fromiter((i for x in rows for i in x[0]), np.int64)
    weights, mean, square = (np.zeros(n_features + 1) for _ in range(3))
    for step in range(1, rounds + 1):
        z = np.bincount(text, weights[feature], len(rows)) + weights[-1]
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        slope = np.append(np.bincount(feature, error[text], n_features), error.sum()) / len(rows)
        slope[:-1] += decay * weights[:-1]
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        weights -= 0.1 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
        np.maximum(weights[:-1], 0, out=weights[:-1])
    return weights[:-1], float(weights[-1])


def held_out(ident: str = "doc_id"):
    """Rows whose labels are for testing."""
    return F.pmod(F.crc32(F.col(ident).cast("string").cast("binary")), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", label: str = "toxic",
          sample: int = SAMPLE, features: int = FEATURES, learned: int = LEARNED, least_toxic: int = LEAST_TOXIC
          ) -> tuple[dict[str, float], float]:
    """Weights of stems and a bias, from at most ``sample`` labelled rows that are not held out."""
    marks = labels.where(F.col(label).isNotNull() & F.col(ident).isNotNull() & ~held_out(ident)).select(
        F.col(ident).cast("long").alias("id"), F.col(label).cast("int").alias("toxic")).distinct()
    rows = docs.select(F.col(ident).cast("long").alias("id"), F.xxhash64(F.col(ident).cast("long"), F.col(text).cast("string")).alias("row"),
                       F.col(text).cast("string").alias("text"))
    key = ["id", "row", "toxic"]
    known = rows.select("id", "row").join(marks, "id").distinct().orderBy(F.xxhash64(*key), *key).limit(sample)
    # At most ``sample`` rows of three numbers; repeated rows are one.
    texts = stored(rows.join(F.broadcast(known), ["id", "row"]).dropDuplicates(key).select("text", "toxic"), "toxicity-sample")
    counted = texts.mapInArrow(stem_counts, "stem string, toxic long, clean long").groupBy("stem").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    totals = {toxic: n for toxic, n in texts.groupBy("toxic").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return {f"{x} ": 4.0 for x in LEXICON_OF}, -3.0
    odds = F.log(((F.col("toxic") + 0.2) / (toxic + 0.4)) / ((F.col("clean") + 0.2) / (clean + 0.4)))
    best = [x["stem"] for x in counted.withColumn("odds", odds).where((F.col("odds") > 1.5) & (F.col("toxic") >= least_toxic))
            .orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "stem").limit(features).collect()]
    stems = list(dict.fromkeys(best + [f"{x} " for x in LEXICON_OF]))
    rows = texts.mapInArrow(sample_rows(stems), "features array<int>, votes array<int>, toxic int").collect()
    fixed = len(LEXICONS) + len(PATTERNS)
    learned = min(learned, len(best))
    votes = np.zeros((len(rows), fixed + learned + 1), np.float32)
    for i, row in enumerate(rows):
        votes[i, row["votes"]] = 1
        votes[i, [fixed + x for x in row["features"] if x < learned]] = 1
        votes[i, -1] = row["toxic"]  # people vote too
    soft, _, _ = posterior(votes, 0.02 + 0.95 * votes[:, -1])
    weights, bias = fitted([(x["features"], y) for x, y in zip(rows, soft.tolist())], len(stems))
    return dict(zip(stems, weights.tolist())), bias


def scorer(weights: dict[str, float], bias: float):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {x: i for i, x in enumerate(weights)}
        weight = np.fromiter(weights.values(), float, len(weights))
        known: dict[int, tuple[int, ...]] = {}  # words by hash that have features
        seen = np.empty(0, np.uint64)  # words that were looked up
        for block in blocks(batches, limit=SCORED_BLOCK):
            texts = texts_of(block)
            words, hashes, of, text = distinct_words(texts)
            new = ~np.isin(hashes, seen)
            for i in np.flatnonzero(new).tolist():
                if found := tuple({number[x] for x in stems_of(words[i]) if x in number}):
                    known[int(hashes[i])] = found
            marked = np.isin(hashes, np.fromiter(known, np.uint64, len(known)))
            if len(seen) > WORDS:
                seen, known = hashes, {h: known[h] for h in hashes[marked].tolist()}
            else:
                seen = np.concatenate([seen, hashes[new]])
            at = np.flatnonzero(marked[of])
            cuts = np.searchsorted(text[at], np.arange(len(texts) + 1)).tolist()
            sums = np.full(len(texts), bias)
            for t, (a, b) in enumerate(pairwise(cuts)):
                for f in sorted({f for h in set(hashes[of[at[a:b]]].tolist()) for f in known[h]}):
                    sums[t] += weight[f]
            yield block.append_column("score", pa.array(1 / (1 + np.exp(-np.clip(sums, -30, 30)))))

    return score


def with_scores(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", label: str = "toxic",
                **bounds: int) -> DataFrame:
    """(rest, text, score) for each row of ``docs``; ``rest`` holds its other columns. ``bounds`` as in ``toxicity``."""
    weights, bias = train(docs, labels, ident, text, label, **bounds)
    frame = docs.select(rest_of(docs, text), F.col(text).cast("string").alias("text"))
    kind = frame.schema["rest"].dataType.simpleString()
    return frame.mapInArrow(scorer(weights, bias), f"rest {kind}, text string, score double")


def toxicity(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", label: str = "toxic",
             threshold: float = THRESHOLD, sample: int = SAMPLE, features: int = FEATURES, learned: int = LEARNED,
             least_toxic: int = LEAST_TOXIC) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    Scores depend on the words of a text alone. Labels are learned from rows that are not held out
    (crc32 of the id as text, modulo 4, other than 2): at most ``sample`` different pairs of text and
    label, which also bounds what reaches the driver, repeated rows counting once. The classifier
    knows at most ``features`` stems, each in ``least_toxic`` toxic texts of the sample, the best
    ``learned`` of which vote. Rows with NULL for id or label teach nothing, and rows without an id
    are held out. NULL and empty texts get the score of a text without a known word. Without labels
    of both kinds the fixed lexicons decide. Repeated rows are scored one by one; an empty table
    gives no rows; other columns, whatever their names, are not looked at. Texts are read in blocks
    of some megabytes, a longer one as a block by itself.
    """
    scored = with_scores(docs.select(F.col(ident).alias("doc_id"), F.col(text).alias("text")),
                         labels.select(F.col(ident).alias("doc_id"), F.col(label).alias("toxic")),
                         sample=sample, features=features, learned=learned, least_toxic=least_toxic)
    return scored.select("rest.doc_id", "score").select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
