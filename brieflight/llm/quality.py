"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A rating has a grade from 0 to GRADES - 1. One weight for each hashed text feature is shared by all grades, and ordered
thresholds cut the score: P(grade <= j) = logistic(threshold[j] - w.x). From it come the expected grade and the tail
probability P(grade >= SELECT), by which documents are selected.

From `labels` the grade is one point for good text and one for text that isn't toxic: 0, 1 or 2. The model is fitted on at most SAMPLE
rated documents, those with the smallest hash of their id (the bound is a parameter); every document is scored.

Features are distinct hashed words (A-Z lower-cased, between ASCII white space and with outer punctuation off), their
beginnings, and bucketed measures of form: repetition, word length, symbols, digits, lines.

Defined results: a null text is an empty one; a null label or one without a document is not used; a document rated twice
is used twice, and one whose id repeats for each row, as long as the rows fit the sample; ties in the hash go by id and
grade; equal texts get equal scores; very long texts are read whole; without ratings of at least two grades nothing is learnt and every document is kept with tail probability
1; an empty table gives no rows; other columns are ignored, or passed through by `select_documents`.
"""

from __future__ import annotations

import math
import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces

GRADES, SELECT, KEEP = 3, 2, 0.5
BUCKETS = 1 << 18
#: At most so many rated documents are used to fit the model.
SAMPLE = 20_000
EPOCHS, BATCH, RATE, DECAY = 10, 64, 0.1, 1e-4
#: Rated documents that a word must be in to get a weight.
LEAST = 8
#: Standard deviations by which a word's share of low grades must differ from the whole's.
TELLS = 6.0
_SHAPES = 4096  # buckets at the end for measures of form
#: Bytes of the words' beginnings that count as features of their own.
_BEGINNINGS = (4, 5, 6)
_PUNCTUATION = b"".join(bytes([c]) for c in range(33, 127) if not chr(c).isalnum())


def features(text: bytes | None) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    tokens = text.lower().split() if text else []
    crc, n = zlib.crc32, len(tokens)
    distinct = set(tokens)
    words = {w.strip(_PUNCTUATION) for w in distinct}
    words.discard(b"")
    parts = words | {b"<" + w[:k] for k in _BEGINNINGS for w in words}
    found = {crc(w) % (BUCKETS - _SHAPES) for w in parts}
    size = len(text or b"")
    symbols = size - sum(map(text.count, (b" ", b"\n"))) - _letters(text) if text else 0
    level = lambda x, steps: min(steps, int(x * steps))
    measures = [
        level(len(distinct) / n if n else 0, 20),
        level(sum(map(len, tokens)) / n / 20 if n else 0, 20),
        level(symbols / size if size else 0, 40),
        level(math.log2(1 + n) / 20, 20),
        level(text.count(b"\n") / n if n else 0, 20),
        level(sum(t[-1:] in b".,!?;:" for t in tokens) / n if n else 0, 20),
        level(len(_RUN.findall(text)) / n if n else 0, 20),
    ]
    found.update(BUCKETS - _SHAPES + i * 64 + m for i, m in enumerate(measures))
    return np.fromiter(sorted(found), dtype=np.int64, count=len(found))


#: Three equal symbols in a row.
_RUN = re.compile(rb"([!-/:-@\[-`{-~])\1\1")
_OTHER = bytes(c for c in range(256) if not (97 <= c <= 122 or 65 <= c <= 90 or c >= 128))


def _letters(text: bytes) -> int:
    return len(text.translate(None, _OTHER))


class Ordinal:
    """Shared weights and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights.astype(np.float32), thresholds

    def score(self, found: np.ndarray) -> float:
        return float(self.weights[found].sum(dtype=np.float64))

    def tails(self, score: float) -> list[float]:
        """P(grade >= j) for j from 1."""
        return [1 / (1 + math.exp(min(700.0, max(-700.0, t - score)))) for t in self.thresholds]


class Rated(NamedTuple):
    """Features of rated documents, end to end: those of document i are flat[starts[i]:starts[i + 1]]."""

    flat: np.ndarray
    starts: np.ndarray
    grades: np.ndarray


def telling(data: Rated, grades: int) -> np.ndarray:
    """Which features get a weight: not words in too few documents, nor those that say nothing about any grade."""
    count, seen = np.zeros(BUCKETS), np.zeros((grades - 1, BUCKETS))
    for s in range(0, len(data.grades), 1000):  # counts by parts, which keeps the driver's memory small
        e = min(s + 1000, len(data.grades))
        part, sizes = data.flat[data.starts[s] : data.starts[e]], np.diff(data.starts[s : e + 1])
        count += np.bincount(part, minlength=BUCKETS)
        for j in range(grades - 1):
            seen[j] += np.bincount(part, np.repeat((data.grades[s:e] <= j).astype(float), sizes), minlength=BUCKETS)
    often = np.zeros(BUCKETS, dtype=bool)
    for j in range(grades - 1):
        p = float((data.grades <= j).mean())
        often |= np.abs(seen[j] - count * p) >= TELLS * np.sqrt(np.maximum(count * p * (1 - p), 1e-9))
    often &= count >= LEAST
    often[BUCKETS - _SHAPES :] = True
    return often


def fit(data: Rated, grades: int = GRADES, epochs: int = EPOCHS) -> Ordinal | None:
    """Maximum likelihood by AdaGrad over small batches, in a fixed order. Gaps between thresholds are kept positive."""
    if len(np.unique(data.grades)) < 2:
        return None
    keep = telling(data, grades)[data.flat]
    # every document has features of form, so none of these sums is over nothing
    starts = np.concatenate([[0], np.cumsum(np.add.reduceat(keep, data.starts[:-1], dtype=np.int64))])
    flat, y_all = data.flat[keep].astype(np.int64), data.grades
    w, squares = np.zeros(BUCKETS), np.full(BUCKETS, 1e-6)
    share = np.array([((y_all <= j).sum() + 0.5) / (len(y_all) + 1.0) for j in range(grades - 1)])
    theta = np.log(share / (1 - share))
    theta = np.maximum.accumulate(theta + np.arange(grades - 1) * 1e-3)
    theta_squares = np.full(grades - 1, 1e-2)
    logistic = lambda x: 1 / (1 + np.exp(-np.clip(x, -500, 500)))
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        order = rng.permutation(len(y_all))
        for s in range(0, len(order), BATCH):
            part = order[s : s + BATCH]
            sizes = starts[part + 1] - starts[part]
            at = np.concatenate([flat[starts[i] : starts[i + 1]] for i in part])
            of = np.repeat(np.arange(len(part)), sizes)
            eta = np.bincount(of, w[at], minlength=len(part))
            y = y_all[part]
            edges = np.concatenate([[-np.inf], theta, [np.inf]])
            high, low = logistic(edges[y + 1] - eta), logistic(edges[y] - eta)
            p = np.maximum(high - low, 1e-12)
            d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
            g_eta = (d_high - d_low) / len(part)  # of the negative log-likelihood
            touched, where = np.unique(at, return_inverse=True)
            grad = np.bincount(where, g_eta[of], minlength=len(touched)) + DECAY * w[touched]
            squares[touched] += grad * grad
            w[touched] -= RATE * grad / np.sqrt(squares[touched])
            g_theta = np.array([(d_low[y == j + 1].sum() - d_high[y == j].sum()) / len(part) for j in range(grades - 1)])
            theta_squares += g_theta * g_theta
            theta -= RATE * g_theta / np.sqrt(theta_squares)
            theta = np.maximum.accumulate(theta + np.arange(grades - 1) * 1e-9)
    return Ordinal(w, theta)


def bounded(docs: DataFrame, found: DataFrame, sample: int) -> DataFrame:
    """The ratings (id, grade), without those ids whose rows in docs would go beyond the sample: a doc_id that repeats makes a
    rating count for each of its rows. At most `sample` rows come to the driver."""
    spark = docs.sparkSession
    found = found.groupBy("id", "grade").agg(F.count("*").alias("times"))
    counts = docs.select(F.col("doc_id").cast("long").alias("id")).join(F.broadcast(found), "id").groupBy("id", "grade", "times").agg(F.count("*").alias("n")).orderBy(F.xxhash64("id"), "id", "grade").collect()
    held, left = [], sample
    for r in counts:
        if r.n * r.times <= left:
            left -= r.n * r.times
            held += [(r.id, r.grade)] * r.times
    return spark.createDataFrame(held, "id long, grade int")


def rated(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Rated:
    """(features, grade) of at most `sample` rated documents; only their features come to the driver."""
    grade = (F.when(F.col("quality") > 0, 1).otherwise(0) + F.when(F.coalesce("toxic", F.lit(0)) > 0, 0).otherwise(1)).cast("int")
    found = labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").cast("long").alias("id"), grade.alias("grade"))
    found = found.orderBy(F.xxhash64("id"), "id", "grade").limit(sample)
    found = bounded(docs, found, sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text")).join(F.broadcast(found), "id")

    def run(batches):
        for b in pieces(batches):
            at = [b.schema.get_field_index(x) for x in ("id", "grade", "text")]
            yield pa.RecordBatch.from_arrays([b.column(at[0]), b.column(at[1]), pa.array([features(t).astype(np.int32) for t in b.column(at[2]).to_pylist()], pa.list_(pa.int32()))], ["id", "grade", "found"])

    table = rows.mapInArrow(run, "id long, grade int, found array<int>").toArrow()
    ids, grades = np.asarray(table.column("id")), np.asarray(table.column("grade"))
    if not len(ids):
        return Rated(np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int64))
    lists = []  # views of the chunks, one for each document
    for chunk in table.column("found").chunks:
        flat, ends = np.asarray(chunk.flatten()), np.asarray(chunk.offsets) - chunk.offsets[0].as_py()
        lists += [flat[s:e] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
    sizes = np.array([len(x) for x in lists])
    order = np.lexsort((sizes, grades, ids))
    return Rated(np.concatenate([lists[i] for i in order]), np.concatenate([[0], np.cumsum(sizes[order])]), grades[order].astype(np.int64))


def model(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ordinal | None:
    return fit(rated(docs, labels, sample))


def score_documents(docs: DataFrame, fitted: Ordinal | None, keep: float = KEEP) -> DataFrame:
    """doc_id, expected_grade, tail_probability, kept: one row per document."""
    sent = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches):
        m = sent.value
        for b in pieces(batches):
            tails = [m.tails(m.score(features(t))) if m else [1.0] * (GRADES - 1) for t in b.column(1).to_pylist()]
            p = [t[SELECT - 1] for t in tails]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sum(t) for t in tails], pa.float64()), pa.array(p, pa.float64()), pa.array([x >= keep for x in p], pa.bool_())], ["doc_id", "expected_grade", "tail_probability", "kept"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, expected_grade double, tail_probability double, kept boolean")


def select_documents(docs: DataFrame, fitted: Ordinal | None, keep: float = KEEP) -> DataFrame:
    """The documents that the classifier keeps, with all their columns."""
    sent, at = docs.sparkSession.sparkContext.broadcast(fitted), docs.columns.index("text")

    def run(batches):
        m = sent.value
        for b in pieces(batches):
            texts = b.column(at).to_pylist()
            yield b.filter(pa.array([not m or m.tails(m.score(features(t.encode("utf-8") if t else None)))[SELECT - 1] >= keep for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op9(spark, sf_dir) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_documents(docs, model(docs, labels))
