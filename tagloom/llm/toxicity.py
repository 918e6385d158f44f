"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Each coordinate has its own learning rate and an L1 threshold, so most of the 2^20 weights stay zero and the model
that is sent to the tasks is a short pair of arrays. It has at most 2^20 entries (12 MB), whatever the corpus.

The model is fitted on a bounded sample of labelled rows (``max_rows``), chosen by a hash of the id; all rows are
scored, with their whole texts, by a map over Arrow batches without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 20
MASK = np.uint32((1 << BITS) - 1)
WORD = re.compile(r"\w+")
STEM = 4
CACHE = 200_000
MAX_ROWS = 20_000
THRESHOLD = 0.7
_WORD, _STEM, _PAIR, _SKIP = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F))


class _Hashes(dict):
    """word -> (hash of the word, hash of its first letters), emptied when it is full."""

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) >= CACHE:
            self.clear()
        pair = self[word] = (zlib.crc32(word.encode()), zlib.crc32(word[:STEM].encode()))
        return pair


def features(text: str | None, hashes: dict) -> np.ndarray:
    """Distinct feature numbers of a text: words, their first four letters, word pairs, and pairs that skip one word.

    Empty and null texts have none.
    """
    words = WORD.findall(text.lower()) if text else []
    if not words:
        return np.zeros(0, dtype=np.uint32)
    h = np.array([hashes[w] for w in words], dtype=np.uint32)
    w, s = h[:, 0], h[:, 1]
    parts = [w * _WORD, s * _STEM]
    if len(w) > 1:
        parts.append((w[:-1] ^ _PAIR) * _WORD + w[1:] * _PAIR)
    if len(w) > 2:
        parts.append((w[:-2] ^ _SKIP) * _WORD + w[2:] * _SKIP)
    return np.unique((np.concatenate(parts) >> np.uint32(7)) & MASK)


def ftrl(
    rows: list[np.ndarray], labels: np.ndarray, epochs: int = 5, alpha: float = 3.0, beta: float = 1.0,
    l1: float = 4.0, l2: float = 0.01,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights ``(numbers, values, bias)`` of a logistic regression on binary features, only those not zero."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias = bias_n = 0.0
    for _ in range(epochs):
        for x, y in zip(rows, labels, strict=True):
            zx, nx = z[x], n[x]
            w = np.where(np.abs(zx) <= l1, 0.0, (np.sign(zx) * l1 - zx) / ((beta + np.sqrt(nx)) / alpha + l2))
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + bias, -35.0, 35.0)))
            g = p - y
            grown = np.sqrt(nx + g * g)
            z[x] = zx + g - (grown - np.sqrt(nx)) / alpha * w
            n[x] = nx + g * g
            bias_n += g * g
            bias -= alpha * g / (beta + bias_n**0.5)
    w = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))
    kept = np.flatnonzero(w)
    return kept.astype(np.uint32), w[kept].astype(np.float32), float(bias)


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Fit on ``docs`` (doc_id, text) joined with ``labels`` (doc_id, toxic).

    ``max_rows`` bounds the sample (in expectation; rows are taken by a hash of the id). Rows with a null id or
    label are left out; an id with several labels counts as toxic if one of them says so. Without labelled rows the
    model is empty and every score is 0.5.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    found = known.count()
    share = min(1.0, max_rows / max(found, 1))
    mixed = F.xxhash64(F.lit(11), F.col("doc_id"))
    chosen = known.where(F.pmod(mixed, F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else known
    # At most about max_rows narrow rows: the bound of this broadcast is the parameter.
    train = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("_at", mixed)
    train = train.repartitionByRange(1, "_at").sortWithinPartitions("_at", "doc_id", "text").select("text", "toxic")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rows, marks = _Hashes(), [], []
        for batch in batches:
            rows += [features(t.as_py(), hashes) for t in batch["text"]]
            marks += batch["toxic"].to_pylist()
        if rows:
            at, value, bias = ftrl(rows, np.array(marks, dtype=float))
            yield pa.RecordBatch.from_arrays(
                [pa.array([at.tobytes()]), pa.array([value.tobytes()]), pa.array([bias])], ["at", "value", "bias"]
            )

    models = train.mapInArrow(fit, "at binary, value binary, bias double").collect()
    if not models:
        return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.float32), 0.0
    m = models[0]
    return np.frombuffer(m.at, dtype=np.uint32), np.frombuffer(m.value, dtype=np.float32), float(m.bias)


def score_toxicity(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``docs``.

    Repeated rows are scored each; empty and null texts get the score of the bias. Other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, value, bias = sent.value
        weights = np.zeros(1 << BITS, dtype=np.float32)
        weights[at] = value
        hashes = _Hashes()
        for batch in batches:
            sums = np.array([weights[features(t.as_py(), hashes)].sum(dtype=float) for t in batch["text"]], dtype=float)
            p = 1.0 / (1.0 + np.exp(-np.clip(sums + bias, -35.0, 35.0)))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double, predicted int")


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are not learned from; a null id counts as one."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted``: fitted on the labels that are not held out, applied to all rows."""
    model = fit_toxicity(docs, labels.where(~held_out()), max_rows)
    return score_toxicity(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns.

    Each row is scored by its own text in one map over ``docs``; clean, empty and null texts stay.
    """
    model = fit_toxicity(docs, labels.where(~held_out()), max_rows)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    least = float(np.log(THRESHOLD / (1 - THRESHOLD)))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, value, bias = sent.value
        weights = np.zeros(1 << BITS, dtype=np.float32)
        weights[at] = value
        hashes = _Hashes()
        for batch in batches:
            sums = [weights[features(t.as_py(), hashes)].sum(dtype=float) + bias for t in batch["text"]]
            yield batch.filter(pa.array([s < least for s in sums], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
