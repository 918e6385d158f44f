"""M6 with all its settings: variational LDA over chunks of documents, with the topics of a word as a row of a table.

A pass deals every document to one of at most ``1 / LEAST_SHARE`` chunks and goes through all of them, so each document is seen
exactly ``passes`` times. Inference inside a document starts from the same numbers everywhere and ends when a round moves its weights by
less than ``THRESHOLD`` on average or after ``iterations`` rounds; it does not depend on the documents beside it. The weights of a
document that is not done early leap along the way of its last rounds: most documents creep, and rounds alone stop farther from
their end. What ends a document is a round all the same. A chunk moves the weights of the words by the step ``(offset + t) ** -decay``.

The number of words times topics decides how documents meet the weights, not what comes out. Up to ``model_bytes`` they are sent
to the tasks as a matrix, and one shuffle adds the sums by ranges of words. Beyond that they stay a table, which the words of a chunk
look up; frequent words are answered by a broadcast of a fixed number of rows (``token_lookup``). Then only one number per topic
comes to the driver. The words themselves never do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators import linear
from tagloom.operators.batches import with_batch_column
from tagloom.operators.dictionary import Dictionary, fit_dictionary
from tagloom.operators.membership import token_lookup
from tagloom.session import materialise, scratch_path

MODEL_BYTES = 64 << 20
THRESHOLD = 0.001
GROUP_ENTRIES = 50_000  # words of documents that one task call holds, when the weights are looked up
FLOOR = 1e-100
LEAST_SHARE = 0.05  # of the documents, in a chunk
DENSE_CELLS = 16  # cells of such a stack, for each word of its documents, up to which it is made
STACK_CELLS = 250_000  # numbers of the word matrices of documents that are inferred side by side
STACK_LEAST = 0.7  # share of a stack's documents that are not done, from which on down the others leave it
FIRST_LEAP, LAST_LEAP = 9, 200  # rounds: before the first a document finds its way, after the last it ends as rounds alone do
LEAP_EVERY = 3  # rounds from one leap to the next
LONGEST_LEAP = 64.0
_SHIFT = 6
_SUMS = "word_id int, sums array<double>, about array<double>"


def digamma(x: np.ndarray) -> np.ndarray:
    """By its series at ``x + 6`` and the recurrence down to ``x`` > 0."""
    x = np.asarray(x, dtype=float)
    y = x + _SHIFT
    r = 1 / (y * y)
    series = np.log(y) - 0.5 / y - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r / 240)))
    u = x * (x + 5)  # 1 / x + 1 / (x + 1) + ... + 1 / (x + 5) as one quotient
    return series - (2 * x + 5) * (u * (3 * u + 20) + 24) / (u * (u + 4) * (u + 6))


def log_gamma(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, dtype=float)
    y = x + _SHIFT
    r = 1 / (y * y)
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y
    return series - sum(np.log(x + j) for j in range(_SHIFT))


def _shares(gamma: np.ndarray) -> np.ndarray:
    """exp(E[log theta]) of the rows."""
    return np.exp(digamma(gamma) - digamma(gamma.sum(axis=1))[:, None])


def word_weights(weights: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """exp(E[log beta]) of words whose ``weights`` add up to ``totals`` over all words."""
    return np.exp(digamma(weights) - digamma(totals)) if len(weights) else np.zeros(weights.shape)


def _added(feature, value, row, theta, matrix, by, out, logs=None) -> None:
    """Adds n / norm times ``matrix`` (``by`` is ``row``) or ``theta`` (``by`` is ``feature``) to the rows of ``out``; ``by`` ascends."""
    step = max(1, linear.WORK_NUMBERS // matrix.shape[1])
    for a in range(0, len(by), step):
        f, v, r, b = (x[a : a + step] for x in (feature, value, row, by))
        beta, share = matrix[f], theta[r]
        norm = np.einsum("ij,ij->i", beta, share) + FLOOR
        heads = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
        out[b[heads]] += np.add.reduceat((beta if by is row else share) * (v / norm)[:, None], heads, axis=0)
        if logs is not None:
            logs[b[heads]] += np.add.reduceat(v * np.log(norm), heads)


def infer(first, feature, value, matrix, alpha, iterations: int, leaps: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Topic weights of documents (rows ``first[i]`` to ``first[i + 1]``) and the rounds that each took. No words: ``alpha``, which is
    one number or one for each topic. Documents of like length go through the rounds side by side, up to ``STACK_CELLS`` numbers.
    ``leaps``: with leaps between the rounds, as models are fitted and used."""
    sizes, topics = np.diff(first), matrix.shape[1]
    gamma = np.ones((len(sizes), topics))
    gamma[sizes == 0] = alpha
    rounds = np.zeros(len(sizes), dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")[: int((sizes > 0).sum())]
    a = 0
    while a < len(order):
        longest = int(sizes[order[a]])
        live = order[a : a + max(1, STACK_CELLS // (longest * topics))]
        a += len(live)
        dense = len(live) * longest <= DENSE_CELLS * int(sizes[live].sum())
        (_stacked if dense else _single)(live, first, feature, value, matrix, alpha, iterations, leaps, gamma, rounds)
    return gamma, rounds


def _leap(before: np.ndarray, last: np.ndarray, now: np.ndarray, alpha) -> np.ndarray:
    """From the weights of documents in three rounds, weights further along their way: a step of squared extrapolation, whose length
    comes from how much shorter the second move is than the first."""
    move = last - before
    bend = now - last - move
    length = np.sqrt((move * move).sum(axis=1) / np.maximum((bend * bend).sum(axis=1), 1e-300))
    length = np.clip(length, 1, LONGEST_LEAP)[:, None]
    return np.maximum(before + 2 * length * move + length * length * bend, alpha)


def _leaps_after(round_: int) -> bool:
    return FIRST_LEAP <= round_ <= LAST_LEAP and (round_ - FIRST_LEAP) % LEAP_EVERY == 0


def _stacked(live, first, feature, value, matrix, alpha, iterations, leaps, gamma, rounds) -> None:
    """The rounds of the documents ``live``, held as a stack of matrices of topics by the words of a document. Those that are done
    leave the stack when they are many."""
    sizes = (first[live + 1] - first[live])[:, None]
    at = np.arange(int(sizes.max()))
    place = first[live][:, None] + np.where(at < sizes, at, 0)  # beyond its end a document has no counts
    beta = np.ascontiguousarray(matrix[feature[place]].transpose(0, 2, 1))
    counts, now = np.where(at < sizes, value[place], 0.0), gamma[live]
    last, moving = now, np.ones(len(live), dtype=bool)
    for done in range(1, iterations + 1):
        theta = _shares(now)
        norm = np.matmul(theta[:, None, :], beta)[:, 0] + FLOOR
        made = alpha + theta * np.matmul(beta, (counts / norm)[:, :, None])[:, :, 0]
        gamma[live[moving]] = made[moving]
        rounds[live[moving]] += 1
        moving &= np.abs(made - now).mean(axis=1) >= THRESHOLD
        before, last, now, left = last, now, made, int(moving.sum())
        if not left:
            return
        if left <= STACK_LEAST * len(moving):
            beta, counts, live, before, last, now = (x[moving] for x in (beta, counts, live, before, last, now))
            moving = np.ones(left, dtype=bool)
        if leaps and _leaps_after(done):
            now = _leap(before, last, now, alpha)


def _single(live, first, feature, value, matrix, alpha, iterations, leaps, gamma, rounds) -> None:
    """The same over single words, where a stack would be mostly empty."""
    sizes = first[live + 1] - first[live]
    row = np.repeat(np.arange(len(live)), sizes)
    place = np.repeat(first[live], sizes) + np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    feature, value = feature[place], value[place]
    last = now = gamma[live]
    for done in range(1, iterations + 1):
        theta = _shares(now)
        sums = np.zeros_like(theta)
        _added(feature, value, row, theta, matrix, row, sums)
        made = alpha + theta * sums
        moving = np.abs(made - now).mean(axis=1) >= THRESHOLD
        gamma[live] = made
        rounds[live] += 1
        if not moving.any():
            return
        stay = moving[row]
        feature, value = feature[stay], value[stay]
        row = (np.cumsum(moving) - 1)[row[stay]]
        before, last, now, live = last[moving], now[moving], made[moving], live[moving]
        if leaps and _leaps_after(done):
            now = _leap(before, last, now, alpha)


def statistics(first, feature, value, matrix, alpha: float, iterations: int, out: np.ndarray, leaps: bool = False) -> list[float]:
    """Adds the word sums of documents to ``out``; returns documents, their part of the bound, and the rounds they took."""
    gamma, rounds = infer(first, feature, value, matrix, alpha, iterations, leaps)
    theta = _shares(gamma)
    row = np.repeat(np.arange(len(gamma)), np.diff(first))
    logs = np.zeros(len(gamma))
    _added(feature, value, row, theta, matrix, row, np.zeros_like(theta), logs)
    order = np.argsort(feature, kind="stable")
    feature = feature[order]
    _added(feature, value[order], row[order], theta, matrix, feature, out)
    k = gamma.shape[1]
    prior = ((alpha - gamma) * (digamma(gamma) - digamma(gamma.sum(axis=1))[:, None]) + log_gamma(gamma)).sum(axis=1)
    bound = logs + prior - k * log_gamma(alpha) + log_gamma(k * alpha) - log_gamma(gamma.sum(axis=1))
    return [float(len(gamma)), float(bound.sum()), float(rounds.sum())]


def _numbers(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.asarray(pc.list_flatten(lists.combine_chunks()), dtype=float).reshape(-1, width)


def _documents(table: pa.Table, id_col: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct ids, the starts of their rows, and the order that puts rows of one id together."""
    codes = table[id_col].combine_chunks().dictionary_encode(null_encoding="encode")
    index = np.asarray(codes.indices)
    order = np.argsort(index, kind="stable")
    return codes.dictionary, np.searchsorted(index[order], np.arange(len(codes.dictionary) + 1)), order


def _entries(vectors: DataFrame, id_col: str, col: str) -> DataFrame:
    pairs = F.arrays_zip(F.col(col)["indices"].alias("word_id"), F.col(col)["values"].alias("value"))
    return vectors.select(id_col, F.inline(pairs).alias("word_id", "value"))


def _met(entries: DataFrame, id_col: str, table: DataFrame) -> DataFrame:
    """Entries with the weights of their words, in groups of whole documents."""
    groups = max(1, -(-entries.count() // GROUP_ENTRIES))
    rows = token_lookup(entries, table, "word_id", ["weights"], [id_col, "word_id"], written=True)
    return rows.withColumn("_group", F.pmod(F.xxhash64(id_col), F.lit(groups)))


@dataclass
class WordTopics:
    """``table`` is written: ``word_id, weights`` (one number a topic); ``totals`` are their sums. ``bounds`` and ``rounds`` have a
    value for each pass: the variational bound after it, and the mean number of rounds inside a document."""

    words: Dictionary
    table: DataFrame
    totals: np.ndarray
    alpha: float
    eta: float
    iterations: int
    bounds: list[float] = field(default_factory=list)
    rounds: list[float] = field(default_factory=list)
    model_bytes: int = MODEL_BYTES

    @property
    def num_topics(self) -> int:
        return len(self.totals)

    def document_weights(self, df: DataFrame, id_col: str, col: str, out: str = "weights") -> DataFrame:
        """``(id, out)``: the topic weights of every document of ``df`` (unique on ``id_col``); ``alpha`` each without a known word."""
        vectors = self.words.transform(df.select(id_col, col), id_col, col, "_v").select(id_col, "_v")
        kind = T.ArrayType(T.DoubleType())
        alpha, iterations, totals = self.alpha, self.iterations, self.totals
        if _fits(self.words.size, self.num_topics, self.model_bytes):
            matrix = word_weights(_matrix(self.table, self.words.size, self.num_topics), totals)
            shared = df.sparkSession.sparkContext.broadcast(matrix)

            def weigh(column: pa.Array) -> list:
                return infer(*linear.sparse_rows(column), shared.value, alpha, iterations, leaps=True)[0].tolist()

            return with_batch_column(vectors, [id_col], F.col("_v"), out, kind, weigh)
        vectors = materialise(vectors)
        met = _met(_entries(vectors, id_col, "_v"), id_col, self.table)

        def weigh_group(group: pa.Table) -> pa.Table:
            ids, first, order = _documents(group, id_col)
            matrix = word_weights(_numbers(group["weights"], len(totals))[order], totals)
            value = np.asarray(group["value"])[order]
            gamma, _ = infer(first, np.arange(len(value)), value, matrix, alpha, iterations, leaps=True)
            return pa.table({id_col: ids, out: pa.array(gamma.tolist(), pa.list_(pa.float64()))})

        schema = T.StructType([df.schema[id_col], T.StructField(out, kind)])
        found = met.groupBy("_group").applyInArrow(weigh_group, schema)
        rows = vectors.select(F.col(id_col).alias("_id")).join(found, F.col("_id").eqNullSafe(F.col(id_col)), "left")
        none = F.array_repeat(F.lit(alpha), len(totals))
        return rows.select(F.col("_id").alias(id_col), F.coalesce(out, none).alias(out))

    def topic_distribution(self, df: DataFrame, id_col: str, col: str, out: str = "topics") -> DataFrame:
        """``(id, out)``: the shares of the topics, which add up to 1."""
        weights = self.document_weights(df, id_col, col, out)
        return weights.withColumn(out, F.transform(out, lambda v: v / F.aggregate(out, F.lit(0.0), lambda a, x: a + x)))

    def phi(self) -> DataFrame:
        """``(topic, term, p)``, every term of every topic."""
        totals = F.array(*[F.lit(float(t)) for t in self.totals])
        rows = self.table.join(self.words.table.select("word_id", F.col("token").alias("term")), "word_id")
        rows = rows.select("term", F.posexplode("weights").alias("topic", "_w"))
        return rows.select("topic", "term", (F.col("_w") / F.get(totals, F.col("topic"))).alias("p"))

    def topic_terms(self, n: int = 10, cells: int = 64) -> DataFrame:
        """``(topic, rank, term, share)`` of the ``n`` best terms; equal shares by term. Ranked in cells of a topic first."""
        order = [F.desc("p"), F.asc("term")]
        cell = F.pmod(F.xxhash64("term"), F.lit(cells))
        first = self.phi().withColumn("_r", F.row_number().over(W.partitionBy("topic", cell).orderBy(*order))).where(F.col("_r") <= n)
        ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("topic").orderBy(*order)))
        return ranked.where(F.col("rank") <= n).select("topic", "rank", "term", F.col("p").alias("share"))

    def save(self, path: str) -> None:
        self.words.save(f"{path}/dictionary")
        self.table.write.mode("overwrite").parquet(f"{path}/weights")
        about = [([float(x) for x in self.totals], self.alpha, self.eta, self.iterations, self.bounds, self.rounds)]
        kind = "totals array<double>, alpha double, eta double, iterations int, bounds array<double>, rounds array<double>"
        self.table.sparkSession.createDataFrame(about, kind).coalesce(1).write.mode("overwrite").parquet(f"{path}/topics")

    @staticmethod
    def load(spark: SparkSession, path: str) -> WordTopics:
        a = spark.read.parquet(f"{path}/topics").first()
        return WordTopics(Dictionary.load(spark, f"{path}/dictionary"), spark.read.parquet(f"{path}/weights"),
                          np.array(a.totals), a.alpha, a.eta, a.iterations, list(a.bounds), list(a.rounds))


def _fits(words: int, num_topics: int, model_bytes: int) -> bool:
    return words * num_topics * 8 <= model_bytes


def _matrix(table: DataFrame, words: int, num_topics: int) -> np.ndarray:
    """The table as a matrix; callers have checked its size."""
    found = table.toArrow()
    out = np.zeros((words, num_topics))
    if found.num_rows:
        out[np.asarray(found["word_id"])] = _numbers(found["weights"], num_topics)
    return out


def _table(spark: SparkSession, matrix: np.ndarray) -> DataFrame:
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]), pa.array(matrix.ravel()))
    made = pa.table({"word_id": pa.array(np.arange(len(matrix), dtype=np.int32)), "weights": lists})
    return materialise(spark.createDataFrame(made, "word_id int, weights array<double>"))


def _totals(table: DataFrame, num_topics: int) -> np.ndarray:
    rows = table.select(F.posexplode("weights").alias("topic", "w")).groupBy("topic").agg(F.sum("w").alias("w")).collect()
    out = np.zeros(num_topics)
    for r in rows:
        out[r.topic] = r.w
    return out


def _prior_bound(weights: np.ndarray, totals: np.ndarray, eta: float) -> float:
    """The part of the bound that adds up over words."""
    return float(((eta - weights) * (digamma(weights) - digamma(totals)) + log_gamma(weights) - log_gamma(eta)).sum())


def _topics_bound(parts: float, totals: np.ndarray, words: int, eta: float) -> float:
    return parts + float((log_gamma(words * eta) - log_gamma(totals)).sum()) if words else 0.0


def start_weights(word_id: Column, num_topics: int, seed: int) -> Column:
    """Weights around 1 with a deviation of 0.1, from a hash of the word and the topic."""
    spread = 0.1 * math.sqrt(12)
    cells = 1 << 30
    return F.transform(
        F.sequence(F.lit(0), F.lit(num_topics - 1)),
        lambda k: 1.0 + spread * (F.pmod(F.xxhash64(F.lit(seed), word_id, k), F.lit(cells)) / float(cells) - 0.5),
    )


class _Sent:
    """Weights as a matrix that each step sends."""

    def __init__(self, chunks: list[DataFrame], table: DataFrame, words: int, num_topics: int):
        self.chunks = [linear.row_blocks(c, "_v") for c in chunks]
        self.spark = table.sparkSession
        self.weights = _matrix(table, words, num_topics)

    def totals(self) -> np.ndarray:
        return self.weights.sum(axis=0)

    def step(self, chunk: int, alpha: float, iterations: int, move) -> list[float]:
        matrix = word_weights(self.weights, self.totals())

        def one(block, sent, total, rest):
            rest[0] += statistics(block.first, block.feature, block.value, sent, alpha, iterations, total, leaps=True)

        sums, about = linear.summed(self.chunks[chunk], matrix.shape, (1, 3), one, matrix)
        self.weights = move(self.weights, matrix * sums, about[0, 0])
        return about[0].tolist()

    def prior(self, eta: float) -> float:
        return _prior_bound(self.weights, self.totals(), eta)

    def table(self) -> DataFrame:
        return _table(self.spark, self.weights)


class _LookedUp:
    """Weights as a table that each step joins and writes anew."""

    def __init__(self, chunks: list[DataFrame], table: DataFrame, words: int, num_topics: int):
        self.chunks = [(c, c.count()) for c in chunks]
        self.now, self.num_topics = table, num_topics

    def totals(self) -> np.ndarray:
        return _totals(self.now, self.num_topics)

    def step(self, chunk: int, alpha: float, iterations: int, move) -> list[float]:
        totals, (rows, documents) = self.totals(), self.chunks[chunk]
        met = _met(_entries(rows, "_doc", "_v"), "_doc", self.now)

        def sums_of(group: pa.Table) -> pa.Table:
            _, first, order = _documents(group, "_doc")
            word, place = np.unique(np.asarray(group["word_id"])[order], return_inverse=True)
            matrix = np.zeros((len(word), len(totals)))
            matrix[place] = word_weights(_numbers(group["weights"], len(totals))[order], totals)
            out = np.zeros_like(matrix)
            about = statistics(first, place, np.asarray(group["value"])[order], matrix, alpha, iterations, out, leaps=True)
            kind = pa.list_(pa.float64())
            return pa.table({
                "word_id": pa.array([*word.tolist(), None], pa.int32()),
                "sums": pa.array([*(out * matrix).tolist(), [0.0] * len(totals)], kind),
                "about": pa.array([[0.0] * 3] * len(word) + [about], kind),
            })

        found = materialise(met.groupBy("_group").applyInArrow(sums_of, _SUMS))
        about = found.where("word_id is null").agg(*[F.sum(F.col("about")[j]).alias(f"a{j}") for j in range(3)]).first()
        summed = found.where("word_id is not null").groupBy("word_id").agg(Summarizer.sum(array_to_vector("sums")).alias("_s"))
        joined = self.now.join(summed.select("word_id", vector_to_array("_s").alias("_s")), "word_id", "left")
        zeros = F.array_repeat(F.lit(0.0), self.num_topics)
        moved = F.transform(F.arrays_zip("weights", F.coalesce("_s", zeros).alias("_s")), lambda p: move(p["weights"], p["_s"], float(documents)))
        self.now = materialise(joined.select("word_id", moved.alias("weights")))
        # A document without words adds nothing to the sums or the bound.
        return [float(documents), about.a1 or 0.0, about.a2 or 0.0]

    def prior(self, eta: float) -> float:
        totals = self.totals()

        def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = np.asarray(batch["weights"].flatten(), dtype=float).reshape(-1, len(totals))
                yield pa.RecordBatch.from_arrays([pa.array([_prior_bound(rows, totals, eta)])], names=["part"])

        return self.now.select("weights").mapInArrow(parts, "part double").agg(F.sum("part")).first()[0] or 0.0

    def table(self) -> DataFrame:
        return self.now


def fit_word_topics(
    train: DataFrame, col: str, num_topics: int = 10, passes: int = 20, chunk_size: int | None = 2000, iterations: int = 400,
    seed: int = 42, vocab_size: int | None = None, decay: float = 0.5, offset: float = 1.0, model_bytes: int = MODEL_BYTES,
) -> WordTopics:
    """M6. Priors are ``1 / num_topics`` for topics in documents and for words in topics. A chunk has about ``chunk_size`` documents,
    but at least ``LEAST_SHARE`` of them, and all of them for None. Null and empty lists are documents without words. An empty table
    gives a model without words, which weighs all topics alike."""
    alpha = eta = 1 / num_topics
    words = fit_dictionary(train, col, vocab_size=vocab_size)
    # The number of a document is written with it, so a retry cannot deal the documents anew.
    rows = materialise(train.select(F.monotonically_increasing_id().alias("_doc"), F.col(col).alias("_tokens")))
    documents = rows.count()
    share = 1.0 if chunk_size is None or not documents else min(1.0, max(chunk_size / documents, LEAST_SHARE))
    number = math.ceil(1 / share)
    path = scratch_path(train.sparkSession, "chunks")
    chunk = F.pmod(F.xxhash64(F.lit(seed), "_doc"), F.lit(number)).cast("int")
    vectors = words.transform(rows, "_doc", "_tokens", "_v").select("_doc", "_v", chunk.alias("_chunk"))
    vectors.write.partitionBy("_chunk").parquet(path)
    dealt = train.sparkSession.read.schema(vectors.schema).parquet(path)
    chunks = [dealt.where(F.col("_chunk") == c) for c in range(number)]

    table = materialise(words.table.select("word_id", start_weights(F.col("word_id"), num_topics, seed).alias("weights")))
    way = (_Sent if _fits(words.size, num_topics, model_bytes) else _LookedUp)(chunks, table, words.size, num_topics)
    bounds, rounds, steps = [], [], 0
    for _ in range(passes if words.size else 0):
        bound = taken = 0.0
        for c in range(number):
            rate = (offset + steps) ** -decay

            def move(weight, sums, seen, rate=rate):
                return (1 - rate) * weight + rate * (eta + documents / seen * sums) if seen else weight

            # The bound of the weights that the step starts from, over the documents of its chunk.
            before = _topics_bound(way.prior(eta), way.totals(), words.size, eta) if c == 0 else before  # noqa: F821
            seen, part, used = way.step(c, alpha, iterations, move)
            bound, taken, steps = bound + part, taken + used, steps + bool(seen)
        bounds.append(bound + before)
        rounds.append(taken / documents)
    return WordTopics(words, way.table(), way.totals(), alpha, eta, iterations, bounds, rounds, model_bytes)
