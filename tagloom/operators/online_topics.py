"""M6 for many documents: the steps of Spark's online LDA, each over its own chunk of the rows.

Spark's trainer goes through all rows in each step to draw its share of them, and infers one document at a time. Here the rows are
dealt to chunks once, a step reads one chunk, and documents are inferred side by side (``word_topics.infer``). Priors, step sizes and
the fitted prior of the documents are those of Spark's trainer; inference ends by its threshold alone, with leaps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators import linear
from tagloom.operators.batches import with_batch_column
from tagloom.operators.word_topics import _added, _shares, digamma, infer, word_weights
from tagloom.session import scratch_path

OFFSET, DECAY = 1024, 0.51  # of Spark's trainer
NO_BOUND = 1 << 40
BLOCK_NUMBERS = 500_000  # documents that are inferred side by side come from one block


def trigamma(x: np.ndarray) -> np.ndarray:
    """By its series at ``x + 6`` and the recurrence down to ``x`` > 0."""
    y = x + 6
    r = 1 / (y * y)
    return 1 / y + r / 2 + r / y * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r / 30))) + sum(1 / (x + j) ** 2 for j in range(6))


def moved_prior(alpha: np.ndarray, logs: np.ndarray, documents: float, rate: float) -> np.ndarray:
    """A Newton step of the documents' prior towards the mean ``logs`` of their log shares; left alone where it would not stay above 0."""
    gradient = documents * (logs - digamma(alpha) + digamma(alpha.sum()))
    c, q = documents * trigamma(alpha.sum()), -documents * trigamma(alpha)
    b = (gradient / q).sum() / (1 / c + (1 / q).sum())
    made = alpha - rate * (gradient - b) / q
    return made if (made > 0).all() else alpha


@dataclass
class OnlineTopics:
    """Weights of words (rows) in topics (columns) and the prior of the topics in a document; both lie on the driver."""

    weights: np.ndarray
    alpha: np.ndarray

    def getK(self) -> int:  # noqa: N802
        return len(self.alpha)

    def topicsMatrix(self) -> DenseMatrix:  # noqa: N802
        return DenseMatrix(*self.weights.shape, self.weights.ravel(order="F"))

    def shares(self, df: DataFrame, keep: list[str], counts: str, out: str) -> DataFrame:
        """The columns ``keep`` and the topic shares of count vectors; a document without words has no share in any topic."""
        sent = df.sparkSession.sparkContext.broadcast((word_weights(self.weights, self.weights.sum(axis=0)), self.alpha))

        def share(vectors: pa.Array) -> list:
            first, feature, value = linear.sparse_rows(vectors)
            gamma, _ = infer(first, feature, value, *sent.value, NO_BOUND, leaps=True)
            found = gamma / gamma.sum(axis=1, keepdims=True)
            found[np.diff(first) == 0] = 0
            return found.tolist()

        return with_batch_column(df, keep, F.col(counts), out, T.ArrayType(T.DoubleType()), share)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = pa.table({"word_id": np.arange(len(self.weights)), "weights": pa.array(list(self.weights), pa.list_(pa.float64()))})
        spark.createDataFrame(rows, "word_id long, weights array<double>").write.mode("overwrite").parquet(f"{path}/weights")
        about = spark.createDataFrame([(self.alpha.tolist(),)], "alpha array<double>")
        about.coalesce(1).write.mode("overwrite").parquet(f"{path}/alpha")

    @staticmethod
    def load(spark: SparkSession, path: str) -> OnlineTopics:
        alpha = np.array(spark.read.parquet(f"{path}/alpha").first().alpha)
        found = spark.read.parquet(f"{path}/weights").toArrow()
        weights = np.zeros((found.num_rows, len(alpha)))
        weights[np.asarray(found["word_id"])] = np.asarray(found["weights"].combine_chunks().flatten()).reshape(-1, len(alpha))
        return OnlineTopics(weights, alpha)


def fit_online(counts: DataFrame, col: str, num_topics: int, passes: int, chunks: int, seed: int) -> OnlineTopics:
    """``counts`` is written and not empty. Each row is seen ``passes`` times."""
    width, documents = linear.width_of(counts, col), counts.count()
    path = scratch_path(counts.sparkSession, "chunks")
    # The number of a row's chunk is written with it, so a retry cannot deal the rows anew.
    chunk = F.pmod(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), F.lit(chunks)).cast("int")
    dealt = counts.select(col, chunk.alias("_chunk"))
    dealt.write.partitionBy("_chunk").parquet(path)
    dealt = counts.sparkSession.read.schema(dealt.schema).parquet(path)
    blocks = [linear.row_blocks(dealt.where(F.col("_chunk") == c), col, numbers=BLOCK_NUMBERS) for c in range(chunks)]

    def one(block: linear.Block, sent, out: np.ndarray, rest: np.ndarray) -> None:
        gamma, _ = infer(block.first, block.feature, block.value, *sent, NO_BOUND, leaps=True)
        row = np.repeat(np.arange(block.rows), np.diff(block.first))
        order = np.argsort(block.feature, kind="stable")
        feature = block.feature[order]
        _added(feature, block.value[order], row[order], _shares(gamma), sent[0], feature, out)
        known = gamma[np.diff(block.first) > 0]
        rest[0] += [*(digamma(known) - digamma(known.sum(axis=1))[:, None]).sum(axis=0), len(known), block.rows]

    alpha, eta = np.full(num_topics, 1 / num_topics), 1 / num_topics
    weights = np.random.default_rng(seed).gamma(100, 1 / 100, (width, num_topics))
    for step in range(passes * chunks):
        matrix = word_weights(weights, weights.sum(axis=0))
        sums, rest = linear.summed(blocks[step % chunks], matrix.shape, (1, num_topics + 2), one, (matrix, alpha))
        known, seen = rest[0, -2:]
        if not known:
            continue
        rate = (OFFSET + step + 1) ** -DECAY
        weights = (1 - rate) * weights + rate * (eta + documents / seen * matrix * sums)
        alpha = moved_prior(alpha, rest[0, :num_topics] / known, known, rate)
    return OnlineTopics(weights, alpha)
