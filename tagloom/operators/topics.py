"""LDA topics and the terms they predict."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.errors import AnalysisException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.arrays import let, unfolded
from tagloom.operators.batches import matrix, with_batch_column
from tagloom.operators.online_topics import OnlineTopics, fit_online
from tagloom.operators.vectors import ALL_TOKENS
from tagloom.operators.word_topics import LEAST_SHARE
from tagloom.session import materialise

DEFAULT_P = 0.95
TOPIC_FLOOR = 0.01
ONE_TRAINER = 2000  # rows up to which Spark's trainer goes through all of them in each step
CELLS = 1_000_000  # score matrix cells that one prediction step holds

TERMS_TYPE = T.ArrayType(
    T.StructType([T.StructField("term", T.StringType()), T.StructField("prob", T.DoubleType())])
)


@dataclass
class TopicModel:
    vectorizer: CountVectorizerModel
    lda: LDAModel | OnlineTopics

    @property
    def terms(self) -> list[str]:
        return self.vectorizer.vocabulary

    @property
    def num_topics(self) -> int:
        return self.lda.getK()

    def phi(self) -> np.ndarray:
        """Topics by terms; Spark's matrix is not normalised, this one is."""
        weights = self.lda.topicsMatrix().toArray().T
        return weights / weights.sum(axis=1, keepdims=True)

    def save(self, path: str) -> None:
        self.vectorizer.write().overwrite().save(f"{path}/vectorizer")
        spark, online = SparkSession.getActiveSession(), isinstance(self.lda, OnlineTopics)
        if online:
            self.lda.save(spark, f"{path}/online")
        else:
            self.lda.write().overwrite().save(f"{path}/lda")
        spark.createDataFrame([(online,)], "online boolean").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @staticmethod
    def load(path: str) -> TopicModel:
        from pyspark.ml.clustering import LocalLDAModel

        spark = SparkSession.getActiveSession()
        try:
            online = spark.read.parquet(f"{path}/about").first().online
        except AnalysisException:  # saved before there were two kinds
            online = False
        lda = OnlineTopics.load(spark, f"{path}/online") if online else LocalLDAModel.load(f"{path}/lda")
        return TopicModel(CountVectorizerModel.load(f"{path}/vectorizer"), lda)


def fit_topics(
    train: DataFrame, col: str, num_topics: int = 10, passes: int = 20, chunk_size: int = 2000,
    seed: int = 42, vocab_size: int | None = None,
) -> TopicModel:
    """M6: online LDA. Every document is seen ``passes`` times, in expectation where Spark's trainer draws them (``ONE_TRAINER`` rows
    or fewer); with more rows they are dealt to chunks, and a step reads one (``online_topics``).

    A step sees about ``chunk_size`` documents, but at least ``LEAST_SHARE`` of the corpus, so the number
    of steps does not grow with it. The inference inside a document (bounded by ``iterations`` elsewhere) ends by
    its threshold. All tokens are used unless ``vocab_size`` asks for the most used ones.
    """
    vectorizer = CountVectorizer(inputCol=col, outputCol="counts", vocabSize=vocab_size or ALL_TOKENS).fit(train)
    counts = materialise(vectorizer.transform(train).select("counts"))
    rows = max(counts.count(), 1)
    share = min(1.0, max(chunk_size / rows, LEAST_SHARE))
    if rows > ONE_TRAINER:
        return TopicModel(vectorizer, fit_online(counts, "counts", num_topics, passes, math.ceil(1 / share), seed))
    steps = math.ceil(passes / share)
    lda = LDA(
        k=num_topics, featuresCol="counts", optimizer="online", maxIter=steps,
        subsamplingRate=share, seed=seed,
    ).fit(counts)
    return TopicModel(vectorizer, lda)


def topic_distribution(df: DataFrame, model: TopicModel, out: str = "topics") -> DataFrame:
    """Per-document topic shares."""
    counted = model.vectorizer.transform(df)
    if isinstance(model.lda, OnlineTopics):
        return model.lda.shares(counted, df.columns, "counts", out)
    scored = model.lda.transform(counted)
    return scored.withColumn(out, vector_to_array("topicDistribution")).drop("counts", "topicDistribution")


def check_predict(
    num_topics: int, num_terms: int, p_topic=None, n_topic=None, p_term=None, n_term=None
) -> tuple:
    """M9: at most one rule each; values out of bounds are pulled in; defaults."""
    if p_topic is not None and n_topic is not None:
        raise ValueError("p_topic and n_topic are both set")
    if p_term is not None and n_term is not None:
        raise ValueError("p_term and n_term are both set")
    p_topic = DEFAULT_P if p_topic is not None and p_topic > 1.0 else p_topic
    p_term = DEFAULT_P if p_term is not None and p_term > 1.0 else p_term
    n_topic = num_topics if n_topic is not None and n_topic > num_topics else n_topic
    n_term = num_terms if n_term is not None and n_term > num_terms else n_term
    if p_topic is None and n_topic is None:
        n_topic = num_topics
    if p_term is None and n_term is None:
        p_term = DEFAULT_P
    return p_topic, n_topic, p_term, n_term


def select_topics(
    topics: Column, p_topic: float | None = None, n_topic: int | None = None, floor: float | None = None
) -> Column:
    """M7: shares not above ``p_topic`` become 0, or all but the ``n_topic`` largest.
    Shares below ``floor`` count as absent."""
    if floor is not None:
        topics = F.transform(topics, lambda v: F.when(v >= floor, v).otherwise(0.0))
    if p_topic is not None:
        return F.transform(topics, lambda v: F.when(v > p_topic, v).otherwise(0.0))
    if n_topic is None:
        return topics

    def largest(bound: Column) -> Column:
        ranked = F.sort_array(
            F.transform(bound, lambda v, k: F.struct(v.alias("v"), (-k).alias("k"))), asc=False
        )
        kept = F.transform(F.slice(ranked, 1, n_topic), lambda s: -s["k"])
        return let(
            kept,
            lambda ids: F.transform(
                bound, lambda v, k: F.when(F.array_contains(ids, k), v).otherwise(0.0)
            ),
        )

    return let(topics, largest)


def predict_terms(
    df: DataFrame, topics: str, phi: np.ndarray, terms: Sequence[str],
    p_term: float | None = None, n_term: int | None = None, out: str = "terms",
) -> DataFrame:
    """M8: term probability = sum over topics of topic share times term share; the
    ``n_term`` best, ascending, or all with at least ``p_term``.

    The joined form would hold documents x topics x vocabulary rows. Here a batch of
    topic rows meets the broadcast model in one matrix product and only the result leaves,
    with the other columns of ``df``.
    """
    shared = df.sparkSession.sparkContext.broadcast((np.asarray(phi, dtype=float), np.array(terms, dtype=object)))

    def best(scores: np.ndarray, names: np.ndarray) -> list[dict]:
        if n_term is not None:
            n = min(n_term, len(scores))
            if n == 0:
                return []
            edge = np.partition(scores, len(scores) - n)[len(scores) - n]
            above = np.flatnonzero(scores > edge)
            ties = np.flatnonzero(scores == edge)[: n - len(above)]
            chosen = np.concatenate([above, ties])
        else:
            chosen = np.flatnonzero(scores >= p_term)
        chosen = chosen[np.lexsort((-chosen, scores[chosen]))]
        return [{"term": names[j], "prob": float(scores[j])} for j in chosen]

    def terms_of(lists: pa.Array) -> list:
        weights, names = shared.value
        step = max(1, CELLS // max(1, weights.shape[1]))
        shares = matrix(lists) if len(lists) else np.zeros((0, weights.shape[0]))
        found: list = []
        for begin in range(0, len(shares), step):
            found.extend(best(row, names) for row in shares[begin : begin + step] @ weights)
        return found

    kept = [c for c in df.columns if c != topics]
    return with_batch_column(df, kept, F.col(topics), out, TERMS_TYPE, terms_of)


def predict(
    df: DataFrame, model: TopicModel, p_topic=None, n_topic=None, p_term=None, n_term=None, out: str = "terms"
) -> DataFrame:
    """M7 + M8, M17: terms for token lists. With the default rules a term must hold 95 %
    of the mass, so most results are empty."""
    p_topic, n_topic, p_term, n_term = check_predict(
        model.num_topics, len(model.terms), p_topic, n_topic, p_term, n_term
    )
    shares = topic_distribution(df, model, "_topics")
    chosen = shares.withColumn("_topics", select_topics(F.col("_topics"), p_topic, n_topic, TOPIC_FLOOR))
    return predict_terms(chosen, "_topics", model.phi(), model.terms, p_term, n_term, out)


def topic_terms(model: TopicModel, n: int = 10) -> DataFrame:
    """``(topic, rank, term, share)`` of the n best terms."""
    spark = SparkSession.getActiveSession()
    phi, terms = model.phi(), model.terms
    rows = []
    for topic, shares in enumerate(phi):
        for rank, j in enumerate(np.lexsort((np.arange(len(shares)), -shares))[:n]):
            rows.append((topic, rank + 1, terms[j], float(shares[j])))
    return spark.createDataFrame(rows, "topic int, rank int, term string, share double")


def topic_shares(df: DataFrame, topics: str) -> DataFrame:
    """Mean share of every topic over the documents."""
    return (
        df.select(F.posexplode(unfolded(topics)).alias("topic", "share"))
        .groupBy("topic")
        .agg(F.avg("share").alias("share"))
    )


def topic_distances(phi: DataFrame) -> DataFrame:
    """Jensen-Shannon divergence between topics from ``(topic, term, p)``.

    Joined on the term, so the work is terms x topics x topics and no pair of rows meets
    that does not share a term. Terms missing on one side are absent from the join; their
    part is what is left of each topic's mass, times ln 2. The result has one row for every
    pair of topics, also for pairs without a common term; a model has few topics.
    """
    names = phi.agg(F.array_sort(F.collect_set("topic")).alias("names"))
    first = names.select("names", F.explode("names").alias("topic_a"))
    every = first.select("topic_a", F.explode("names").alias("topic_b")).where("topic_a < topic_b")
    left = phi.select("term", F.col("topic").alias("topic_a"), F.col("p").alias("a"))
    right = phi.select("term", F.col("topic").alias("topic_b"), F.col("p").alias("b"))
    pairs = left.join(right, "term").where("topic_a < topic_b")
    middle = (F.col("a") + F.col("b")) / 2

    def part(x: str) -> Column:
        return F.when(F.col(x) > 0, F.col(x) * F.log(F.col(x) / middle)).otherwise(0.0)

    sums = pairs.groupBy("topic_a", "topic_b").agg(
        F.sum((part("a") + part("b")) / 2).alias("shared"), F.sum(F.col("a") + F.col("b")).alias("mass")
    )
    alone = (2.0 - F.coalesce("mass", F.lit(0.0))) / 2 * F.log(F.lit(2.0))
    return every.join(sums, ["topic_a", "topic_b"], "left").select(
        "topic_a", "topic_b", (F.coalesce("shared", F.lit(0.0)) + alone).alias("js_divergence")
    )
