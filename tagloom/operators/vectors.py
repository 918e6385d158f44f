"""F1, F2, F4-F6 with Spark ML, F10: vectors, scaling, principal components, word vectors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    IDF,
    PCA,
    CountVectorizer,
    ElementwiseProduct,
    Normalizer,
    StandardScaler,
    VectorSlicer,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators import features, linear, skipgram
from tagloom.operators.batches import with_batch_column
from tagloom.session import materialise

DENSE_FEATURES = 4096  # up to here a table of features by features is made
ALL_TOKENS = (1 << 31) - 1


def fit_vectorizer(
    train: DataFrame, col: str, kind: str = "count", out: str = "features", vocab_size: int | None = None
) -> PipelineModel:
    """count or TF-IDF vectors over ready token lists, fitted on ``train``.

    All tokens of ``train`` unless ``vocab_size`` asks for the most used ones. The fitted model holds its
    vocabulary on the driver; the long forms (``features.bow_counts``, ``features.bow_tfidf``) have no such part.
    Spark's idf lacks the added 1 and the scaling to length 1; both are added as stages.
    """
    if kind not in ("count", "tfidf"):
        raise ValueError(f"unknown vectoriser: {kind}")
    counted = out if kind == "count" else f"{out}_tf"
    counts = CountVectorizer(inputCol=col, outputCol=counted, vocabSize=vocab_size or ALL_TOKENS, minDF=1.0).fit(train)
    if kind == "count":
        return PipelineModel([counts])
    idf = IDF(inputCol=counted, outputCol="idf").fit(counts.transform(train))
    weigh = ElementwiseProduct(
        scalingVec=Vectors.dense(idf.idf.toArray() + 1.0), inputCol=counted, outputCol=f"{out}_raw"
    )
    return PipelineModel([counts, weigh, Normalizer(p=2.0, inputCol=f"{out}_raw", outputCol=out)])


def fit_scaler(df: DataFrame, col: str, out: str) -> PipelineModel:
    """centred, divided by the population standard deviation. The rows become dense; what fits or projects them can do
    without (``linear.Moments``)."""
    width = linear.width_of(df, col)
    rows = df.count()
    scaler = StandardScaler(withMean=True, withStd=True, inputCol=col, outputCol=f"{out}_sample").fit(df)
    factor = (rows / (rows - 1)) ** 0.5 if rows > 1 else 1.0
    population = ElementwiseProduct(
        scalingVec=Vectors.dense([factor] * width), inputCol=f"{out}_sample", outputCol=out
    )
    return PipelineModel([scaler, population])


def fit_pca(df: DataFrame, col: str, out: str, max_components: int | None = None) -> PipelineModel:
    """Standardise by the population deviation (F4), then principal components, from a table of features by features."""
    width = linear.width_of(df, col)
    scaler = fit_scaler(df, col, f"{out}_scaled")
    pca = PCA(k=min(width, max_components or width), inputCol=f"{out}_scaled", outputCol=out)
    return PipelineModel([*scaler.stages, pca.fit(scaler.transform(df))])


@dataclass
class Components:
    """Principal components for raw vectors: ``x weights + constants``, the same as those of the standardised vectors, which need
    not be made dense for it. ``shares`` are the components' shares of the variance, ``axes`` the orthonormal directions."""

    col: str
    out: str
    axes: np.ndarray
    weights: np.ndarray
    constants: np.ndarray
    shares: np.ndarray

    def transform(self, df: DataFrame) -> DataFrame:
        """All other columns that are no vectors, and the components as a vector."""
        sent = df.sparkSession.sparkContext.broadcast((self.weights, self.constants))

        def project(x: pa.Array) -> list:
            weights, constants = sent.value
            first, feature, value = linear.sparse_rows(x)
            return list(linear.Block(first, feature, value, feature[:0], feature[:0]).times(weights) + constants)

        plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, VectorUDT)]
        made = with_batch_column(df, plain, F.col(self.col), self.out, T.ArrayType(T.DoubleType()), project)
        return made.withColumn(self.out, array_to_vector(self.out))


def wide_components(df: DataFrame, col: str, out: str, most: int | None = None, level: float | None = None) -> Components:
    """F5, F6 for any number of features: the leading components of the sparse rows, found without a table of features by features.
    ``axes`` has features times components numbers; ``most`` or ``level`` bound how many are found."""
    width = linear.width_of(df, col)
    blocks = linear.row_blocks(df, col)
    stats = linear.moments(blocks, width)
    axes, shares = linear.principal_components(blocks, width, stats, most or width, level)
    return Components(col, out, axes, *stats.weights(axes), shares)


def components_below(explained: list[float], level: float) -> int:
    """Leading components while the cumulative explained variance stays below ``level``;
    the one that crosses it is not counted, so the result can be 0."""
    total, n = 0.0, 0
    for share in explained:
        total += share
        if not total < level:
            break
        n += 1
    return n


def pca_select(df: DataFrame, col: str, out: str, level: float = 0.8) -> tuple[PipelineModel | Components | None, int]:
    """what keeps the leading components (both kinds have ``transform``), and how many it keeps.
    None when not even the first component stays below ``level``: there is nothing to keep."""
    if linear.width_of(df, col) > DENSE_FEATURES:
        found = wide_components(df, col, out, level=level)
        kept = components_below(found.shares.tolist(), level)
        if kept == 0:
            return None, 0
        return Components(col, out, found.axes[:, :kept], found.weights[:, :kept], found.constants[:kept], found.shares[:kept]), kept
    fitted = fit_pca(df, col, f"{out}_all")
    kept = components_below(list(fitted.stages[-1].explainedVariance), level)
    if kept == 0:
        return None, 0
    slicer = VectorSlicer(inputCol=f"{out}_all", outputCol=out, indices=list(range(kept)))
    return PipelineModel([*fitted.stages, slicer]), kept


def scree_table(df: DataFrame, col: str, step: int = 5, include_last: bool = False, most: int | None = None) -> DataFrame:
    """cumulative explained variance (%) at every ``step``-th axis, of ``most`` axes if given."""
    if linear.width_of(df, col) > DENSE_FEATURES:
        explained = wide_components(df, col, "_pca", most).shares.tolist()
    else:
        explained = [float(x) for x in fit_pca(df, col, "_pca", most).stages[-1].explainedVariance]
    spark = df.sparkSession
    axes = spark.createDataFrame(list(enumerate(explained)), "axis int, share double")
    # One row per axis, as many as the model on the driver has.
    total = F.sum(F.col("share") * 100).over(W.orderBy("axis").rowsBetween(W.unboundedPreceding, 0))
    keep = F.col("axis") % step == 0
    if include_last:
        keep = keep | (F.col("axis") == len(explained) - 1)
    return axes.select("axis", total.alias("cumulative_percent")).where(keep)


def fit_word_vectors(
    df: DataFrame, id_col: str, col: str, dim: int = 128, vocab_size: int = 4096, sequence_length: int | None = None,
    window: int = 2, epochs: int = 20, seed: int = 42, partitions: int | None = None,
) -> skipgram.WordVectors:
    """skip-gram word vectors over the ``vocab_size`` most used words, from whole texts unless
    ``sequence_length`` cuts them. The texts are read once for the vocabulary and once for the counted pairs; an epoch is
    ``skipgram.STEPS`` steps over all of these, whose number the vocabulary bounds. ``partitions``: blocks of words that a step
    works on side by side."""
    top = materialise(features.vocabulary_ids(df, col, vocab_size + 2))
    size = top.count()
    ids = features.encode_sequences(df, id_col, col, vocab_size + 2, None, top)
    # Words out of the vocabulary are left out, those on both sides then stand side by side.
    words = F.filter("sequence", lambda w: w > features.UNKNOWN)
    words = F.transform(F.slice(words, 1, sequence_length) if sequence_length else words, lambda w: w - features.UNKNOWN - 1)
    pairs = materialise(skipgram.count_pairs(ids.select(words.alias("_ids")), "_ids", size, window))
    used = pairs.where(F.col("b") == size).join(top, F.col("a") + features.UNKNOWN + 1 == F.col("word_id"))
    used = used.orderBy("a").select("a", "token", "n").collect()  # at most one row a word
    counts = np.zeros(size, np.int64)
    counts[[r.a for r in used]] = [r.n for r in used]
    blocks = skipgram.pair_blocks(pairs, size, window, partitions or skipgram.BLOCKS)
    found, losses = skipgram.train(blocks, counts, dim, epochs * skipgram.STEPS, seed)
    return skipgram.WordVectors([r.token for r in used], found[[r.a for r in used]], losses)


def word_vectors(model: skipgram.WordVectors) -> DataFrame:
    """``(word, vector)``."""
    rows = [(w, v.tolist()) for w, v in zip(model.words, model.vectors, strict=True)]
    return SparkSession.active().createDataFrame(rows, "word string, vector array<float>")
