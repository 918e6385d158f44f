"""One linear classifier per tag over shared features, all tags fitted together.

Squared error: with few features one pass adds up the products of the features with themselves and with the labels, and the small
system is solved once for all tags; with more it is solved by conjugate gradients, one pass a step. Hinge loss: a quasi-Newton method
whose passes serve all tags, stopped by its duality gap. Features may stay sparse; they can be standardised without being made dense.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators import linear
from tagloom.operators.batches import matrix, with_batch_column
from tagloom.operators.vectors import DENSE_FEATURES

LOSSES = ("squared_error", "hinge")
PENALTY = 1e-4
MAX_ITER = 5000
GAP = 1e-2  # duality gap at which a hinge fit is done; without weights the mean loss is 1
ROWS_OUT = 256  # matrix rows per Arrow batch that a task emits


@dataclass
class TagModel:
    """Weights per tag (columns follow ``classes``), a constant per tag, and the names of the tags. ``gaps``: how far the value
    of a hinge fit may be from the least one."""

    classes: list[str]
    weights: np.ndarray
    loss: str
    constants: np.ndarray | None = None
    gaps: np.ndarray | None = None

    def __post_init__(self):
        if self.constants is None:
            self.constants = np.zeros(len(self.classes))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(tag, [float(x) for x in self.weights[:, k]], float(self.constants[k])) for k, tag in enumerate(self.classes)]
        return spark.createDataFrame(rows, "tag string, weights array<double>, constant double")

    @staticmethod
    def from_frame(df: DataFrame, loss: str) -> TagModel:
        rows = df.orderBy("tag").collect()
        return TagModel([r.tag for r in rows], np.array([r.weights for r in rows]).T, loss, np.array([r.constant for r in rows]))


def gram_rows(df: DataFrame, features: str, tags: str, classes: Sequence[str], width: int) -> DataFrame:
    """``(k, values)``: row k of [X | Y]'X, summed over all rows; Y holds +1 and -1.

    Every task adds up its own rows first, so the shuffle carries one small matrix per
    task. Tasks beyond a few per core are merged to keep their number down.
    """
    position, step = {tag: k for k, tag in enumerate(classes)}, max(1, linear.WORK_NUMBERS // max(width, 1))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + len(position), width))
        for batch in batches:
            first, feature, value = linear.sparse_rows(batch.column("x"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            y = np.full((batch.num_rows, len(position)), -1.0)
            for k, names in enumerate(batch.column("tags").to_pylist()):
                for name in names or []:
                    if name in position:
                        y[k, position[name]] = 1.0
            for a in range(0, batch.num_rows, step):  # made dense here, a few rows at a time: sparse rows travel as they are
                b = min(a + step, batch.num_rows)
                mine, x = slice(first[a], first[b]), np.zeros((b - a, width))
                x[row[mine] - a, feature[mine]] = value[mine]
                total[:width] += x.T @ x
                total[width:] += y[a:b].T @ x
        if not total.any():
            return
        for begin in range(0, len(total), ROWS_OUT):
            part = total[begin : begin + ROWS_OUT]
            ends = np.arange(0, part.size + 1, width, dtype=np.int32)
            rows = pa.ListArray.from_arrays(ends, part.ravel())
            keys = pa.array(np.arange(begin, begin + len(part)))
            yield pa.RecordBatch.from_arrays([keys, rows], names=["k", "v"])

    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    rows = df.select(F.col(features).alias("x"), F.col(tags).alias("tags")).coalesce(tasks)
    partials = rows.mapInArrow(partial, "k long, v array<double>")
    summed = partials.groupBy("k").agg(Summarizer.sum(array_to_vector("v")).alias("v"))
    return summed.select("k", vector_to_array("v").alias("values"))


def fit_squared_error(
    train: DataFrame, features: str, tags: str, classes: Sequence[str], penalty: float = PENALTY
) -> TagModel:
    """From one table of products; for at most ``DENSE_FEATURES`` features."""
    width = linear.width_of(train, features)
    rows = train.count()
    table = gram_rows(train, features, tags, classes, width).toArrow()  # at most DENSE_FEATURES rows and the tags
    total = np.zeros((width + len(classes), width))
    total[table.column("k").to_numpy()] = matrix(table.column("values").combine_chunks())
    left = total[:width] / rows + penalty * np.eye(width)
    weights = np.linalg.lstsq(left, total[width:].T / rows, rcond=None)[0]
    return TagModel(list(classes), weights, "squared_error")


def fit_tags(
    train: DataFrame, features: str, tags: str, classes: Sequence[str], loss: str = "hinge", max_iter: int = MAX_ITER,
    scale: bool = False, penalty: float = PENALTY,
) -> TagModel:
    """M1. ``train`` is written as blocks once and read by each pass. ``scale`` fits on standardised features (F4); the weights
    returned are those of the raw features, with a constant for the means. ``max_iter`` bounds the passes over the rows."""
    if loss not in LOSSES:
        raise ValueError(f"loss must be one of {LOSSES}")
    width = linear.width_of(train, features)
    if loss == "squared_error" and not scale and width <= DENSE_FEATURES:
        return fit_squared_error(train, features, tags, classes, penalty)
    blocks = linear.row_blocks(train, features, tags, classes)
    stats, gaps = linear.moments(blocks, width, scale), None
    if not stats.rows:
        return TagModel(list(classes), np.zeros((width, len(classes))), loss)
    if loss == "squared_error":
        weights = linear.solve_squared_error(blocks, width, len(classes), stats, penalty, most=max_iter)
    else:
        weights, gaps, _ = linear.solve_hinge(blocks, width, len(classes), stats, penalty, GAP, max_iter)
    return TagModel(list(classes), *_raw(weights, stats, loss), gaps)


def _raw(weights: np.ndarray, stats: linear.Moments, loss: str) -> tuple[np.ndarray, str, np.ndarray]:
    scaled, constants = stats.weights(weights)
    return scaled, loss, constants


def predict_tags(df: DataFrame, features: str, model: TagModel, out: str = "predicted") -> DataFrame:
    """Names of the tags whose score is above 0, from dense or sparse vectors. One product per Arrow batch; the weights
    travel as broadcast variables of bounded size, so many tags of many features take several rounds."""
    group = linear.group_size(len(model.weights))
    parts = [slice(a, a + group) for a in range(0, max(len(model.classes), 1), group)]
    sent = [df.sparkSession.sparkContext.broadcast((model.weights[:, p], model.constants[p])) for p in parts]
    names = np.array(model.classes, dtype=object)

    def tags_of(k: int):
        def compute(x: pa.Array) -> list:
            if not len(x):
                return []
            weights, constants = sent[k].value
            first, feature, value = linear.sparse_rows(x)
            if len(value) == len(x) * len(weights) and (np.diff(first) == len(weights)).all():
                scores = value.reshape(len(x), -1) @ weights
            else:
                scores = linear.Block(first, feature, value, feature[:0], feature[:0]).times(weights)
            return [list(names[parts[k]][row]) for row in scores + constants > 0]

        return compute

    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, VectorUDT)]
    kind = T.ArrayType(T.StringType())
    if len(parts) == 1:
        return with_batch_column(df, plain, F.col(features), out, kind, tags_of(0))
    # The vectors stay in the rows, as plain structures, until the last round.
    vector = "type tinyint, size int, indices array<int>, values array<double>"
    kept = T.StructType([*df.select(*plain).schema.fields, T.StructField("_x", T.StructType.fromDDL(vector))])
    df = df.select(*plain, F.col(features).alias("_x")).mapInArrow(lambda batches: batches, kept)
    found = [f"_tags_{k}" for k in range(len(parts))]
    for k, name in enumerate(found):
        df = with_batch_column(df, [*plain, "_x", *found[:k]], F.col("_x"), name, kind, tags_of(k))
    return df.select(*plain, F.flatten(F.array(*found)).alias(out))
