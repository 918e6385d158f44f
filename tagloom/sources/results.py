"""Run results, models and cached embeddings as tables.

Results of all runs share one table partitioned by run, so reading one run prunes to its
folder and rewriting it leaves the others alone.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.relevance import TagModel


def save_results(df: DataFrame, path: str, run: str) -> None:
    """S4."""
    (
        df.withColumn("run", F.lit(run))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run")
        .parquet(path)
    )


def load_results(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """One run, or all."""
    df = spark.read.parquet(path)
    return df if run is None else df.where(F.col("run") == run)


def save_model(spark: SparkSession, path: str, name: str, vectorizer: PipelineModel, model: TagModel) -> None:
    """The parts needed for serving: vectoriser, weights with their tag names, run name."""
    vectorizer.write().overwrite().save(f"{path}/vectorizer")
    model.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/tags")
    meta = spark.createDataFrame([(json.dumps({"name": name, "loss": model.loss}),)], "value string")
    meta.coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load_model(spark: SparkSession, path: str) -> tuple[str, PipelineModel, TagModel]:
    about = json.loads(spark.read.text(f"{path}/about").first().value)
    tags = spark.read.parquet(f"{path}/tags")
    return about["name"], PipelineModel.load(f"{path}/vectorizer"), TagModel.from_frame(tags, about["loss"])


def save_embeddings(df: DataFrame, path: str) -> None:
    """``(Id, embedding, ...)``."""
    df.write.mode("overwrite").parquet(path)


def load_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
