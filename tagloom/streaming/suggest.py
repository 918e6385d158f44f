"""Questions arrive, tag suggestions go out, from tags that can be refreshed and learned while the stream runs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tagloom.plans.suggest import suggest_tags

TAGS = "tokens string, doc_freq double"
VERSIONS = "version long, source string"


def question_stream(
    spark: SparkSession, path: str, schema: T.StructType, files: str | None = None,
    max_files: int | None = None, partitions: int | None = None, key: str = "Id",
) -> DataFrame:
    """New parquet files below ``path``; ``files`` is a glob, ``max_files`` bounds a batch.
    When batches are a few small files, ``partitions`` spreads them over the cores."""
    reader = spark.readStream.schema(schema)
    if files is not None:
        reader = reader.option("pathGlobFilter", files)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(path)
    return stream if partitions is None else stream.repartition(partitions, key)


@dataclass
class TagTable:
    """Known tags below ``path``, a folder that driver and executors share, in versions that never change once they are listed.

    A version's rows are written first and listed after, in a small table of ``(version, source)``, so a reader sees all of a
    version or nothing of it. One writer at a time; readers need no lock.
    """

    spark: SparkSession
    path: str

    def __post_init__(self):
        none = self.spark.createDataFrame([], VERSIONS)
        none.write.mode("append").parquet(f"{self.path}/versions")

    def _listed(self) -> DataFrame:
        return self.spark.read.schema(VERSIONS).parquet(f"{self.path}/versions")

    def version(self) -> int:
        """The latest listed version, 0 before the first."""
        return self._listed().agg(F.max("version")).first()[0] or 0

    def latest(self, before: str | None = None) -> DataFrame:
        """``(tokens, doc_freq)`` of the latest version, or of the one in front of that of source ``before`` if that is listed;
        no rows before the first."""
        mine = self._listed().where(F.col("source") == before).agg(F.max("version")).first()[0] if before else None
        version = self.version() if mine is None else mine - 1
        if not version:
            return self.spark.createDataFrame([], TAGS)
        return self.spark.read.schema(TAGS).parquet(f"{self.path}/rows-{version}")

    def publish(self, tags: DataFrame, source: str) -> int:
        """Make ``tags`` the latest version. A source that is listed already is not published again, so a step that is
        repeated after a failure changes nothing. Returns the version in force."""
        if self._listed().where(F.col("source") == source).limit(1).count():
            return self.version()
        version = self.version() + 1
        rows = tags.select("tokens", F.col("doc_freq").cast("double").alias("doc_freq"))
        rows.write.mode("overwrite").parquet(f"{self.path}/rows-{version}")
        listed = self.spark.createDataFrame([(version, source)], VERSIONS)
        listed.coalesce(1).write.mode("append").parquet(f"{self.path}/versions")
        return version

    def learn(self, found: DataFrame, source: str) -> int:
        """Add ``found`` ``(tokens, doc_freq)`` to the latest version: new tags join it, known ones add up their weights."""
        union = self.latest().unionByName(found.select("tokens", F.col("doc_freq").cast("double").alias("doc_freq")))
        return self.publish(union.groupBy("tokens").agg(F.sum("doc_freq").alias("doc_freq")), source)


def suggest_tags_stream(
    questions: DataFrame,
    out_path: str,
    checkpoint: str,
    stop_words: Sequence[str],
    known_tags: Sequence[str] | TagTable,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    learn: Callable[[DataFrame], DataFrame] | None = None,
    **models,
) -> StreamingQuery:
    """Start the job: process what is there, then stop. Every question's suggestion appears exactly once, also after a restart.

    With a list of tags the job is one projection into a file sink. With a ``TagTable`` each batch reads the version that is the
    latest when it begins and joins it; the batch has a folder ``batch=N`` of ``out_path``, which a repeated batch overwrites.
    ``learn`` turns a batch (as it arrives, before ``prepare``) into tags ``(tokens, doc_freq)`` that later batches know.
    """
    if not isinstance(known_tags, TagTable):
        suggested = suggest_tags(prepare(questions), stop_words, known_tags, **models)
        return (
            suggested.writeStream.format("parquet")
            .option("path", out_path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )

    def one_batch(batch: DataFrame, number: int) -> None:
        source = f"{checkpoint} {number}"
        tags = known_tags.latest(before=source)  # a repeated batch does not know what it taught itself
        work = f"{checkpoint.rstrip('/')}-tokens"
        found = suggest_tags(prepare(batch), stop_words, tags, written=True, work=work, **models)
        found.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch={number}")
        if learn is not None:
            known_tags.learn(learn(batch), source)

    return (
        questions.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
