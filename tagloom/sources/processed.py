"""S3: the processed question table, and list columns that went through CSV as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LIST_COLUMNS = ["body-tokens", "body-tokens-wov", "title-tokens", "ntags"]


def serialize_list(tokens: Column) -> Column:
    """``['a', 'b']``, the text that a list becomes in a CSV cell."""
    quoted = F.transform(tokens, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def deserialize_list(value: Column) -> Column:
    """Back to a list: brackets and quotes are dropped. ``[]`` becomes one empty string."""
    return F.split(F.regexp_replace(value, F.lit("[\\[\\]']"), F.lit("")), ", ")


def deserialize_columns(df: DataFrame, columns: Sequence[str] = tuple(LIST_COLUMNS)) -> DataFrame:
    return df.withColumns({c: deserialize_list(F.col(f"`{c}`")) for c in columns})


def write_processed(df: DataFrame, path: str) -> None:
    """Parquet keeps the list columns as they are."""
    df.write.mode("overwrite").parquet(path)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_processed_csv(df: DataFrame, path: str, columns: Sequence[str] = tuple(LIST_COLUMNS)) -> None:
    """CSV for tools that expect it; lists become text."""
    text = df.withColumns({c: serialize_list(F.col(f"`{c}`")) for c in columns})
    text.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_processed_csv(
    spark: SparkSession, path: str, schema: str, columns: Sequence[str] = tuple(LIST_COLUMNS)
) -> DataFrame:
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
    return deserialize_columns(reader.csv(path), columns)
