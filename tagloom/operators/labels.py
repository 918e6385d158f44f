"""Tags as labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.functions.text import filter_list, list_to_str
from tagloom.operators.membership import keep_tokens
from tagloom.operators.stats import most_used

MAX_LABELS = 10_000
BUCKETS = 4096
REST = "\x00rest"


def label_classes(df: DataFrame, col: str, max_labels: int = MAX_LABELS) -> list[str]:
    """the sorted classes. A dense row needs them all, so their number is checked;
    beyond it use the long form ``(id, tag)``."""
    rows = df.select(F.explode(F.array_distinct(col)).alias("tag")).distinct().limit(max_labels + 1).collect()
    if len(rows) > max_labels:
        raise ValueError(f"more than {max_labels} classes: use the long form")
    return sorted(r.tag for r in rows)


def binarize(tags: Column, classes: list[str]) -> Column:
    """0/1 array in class order."""
    names = F.array(*[F.lit(c) for c in classes]).cast("array<string>")
    return F.transform(names, lambda c: F.array_contains(tags, c).cast("int"))


def unbinarize(bits: Column, classes: list[str]) -> Column:
    """F3, inverse: names of the set classes."""
    names = F.array(*[F.lit(c) for c in classes])
    return F.filter(
        F.transform(bits, lambda b, k: F.when(b == 1, F.get(names, k))), lambda t: t.isNotNull()
    )


def binarized_long(df: DataFrame, id_col: str, col: str) -> DataFrame:
    """F3 without a bound on the classes: one row per set label."""
    return df.select(id_col, F.explode(F.array_distinct(col)).alias("tag"))


def label_filter(
    df: DataFrame, id_col: str, col: str, nb_tags: int, out: str, fit_on: DataFrame | None = None
) -> DataFrame:
    """M2: keep only the ``nb_tags`` most used tags, of ``fit_on`` if given (say, the training part)."""
    source = df if fit_on is None else fit_on
    return keep_tokens(df, id_col, col, most_used(source, col, nb_tags), out, "doc_freq")


def stratum(tags: Column, include: list[str] | None = None) -> Column:
    """Sorted tags (or those of ``include``) as one key."""
    return list_to_str(filter_list(tags, include=include) if include is not None else tags)


def split_parts(
    df: DataFrame, id_col: str, key: str | Column | None, test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """M3: ``(id, is_test)``. Keys that occur more than once are split key by key, all
    others together; without a key everything is one stratum.

    In each stratum the rows with the lowest hashes, ``round(test_size * n)`` of them, are
    the test part. A stratum may hold a large part of all rows, so it is never ranked as
    one group: counts per hash bucket show which buckets belong to the test part as a
    whole, and only the one bucket at the border is ranked.
    """
    hashed = F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))
    value = F.lit(REST) if key is None else (F.col(key) if isinstance(key, str) else key)
    rows = df.select(id_col, value.alias("_key"), hashed.alias("_hash")).withColumn(
        "_bucket", F.substr("_hash", F.lit(1), F.lit(3))
    )
    if key is not None:
        once = (
            rows.groupBy("_key")
            .agg(F.count("*").alias("_n"), F.min(id_col).alias(id_col))
            .where("_n = 1")
            .select(id_col, F.lit(True).alias("_once"))
        )
        rows = rows.join(once, id_col, "left").withColumn(
            "_key", F.when(F.col("_once"), F.lit(REST)).otherwise(F.col("_key"))
        )
    buckets = rows.groupBy("_key", "_bucket").agg(F.count("*").alias("_n"))
    whole = W.partitionBy("_key")
    before = whole.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    wanted = F.floor(F.sum("_n").over(whole) * F.lit(float(test_size)) + 0.5)
    quota = buckets.select(
        F.col("_key").alias("_quota_key"),
        F.col("_bucket").alias("_quota_bucket"),
        F.col("_n").alias("_size"),
        (wanted - F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_quota"),
    )
    joined = rows.join(
        quota,
        rows["_key"].eqNullSafe(quota["_quota_key"]) & (rows["_bucket"] == quota["_quota_bucket"]),
    )
    border = (F.col("_quota") > 0) & (F.col("_quota") < F.col("_size"))
    rank = F.row_number().over(W.partitionBy("_key", "_bucket").orderBy("_hash", id_col))
    is_test = F.when(border, rank <= F.col("_quota")).otherwise(F.col("_quota") > 0)
    return joined.select(id_col, is_test.alias("is_test"))


def stratified_split(
    df: DataFrame, id_col: str, key: str | None, test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """M3: ``df`` with ``is_test``."""
    return df.join(split_parts(df, id_col, key, test_size, seed), id_col)


def jaccard(truth: Column, predicted: Column) -> Column:
    """Of one document; 0 when both sides are empty."""
    union = F.size(F.array_union(truth, predicted))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(truth, predicted)) / union)


def jaccard_samples(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """M4: mean over documents."""
    return df.agg(F.avg(jaccard(F.col(truth), F.col(predicted))).alias("jaccard"))


def coverage_rates(df: DataFrame, truth: str, predicted: str, words: str) -> DataFrame:
    """Shares of real tags that were proposed, and of question words that are proposed tags."""
    hit = F.size(F.array_intersect(F.col(truth), F.col(predicted)))
    used = F.size(F.array_intersect(F.col(words), F.col(predicted)))
    return df.agg(
        F.avg(hit / F.nullif(F.size(F.array_distinct(truth)), F.lit(0))).alias("tag_coverage"),
        F.avg(used / F.nullif(F.size(F.array_distinct(words)), F.lit(0))).alias("word_coverage"),
    )
