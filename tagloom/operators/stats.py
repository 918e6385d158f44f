"""Token statistics, ranking and coverage.

Ranks and cumulative sums over a whole vocabulary would sort it in one task. They are
computed on the histogram "statistic -> number of tokens" instead: a corpus of N token
occurrences has at most sqrt(2N) different counts, so the ordered window runs over a
small table whatever the vocabulary size, and positions inside a tie follow by arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from typing import Literal, get_args

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.functions.arrays import run_lengths, unfolded
from tagloom.session import materialise

Stat = Literal["term_count", "term_freq", "doc_count", "doc_freq"]
DECILES = [k / 10 for k in range(1, 10)]


def check_stat(stat: str) -> str:
    """A5: exactly one known statistic."""
    if stat not in get_args(Stat):
        raise ValueError(f"one of {get_args(Stat)} expected, not {stat!r}")
    return stat


def _counts(df: DataFrame, col: str, per_document: bool) -> DataFrame:
    """``(tokens, n)`` with map-side partial counts; duplicates inside a document are
    removed in the row, so a document count needs no distinct aggregation."""
    tokens = F.array_distinct(col) if per_document else unfolded(col)
    return df.select(F.explode(tokens).alias("tokens")).groupBy("tokens").agg(F.count("*").alias("n"))


def row_count(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery: no join, no collect."""
    return df.agg(F.count("*")).scalar()


def count_tokens(df: DataFrame, col: str, stat: Stat) -> DataFrame:
    """A1-A4: ``(tokens, <stat>)``. Rows with empty lists count as documents."""
    check_stat(stat)
    counts = _counts(df, col, per_document=stat.startswith("doc_"))
    if stat == "term_freq":
        total = counts.agg(F.sum("n")).scalar()
        return counts.select("tokens", (F.col("n") / total).alias(stat))
    if stat == "doc_freq":
        return counts.select("tokens", (F.col("n") / row_count(df)).alias(stat))
    return counts.select("tokens", F.col("n").alias(stat))


def term_doc_stats(df: DataFrame, col: str) -> DataFrame:
    """Term and document frequency of every token in one pass over in-row counts."""
    pairs = df.select(F.inline(run_lengths(F.col(col))))
    counts = pairs.groupBy(F.col("token").alias("tokens")).agg(
        F.sum("n").alias("term_count"), F.count("*").alias("doc_count")
    )
    total = counts.agg(F.sum("term_count")).scalar()
    return counts.select(
        "tokens",
        (F.col("term_count") / total).alias("term_freq"),
        (F.col("doc_count") / row_count(df)).alias("doc_freq"),
    )


def term_doc_matrix(df: DataFrame, id_col: str, col: str, tokens: Sequence[str] | None = None) -> DataFrame:
    """The count matrix. Without ``tokens`` the whole one, one row ``(id, token, n)`` per cell that is not 0;
    with a short list of tokens one column per token."""
    if tokens is None:
        return df.select(id_col, F.inline(run_lengths(F.col(col))))

    def count_of(token: str) -> Column:
        return F.size(F.filter(F.col(col), lambda x: x == token)).alias(token)

    return df.select(id_col, *[count_of(t) for t in tokens])


def most_used(df: DataFrame, col: str, n: int, stat: Stat = "doc_freq") -> DataFrame:
    """The n tokens with the highest statistic, ties by token (top-k, no full sort)."""
    return count_tokens(df, col, stat).orderBy(F.desc(stat), "tokens").limit(n)


def least_used(df: DataFrame, col: str, n: int, stat: Stat = "doc_freq") -> DataFrame:
    """A7."""
    return count_tokens(df, col, stat).orderBy(stat, "tokens").limit(n)


def frequency_cloud(df: DataFrame, col: str, max_words: int | None = None) -> DataFrame:
    """Document frequencies behind a word cloud."""
    if max_words is None:
        return count_tokens(df, col, "doc_freq")
    return most_used(df, col, max_words)


def count_histogram(df: DataFrame, col: str, per_document: bool) -> DataFrame:
    """``n, tokens, rank_before, sum_before, all_tokens, all_sum``, one row per distinct count."""
    histogram = _counts(df, col, per_document).groupBy("n").agg(F.count("*").alias("tokens"))
    # Bounded by the number of distinct counts, see the module text.
    before = W.orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    return histogram.select(
        "n",
        "tokens",
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("rank_before"),
        F.coalesce(F.sum(F.col("n") * F.col("tokens")).over(before), F.lit(0)).alias("sum_before"),
        F.sum("tokens").over(everything).alias("all_tokens"),
        F.sum(F.col("n") * F.col("tokens")).over(everything).alias("all_sum"),
    )


def _used_by_first(n: Column) -> Column:
    """Occurrences that one histogram row adds to the n most used tokens."""
    inside = F.greatest(F.lit(0), F.least(F.col("tokens"), n - F.col("rank_before")))
    return F.col("n") * inside


def _tokens_needed(share: float) -> Column:
    """Over the histogram: the least n whose usage reaches ``share``, in whole numbers.

    The share is the decimal number as written, a fraction of two integers; the sums are
    multiplied as decimals, which neither round nor overflow.
    """
    top, bottom = Decimal(str(share)).as_integer_ratio()
    whole = "decimal(38,0)"
    wanted = F.col("all_sum").cast("decimal(19,0)") * F.lit(top).cast("decimal(19,0)")
    before = F.col("sum_before").cast("decimal(19,0)") * F.lit(bottom).cast("decimal(19,0)")
    step = F.col("n").cast("decimal(19,0)") * F.lit(bottom).cast("decimal(19,0)")
    reached = before.cast(whole) + step.cast(whole) * F.col("tokens") >= wanted.cast(whole)
    missing = F.greatest((wanted - before).cast(whole), F.lit(0).cast(whole))
    full = F.call_function("div", missing, step.cast(whole))
    inside = full + (full.cast("decimal(19,0)") * step < missing).cast("long")
    needed = F.greatest(F.col("rank_before") + inside, F.lit(1))
    return F.coalesce(F.min(F.when(reached, needed)), F.max("all_tokens"))


def tokens_usage(df: DataFrame, col: str, n: int, stat: Stat = "doc_freq", normalize: bool = False) -> DataFrame:
    """Summed statistic of the n most used tokens, one row; ``normalize`` divides by the total."""
    check_stat(stat)
    histogram = count_histogram(df, col, per_document=stat.startswith("doc_"))
    used = F.sum(_used_by_first(F.lit(n)))
    total = F.max("all_sum")
    if normalize or stat == "term_freq":
        value = used / total
    elif stat == "doc_freq":
        value = used / row_count(df)
    else:
        value = used
    return histogram.agg(value.alias("tokens_usage"))


def tokens_for_coverage(df: DataFrame, col: str, share: float, stat: Stat = "term_freq") -> DataFrame:
    """Smallest n whose share of the total statistic reaches ``share``, one row."""
    check_stat(stat)
    histogram = count_histogram(df, col, per_document=stat.startswith("doc_"))
    return histogram.agg(_tokens_needed(share).cast("long").alias("n_tokens"))


def coverage_table(
    df: DataFrame,
    col: str,
    ns: Sequence[int] = (),
    sizes_from: Literal["term", "doc"] = "term",
    shares: Sequence[float] = tuple(DECILES),
) -> DataFrame:
    """A10: for each coverage level and each given n, the share of occurrences and of
    document counts that the n most used tokens hold. ``sizes_from`` chooses the statistic
    that the coverage levels refer to."""
    terms = count_histogram(df, col, per_document=False)
    docs = count_histogram(df, col, per_document=True)
    base = terms if sizes_from == "term" else docs
    sizes = base.agg(
        F.array(*[_tokens_needed(p).cast("long") for p in shares], *[F.lit(n).cast("long") for n in ns])
    ).scalar()

    def usage(histogram: DataFrame, name: str) -> DataFrame:
        return (
            histogram.select("*", F.posexplode(sizes).alias("k", "size"))
            .groupBy("k", "size")
            .agg((F.sum(_used_by_first(F.col("size"))) / F.max("all_sum")).alias(name))
        )

    return (
        usage(terms, "cumulative_term_freq")
        .join(usage(docs, "doc_coverage").drop("size"), "k")
        .select(F.col("size").alias("n_most_used"), "cumulative_term_freq", "doc_coverage")
    )


def corpus_stats(df: DataFrame, col: str, iqr_factors: Sequence[float] = (1.5, 3.0, 5.0)) -> DataFrame:
    """Description of the document frequencies (%), with counts of tokens outside
    the interquartile fences."""
    histogram = _counts(df, col, per_document=True).groupBy("n").agg(F.count("*").alias("tokens"))
    documents = row_count(df)
    percent = F.col("n") * 100.0 / documents
    quartiles = histogram.agg(
        F.percentile("n", F.array(*[F.lit(q) for q in (0.25, 0.5, 0.75)]), F.col("tokens"))
    ).scalar()
    q1, q2, q3 = (quartiles[k] for k in range(3))
    tokens = F.sum("tokens")
    mean = F.sum(percent * F.col("tokens")) / tokens
    squares = F.sum(percent * percent * F.col("tokens"))
    variance = (squares - tokens * mean * mean) / F.nullif(tokens - 1, F.lit(0))
    outside = [
        F.coalesce(
            F.sum(F.when((F.col("n") > q3 + f * (q3 - q1)) | (F.col("n") < q1 - f * (q3 - q1)), F.col("tokens"))),
            F.lit(0),
        ).alias(f"outside_{str(f).replace('.', '_')}_iqr")
        for f in iqr_factors
    ]
    return histogram.agg(
        tokens.alias("n_tokens"),
        (F.lit(100.0) / F.first(documents)).alias("one_doc_freq"),
        mean.alias("mean"),
        F.sqrt(F.greatest(variance, F.lit(0.0))).alias("std"),
        F.min(percent).alias("min"),
        F.first(q1 * 100.0 / documents).alias("q25"),
        F.first(q2 * 100.0 / documents).alias("q50"),
        F.first(q3 * 100.0 / documents).alias("q75"),
        F.max(percent).alias("max"),
        *outside,
    )


def rank_lookup(df: DataFrame, col: str, ranks: Sequence[int]) -> DataFrame:
    """Document frequency and count at 0-based ranks by descending document frequency."""
    histogram = count_histogram(df, col, per_document=True)
    rank = F.col("rank")
    return (
        histogram.select("*", F.explode(F.array(*[F.lit(r).cast("long") for r in ranks])).alias("rank"))
        .where((rank >= F.col("rank_before")) & (rank < F.col("rank_before") + F.col("tokens")))
        .select("rank", (F.col("n") / row_count(df)).alias("doc_freq"), F.col("n").alias("doc_count"))
    )


def banded_top_tokens(df: DataFrame, col: str, n: int, band: int = 25) -> DataFrame:
    """The n most used tokens in bands. The rank window sees at most n rows."""
    top = _counts(df, col, per_document=True).orderBy(F.desc("n"), "tokens").limit(n)
    rank = F.row_number().over(W.orderBy(F.desc("n"), "tokens"))
    return top.select(
        "tokens",
        rank.alias("rank"),
        F.floor((rank - 1) / band).alias("band"),
        (F.col("n") / row_count(df)).alias("doc_freq"),
        F.col("n").alias("doc_count"),
    )


def tag_usage(df: DataFrame, col: str, n: int, share: float = 0.8) -> DataFrame:
    """What part of the tags the n most used are, what part of the usage they hold,
    and how many tags hold ``share`` of the usage."""
    histogram = count_histogram(df, col, per_document=False)
    return histogram.agg(
        (F.least(F.lit(n), F.max("all_tokens")) / F.max("all_tokens")).alias("share_of_tags"),
        (F.sum(_used_by_first(F.lit(n))) / F.max("all_sum")).alias("share_of_usage"),
        _tokens_needed(share).cast("long").alias("tags_for_share"),
    )


def exact_quantiles(values: DataFrame, group: str, value: str, n: str, shares: Sequence[float]) -> DataFrame:
    """``(group, q)``: interpolated quantiles from a histogram of distinct values.

    The values are sorted over range partitions. A running sum over the partitions' totals, one row per
    group and partition, tells where each partition's ranks begin; no task holds a whole group.
    """
    dealt = materialise(values.repartitionByRange(group, value).withColumn("_cell", F.spark_partition_id()))
    cells = dealt.groupBy(group, "_cell").agg(F.sum(n).alias("_size"))
    whole = W.partitionBy(group)
    earlier = whole.orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select(
        group, "_cell", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"), F.sum("_size").over(whole).alias("_all")
    )
    upto = W.partitionBy(group, "_cell").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    ranked = dealt.join(cells, [group, "_cell"]).withColumn("_end", F.col("_before") + F.sum(n).over(upto))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank < F.col("_end")) & (rank >= F.col("_end") - F.col(n)), F.col(value)))

    def quantile(share: float) -> Column:
        place = (F.col("_all") - 1) * F.lit(float(share))
        low, high, part = at(F.floor(place)), at(F.ceil(place)), F.max(place - F.floor(place))
        return low + (high - low) * part

    return ranked.groupBy(group).agg(F.array(*[quantile(q) for q in shares]).alias("q"))


def describe_counters(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, exact quartiles, max per numeric column.

    Everything comes from value counts that are partially aggregated before the shuffle; the
    quartiles from ranks over range partitions of the values.
    """
    long = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("counter"), F.col(c).cast("double").alias("value")) for c in columns]))
    ).where("value is not null")
    values = materialise(long.groupBy("counter", "value").agg(F.count("*").alias("n")))
    quartiles = exact_quantiles(values, "counter", "value", "n", (0.25, 0.5, 0.75))
    total = F.sum("n")
    mean = F.sum(F.col("value") * F.col("n")) / total
    squares = F.sum(F.col("value") * F.col("value") * F.col("n"))
    return (
        values.groupBy("counter")
        .agg(
            total.alias("count"),
            mean.alias("mean"),
            F.sqrt(F.greatest((squares - total * mean * mean) / F.nullif(total - 1, F.lit(0)), F.lit(0.0))).alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
        .join(quartiles, "counter")
        .select(
            "counter", "count", "mean", "std", "min",
            F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max",
        )
    )
