"""Joining tokens with per-token tables, and the operators built on it: P8 for large
vocabularies, P12 by count, P15 with a lexicon table, A14, M18 for large tag tables.

A few tokens occur in nearly every document, so a plain join on the token would send a
large part of all rows to one task. Small tables are broadcast after their size in bytes has
been checked. For larger ones the most frequent tokens of the rows, a fixed number, are
answered by a broadcast whether the table knows them or not, and the rest is joined by
shuffle; no remaining token can then hold more than a small share of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.arrays import Strings, unfolded
from tagloom.operators.stats import count_tokens
from tagloom.session import materialise

MAX_BROADCAST_BYTES = 32 << 20
HOT_TOKENS = 2_000
IN_LIST = 2_000


def token_lookup(
    rows: DataFrame,
    table: DataFrame,
    on: str,
    payload: Sequence[str],
    spread_by: Sequence[str],
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    hot_tokens: int = HOT_TOKENS,
    written: bool = False,
) -> DataFrame:
    """Left join ``rows`` with ``table`` (unique on ``on``), safe for frequent tokens.

    ``spread_by`` are columns of ``rows`` that identify a row. Missing tokens get nulls. ``written`` says that ``table`` is a
    stored table already and need not be written again. Without ``hot_tokens`` the caller vouches that no token of ``rows`` is frequent.
    """
    right = table.select(on, *payload)
    if not written:
        right = materialise(right)
    size = F.length(F.to_json(F.struct(on, *payload)))
    if (right.agg(F.sum(size)).first()[0] or 0) <= max_broadcast_bytes:
        return rows.join(F.broadcast(right), on, "left")

    if hot_tokens == 0:
        return rows.join(right, on, "left")

    # Counted in the rows themselves (partial sums before the shuffle): a token that the table
    # lacks can be the most frequent one. It is carried with a null payload.
    hot = rows.groupBy(on).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), on).limit(hot_tokens)
    hot = materialise(hot.select(on).join(right, on, "left").select(on, F.struct(*payload).alias("_hot")))
    cold = right.join(F.broadcast(hot), on, "left_anti").select(
        F.col(on).alias("_on"), F.xxhash64(on).alias("_route"), F.struct(*payload).alias("_cold")
    )
    # Rows already answered by the broadcast are routed by their own hash and match nothing, so they
    # spread evenly over the shuffle. (A literal salt would be folded away and leave the token alone.)
    route = F.when(F.col("_hot").isNull(), F.xxhash64(on)).otherwise(F.xxhash64(*spread_by))
    salted = rows.join(F.broadcast(hot), on, "left").withColumn("_route", route)
    joined = salted.join(cold, (salted[on] == cold["_on"]) & (salted["_route"] == cold["_route"]), "left")
    return joined.select(
        *[salted[c] for c in rows.columns],
        *[F.coalesce(F.col("_hot")[c], F.col("_cold")[c]).alias(c) for c in payload],
    )


def exploded(df: DataFrame, id_col: str, col: str) -> DataFrame:
    """``(id, pos, token)``."""
    return df.select(id_col, F.posexplode(unfolded(col)).alias("pos", "token"))


def regroup(rows: DataFrame, id_col: str, order: Sequence[str], value: str = "token") -> DataFrame:
    """Token lists per document again; a group is one document, never more."""
    ordered = F.sort_array(F.collect_list(F.struct(*order, value)))
    return rows.groupBy(id_col).agg(F.transform(ordered, lambda s: s[value]).alias("_tokens"))


def with_lists(df: DataFrame, id_col: str, lists: DataFrame, out: str) -> DataFrame:
    """Attach regrouped lists; documents that lost every token get an empty list."""
    joined = df.join(lists, id_col, "left")
    return joined.withColumn(out, F.coalesce("_tokens", F.array().cast(Strings))).drop("_tokens")


def short_list(vocabulary: DataFrame, limit: int = IN_LIST) -> list[str] | None:
    """The words of a vocabulary of at most ``limit`` rows, else None."""
    rows = vocabulary.select("tokens").limit(limit + 1).collect()
    return [r.tokens for r in rows] if len(rows) <= limit else None


def keep_tokens(
    df: DataFrame, id_col: str, col: str, vocabulary: DataFrame, out: str, weight: str,
    keep: bool = True, limit: int = IN_LIST, written: bool = False,
) -> DataFrame:
    """P8 with a vocabulary table ``(tokens, <weight>)``: keep (or drop) its members.

    A short vocabulary becomes a hash set in the projection: no join and no shuffle of
    tokens. A longer one is joined with the exploded tokens.
    """
    words = short_list(vocabulary, limit)
    if words is not None:
        member = (lambda x: x.isin(words)) if words else (lambda x: F.lit(False))
        test = member if keep else (lambda x: ~member(x))
        kept = F.coalesce(F.filter(col, test), F.array().cast(Strings))
        return df.withColumn(out, kept)
    table = vocabulary.select(F.col("tokens").alias("token"), F.col(weight).alias("_weight"))
    rows = token_lookup(exploded(df, id_col, col), table, "token", ["_weight"], [id_col, "pos"], written=written)
    rows = rows.where(F.col("_weight").isNotNull() if keep else F.col("_weight").isNull())
    return with_lists(df, id_col, regroup(rows, id_col, ["pos"]), out)


def doc_freq_vocabulary(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    """Tokens with ``low < doc_freq < high``, both strict."""
    return count_tokens(df, col, "doc_freq").where((F.col("doc_freq") > low) & (F.col("doc_freq") < high))


def filter_by_doc_freq(
    df: DataFrame, id_col: str, col: str, out: str, low: float = 0.0, high: float = 1.0,
    fit_on: DataFrame | None = None, limit: int = IN_LIST,
) -> DataFrame:
    """A14. ``fit_on`` takes the frequencies from other rows (say, the training part)."""
    source = df if fit_on is None else fit_on
    return keep_tokens(
        df, id_col, col, doc_freq_vocabulary(source, col, low, high), out, "doc_freq", limit=limit
    )


def sort_by_count(df: DataFrame, id_col: str, col: str, counts: DataFrame, count_col: str, out: str) -> DataFrame:
    """Stable sort by a count lookup, unknown tokens first (count -1)."""
    table = counts.select(F.col("tokens").alias("token"), F.col(count_col).alias("_count"))
    rows = token_lookup(exploded(df, id_col, col), table, "token", ["_count"], [id_col, "pos"])
    rows = rows.withColumn("_count", F.coalesce("_count", F.lit(-1)))
    return with_lists(df, id_col, regroup(rows, id_col, ["_count", "pos"]), out)


def lemmatize_with_lexicon(
    df: DataFrame, id_col: str, col: str, lexicon: DataFrame, allowed_pos: Sequence[str], out: str
) -> DataFrame:
    """P15 with the caller's own ``(token, pos, lemma)`` table; tokens it does not know
    follow the suffix rules."""
    from tagloom.functions.lemma import suffix_lemma

    # Of several entries of a token: an allowed part of speech first, then by name.
    order = F.struct(~F.col("pos").isin(list(allowed_pos)), "pos", "lemma")
    table = lexicon.groupBy("token").agg(F.min(order).alias("_e")).select("token", "_e.pos", "_e.lemma")
    known = token_lookup(
        exploded(df, id_col, col), table.withColumnRenamed("pos", "_pos"), "token", ["_pos", "lemma"], [id_col, "pos"]
    )
    lemma: Column = F.when(
        F.col("_pos").isNull(), suffix_lemma(F.col("token"), allowed_pos)
    ).otherwise(F.when(F.col("_pos").isin(list(allowed_pos)), F.col("lemma")).otherwise(""))
    rows = known.select(id_col, "pos", lemma.alias("token"))
    return with_lists(df, id_col, regroup(rows, id_col, ["pos"]), out)
