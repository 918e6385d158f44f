"""Features in relational form."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.arrays import let, run_lengths, unfolded
from tagloom.operators.draws import Draws
from tagloom.operators.membership import HOT_TOKENS, exploded, token_lookup
from tagloom.operators.stats import count_tokens, row_count
from tagloom.session import batch_bytes, materialise

PAD, UNKNOWN = 0, 1
SENT_WORDS = 1 << 16  # the longest vocabulary that is sent
SENT_BYTES = 64 << 20  # the word vectors that are sent
BATCH_BYTES = 8 << 20  # of the rows with their words that travel to Python together
PAIR_WORDS = 100_000  # words whose pairs a task holds at once
SUM_WORDS = 50_000  # words whose vectors a task holds at once
GROUP_NUMBERS = 32_000_000  # numbers of the vectors that a group of documents can meet


def bow_counts(df: DataFrame, id_col: str, col: str) -> DataFrame:
    """F1, long form ``(id, token, n)``; counted inside the row, so map-only."""
    return df.select(id_col, F.inline(run_lengths(F.col(col))))


def inverse_doc_freq(df: DataFrame, col: str) -> DataFrame:
    """``(token, doc_count, idf)`` with idf = ln((1 + documents) / (1 + doc_count)) + 1."""
    counts = count_tokens(df, col, "doc_count")
    idf = F.log((row_count(df) + 1) / (F.col("doc_count") + 1)) + 1
    return counts.select(F.col("tokens").alias("token"), "doc_count", idf.alias("idf"))


def bow_tfidf(df: DataFrame, id_col: str, col: str, fit_on: DataFrame | None = None) -> DataFrame:
    """F2, long form ``(id, token, weight)``, every document scaled to length 1. Tokens
    that the fitted rows do not know are left out."""
    idf = materialise(inverse_doc_freq(df if fit_on is None else fit_on, col))
    most = idf.where("token is not null").orderBy(F.desc("doc_count"), "token").limit(SENT_WORDS)
    found = most.select("token", "idf").toArrow()
    rows = weighed_inside(df, id_col, col, found["token"], found["idf"].to_numpy())
    # Without other rows to fit on, all frequent tokens are answered by now.
    pairs = token_lookup(
        rows.select(id_col, F.inline("_other")).where("token is not null"), idf, "token", ["idf"], [id_col, "token"],
        hot_tokens=0 if fit_on is None else HOT_TOKENS, written=True,
    ).where("idf is not null")
    raw, none = F.col("n") * F.col("idf"), F.lit(None)
    inside = F.aggregate("_values", F.lit(0.0), lambda a, x: a + x * x)
    parts = rows.where(F.size("_known") > 0).select(
        id_col, "_known", "_values", none.cast("string").alias("token"), none.cast("double").alias("_raw"), inside.alias("_square")
    ).unionByName(pairs.select(
        id_col, none.cast("array<int>").alias("_known"), none.cast("array<double>").alias("_values"), "token",
        raw.alias("_raw"), (raw * raw).alias("_square"),
    ))
    length = F.sqrt(F.sum("_square").over(W.partitionBy(id_col)))
    known = F.arrays_zip(F.col("_known").alias("k"), F.col("_values").alias("raw"))
    own = F.array(F.struct(F.lit(None).cast("int").alias("k"), F.col("_raw").alias("raw")))
    cells = parts.withColumn("_length", length).select(
        F.col(id_col).alias("_id"), "token", "_length", F.inline(F.when(F.col("_known").isNull(), own).otherwise(known)).alias("k", "raw")
    )
    names = found.select(["token"]).rename_columns(["_name"]).append_column("k", pa.array(np.arange(found.num_rows, dtype=np.int32)))
    named = cells.join(F.broadcast(df.sparkSession.createDataFrame(names)), "k", "left")
    return named.select(F.col("_id").alias(id_col), F.coalesce("token", "_name").alias("token"), (F.col("raw") / F.col("_length")).alias("weight"))


def weighed_inside(df: DataFrame, id_col: str, col: str, tokens: pa.ChunkedArray, weights: np.ndarray) -> DataFrame:
    """``(id, _known, _values, _other)``, written: the distinct words of a row that are among ``tokens`` by their places there, with their
    counts times ``weights``; and the other words as ``token, n``. What later meets by document are numbers instead of most words."""
    sent = df.sparkSession.sparkContext.broadcast((tokens.combine_chunks(), weights))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, weights = sent.value
        for batch in batches:
            lists = batch["_pairs"]
            words, n = lists.flatten().flatten()
            place = pc.index_in(words, value_set=tokens.cast(words.type), skip_nulls=True)
            row = np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(lists)).astype(np.int64))
            mine = np.asarray(pc.is_valid(place)).astype(bool)
            at = np.asarray(place.filter(pa.array(mine))).astype(np.int32)
            values = np.asarray(n).astype(float)[mine] * weights[at]

            def ends(which: np.ndarray) -> pa.Array:
                return pa.array(np.r_[0, np.cumsum(np.bincount(row[which], minlength=batch.num_rows))].astype(np.int32))

            other = pa.StructArray.from_arrays([words.filter(pa.array(~mine)), n.filter(pa.array(~mine))], names=["token", "n"])
            inside = ends(mine)
            columns = [pa.ListArray.from_arrays(inside, pa.array(at)), pa.ListArray.from_arrays(inside, pa.array(values))]
            columns = [batch[id_col], *columns, pa.ListArray.from_arrays(ends(~mine), other)]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "_known", "_values", "_other"])

    kinds = "_known array<int>, _values array<double>, _other array<struct<token: string, n: int>>"
    schema = T.StructType([df.schema[id_col], *T.StructType.fromDDL(kinds).fields])
    with batch_bytes(df.sparkSession, BATCH_BYTES):
        return materialise(df.select(id_col, run_lengths(F.col(col)).alias("_pairs")).mapInArrow(split, schema))


def vocabulary_ids(df: DataFrame, col: str, vocab_size: int) -> DataFrame:
    """``(token, word_id)`` by falling count; 0 is padding and 1 the unknown word, both
    part of ``vocab_size``. The rank window sees at most ``vocab_size`` rows."""
    top = count_tokens(df, col, "term_count").orderBy(F.desc("term_count"), "tokens").limit(vocab_size - 2)
    rank = F.row_number().over(W.orderBy(F.desc("term_count"), "tokens"))
    return top.select(F.col("tokens").alias("token"), (rank + UNKNOWN).alias("word_id"), "term_count")


def encode_sequences(
    df: DataFrame, id_col: str, col: str, vocab_size: int = 4096, sequence_length: int | None = 10,
    vocabulary: DataFrame | None = None,
) -> DataFrame:
    """``(id, sequence)``: the first words as ids, padded with 0 to ``sequence_length``; all words and no
    padding without a length. Up to ``SENT_WORDS`` words of a vocabulary are sent and looked up inside the row, a longer one is joined;
    rows of one id have one sequence, their words by place, and rows without an id have no words. ``vocabulary`` holds the
    ids if they are known already."""
    head = F.col(col) if sequence_length is None else F.slice(col, 1, sequence_length)
    heads = df.select(id_col, head.alias("_head"))
    if vocabulary is None:
        vocabulary = vocabulary_ids(df, col, vocab_size)
    joined = _coded_inside if vocab_size <= SENT_WORDS else _coded_by_join
    ids = F.coalesce("_ids", F.array().cast("array<int>"))
    joined = joined(heads, id_col, vocabulary)
    if sequence_length is None:
        return joined.select(id_col, ids.alias("sequence"))
    padding = F.array_repeat(F.lit(PAD), sequence_length)
    return joined.select(id_col, F.slice(F.concat(ids, padding), 1, sequence_length).alias("sequence"))


def _coded_inside(heads: DataFrame, id_col: str, vocabulary: DataFrame) -> DataFrame:
    """``(id, _ids)`` of ``(id, _head)``; what is shuffled are the ids of the words, once."""
    found = vocabulary.toArrow()
    sent = heads.sparkSession.sparkContext.broadcast((found["token"].combine_chunks(), found["word_id"].to_numpy()))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, word_id = sent.value
        word_id = np.r_[word_id, UNKNOWN].astype(np.int32)  # the last place is that of an unknown word
        for batch in batches:
            lists = batch["_head"]
            words = lists.flatten()
            place = pc.fill_null(pc.index_in(words, value_set=tokens.cast(words.type), skip_nulls=True), len(tokens))
            ends = np.r_[0, np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))].astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(word_id[np.asarray(place)]))
            yield pa.RecordBatch.from_arrays([batch[id_col], ids], names=[id_col, "_ids"])

    schema = T.StructType([heads.schema[id_col], T.StructField("_ids", T.ArrayType(T.IntegerType()))])
    none = F.array().cast("array<string>")
    named = heads.select(id_col, F.when(F.col(id_col).isNotNull(), F.col("_head")).otherwise(none).alias("_head"))
    lists = named.mapInArrow(code, schema).groupBy(id_col).agg(F.collect_list("_ids").alias("_lists"))
    placed = F.flatten(F.transform("_lists", lambda l: F.transform(l, lambda w, k: F.struct(k.alias("pos"), w.alias("word_id")))))
    merged = F.transform(F.sort_array(placed), lambda s: s["word_id"])
    ids = F.when(F.size("_lists") == 1, F.col("_lists")[0]).otherwise(merged)
    return lists.select(id_col, F.explode(F.array_repeat(ids, F.size("_lists"))).alias("_ids"))


def _coded_by_join(heads: DataFrame, id_col: str, vocabulary: DataFrame) -> DataFrame:
    """The same with a vocabulary of any length."""
    rows = token_lookup(exploded(heads, id_col, "_head"), vocabulary, "token", ["word_id"], [id_col, "pos"])
    word = F.coalesce("word_id", F.lit(UNKNOWN)).alias("word_id")
    lists = (
        rows.select(id_col, "pos", word)
        .groupBy(id_col)
        .agg(F.sort_array(F.collect_list(F.struct("pos", "word_id"))).alias("_ids"))
    )
    ids = F.transform("_ids", lambda s: s["word_id"]).alias("_ids")
    return heads.select(id_col).join(lists, id_col, "left").select(id_col, ids)


def keep_probability(word_id: Column, factor: float = 1e-5) -> Column:
    """F8: chance that a target of this rank is used, under Zipf's law for the ranks."""
    gamma = 0.577
    rank = F.greatest(word_id, F.lit(1)).cast("double")
    inverse = rank * (F.log(rank) + gamma) + 0.5 - 1.0 / (12.0 * rank)
    scaled = inverse * factor
    return F.least(F.lit(1.0), scaled / F.sqrt(scaled))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash: the same on every run and in every retry."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substr(F.md5(text), F.lit(1), F.lit(8)), 16, 10).cast("double") / F.lit(2.0**32)


def skipgram_pairs(
    df: DataFrame, id_col: str, col: str = "sequence", window: int = 2,
    seed: int | None = None, factor: float = 1e-5,
) -> DataFrame:
    """F8: ``(id, pos, context_pos, target, context)`` for words at most ``window`` apart, padding left
    out. With a seed, frequent targets are thinned out. Built per document from shifted
    copies of its words: no join on frequent words."""
    ints = [T.StructField(c, T.IntegerType()) for c in ("pos", "context_pos", "target", "context")]
    away = np.array([k for k in range(-window, window + 1) if k])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(pc.fill_null(pc.list_value_length(batch["_words"]), 0))
            words = np.asarray(pc.fill_null(batch["_words"].flatten(), PAD))
            ends = np.r_[0, np.cumsum(sizes)]
            for a, b in _cuts(ends, PAIR_WORDS):
                mine, size = words[ends[a] : ends[b]], sizes[a:b]
                row = np.repeat(np.arange(a, b), size)
                pos = np.arange(len(mine)) - np.repeat(ends[a:b] - ends[a], size)
                near = pos[:, None] + away
                inside = (near >= 0) & (near < np.repeat(size, size)[:, None]) & (mine != PAD)[:, None]
                at, k = np.nonzero(inside)
                context = mine[at + away[k]]
                at, k, context = (x[context != PAD] for x in (at, k, context))
                made = [pos[at], near[at, k], mine[at], context]
                columns = [batch[id_col].take(pa.array(row[at])), *[pa.array(x.astype(np.int32)) for x in made]]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, *[f.name for f in ints]])

    schema = T.StructType([df.schema[id_col], *ints])
    rows = df.select(id_col, F.col(col).cast("array<int>").alias("_words")).mapInArrow(pairs, schema)
    if seed is not None:
        chance = uniform(F.lit(seed), F.col(id_col), F.col("pos"))
        rows = rows.where(chance < keep_probability(F.col("target"), factor))
    return rows.select(id_col, "pos", "context_pos", "target", "context")


def _cuts(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that have at most ``most`` entries together, or are one row; row i has those up to ``ends[i + 1]``."""
    a, n = 0, len(ends) - 1
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(ends, ends[a] + most, side="right")) - 1))
        yield a, b
        a = b


def negative_samples(
    pairs: DataFrame, id_col: str, k: int = 4, vocab_size: int = 4096, seed: int = 42, joined: str | None = None
) -> DataFrame:
    """for every pair, the context and ``k`` distinct other ids with log-uniform
    chances, and the label vector 1, 0, ..., 0. When the draws repeat too often the lowest
    unused ids fill up. ``joined``: both lists as texts with this between the numbers, made where the lists are."""
    if k >= vocab_size:
        raise ValueError("fewer ids than samples")
    scale = math.log(vocab_size + 1)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context = np.asarray(batch["context"])
            draws, n = Draws(prefix_of(batch)), len(context)
            found, size = np.full((n, k + 1), -1, dtype=np.int32), np.ones(n, dtype=np.int64)
            found[:, 0] = context
            # A draw is made only for pairs that lack samples; of the ``4 * k`` allowed ones most need a few.
            missing = np.arange(n)
            for j in range(1, 5 * k + 2):
                if not len(missing):
                    break
                if j <= 4 * k:
                    one = np.floor(np.exp(draws.uniform(missing, j) * scale)).astype(np.int32) - 1
                else:
                    one = np.full(len(missing), j - 4 * k - 1, dtype=np.int32)
                new = ~(found[missing] == one[:, None]).any(axis=1)
                found[missing[new], size[missing[new]]] = one[new]
                size[missing[new]] += 1
                missing = missing[size[missing] <= k]
            ends = pa.array(np.arange(n + 1, dtype=np.int32) * (k + 1))
            marks = np.tile(np.r_[1, np.zeros(k)].astype(np.int32), n)
            if joined is None:
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (found.ravel(), marks)]
            else:
                ids = pa.ListArray.from_arrays(ends, pa.array(found.ravel()).cast(pa.string()))
                lists = [pc.binary_join(ids, joined), pa.repeat(joined.join(["1"] + ["0"] * k), n)]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], *lists], names=[*kept, "contexts", "labels"])

    # The text that the draws of a pair begin with; ids that print alike here and in SQL are printed here.
    plain = isinstance(pairs.schema[id_col].dataType, (T.StringType, T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    named = [id_col, "pos", "context_pos"] if plain else ["_id", "pos", "context_pos"]

    def prefix_of(batch: pa.RecordBatch) -> pa.Array:
        parts = [pa.scalar(str(seed)), *[batch[c].cast(pa.string()) for c in named], pa.scalar("")]
        return pc.binary_join_element_wise(*parts, "|", null_handling="skip")

    kept = [id_col, "pos", "context_pos", "target"]
    kind = T.ArrayType(T.IntegerType()) if joined is None else T.StringType()
    schema = T.StructType([*[pairs.schema[c] for c in kept], T.StructField("contexts", kind), T.StructField("labels", kind)])
    more = [] if plain else [F.col(id_col).cast("string").alias("_id")]
    return pairs.select(*kept, F.col("context").cast("int").alias("context"), *more).mapInArrow(sampled, schema)


def document_embedding(
    df: DataFrame, id_col: str, col: str, vectors: DataFrame, dim: int, denominator: str = "tokens"
) -> DataFrame:
    """mean of the word vectors ``(word, vector)`` of a document.

    ``denominator='tokens'`` divides by the document's token count, ``'max_len'`` by the
    longest document's, as pooling over padded rows does. Unknown words are zero vectors.
    """
    if denominator not in ("tokens", "max_len"):
        raise ValueError(f"unknown denominator: {denominator}")
    known = materialise(vectors.select(F.col("word").alias("token"), F.col("vector").alias("_vector")).where("token is not null and _vector is not null"))
    words = F.coalesce(F.col(col), F.array().cast("array<string>"))
    docs = df.select(id_col, F.size(words).alias("_size"), words.alias("_tokens"))
    sums = (_sums_inside if known.count() * dim * 8 <= SENT_BYTES else _sums_by_group)(docs, id_col, known, dim)
    # Rows of one id have the sum of all of them.
    merged = sums.groupBy(id_col).agg(
        Summarizer.sum(array_to_vector("_sum")).alias("_sum"), F.collect_list("_size").alias("_sizes")
    )
    zeros = F.array_repeat(F.lit(0.0), dim)
    rows = merged.select(
        id_col, F.when(F.col(id_col).isNull(), zeros).otherwise(vector_to_array("_sum")).alias("_sum"), F.explode("_sizes").alias("_size")
    )
    size = df.agg(F.max(F.size(col))).scalar() if denominator == "max_len" else F.col("_size")
    rows = rows.withColumn("_by", F.greatest(size, F.lit(1)))
    return rows.select(id_col, F.transform("_sum", lambda v: v / F.col("_by")).alias("embedding"))


class _Vectors:
    """Word vectors that a task holds; a word that comes several times has the sum."""

    def __init__(self, tokens: pa.Array, lists: pa.Array, dim: int):
        codes = tokens.dictionary_encode()
        self.words, place = codes.dictionary, np.asarray(codes.indices)
        self.matrix = np.zeros((len(self.words), dim))
        np.add.at(self.matrix, place, lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))

    def sums(self, lists: pa.Array) -> np.ndarray:
        """The sum of the vectors of the words of each list."""
        words = lists.flatten()
        place = pc.index_in(words, value_set=self.words.cast(words.type), skip_nulls=True)
        met = np.asarray(pc.is_valid(place))
        sizes = np.asarray(pc.list_value_length(lists))
        sizes = np.bincount(np.repeat(np.arange(len(lists)), sizes)[met], minlength=len(lists))
        place, ends = np.asarray(place.drop_null()), np.r_[0, np.cumsum(sizes)]
        out = np.zeros((len(lists), self.matrix.shape[1]))
        for a, b in _cuts(ends, SUM_WORDS):
            full = a + np.flatnonzero(sizes[a:b])
            if len(full):
                out[full] = np.add.reduceat(self.matrix[place[ends[a] : ends[b]]], ends[full] - ends[a], axis=0)
        return out


def _sums_inside(docs: DataFrame, id_col: str, known: DataFrame, dim: int) -> DataFrame:
    """``(id, _size, _sum)`` of ``(id, _size, _tokens)`` with vectors that are sent."""
    found = known.toArrow()
    held = _Vectors(found["token"].combine_chunks(), found["_vector"].combine_chunks(), dim)
    sent = docs.sparkSession.sparkContext.broadcast(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _summed(batch, id_col, sent.value, dim)

    return docs.mapInArrow(add, _sum_schema(docs, id_col))


def _sums_by_group(docs: DataFrame, id_col: str, known: DataFrame, dim: int) -> DataFrame:
    """The same with any number of vectors: documents meet them in groups of bounded size, so a vector travels once for each
    group that has its word, and not for each document."""
    docs = materialise(docs)
    words = docs.agg(F.sum("_size")).first()[0] or 0
    groups = max(1, -(-words * dim // GROUP_NUMBERS))
    docs = docs.withColumn("_group", F.pmod(F.xxhash64(id_col, "_tokens"), F.lit(groups)))
    needed = docs.select(F.col("_group").alias("_met"), F.explode(unfolded("_tokens")).alias("token")).distinct()
    met = needed.join(known, "token").select("_met", "token", "_vector")

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        held = _Vectors(right["token"].combine_chunks(), right["_vector"].combine_chunks(), dim)
        parts = [_summed(batch, id_col, held, dim) for batch in left.select([id_col, "_size", "_tokens"]).to_batches()]
        return pa.Table.from_batches(parts)

    return docs.groupBy("_group").cogroup(met.groupBy("_met")).applyInArrow(add, _sum_schema(docs, id_col))


def _sum_schema(docs: DataFrame, id_col: str) -> T.StructType:
    return T.StructType([docs.schema[id_col], T.StructField("_size", T.IntegerType()), T.StructField("_sum", T.ArrayType(T.DoubleType()))])


def _summed(batch: pa.RecordBatch, id_col: str, held: _Vectors, dim: int) -> pa.RecordBatch:
    sums = held.sums(batch["_tokens"])
    ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * dim)
    return pa.RecordBatch.from_arrays(
        [batch[id_col], batch["_size"].cast(pa.int32()), pa.ListArray.from_arrays(ends, pa.array(sums.ravel()))], names=[id_col, "_size", "_sum"]
    )


def embedding_features(
    embeddings: DataFrame, parts: DataFrame, id_col: str = "Id"
) -> DataFrame:
    """precomputed vectors ``(id, embedding)`` beside the split ``(id, is_test, ...)``."""
    return embeddings.join(parts, id_col)
