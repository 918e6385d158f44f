"""One query per operator of the survey, over the given tables.

``queries()`` maps a name to ``(spark, sf_dir) -> DataFrame``. Lists are returned as joined
strings or exploded rows and floats are rounded, so that results can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import codelang, html, text
from tagloom.functions.arrays import unfolded
from tagloom.functions.lemma import LEXICON, NOUN, VERB
from tagloom.functions.stopwords import FUNCTION_WORDS, default_stop_words, merge_stop_words
from tagloom.operators import dictionary, dual, features, labels, linear, membership, relevance, stats, topics, vectors, word_topics
from tagloom.plans import experiments, grid, suggest
from tagloom.plans.prepare import body_nodes, processed_questions
from tagloom.session import materialise, scratch_path
from tagloom.sources import processed, questions, results
from tagloom.streaming.suggest import TagTable, question_stream, suggest_tags_stream

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the comparison SQL.
FRENCH_WORDS = ["de", "la", "le", "les", "des", "et", "que", "une", "un", "pour", "dans", "avec"]
GERMAN_WORDS = ["der", "die", "das", "und", "ein", "eine", "mit", "nicht", "ist", "auf", "den"]
STOP_WORDS = merge_stop_words(default_stop_words(), FRENCH_WORDS, GERMAN_WORDS)
KEPT_WORDS = ["the", "de", "und", "que"]
VOCAB, SEQ_LEN, WINDOW, NEGATIVES = 4096, 10, 2, 4
BODY_RANGE, TITLE_RANGE = (0.02, 0.4), (0.005, 1.0)
N_TOPIC, N_TERM, P_TERM = 3, 5, 0.009
UNEVEN_SHARES = [0.33334, 0.99996, 0.123457]
DIM = 64
SIDES, SIDE_ROWS = "tag string, dim long, side double", 1 << 16


def joined(tokens: Column) -> Column:
    return F.array_join(tokens, "|")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def posts(spark: SparkSession, sf: str) -> DataFrame:
    return questions.document_posts(spark, sf)


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """``Id, Title, Body`` only."""
    return questions.document_posts(spark, sf, with_tags=False).select("Id", "Title", "Body")


@lru_cache(maxsize=2)
def body_word_column(context: SparkContext) -> Column:
    """Built once per context: a Column is a tree of many small calls to the JVM."""
    return text.body_words(body_nodes(F.col("Body")), STOP_WORDS)


@lru_cache(maxsize=2)
def segment_column(context: SparkContext) -> Column:
    return html.html_segments(F.col("Body"))


def words(spark: SparkSession, sf: str) -> DataFrame:
    """``Id, tokens``: body words without stop words."""
    return texts(spark, sf).select("Id", body_word_column(spark.sparkContext).alias("tokens"))


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    """``Id, ntags``."""
    return posts(spark, sf).select("Id", text.extract_tags(F.col("Tags")).alias("ntags"))


def segments(spark: SparkSession, sf: str) -> DataFrame:
    return questions.page_posts(spark, sf).select("Id", segment_column(spark.sparkContext).alias("segments"))


def vector_rows(spark: SparkSession, sf: str) -> DataFrame:
    return questions.read_table(spark, sf, "embeddings")


# --- sources and sinks ---------------------------------------------------------------


def question_extract(spark, sf):
    return questions.question_extract(posts(spark, sf))


def csv_questions(spark, sf):
    path = scratch_path(spark, "questions-csv")
    questions.write_questions(posts(spark, sf).select(*questions.QUESTION_COLUMNS), path)
    return questions.load_questions(spark, path)


def deserialize_lists(spark, sf):
    cell = processed.serialize_list(text.title_words(F.col("Title"), STOP_WORDS))
    rows = texts(spark, sf).select("Id", F.posexplode(processed.deserialize_list(cell)).alias("pos", "token"))
    return rows


def processed_csv(spark, sf):
    path = scratch_path(spark, "processed-csv")
    rows = words(spark, sf).select("Id", F.col("tokens").alias("body-tokens"))
    processed.write_processed_csv(rows, path, ["body-tokens"])
    back = processed.read_processed_csv(spark, path, "Id long, `body-tokens` string", ["body-tokens"])
    return back.select("Id", joined(F.col("`body-tokens`")).alias("tokens"))


def results_store(spark, sf):
    path = scratch_path(spark, "results")
    rows = tagged(spark, sf).select("Id", joined(F.col("ntags")).alias("tags"))
    results.save_results(rows, path, "first")
    results.save_results(rows.withColumn("tags", F.upper("tags")), path, "second")
    results.save_results(rows, path, "first")
    return results.load_results(spark, path, "second").select("Id", "tags", "run")


def embedding_store(spark, sf):
    path = scratch_path(spark, "embeddings")
    rows = vector_rows(spark, sf).select(F.col("vec_id").alias("Id"), "embedding")
    results.save_embeddings(rows, path)
    back = results.load_embeddings(spark, path)
    return rounded(back.select("Id", F.posexplode("embedding").alias("dim", "value"))
                   .withColumn("value", F.col("value").cast("double")), "value")


# --- strings and token lists ---------------------------------------------------------


def apply_in_order(spark, sf):
    actions = [text.lower_str, lambda c: text.remove_signs_str(c, text.COMMON_SIGNS), F.trim]
    return texts(spark, sf).select("Id", text.apply_in_order(F.col("Title"), actions).alias("title"))


def extract_tags(spark, sf):
    return posts(spark, sf).select("Id", F.posexplode(text.extract_tags(F.col("Tags"))).alias("pos", "tag"))


def lower_text(spark, sf):
    return texts(spark, sf).select(
        "Id", F.lower("Title").alias("title"), joined(text.lower_list(F.split("Body", " "))).alias("body")
    )


def remove_list(spark, sf):
    pieces = F.split("Title", " ")
    return texts(spark, sf).select(
        "Id", joined(text.remove_list(pieces, "[aeiou]", "_", KEPT_WORDS)).alias("tokens")
    )


def remove_signs_list(spark, sf):
    tokens = text.remove_signs_list(F.split("Body", " "), text.COMMON_SIGNS, " ", text.SIGN_EXCEPTIONS)
    return texts(spark, sf).select("Id", joined(tokens).alias("tokens"))


def remove_signs_str(spark, sf):
    return texts(spark, sf).select("Id", text.remove_signs_str(F.col("Body"), text.COMMON_SIGNS).alias("body"))


def remove_patterns_list(spark, sf):
    tokens = text.remove_patterns_list(F.split("Body", " "), text.NUMBER_PATTERNS)
    return texts(spark, sf).select("Id", joined(tokens).alias("tokens"))


def filter_list(spark, sf):
    pieces = F.split(F.lower("Body"), " ")
    return texts(spark, sf).select(
        "Id",
        joined(text.filter_list(pieces, include=KEPT_WORDS)).alias("included"),
        F.size(text.filter_list(pieces, exclude=KEPT_WORDS)).alias("n_left"),
    )


def filter_empty_list(spark, sf):
    return texts(spark, sf).select(
        "Id", joined(text.filter_empty_list(F.split("Body", "[., \n]"))).alias("tokens")
    )


def tokenize_list(spark, sf):
    return texts(spark, sf).select(
        "Id", joined(text.tokenize_list(F.array("Title", "Body"))).alias("tokens")
    )


def list_to_str(spark, sf):
    return tagged(spark, sf).select("Id", text.list_to_str(F.col("ntags")).alias("tags"))


def sort_list(spark, sf):
    return words(spark, sf).select("Id", joined(text.sort_list(F.col("tokens"))).alias("tokens"))


def sort_by_count(spark, sf):
    rows = tagged(spark, sf)
    counts = stats.count_tokens(rows, "ntags", "doc_count").where("doc_count > 60")
    return membership.sort_by_count(rows, "Id", "ntags", counts, "doc_count", "sorted").select(
        "Id", joined(F.col("sorted")).alias("tags")
    )


def merge_tokens(spark, sf):
    title = text.title_words(F.col("Title"), STOP_WORDS)
    body = text.body_words(body_nodes(F.col("Body")), STOP_WORDS)
    return texts(spark, sf).select("Id", joined(text.merge_tokens(title, body)).alias("tokens"))


def stop_words(spark, sf):
    merged = merge_stop_words(FUNCTION_WORDS, FRENCH_WORDS, GERMAN_WORDS)
    pieces = text.tokenize_list(F.array(F.lower("Body")))
    return texts(spark, sf).select(
        "Id", joined(text.filter_list(pieces, exclude=merged)).alias("tokens")
    )


def lemmatize(spark, sf):
    return words(spark, sf).select("Id", joined(text.lemmatize(F.col("tokens"), (VERB, NOUN))).alias("tokens"))


def lemmatize_nouns(spark, sf):
    return words(spark, sf).select("Id", joined(text.lemmatize(F.col("tokens"), (NOUN,))).alias("tokens"))


def lemmatize_lexicon(spark, sf):
    lexicon = spark.createDataFrame(LEXICON, "token string, pos string, lemma string")
    rows = membership.lemmatize_with_lexicon(words(spark, sf), "Id", "tokens", lexicon, (VERB, NOUN), "lemmas")
    return rows.select("Id", joined(F.col("lemmas")).alias("tokens"))


def body_tokens(spark, sf):
    nodes = body_nodes(F.col("Body"))
    return texts(spark, sf).select("Id", joined(text.body_tokens(nodes, STOP_WORDS)).alias("tokens"))


def body_tokens_wov(spark, sf):
    nodes = body_nodes(F.col("Body"))
    return texts(spark, sf).select(
        "Id", joined(text.body_tokens_without_verbs(nodes, STOP_WORDS)).alias("tokens")
    )


def body_tokens_html(spark, sf):
    nodes = body_nodes(F.col("Body"), exclude=("code", "script", "style"))
    return questions.page_posts(spark, sf).select(
        "Id", joined(text.body_tokens(nodes, STOP_WORDS)).alias("tokens")
    )


def title_tokens(spark, sf):
    return texts(spark, sf).select(
        "Id", joined(text.title_tokens(F.col("Title"), STOP_WORDS)).alias("tokens")
    )


def question_text(spark, sf):
    body = html.html_text(html.html_segments(F.col("Body"), exclude_tags=["code"]))
    return texts(spark, sf).select(
        "Id",
        text.question_text(F.col("Title"), body).alias("question"),
        text.embedding_input(F.col("Title"), body).alias("input"),
    )


def tags_bitmask(spark, sf):
    rows = materialise(tagged(spark, sf))
    classes = [r.tokens for r in stats.most_used(rows, "ntags", 63).collect()]  # what a 64-bit mask holds
    return rows.select("Id", text.tags_bitmask(labels.binarize(F.col("ntags"), sorted(classes))).alias("mask"))


def lookup_questions(spark, sf):
    return questions.document_posts(spark, sf, with_tags=False).where(
        F.col("Id").isin(0, 7, 42, 99, 150)
    ).select("Id", "Title", "Score")


# --- HTML and code -------------------------------------------------------------------


def html_segments(spark, sf):
    return segments(spark, sf).select(
        "Id", F.posexplode(unfolded("segments")).alias("pos", "s")
    ).select("Id", "pos", "s.tag", "s.text")


def html_segments_enclosing(spark, sf):
    nodes = html.html_segments(F.col("Body"), attribution="enclosing")
    return questions.page_posts(spark, sf).select("Id", F.posexplode(nodes).alias("pos", "s")).select(
        "Id", "pos", "s.tag", "s.text"
    )


def segments_by_tag(spark, sf):
    return segments(spark, sf).select(
        "Id",
        joined(html.segments_by_tag(F.col("segments"), exclude=["script", "style", "a"])).alias("without"),
        joined(html.segments_by_tag(F.col("segments"), include=["title", "h1", "li"])).alias("only"),
    )


def html_text(spark, sf):
    return segments(spark, sf).select(
        "Id", html.html_text(F.col("segments")).alias("glued"), html.html_text(F.col("segments"), " ").alias("spaced")
    )


def mixed_text(spark, sf):
    mixed = html.mixed_text(F.col("segments"), code_tags=("code", "script", "style"))
    return segments(spark, sf).select("Id", mixed.alias("m")).select(
        "Id", F.col("m.text").alias("text"), joined(F.col("m.code")).alias("code")
    )


def code_language(spark, sf):
    blocks = html.segments_by_tag(F.col("segments"), include=["code", "script", "style"])
    rows = segments(spark, sf).select("Id", F.posexplode(blocks).alias("pos", "code"))
    return rows.select("Id", "pos", codelang.code_language(F.col("code")).alias("language"))


def code_sections(spark, sf):
    blocks = html.segments_by_tag(F.col("segments"), include=["code", "script", "style"])
    found = codelang.code_sections(blocks, exclude=["CSS"])
    return segments(spark, sf).select("Id", found.alias("c")).select(
        "Id", joined(F.col("c.text")).alias("text"), joined(F.col("c.lexer")).alias("lexer")
    )


# --- statistics ----------------------------------------------------------------------


def count_query(stat: str) -> Query:
    def run(spark, sf):
        counted = stats.count_tokens(words(spark, sf), "tokens", stat)
        return rounded(counted, stat) if stat.endswith("freq") else counted

    return run


def term_doc_stats(spark, sf):
    return rounded(stats.term_doc_stats(words(spark, sf), "tokens"), "term_freq", "doc_freq")


def term_doc_matrix(spark, sf):
    return stats.term_doc_matrix(words(spark, sf), "Id", "tokens")


def top_tokens(spark, sf):
    return rounded(stats.most_used(words(spark, sf), "tokens", 20), "doc_freq")


def bottom_tokens(spark, sf):
    return rounded(stats.least_used(words(spark, sf), "tokens", 20), "doc_freq")


def tokens_usage(spark, sf):
    rows = words(spark, sf)
    plain = stats.tokens_usage(rows, "tokens", 100, "term_freq").select(
        F.lit("term").alias("kind"), F.col("tokens_usage"))
    share = stats.tokens_usage(rows, "tokens", 100, "doc_freq", normalize=True).select(
        F.lit("doc").alias("kind"), F.col("tokens_usage"))
    return rounded(plain.unionByName(share), "tokens_usage")


def tokens_for_coverage(spark, sf):
    return stats.tokens_for_coverage(words(spark, sf), "tokens", 0.5)


def tokens_for_coverage_uneven(spark, sf):
    rows = words(spark, sf)
    tables = [
        stats.tokens_for_coverage(rows, "tokens", share, stat).select(F.lit(f"{share} {stat}").alias("kind"), "n_tokens")
        for share in UNEVEN_SHARES for stat in ("term_freq", "doc_freq")
    ]
    union = tables[0]
    for table in tables[1:]:
        union = union.unionByName(table)
    return union


def coverage_table(spark, sf):
    table = stats.coverage_table(words(spark, sf), "tokens", [100, 500, 1000])
    return rounded(table, "cumulative_term_freq", "doc_coverage")


def corpus_stats(spark, sf):
    table = stats.corpus_stats(words(spark, sf), "tokens")
    return rounded(table, "one_doc_freq", "mean", "std", "min", "q25", "q50", "q75", "max")


def rank_lookup(spark, sf):
    return rounded(stats.rank_lookup(words(spark, sf), "tokens", [49, 258, 685]), "doc_freq")


def banded_top_tokens(spark, sf):
    return rounded(stats.banded_top_tokens(words(spark, sf), "tokens", 100, 25), "doc_freq")


def filter_term_docfreq(spark, sf):
    rows = membership.filter_by_doc_freq(words(spark, sf), "Id", "tokens", "kept", *BODY_RANGE)
    return rows.select("Id", joined(F.col("kept")).alias("tokens"))


def filter_term_docfreq_wide(spark, sf):
    """The same with a vocabulary too long for the plan: joined instead."""
    rows = membership.filter_by_doc_freq(words(spark, sf), "Id", "tokens", "kept", 0.0015, 0.4, limit=0)
    return rows.select("Id", joined(F.col("kept")).alias("tokens"))


def tag_usage(spark, sf):
    return rounded(stats.tag_usage(tagged(spark, sf), "ntags", 10), "share_of_tags", "share_of_usage")


def describe_counters(spark, sf):
    rows = questions.document_posts(spark, sf, with_tags=False)
    table = stats.describe_counters(rows, ["Score", "ViewCount", "FavoriteCount", "AnswerCount"])
    return rounded(table, "mean", "std", "min", "q25", "q50", "q75", "max")


def frequency_cloud(spark, sf):
    return rounded(stats.frequency_cloud(words(spark, sf), "tokens", 200), "doc_freq")


# --- features ------------------------------------------------------------------------


def bow_counts(spark, sf):
    return features.bow_counts(words(spark, sf), "Id", "tokens")


def bow_tfidf(spark, sf):
    return rounded(features.bow_tfidf(words(spark, sf), "Id", "tokens"), "weight")


def bow_vectors(spark, sf):
    """F1 and F2 as vectors: size and squared length of every document's vector."""
    rows = materialise(membership.filter_by_doc_freq(words(spark, sf), "Id", "tokens", "kept", *BODY_RANGE))
    model = vectors.fit_vectorizer(rows, "kept", "tfidf", "v")
    values = vector_to_array("v")
    norm = F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x)
    return model.transform(rows).select(
        "Id", F.size(F.filter(values, lambda x: x != 0)).alias("n_terms"), F.round(norm, 6).alias("norm")
    )


def word_dictionary(spark, sf):
    """Every word with its id, numbered over range partitions."""
    return dictionary.numbered_words(words(spark, sf), "tokens")


def dictionary_tfidf(spark, sf):
    """F2 with the vocabulary as a table: the numbers of the sparse rows."""
    rows = words(spark, sf)
    fitted = dictionary.fit_dictionary(rows, "tokens", "tfidf")
    vector = fitted.transform(rows, "Id", "tokens", "v").select("Id", "v")
    return rounded(vector.select("Id", F.inline(F.arrays_zip("v.indices", "v.values"))).toDF("Id", "word_id", "weight"), "weight")


def multilabel_binarize(spark, sf):
    rows = materialise(tagged(spark, sf))
    classes = labels.label_classes(rows, "ntags")
    bits = labels.binarize(F.col("ntags"), classes)
    return rows.select(
        "Id", F.array_join(bits.cast("array<string>"), "").alias("bits"),
        joined(labels.unbinarize(bits, classes)).alias("tags"),
    )


def standardize(spark, sf):
    rows = vector_rows(spark, sf).select(
        "vec_id", array_to_vector(F.transform("embedding", lambda v: v.cast("double"))).alias("v")
    )
    scaled = vectors.fit_scaler(rows, "v", "z").transform(rows)
    long = scaled.select("vec_id", F.posexplode(vector_to_array("z")).alias("dim", "value"))
    return rounded(long, "value")


def pca_select(spark, sf):
    rows = vector_rows(spark, sf).select(
        "vec_id", array_to_vector(F.transform("embedding", lambda v: v.cast("double"))).alias("v")
    )
    model, kept = vectors.pca_select(rows, "v", "z", 0.8)
    if model is None:
        return rows.select("vec_id", F.lit(0).alias("kept"), F.array().cast("array<double>").alias("components"))
    return model.transform(rows).select("vec_id", F.lit(kept).alias("kept"), vector_to_array("z").alias("components"))


def scree_table(spark, sf):
    rows = vector_rows(spark, sf).select(
        array_to_vector(F.transform("embedding", lambda v: v.cast("double"))).alias("v")
    )
    return rounded(vectors.scree_table(rows, "v", 5), "cumulative_percent")


def pca_norms(spark, sf):
    """All components of each standardised row: their squares add up to those of the row, and the shares to one."""
    rows = vector_rows(spark, sf).select(
        "vec_id", array_to_vector(F.transform("embedding", lambda v: v.cast("double"))).alias("v")
    )
    found = vectors.wide_components(rows, "v", "z")
    squares = F.aggregate(vector_to_array("z"), F.lit(0.0), lambda a, x: a + x * x)
    return found.transform(rows).select(
        "vec_id", F.round(squares, 4).alias("squares"), F.lit(round(float(found.shares.sum()), 6)).alias("shares"))


def sequences(spark, sf) -> DataFrame:
    return features.encode_sequences(words(spark, sf), "Id", "tokens", VOCAB, SEQ_LEN)


def encode_sequences(spark, sf):
    return sequences(spark, sf).select("Id", joined(F.col("sequence").cast("array<string>")).alias("sequence"))


def whole_sequences(spark, sf) -> DataFrame:
    """All words of every text as ids."""
    return features.encode_sequences(materialise(words(spark, sf)), "Id", "tokens", VOCAB, None)


def skipgram_pairs(spark, sf):
    return features.skipgram_pairs(whole_sequences(spark, sf), "Id", "sequence", WINDOW)


def skipgram_pairs_sampled(spark, sf):
    return features.skipgram_pairs(whole_sequences(spark, sf), "Id", "sequence", WINDOW, seed=42, factor=1e-3)


def negative_samples(spark, sf):
    pairs = features.skipgram_pairs(whole_sequences(spark, sf), "Id", "sequence", WINDOW)
    return features.negative_samples(pairs, "Id", NEGATIVES, VOCAB, 42, joined="|")


def word_embeddings(spark, sf):
    model = vectors.fit_word_vectors(words(spark, sf), "Id", "tokens", vocab_size=VOCAB, window=WINDOW)
    return vectors.word_vectors(model)


def ranked_vectors(spark, sf) -> DataFrame:
    """The given embeddings as word vectors: the k-th used word gets vector k."""
    ids = features.vocabulary_ids(words(spark, sf), "tokens", vector_rows(spark, sf).count() + 2)
    rows = vector_rows(spark, sf).select((F.col("vec_id") + 2).cast("int").alias("word_id"), "embedding")
    return ids.join(rows, "word_id").select(F.col("token").alias("word"), F.col("embedding").alias("vector"))


def document_embedding(spark, sf):
    rows = materialise(words(spark, sf))
    docs = features.document_embedding(rows, "Id", "tokens", ranked_vectors(spark, sf), DIM)
    long = rounded(docs.select("Id", F.posexplode(unfolded("embedding")).alias("dim", "value")), "value")
    return long.withColumn("value", F.col("value") + 0.0)  # no negative zero


def embedding_features(spark, sf):
    rows = tagged(spark, sf)
    parts = labels.split_parts(rows, "Id", labels.stratum(F.col("ntags")))
    vecs = vector_rows(spark, sf).select(F.col("vec_id").alias("Id"), "embedding")
    joined_rows = features.embedding_features(vecs, parts.join(rows, "Id"))
    return joined_rows.select(
        "Id", "is_test", joined(F.col("ntags")).alias("tags"),
        F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("total"),
    )


# --- learning, scoring, serving ------------------------------------------------------


def prepared_questions(spark, sf) -> DataFrame:
    return processed_questions(posts(spark, sf).select("Id", "Title", "Body", "Tags"), STOP_WORDS)


def relevance_query(loss: str, nb_tags: int) -> Query:
    def run(spark, sf):
        vecs = vector_rows(spark, sf).select(F.col("vec_id").alias("Id"), "embedding")
        data = tagged(spark, sf)
        found = experiments.supervised_embedding(data, vecs, nb_tags=nb_tags, loss=loss)
        return found.predictions.select("Id", joined("truth").alias("truth"), joined("predicted").alias("predicted"))

    return run


def binary_relevance_equations(spark, sf):
    """The fitted weights put into their normal equations: by tag and dimension the side that holds the weights."""
    vecs = vector_rows(spark, sf).select(F.col("vec_id").alias("Id"), array_to_vector(F.transform("embedding", lambda v: v.cast("double"))).alias("x"))
    return rounded(equations(vecs.join(labels.label_filter(tagged(spark, sf), "Id", "ntags", 50, "kept"), "Id")), "side")


def binary_relevance_equations_wide(spark, sf):
    """The same for standardised word counts, one feature for each word of the vocabulary, solved without a table of features."""
    rows = words(spark, sf).join(labels.label_filter(tagged(spark, sf), "Id", "ntags", 5, "kept"), "Id")
    rows = materialise(rows.select(F.monotonically_increasing_id().alias("_row"), "tokens", "kept"))
    fitted = dictionary.fit_dictionary(rows, "tokens")
    found = equations(fitted.transform(rows, "_row", "tokens", "x"), scale=True, penalty=100.0)
    # Summed over the features, with weights of their own, since the vocabulary has no order in SQL.
    names = fitted.table.select(F.col("word_id").cast("long").alias("dim"), "token")
    weight = F.conv(F.substr(F.md5("token"), F.lit(1), F.lit(6)), 16, 10).cast("double") / F.lit(2.0**24)
    return found.join(names, "dim").groupBy("tag").agg(F.round(F.sum(F.col("side") * weight), 4).alias("side"))


def equations(rows, scale: bool = False, penalty: float = relevance.PENALTY) -> DataFrame:
    """``tag, dim, side``: (Z'Z / n + penalty) w of the weights fitted on ``rows`` (``x``, ``kept``). Of sparse rows with more features than
    rows the weights stay a table; other weights lie on the driver."""
    rows = materialise(rows.select("x", "kept", F.monotonically_increasing_id().alias("_at")))
    classes, width = labels.label_classes(rows, "kept"), linear.width_of(rows, "x")
    if not isinstance(rows.schema["x"].dataType, VectorUDT) and rows.count() < width:
        rows, n = dual.numbered(rows, "_at")
        blocks = dual.feature_blocks(rows, "x")
        found = dual.solve(blocks, dual.signs(rows, n, "kept", classes), scale, penalty)
        return dual.sides(blocks, found, classes, scale, penalty)
    model = relevance.fit_tags(rows, "x", "kept", classes, "squared_error", scale=scale, penalty=penalty)
    blocks = linear.row_blocks(rows, "x", "kept", classes)
    stats = linear.moments(blocks, width, scale)
    w = model.weights * stats.deviation[:, None]
    side = linear.gram_times(blocks, w, stats) / stats.rows + penalty * w
    # From the matrix in slices, so that its numbers never are Python objects.
    path = scratch_path(rows.sparkSession, "sides")
    for a in range(0, max(width, 1), SIDE_ROWS):
        part = side[a : a + SIDE_ROWS]
        dims = np.repeat(np.arange(a, a + len(part)), len(classes))
        made = pa.table({"tag": pa.array(classes * len(part), pa.string()), "dim": dims, "side": part.ravel()})
        rows.sparkSession.createDataFrame(made, SIDES).coalesce(1).write.mode("append").parquet(path)
    return rows.sparkSession.read.schema(SIDES).parquet(path)


def label_filter(spark, sf):
    return labels.label_filter(tagged(spark, sf), "Id", "ntags", 8, "kept").select(
        "Id", joined(F.col("kept")).alias("tags")
    )


def stratified_split(spark, sf):
    rows = labels.label_filter(tagged(spark, sf), "Id", "ntags", 20, "kept")
    return labels.split_parts(rows, "Id", labels.stratum(F.col("kept")))


def stratified_split_lang(spark, sf):
    """A key with one hot value."""
    docs = questions.read_table(spark, sf, "documents").select(F.col("doc_id").alias("Id"), "lang")
    return labels.split_parts(docs, "Id", "lang")


def jaccard_samples(spark, sf):
    rows = labels.label_filter(tagged(spark, sf), "Id", "ntags", 8, "kept")
    return rounded(labels.jaccard_samples(rows, "ntags", "kept"), "jaccard")


def coverage_rates(spark, sf):
    rows = posts(spark, sf).select(
        "Id", text.extract_tags(F.col("Tags")).alias("ntags"),
        text.body_words(body_nodes(F.col("Body")), STOP_WORDS).alias("words"),
    )
    rows = rows.withColumn("predicted", F.array(F.lit("en"), F.lit("que"), F.lit("ander")))
    return rounded(labels.coverage_rates(rows, "ntags", "predicted", "words"), "tag_coverage", "word_coverage")


def bow_run(spark, sf, nb_tags: int = 100, **setting) -> experiments.Run:
    return experiments.supervised_bow(
        prepared_questions(spark, sf), nb_tags=nb_tags, body_min_df=BODY_RANGE[0], body_max_df=BODY_RANGE[1],
        title_min_df=TITLE_RANGE[0], title_max_df=TITLE_RANGE[1], **setting,
    )


def supervised_bow(spark, sf):
    run = bow_run(spark, sf, vect="tfidf", loss="squared_error", scaler=True)
    return run.predictions.select("Id", joined("truth").alias("truth"), joined("predicted").alias("predicted"))


def supervised_bow_hinge(spark, sf):
    run = bow_run(spark, sf, vect="count", loss="hinge", scaler=False)
    return run.predictions.select("Id", joined("truth").alias("truth"), joined("predicted").alias("predicted"))


def scored_rows(run: experiments.Run) -> DataFrame:
    """The test rows of a run with their true labels, and whether each got a prediction."""
    return run.predictions.select("Id", joined("truth").alias("truth"), F.col("predicted").isNotNull().alias("scored"))


def supervised_bow_rows(spark, sf):
    return scored_rows(bow_run(spark, sf, vect="count", loss="squared_error", scaler=False))


def binary_relevance_rows(spark, sf):
    vecs = vector_rows(spark, sf).select(F.col("vec_id").alias("Id"), "embedding")
    return scored_rows(experiments.supervised_embedding(tagged(spark, sf), vecs, nb_tags=50, loss="squared_error"))


def topic_rows(spark, sf) -> DataFrame:
    rows = membership.filter_by_doc_freq(words(spark, sf), "Id", "tokens", "kept", *BODY_RANGE)
    return materialise(rows.select("Id", F.col("kept").alias("tokens")))


def lda_fit(spark, sf):
    rows = topic_rows(spark, sf)
    model = topics.fit_topics(rows, "tokens", num_topics=10)
    return topics.topic_terms(model, 10)


def lda_topics(spark, sf):
    rows = topic_rows(spark, sf)
    model = topics.fit_topics(rows, "tokens", num_topics=10)
    return topics.topic_distribution(rows, model).select("Id", F.posexplode(unfolded("topics")).alias("topic", "share"))


def lda_word_mass(spark, sf):
    """The weights of a word beyond its prior: with all documents in one chunk, its occurrences, however the topics share them."""
    model = word_topics.fit_word_topics(topic_rows(spark, sf), "tokens", num_topics=10, chunk_size=None)
    words = model.table.join(model.words.table.select("word_id", "token"), "word_id")
    mass = F.aggregate("weights", F.lit(0.0), lambda a, x: a + x) - F.lit(model.num_topics * model.eta)
    return words.select(F.col("token").alias("word"), F.round(mass, 3).alias("mass"))


def lda_document_mass(spark, sf):
    """The topic weights of a document beyond their prior: its words, however the topics share them."""
    rows = topic_rows(spark, sf)
    model = word_topics.fit_word_topics(rows, "tokens", num_topics=10)
    weights = model.document_weights(rows, "Id", "tokens")
    mass = F.aggregate("weights", F.lit(0.0), lambda a, x: a + x) - F.lit(model.num_topics * model.alpha)
    return weights.select("Id", F.size("weights").alias("topics"), F.round(mass, 6).alias("mass"))


def lda_share_sums(spark, sf):
    """Topics and their total share, for every document."""
    rows = topic_rows(spark, sf)
    model = topics.fit_topics(rows, "tokens", num_topics=10)
    total = F.aggregate("topics", F.lit(0.0), lambda a, x: a + x)
    return topics.topic_distribution(rows, model).select(
        "Id", F.size("topics").alias("topics"), (F.size("tokens") > 0).alias("words"), F.round(total, 6).alias("share")
    )


def given_topics(spark, sf) -> DataFrame:
    """Topic shares from the given vectors: ten absolute values scaled to sum 1."""
    head = F.transform(F.slice("embedding", 1, 10), lambda v: F.abs(v.cast("double")))
    total = F.aggregate(F.col("head"), F.lit(0.0), lambda a, x: a + x)
    return vector_rows(spark, sf).select("vec_id", head.alias("head")).select(
        "vec_id", F.transform("head", lambda v: v / total).alias("topics")
    )


def given_phi(spark, sf) -> DataFrame:
    """``(topic, term, p)``: mean absolute vector per label, scaled to sum 1."""
    long = vector_rows(spark, sf).select("label", F.posexplode("embedding").alias("dim", "v"))
    means = long.groupBy("label", "dim").agg(F.avg(F.abs(F.col("v").cast("double"))).alias("m"))
    totals = means.groupBy("label").agg(F.sum("m").alias("total"))
    return means.join(totals, "label").select(
        F.col("label").alias("topic"), F.concat(F.lit("w"), "dim").alias("term"), "dim",
        (F.col("m") / F.col("total")).alias("p"),
    )


def topic_selection(spark, sf):
    shares = given_topics(spark, sf)
    chosen = shares.select(
        "vec_id",
        topics.select_topics(F.col("topics"), n_topic=N_TOPIC).alias("by_n"),
        topics.select_topics(F.col("topics"), p_topic=0.15).alias("by_p"),
    )
    rows = chosen.select("vec_id", F.posexplode(F.arrays_zip("by_n", "by_p")).alias("topic", "s"))
    return rounded(rows.select("vec_id", "topic", "s.by_n", "s.by_p"), "by_n", "by_p")


def terms_query(**rule) -> Query:
    def run(spark, sf):
        rows = given_phi(spark, sf).collect()  # 10 labels x 64 dimensions
        phi = np.zeros((10, DIM))
        for r in rows:
            phi[r.topic, r.dim] = r.p
        shares = given_topics(spark, sf).select(
            "vec_id", topics.select_topics(F.col("topics"), n_topic=N_TOPIC).alias("topics"))
        found = topics.predict_terms(shares, "topics", phi, [f"w{k}" for k in range(DIM)], **rule)
        long = found.select("vec_id", F.posexplode(unfolded("terms")).alias("pos", "t")).select(
            "vec_id", "pos", "t.term", F.col("t.prob").alias("prob"))
        return rounded(long, "prob")

    return run


def topic_summary(spark, sf):
    return rounded(topics.topic_distances(given_phi(spark, sf)), "js_divergence")


def topic_distances_sparse(spark, sf):
    """Topics that hold few terms each, so that many pairs have none in common."""
    few = given_phi(spark, sf).where("dim % 10 = topic or dim % 16 = topic")
    total = few.groupBy("topic").agg(F.sum("p").alias("all"))
    rows = few.join(total, "topic").select("topic", "term", (F.col("p") / F.col("all")).alias("p"))
    return rounded(topics.topic_distances(rows), "js_divergence")


def topic_share(spark, sf):
    return rounded(topics.topic_shares(given_topics(spark, sf), "topics"), "share")


def unsupervised(spark, sf):
    run = experiments.unsupervised(
        prepared_questions(spark, sf), nb_tags=50, body_min_df=BODY_RANGE[0], body_max_df=BODY_RANGE[1],
        title_min_df=TITLE_RANGE[0], title_max_df=TITLE_RANGE[1], num_topics=10,
    )
    return run.predictions.select("Id", joined("truth").alias("truth"), joined("predicted").alias("predicted"))


def unsupervised_rows(spark, sf):
    run = experiments.unsupervised(
        prepared_questions(spark, sf), nb_tags=50, body_min_df=BODY_RANGE[0], body_max_df=BODY_RANGE[1],
        title_min_df=TITLE_RANGE[0], title_max_df=TITLE_RANGE[1], num_topics=10, n_term=N_TERM,
    )
    return run.predictions.select("Id", joined("truth").alias("truth"), F.size("predicted").alias("n_terms"))


def distinct_lists(spark, sf) -> DataFrame:
    """Value lists with few members: languages, quality labels, digits of the text length."""
    docs = questions.read_table(spark, sf, "documents")
    quality = questions.read_table(spark, sf, "labels").agg(F.collect_set("quality")).scalar()
    return docs.agg(
        F.collect_set("lang").alias("loss"),
        F.collect_set(F.length(F.col("n_chars").cast("string"))).alias("nb_tags"),
    ).withColumn("vect", quality)


def param_grid(spark, sf):
    return grid.grid_frame(distinct_lists(spark, sf), ["loss", "vect", "nb_tags"])


def config_name(spark, sf):
    rows = param_grid(spark, sf)
    return rows.select("*", grid.config_name_column(rows.columns).alias("name"))


def config_name_mapped(spark, sf):
    """Run names with real losses, vectorisers and percentages, chosen by what the tables hold."""
    lists = distinct_lists(spark, sf).select(
        F.array_distinct(F.transform("loss", lambda x: F.when(x < "es", "hinge").otherwise("squared_error"))).alias("loss"),
        F.array_distinct(F.transform("vect", lambda x: F.when(x == 1, "count").otherwise("tfidf"))).alias("vect"),
        "nb_tags", F.transform("nb_tags", lambda x: x * F.lit(0.01234567)).alias("body_min_df"),
    )
    rows = grid.grid_frame(lists, ["loss", "vect", "nb_tags", "body_min_df"])
    return rows.select("loss", "vect", "nb_tags", grid.config_name_column(rows.columns).alias("name"))


def grid_config(nb_tags=(50, 100)) -> dict:
    return {
        "type": "embedding",
        "model_params": {"loss": ["squared_error"]},
        "params": {"nb_tags": list(nb_tags), "scaler": [True, False], "embedding": ["vectors"]},
    }


def run_grid(spark, sf, nb_tags=(50, 100)):
    path = scratch_path(spark, "grid")
    vecs = materialise(vector_rows(spark, sf).select(F.col("vec_id").alias("Id"), "embedding"))
    grid.run_grid(materialise(tagged(spark, sf)), grid_config(nb_tags), path, vecs)
    return results.load_results(spark, f"{path}/predictions").select(
        "run", "Id", joined("truth").alias("truth"), joined("predicted").alias("predicted")
    )


def run_grid_rows(spark, sf):
    """Every run of the grid with its test rows and true labels."""
    return run_grid(spark, sf).select("run", "Id", "truth")


def results_table(spark, sf):
    path = scratch_path(spark, "grid")
    vecs = materialise(vector_rows(spark, sf).select(F.col("vec_id").alias("Id"), "embedding"))
    grid.run_grid(materialise(tagged(spark, sf)), grid_config(), path, vecs)
    return grid.results_table(spark, {path: "w2v"})


def model_store(spark, sf):
    """Train, save, load, predict with the loaded parts."""
    run = bow_run(spark, sf, vect="tfidf", loss="squared_error", scaler=False)
    path = scratch_path(spark, "model")
    results.save_model(spark, path, run.name, run.vectorizer, run.model)
    _, stages, model = results.load_model(spark, path)
    tokens = suggest.question_tokens(F.col("Title"), F.col("Body"), STOP_WORDS)
    rows = texts(spark, sf).select("Id", tokens.alias("tokens"))
    return suggest.predict_supervised(rows, stages, model).select("Id", joined("supervised").alias("tags"))


def predict_unsupervised(spark, sf):
    rows = topic_rows(spark, sf)
    model = topics.fit_topics(rows, "tokens", num_topics=10)
    return suggest.predict_unsupervised(rows, model).select("Id", joined("unsupervised").alias("tags"))


def known_tags(spark, sf) -> DataFrame:
    """A tag table for the fixtures: all title words."""
    titles = texts(spark, sf).select(text.title_words(F.col("Title"), STOP_WORDS).alias("tags"))
    return stats.count_tokens(titles, "tags", "doc_freq")


def direct_match(spark, sf):
    return suggest.direct_match(words(spark, sf), "Id", "tokens", known_tags(spark, sf)).select(
        "Id", joined(F.col("direct")).alias("tags")
    )


def suggest_tags(spark, sf):
    tags = materialise(known_tags(spark, sf))
    return suggest.suggest_tags(texts(spark, sf), STOP_WORDS, tags, written=True).select("Id", joined(F.col("tags")).alias("tags"))


def suggest_tags_models(spark, sf):
    """All three predictions."""
    run = bow_run(spark, sf, vect="tfidf", loss="squared_error", scaler=False)
    model = topics.fit_topics(topic_rows(spark, sf), "tokens", num_topics=10)
    tags = materialise(known_tags(spark, sf))
    found = suggest.suggest_tags(
        texts(spark, sf), STOP_WORDS, tags, (run.vectorizer, run.model), model, written=True, n_term=3
    )
    return found.select("Id", joined(F.col("tags")).alias("tags"))


def suggest_tags_stream_query(spark, sf):
    tags = TagTable(spark, scratch_path(spark, "tags"))
    tags.publish(known_tags(spark, sf), "titles")
    table = questions.read_table(spark, sf, "documents")
    few = table.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism
    # A pattern that names the table alone: a stream takes no single file as its path, and a folder's files have names of their own.
    stream = question_stream(
        spark, f"{sf}/documents.parque[t]", table.schema,
        partitions=spark.sparkContext.defaultParallelism if few else None, key="doc_id",
    )
    out = scratch_path(spark, "suggested")
    query = suggest_tags_stream(
        stream, out, scratch_path(spark, "suggest-checkpoint"), STOP_WORDS, tags,
        prepare=lambda df: df.select(
            F.col("doc_id").alias("Id"), F.substr(F.split("text", "\n")[0], F.lit(1), F.lit(200)).alias("Title"),
            F.col("text").alias("Body"),
        ),
    )
    query.awaitTermination()
    return spark.read.schema("Id long, tags array<string>").parquet(out).select(
        "Id", joined(F.col("tags")).alias("tags")
    )


QUERIES: dict[str, Query] = {
    "question_extract": question_extract,
    "load_questions_csv": csv_questions,
    "deserialize_lists": deserialize_lists,
    "processed_csv": processed_csv,
    "results_store": results_store,
    "model_store_predict_supervised": model_store,
    "embedding_store": embedding_store,
    "apply_in_order": apply_in_order,
    "extract_tags": extract_tags,
    "lower_text": lower_text,
    "remove_list": remove_list,
    "remove_signs_list": remove_signs_list,
    "remove_signs_str": remove_signs_str,
    "remove_patterns_list": remove_patterns_list,
    "filter_list": filter_list,
    "filter_empty_list": filter_empty_list,
    "tokenize_list": tokenize_list,
    "list_to_str": list_to_str,
    "sort_list": sort_list,
    "sort_by_count": sort_by_count,
    "merge_tokens": merge_tokens,
    "stop_words": stop_words,
    "lemmatize": lemmatize,
    "lemmatize_nouns": lemmatize_nouns,
    "lemmatize_lexicon": lemmatize_lexicon,
    "body_tokens": body_tokens,
    "body_tokens_wov": body_tokens_wov,
    "body_tokens_html": body_tokens_html,
    "title_tokens": title_tokens,
    "question_text": question_text,
    "tags_bitmask": tags_bitmask,
    "lookup_questions": lookup_questions,
    "html_segments": html_segments,
    "html_segments_enclosing": html_segments_enclosing,
    "segments_by_tag": segments_by_tag,
    "html_text": html_text,
    "mixed_text": mixed_text,
    "code_language": code_language,
    "code_sections": code_sections,
    "term_count": count_query("term_count"),
    "term_freq": count_query("term_freq"),
    "doc_count": count_query("doc_count"),
    "doc_freq": count_query("doc_freq"),
    "term_doc_stats": term_doc_stats,
    "term_doc_matrix": term_doc_matrix,
    "top_tokens": top_tokens,
    "bottom_tokens": bottom_tokens,
    "tokens_usage": tokens_usage,
    "tokens_for_coverage": tokens_for_coverage,
    "tokens_for_coverage_uneven": tokens_for_coverage_uneven,
    "coverage_table": coverage_table,
    "corpus_stats": corpus_stats,
    "rank_lookup": rank_lookup,
    "banded_top_tokens": banded_top_tokens,
    "filter_term_docfreq": filter_term_docfreq,
    "filter_term_docfreq_wide": filter_term_docfreq_wide,
    "tag_usage": tag_usage,
    "describe_counters": describe_counters,
    "frequency_cloud": frequency_cloud,
    "bow_counts": bow_counts,
    "bow_tfidf": bow_tfidf,
    "bow_vectors": bow_vectors,
    "word_dictionary": word_dictionary,
    "dictionary_tfidf": dictionary_tfidf,
    "multilabel_binarize": multilabel_binarize,
    "standardize": standardize,
    "pca_select": pca_select,
    "scree_table": scree_table,
    "pca_norms": pca_norms,
    "encode_sequences": encode_sequences,
    "skipgram_pairs": skipgram_pairs,
    "skipgram_pairs_sampled": skipgram_pairs_sampled,
    "negative_samples": negative_samples,
    "word_embeddings": word_embeddings,
    "document_embedding": document_embedding,
    "embedding_features": embedding_features,
    "binary_relevance_squared_error": relevance_query("squared_error", 50),
    "binary_relevance_hinge": relevance_query("hinge", 50),
    "binary_relevance_equations": binary_relevance_equations,
    "binary_relevance_equations_wide": binary_relevance_equations_wide,
    "label_filter": label_filter,
    "stratified_split": stratified_split,
    "stratified_split_lang": stratified_split_lang,
    "jaccard_samples": jaccard_samples,
    "coverage_rates": coverage_rates,
    "supervised_bow": supervised_bow,
    "supervised_bow_hinge": supervised_bow_hinge,
    "supervised_bow_rows": supervised_bow_rows,
    "binary_relevance_rows": binary_relevance_rows,
    "lda_share_sums": lda_share_sums,
    "lda_word_mass": lda_word_mass,
    "lda_document_mass": lda_document_mass,
    "unsupervised_rows": unsupervised_rows,
    "run_grid_rows": run_grid_rows,
    "lda_fit": lda_fit,
    "lda_topics": lda_topics,
    "topic_selection": topic_selection,
    "predict_terms_n": terms_query(n_term=N_TERM),
    "predict_terms_p": terms_query(p_term=P_TERM),
    "topic_distances": topic_summary,
    "topic_distances_sparse": topic_distances_sparse,
    "topic_shares": topic_share,
    "unsupervised": unsupervised,
    "param_grid": param_grid,
    "config_name": config_name,
    "config_name_mapped": config_name_mapped,
    "run_grid": run_grid,
    "results_table": results_table,
    "predict_unsupervised": predict_unsupervised,
    "direct_match": direct_match,
    "suggest_tags": suggest_tags,
    "suggest_tags_models": suggest_tags_models,
    "suggest_tags_stream": suggest_tags_stream_query,
}
