import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tagloom.operators import features, labels, membership, relevance, stats, topics, vectors
from tagloom.session import materialise


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_frequencies_of_the_three_documents(corpus):
    tf = as_dict(stats.count_tokens(corpus, "tokens", "term_freq"), "tokens", "term_freq")
    assert tf == pytest.approx({"a": 0.3, "b": 0.3, "c": 0.1, "d": 0.1, "e": 0.2})
    df = as_dict(stats.count_tokens(corpus, "tokens", "doc_freq"), "tokens", "doc_freq")
    assert df == pytest.approx({"a": 1 / 3, "b": 1, "c": 1 / 3, "d": 1 / 3, "e": 2 / 3})
    both = stats.term_doc_stats(corpus, "tokens")
    assert as_dict(both, "tokens", "term_freq") == pytest.approx(tf)
    assert as_dict(both, "tokens", "doc_freq") == pytest.approx(df)
    matrix = stats.term_doc_matrix(corpus, "Id", "tokens", ["a", "e"]).orderBy("Id").collect()
    assert [(r.a, r.e) for r in matrix] == [(3, 0), (0, 1), (0, 1)]


def test_statistic_name_is_checked(corpus):
    for bad in ("", "both", "term_count,doc_count"):
        with pytest.raises(ValueError):
            stats.count_tokens(corpus, "tokens", bad)


def test_empty_documents_count(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, [])], "Id long, tokens array<string>")
    assert stats.count_tokens(df, "tokens", "doc_freq").first().doc_freq == 0.5


def test_coverage_equals_a_plain_loop(spark):
    rng = np.random.default_rng(3)
    docs = [[f"t{int(x)}" for x in rng.zipf(1.6, 40) if x < 60] for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(docs)), "Id long, tokens array<string>")
    counts: dict[str, int] = {}
    for t in (t for d in docs for t in d):
        counts[t] = counts.get(t, 0) + 1
    ordered, total = sorted(counts.values(), reverse=True), sum(counts.values())

    def needed(share):
        return next((n for n in range(1, len(ordered) + 1) if sum(ordered[:n]) * 1000 >= round(share * 1000) * total), len(ordered))

    for share in (0.1, 0.25, 0.5, 0.8, 0.9, 0.999, 1.0):
        assert stats.tokens_for_coverage(df, "tokens", share).first()[0] == needed(share)
    usage = stats.tokens_usage(df, "tokens", 7, "term_freq").first()[0]
    assert usage == pytest.approx(sum(ordered[:7]) / total)
    table = stats.coverage_table(df, "tokens", [3, 10_000])
    got = sorted((r.n_most_used, round(r.cumulative_term_freq, 9)) for r in table.collect())
    want = [needed(k / 10) for k in range(1, 10)] + [3, 10_000]
    assert got == sorted((n, round(sum(ordered[:n]) / total, 9)) for n in want)


def test_doc_freq_bounds_are_strict(corpus):
    for limit in (membership.IN_LIST, 0):  # list in the plan, and join
        kept = membership.filter_by_doc_freq(corpus, "Id", "tokens", "kept", limit=limit).orderBy("Id")
        assert [r.kept for r in kept.collect()] == [["a", "a", "a"], ["c", "e"], ["d", "e"]]


def test_drop_and_emptied_documents(spark, corpus):
    vocabulary = spark.createDataFrame([("a", 1), ("b", 3)], "tokens string, n long")
    for limit in (10, 0):
        dropped = membership.keep_tokens(corpus, "Id", "tokens", vocabulary, "o", "n", keep=False, limit=limit)
        assert [r.o for r in dropped.orderBy("Id").collect()] == [[], ["c", "e"], ["d", "e"]]


def test_lookup_beyond_the_broadcast_limit(spark):
    """A hot token in a third of the rows, a large table: same rows as a plain join."""
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 400)).alias("token"))
    seen = rows.groupBy("token").agg(F.count("*").alias("n"))
    for missing in ("t7", "hot"):  # the most frequent token can be one that the table lacks
        table = seen.where(F.col("token") != missing).select("token", F.upper("token").alias("big"))
        got = membership.token_lookup(rows, table, "token", ["big"], ["id"], max_broadcast_bytes=5, hot_tokens=3)
        plain = rows.join(table, "token", "left").select("id", "token", "big")
        assert sorted(got.select("id", "token", "big").collect(), key=str) == sorted(plain.collect(), key=str)


def test_hot_tokens_are_spread_whether_the_table_has_them_or_not(spark):
    rows = spark.range(40_000).select(
        "id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 4000)).alias("token"))
    everything = rows.select("token").distinct().select("token", F.upper("token").alias("big"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for table in (everything, everything.where("token <> 'hot'")):
            got = membership.token_lookup(rows, table, "token", ["big"], ["id"], max_broadcast_bytes=5, hot_tokens=3)
            sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            assert sum(sizes) == 40_000 and max(sizes) < 10_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_coverage_of_uneven_shares(spark):
    df = spark.range(30_001).select(F.col("id").alias("Id"), F.array(F.col("id").cast("string")).alias("tokens"))
    for share, n in ((0.33334, 10_001), (0.99996, 30_000), (0.5, 15_001), (1.0, 30_001)):
        assert stats.tokens_for_coverage(df, "tokens", share).first().n_tokens == n


def test_topics_without_a_common_term(spark):
    rows = [(0, "a", 1.0), (1, "b", 1.0), (2, "a", 0.5), (2, "b", 0.5)]
    got = {(r.topic_a, r.topic_b): r.js_divergence for r in
           topics.topic_distances(spark.createDataFrame(rows, "topic int, term string, p double")).collect()}
    assert set(got) == {(0, 1), (0, 2), (1, 2)} and got[(0, 1)] == pytest.approx(math.log(2))


def test_lexicon_with_two_entries_of_a_token(spark):
    docs = spark.createDataFrame([(1, ["leaves"])], "Id long, tokens array<string>")
    entries = [("leaves", "VERB", "leave"), ("leaves", "NOUN", "leaf"), ("leaves", "NOUN", "leafs")]
    for order in (entries, entries[::-1]):
        lexicon = spark.createDataFrame(order, "token string, pos string, lemma string")
        for allowed, lemma in ((["NOUN"], "leaf"), (["VERB"], "leave")):
            got = membership.lemmatize_with_lexicon(docs, "Id", "tokens", lexicon, allowed, "o").first().o
            assert got == [lemma]


def test_sort_by_count_is_stable(spark):
    df = spark.createDataFrame([(1, ["x", "c", "b", "a", "y"])], "Id long, tags array<string>")
    counts = spark.createDataFrame([("a", 1), ("b", 5), ("c", 1)], "tokens string, n long")
    assert membership.sort_by_count(df, "Id", "tags", counts, "n", "s").first().s == ["x", "y", "c", "a", "b"]


def test_tfidf_by_hand(corpus):
    got = {(r.Id, r.token): r.weight for r in features.bow_tfidf(corpus, "Id", "tokens").collect()}
    a, b = 3 * (math.log(4 / 2) + 1), math.log(4 / 4) + 1
    assert got[(1, "a")] == pytest.approx(a / math.hypot(a, b))
    rows = materialise(corpus)
    model = vectors.fit_vectorizer(rows, "tokens", "tfidf", "v")
    terms = model.stages[0].vocabulary
    for r in model.transform(rows).collect():
        for k, x in zip(r.v.indices, r.v.values):
            assert x == pytest.approx(got[(r.Id, terms[k])])


def test_sequences_pairs_and_negative_samples(corpus):
    seq = features.encode_sequences(corpus, "Id", "tokens", vocab_size=5, sequence_length=5)
    rows = {r.Id: r.sequence for r in seq.collect()}
    assert rows == {1: [2, 2, 2, 3, 0], 2: [3, 1, 4, 0, 0], 3: [3, 1, 4, 0, 0]}
    pairs = features.skipgram_pairs(seq, "Id", window=1)
    of_two = sorted((r.target, r.context) for r in pairs.where("Id = 2").collect())
    assert of_two == [(1, 3), (1, 4), (3, 1), (4, 1)]
    for r in features.negative_samples(pairs, "Id", k=4, vocab_size=5).collect():
        assert r.labels == [1, 0, 0, 0, 0] and sorted(r.contexts) == [0, 1, 2, 3, 4]
    a = features.negative_samples(pairs, "Id", 4, 4096).collect()
    assert a == features.negative_samples(pairs, "Id", 4, 4096).collect()
    assert all(len(set(r.contexts)) == 5 and 0 <= min(r.contexts) and max(r.contexts) < 4096 for r in a)


def test_document_embedding_denominators(spark, corpus):
    vecs = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.0])], "word string, vector array<double>")
    mean = as_dict(features.document_embedding(corpus, "Id", "tokens", vecs, 2), "Id", "embedding")
    assert mean == {1: [1.5, 2.5], 2: [1.0, pytest.approx(4 / 3)], 3: [1.0, pytest.approx(4 / 3)]}
    padded = as_dict(features.document_embedding(corpus, "Id", "tokens", vecs, 2, "max_len"), "Id", "embedding")
    assert padded[2] == [0.75, 1.0]


def test_binarize_and_back(spark):
    df = spark.createDataFrame([(1, ["b", "a"]), (2, ["c"]), (3, [])], "Id long, tags array<string>")
    classes = labels.label_classes(df, "tags")
    bits = labels.binarize(F.col("tags"), classes)
    rows = df.orderBy("Id").select(bits.alias("b"), labels.unbinarize(bits, classes).alias("t")).collect()
    assert [r.b for r in rows] == [[1, 1, 0], [0, 0, 1], [0, 0, 0]] and [r.t for r in rows] == [["a", "b"], ["c"], []]
    with pytest.raises(ValueError):
        labels.label_classes(df, "tags", max_labels=2)


def test_split_sizes_with_hot_and_single_keys(spark):
    df = spark.range(30_000).select(
        F.col("id").alias("Id"),
        F.when(F.col("id") < 10_000, "hot").when(F.col("id") < 10_050, F.concat(F.lit("k"), F.col("id") % 10))
        .otherwise(F.concat(F.lit("single"), "id")).alias("key"),
    )
    rows = labels.stratified_split(df, "Id", "key")
    kind = F.when(F.col("key").startswith("single"), "rest").otherwise(F.col("key"))
    got = as_dict(rows.groupBy(kind.alias("k")).agg(F.sum(F.col("is_test").cast("int")).alias("n")), "k", "n")
    assert rows.count() == 30_000
    assert got == {"hot": 2000, "rest": 3990, **{f"k{i}": 1 for i in range(10)}}
    everything = labels.split_parts(df, "Id", None, test_size=0.1)
    assert everything.where("is_test").count() == 3000


def test_jaccard(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], []), (["a"], ["a"])],
                               "t array<string>, p array<string>")
    assert labels.jaccard_samples(df, "t", "p").first().jaccard == pytest.approx((1 / 3 + 0 + 1) / 3)
    rates = labels.coverage_rates(df.withColumn("w", F.array(F.lit("b"), F.lit("x"))), "t", "p", "w").first()
    assert rates.tag_coverage == pytest.approx(0.75) and rates.word_coverage == pytest.approx(1 / 6)


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 6)) * np.array([5, 3, 2, 1, 0.5, 0.1])
    tags = [["pos"] * int(r[0] > 0) + ["up"] * int(r[1] > 0) for r in x]
    rows = [(k, [float(v) for v in r], t) for k, (r, t) in enumerate(zip(x, tags))]
    df = spark.createDataFrame(rows, "Id long, x array<double>, tags array<string>")
    return x, materialise(df.select("Id", "tags", array_to_vector("x").alias("v")))


def test_scaling_and_components(spark, cloud):
    x, df = cloud
    scaled = vectors.fit_scaler(df, "v", "z").transform(df).orderBy("Id")
    z = np.array([r.z.toArray() for r in scaled.collect()])
    np.testing.assert_allclose(z, (x - x.mean(0)) / x.std(0), atol=1e-9)
    values = np.linalg.svd(z, compute_uv=False) ** 2
    shares = values / values.sum()
    model, kept = vectors.pca_select(df, "v", "p", 0.8)
    assert kept == sum(np.cumsum(shares) < 0.8) == model.transform(df).first().p.size
    assert vectors.pca_select(df, "v", "p", 0.01) == (None, 0)
    table = vectors.scree_table(df, "v", step=2).orderBy("axis").collect()
    assert [r.axis for r in table] == [0, 2, 4]
    np.testing.assert_allclose([r.cumulative_percent for r in table], 100 * np.cumsum(shares)[::2], atol=1e-6)
    assert vectors.scree_table(df, "v", step=2, include_last=True).count() == 4


@pytest.mark.parametrize("loss", relevance.LOSSES)
def test_one_classifier_per_tag(spark, cloud, loss):
    x, df = cloud
    model = relevance.fit_tags(df, "v", "tags", ["pos", "up"], loss)
    found = relevance.predict_tags(df.where(F.size("tags") > 0), "v", model)
    assert labels.jaccard_samples(found, "tags", "predicted").first().jaccard > 0.9
    if loss == "squared_error":
        y = np.array([[1 if x[i, j] > 0 else -1 for j in (0, 1)] for i in range(len(x))])
        want = np.linalg.solve(x.T @ x / len(x) + relevance.PENALTY * np.eye(6), x.T @ y / len(x))
        np.testing.assert_allclose(model.weights, want, atol=1e-8)
    again = relevance.TagModel.from_frame(model.to_frame(spark), loss)
    np.testing.assert_allclose(again.weights, model.weights)
    with pytest.raises(ValueError):
        relevance.fit_tags(df, "v", "tags", ["pos"], "log")


def test_topic_rules(spark):
    assert topics.check_predict(10, 50) == (None, 10, 0.95, None)
    assert topics.check_predict(10, 50, p_topic=2.0, n_term=99) == (0.95, None, None, 50)
    for bad in ({"p_topic": 0.1, "n_topic": 2}, {"p_term": 0.1, "n_term": 2}):
        with pytest.raises(ValueError):
            topics.check_predict(10, 50, **bad)
    df = spark.createDataFrame([([0.5, 0.005, 0.2, 0.295],)], "t array<double>")
    pick = lambda **rule: df.select(topics.select_topics(F.col("t"), **rule).alias("r")).first().r
    assert pick(p_topic=0.2) == [0.5, 0, 0, 0.295] and pick(n_topic=2) == [0.5, 0, 0, 0.295]
    assert pick(floor=0.01) == [0.5, 0, 0.2, 0.295]


def test_terms_per_document(spark):
    phi = np.array([[0.7, 0.2, 0.1], [0.1, 0.3, 0.6]])
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "Id long, t array<double>")
    best = topics.predict_terms(df, "t", phi, ["x", "y", "z"], n_term=2).orderBy("Id").collect()
    assert [[t.term for t in r.terms] for r in best] == [["y", "x"], ["y", "z"]]
    above = topics.predict_terms(df, "t", phi, ["x", "y", "z"], p_term=0.5).orderBy("Id").collect()
    assert [[t.term for t in r.terms] for r in above] == [["x"], ["z"]]


def test_topic_model(spark, tmp_path):
    docs = [["sun", "rain", "wind"] * 4, ["cat", "dog", "cow"] * 4] * 15
    df = materialise(spark.createDataFrame(list(enumerate(docs)), "Id long, tokens array<string>"))
    model = topics.fit_topics(df, "tokens", num_topics=2, passes=20)
    shares = topics.topic_distribution(df, model)
    assert all(sum(r.topics) == pytest.approx(1) for r in shares.collect())
    np.testing.assert_allclose(model.phi().sum(axis=1), 1)
    model.save(str(tmp_path / "lda"))
    loaded = topics.TopicModel.load(str(tmp_path / "lda"))
    found = topics.predict(df, loaded, n_term=3).collect()
    assert {tuple(sorted(t.term for t in r.terms)) for r in found} == {("rain", "sun", "wind"), ("cat", "cow", "dog")}
    assert all(r.terms == [] for r in topics.predict(df, loaded).collect())
    assert topics.topic_terms(model, 2).count() == 4


def test_word_vectors_are_repeatable(corpus):
    fit = lambda: vectors.word_vectors(
        vectors.fit_word_vectors(corpus, "Id", "tokens", dim=4, vocab_size=3, epochs=1)).orderBy("word").collect()
    first = fit()
    assert len(first) == 3 and all(len(r.vector) == 4 for r in first) and first == fit()


def test_cutoff_id_of_spread_and_repeated_ids(spark):
    from tagloom.sources.questions import cutoff_id

    ids = [k * k * 7919 - 5_000_000 for k in range(3000)] + [42, 42]
    frame = spark.createDataFrame([(k,) for k in ids], "Id long")
    for n in (1, 2, 1500, 3002):
        assert cutoff_id(frame, n) == sorted(ids)[n - 1]
    assert cutoff_id(frame, 3003) is None and cutoff_id(frame.limit(0), 1) is None


def test_quantiles_over_range_partitions(spark):
    rows = [(g, float((k * 37) % 101), 1 + k % 3) for g in ("a", "b") for k in range(60)]
    frame = spark.createDataFrame(rows, "g string, value double, n long").groupBy("g", "value").agg(F.sum("n").alias("n"))
    got = {r.g: r.q for r in stats.exact_quantiles(frame, "g", "value", "n", (0.0, 0.25, 0.5, 0.9, 1.0)).collect()}
    for g in ("a", "b"):
        flat = [v for x, v, n in rows if x == g for _ in range(n)]
        assert got[g] == pytest.approx(list(np.quantile(flat, (0.0, 0.25, 0.5, 0.9, 1.0))))
