"""Variational topics: special functions, both ways of meeting the weights, planted topics, the settings, awkward rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.operators import word_topics
from tagloom.session import materialise

PLANTED = [["sun", "rain", "wind", "snow"], ["cat", "dog", "cow", "hen"], ["bus", "car", "train", "ship"]]


@pytest.fixture(scope="module")
def planted(spark):
    """Documents of one topic or of two in the shares 3 to 1, with a word that all have, and documents without words."""
    rnd = np.random.default_rng(5)
    rows = []
    for k in range(240):
        a, b = k % 3, (k + 1) % 3
        tokens = [str(rnd.choice(PLANTED[a if k % 2 or rnd.random() < 0.75 else b])) for _ in range(40)]
        rows.append((k, tokens + ["the"] * 5))
    rows += [(240, []), (241, None), (242, rows[0][1])]
    return materialise(spark.createDataFrame(rows, "Id long, tokens array<string>"))


def plain(docs, weights, alpha, iterations):
    """One document at a time, one word at a time: topic weights and the sums of the words."""
    totals = weights.sum(axis=0)
    beta = np.exp([[word_topics.digamma(x) - word_topics.digamma(t) for x, t in zip(row, totals, strict=True)] for row in weights])
    sums, found = np.zeros_like(weights), []
    for doc in docs:
        gamma = np.ones(weights.shape[1]) if doc else np.full(weights.shape[1], alpha)
        for _ in range(iterations if doc else 0):
            theta = np.exp(word_topics.digamma(gamma) - word_topics.digamma(gamma.sum()))
            new = np.full(len(gamma), alpha)
            for w, n in doc:
                phi = theta * beta[w]
                new = new + n * phi / phi.sum()
            moved, gamma = np.abs(new - gamma).mean(), new
            if moved < word_topics.THRESHOLD:
                break
        theta = np.exp(word_topics.digamma(gamma) - word_topics.digamma(gamma.sum()))
        for w, n in doc:
            phi = theta * beta[w]
            sums[w] += n * phi / phi.sum()
        found.append(gamma)
    return np.array(found), sums


def test_special_functions():
    x = np.array([0.01, 0.1, 0.5, 1.0, 2.5, 7.0, 123.4, 1e6])
    np.testing.assert_allclose(word_topics.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-10)
    np.testing.assert_allclose(word_topics.digamma(np.array([1.0, 0.5])), [-0.5772156649015329, -1.9635100260214235], atol=1e-9)
    np.testing.assert_allclose(word_topics.digamma(x + 1) - word_topics.digamma(x), 1 / x, rtol=1e-8)


def test_inference_equals_a_plain_loop(monkeypatch):
    rnd = np.random.default_rng(1)
    docs = [[(int(w), int(rnd.integers(1, 5))) for w in rnd.choice(30, n, replace=False)] for n in (3, 0, 12, 30, 1)]
    weights = rnd.gamma(1.0, 1.0, (30, 4)) + 0.1
    first = np.r_[0, np.cumsum([len(d) for d in docs])]
    feature, value = (np.array([p[j] for d in docs for p in d]) for j in (0, 1))
    matrix = word_topics.word_weights(weights, weights.sum(axis=0))
    for numbers in (2_000_000, 20):  # also when the words of a document are taken in several pieces
        monkeypatch.setattr(word_topics.linear, "WORK_NUMBERS", numbers)
        for iterations in (1, 3, 200):
            sums = np.zeros_like(weights)
            gamma, _ = word_topics.infer(first, feature, value.astype(float), matrix, 0.25, iterations)
            word_topics.statistics(first, feature, value.astype(float), matrix, 0.25, iterations, sums)
            want, want_sums = plain(docs, weights, 0.25, iterations)
            np.testing.assert_allclose(gamma, want, rtol=1e-7)
            np.testing.assert_allclose(sums * matrix, want_sums, rtol=1e-7, atol=1e-12)


def test_both_ways_give_one_model(spark, planted, tmp_path):
    fits = [word_topics.fit_word_topics(planted, "tokens", 3, passes=2, chunk_size=100, model_bytes=size) for size in (1 << 20, 0)]
    tables = [{r.word_id: r.weights for r in m.table.collect()} for m in fits]
    assert tables[0].keys() == tables[1].keys() == set(range(13))
    np.testing.assert_allclose([tables[0][k] for k in range(13)], [tables[1][k] for k in range(13)], rtol=1e-6)
    np.testing.assert_allclose(fits[0].bounds, fits[1].bounds, rtol=1e-8)
    assert fits[0].rounds == pytest.approx(fits[1].rounds)
    fits[0].save(str(tmp_path / "m"))
    model = word_topics.WordTopics.load(spark, str(tmp_path / "m"))
    shares = {r.Id: r.topics for r in model.topic_distribution(planted, "Id", "tokens").collect()}
    other = {r.Id: r.topics for r in fits[1].topic_distribution(planted, "Id", "tokens").collect()}
    assert shares.keys() == other.keys() == set(range(243))
    assert all(share == pytest.approx(other[k], rel=1e-5) and sum(share) == pytest.approx(1) for k, share in shares.items())
    assert shares[240] == shares[241] == pytest.approx([1 / 3] * 3) and shares[242] == shares[0]


def test_planted_topics_have_the_best_bound(planted):
    """A start can end in a worse optimum, which its bound shows."""
    fits = [word_topics.fit_word_topics(planted, "tokens", 3, passes=15, chunk_size=None, seed=s) for s in (42, 43, 44)]
    model = max(fits, key=lambda m: m.bounds[-1])
    np.testing.assert_allclose([r.p for r in model.phi().groupBy("topic").agg(F.sum("p").alias("p")).collect()], 1)
    top = {}
    for r in model.topic_terms(5).collect():
        top.setdefault(r.topic, set()).add(r.term)
    names = {t: k for t, words in top.items() for k, p in enumerate(PLANTED) if set(p) <= words}
    assert sorted(names.values()) == [0, 1, 2]
    shares = {r.Id: r.topics for r in model.topic_distribution(planted, "Id", "tokens").collect()}
    right = [names[int(np.argmax(shares[k]))] == k % 3 for k in range(240)]
    assert all(right[1::2]) and np.mean(right) > 0.95
    mixed, clear = (np.mean([max(shares[k]) for k in range(first, 240, 2)]) for first in (0, 1))
    assert 0.6 < mixed < 0.85 < clear


def test_settings_have_their_effect(planted):
    whole = word_topics.fit_word_topics(planted, "tokens", 3, passes=8, chunk_size=None)
    assert all(b >= a - 1e-6 * abs(a) for a, b in zip(whole.bounds, whole.bounds[1:], strict=False)) and len(whole.bounds) == 8
    short = word_topics.fit_word_topics(planted, "tokens", 3, passes=8, chunk_size=None, iterations=1)
    assert max(short.rounds) <= 1 < min(whole.rounds) and short.bounds[-1] != pytest.approx(whole.bounds[-1], rel=1e-6)
    again = word_topics.fit_word_topics(planted, "tokens", 3, passes=8, chunk_size=None)
    assert again.bounds == pytest.approx(whole.bounds, rel=1e-12)


def test_nothing_to_learn(spark):
    for rows in ([], [(1, None), (2, [])]):
        df = spark.createDataFrame(rows, "Id long, tokens array<string>")
        model = word_topics.fit_word_topics(df, "tokens", 2, passes=2)
        assert model.table.count() == 0 and model.topic_terms().count() == 0
        some = spark.createDataFrame([(7, ["new"]), (None, None)], "Id long, tokens array<string>")
        assert {r.topics == [0.5, 0.5] for r in model.topic_distribution(some, "Id", "tokens").collect()} == {True}


def test_a_batch_held_as_a_matrix_gives_the_same_weights(monkeypatch):
    rnd = np.random.default_rng(3)
    sizes = rnd.integers(0, 30, 50)
    first = np.r_[0, np.cumsum(sizes)]
    feature = np.concatenate([rnd.choice(40, n, replace=False) for n in sizes])
    value, matrix = rnd.integers(1, 5, first[-1]).astype(float), rnd.random((40, 4))
    met = []
    added = word_topics._added
    monkeypatch.setattr(word_topics, "_added", lambda *a: (met.append(1), added(*a)))
    held = word_topics.infer(first, feature, value, matrix, 0.25, 400)
    assert not met  # no round went over single words
    monkeypatch.setattr(word_topics, "DENSE_CELLS", 0)
    single = word_topics.infer(first, feature, value, matrix, 0.25, 400)
    np.testing.assert_allclose(held[0], single[0], rtol=1e-9)
    assert held[1].tolist() == single[1].tolist() and met


def test_leaps_take_fewer_rounds_to_a_better_bound(monkeypatch):
    """Documents that creep towards their end."""
    rnd = np.random.default_rng(5)
    matrix = word_topics.word_weights(rnd.gamma(2, 1.0, (300, 10)), np.full(10, 600.0))
    sizes = rnd.integers(0, 120, 200)
    first = np.r_[0, np.cumsum(sizes)]
    feature = np.concatenate([rnd.choice(300, n, replace=False) for n in sizes])
    value = rnd.integers(1, 4, len(feature)).astype(float)
    docs = first, feature, value, matrix, 0.1, 400
    (_, bound, many), (_, better, few) = (word_topics.statistics(*docs, np.zeros_like(matrix), leaps=x) for x in (False, True))
    assert 2 * few < many and better > bound
    leaped, taken = word_topics.infer(*docs, leaps=True)
    words = np.bincount(np.repeat(np.arange(200), sizes), value, 200)
    np.testing.assert_allclose(leaped.sum(axis=1), words + 1)  # all words of a document are shared out
    alone, rounds = word_topics.infer(np.array([0, sizes[7]]), *(x[first[7] : first[8]] for x in (feature, value)), *docs[3:], leaps=True)
    np.testing.assert_allclose(alone[0], leaped[7], rtol=1e-6)
    assert rounds[0] == taken[7]
    monkeypatch.setattr(word_topics, "DENSE_CELLS", 0)
    single, rounds = word_topics.infer(*docs, leaps=True)
    np.testing.assert_allclose(single, leaped, rtol=1e-4)
    assert rounds.tolist() == taken.tolist()
