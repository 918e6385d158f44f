import math

import numpy as np
import pytest

from tagloom.operators import linear, online_topics, topics
from tagloom.session import materialise

PLANTED = [["sun", "rain", "wind"], ["cat", "dog", "cow"]]


def test_trigamma():
    assert online_topics.trigamma(np.array([1.0, 0.5])) == pytest.approx([math.pi**2 / 6, math.pi**2 / 2], abs=1e-8)


def test_prior_moves_towards_the_documents():
    alpha, true = np.array([0.5, 0.5]), np.array([0.2, 3.0])
    logs = online_topics.digamma(true) - online_topics.digamma(true.sum())
    for _ in range(500):
        alpha = online_topics.moved_prior(alpha, logs, 100.0, 0.2)
    assert alpha == pytest.approx(true, rel=1e-4)


def test_each_step_of_many_rows_reads_its_chunk_alone(spark, tmp_path, monkeypatch):
    rows = 2100
    docs = [(i, PLANTED[i % 2] * 4 if i < rows - 2 else ([] if i == rows - 2 else ["unknown"])) for i in range(rows)]
    df = materialise(spark.createDataFrame(docs, "Id long, tokens array<string>"))
    read, plain = [], linear.summed

    def summed(*a):
        sums, rest = plain(*a)
        read.append(int(rest[0, -1]))
        return sums, rest

    monkeypatch.setattr(linear, "summed", summed)
    model = topics.fit_topics(df, "tokens", num_topics=2, passes=3, chunk_size=1000)
    assert len(read) == 9 and sum(read) == 3 * rows and max(read) < rows / 2
    model.save(str(tmp_path / "m"))
    loaded = topics.TopicModel.load(str(tmp_path / "m"))
    assert loaded.phi() == pytest.approx(model.phi()) and loaded.lda.alpha == pytest.approx(model.lda.alpha)
    shares = {r.Id: r.topics for r in topics.topic_distribution(df, loaded).collect()}
    assert shares.keys() == set(range(rows)) and shares[rows - 2] == [0.0, 0.0]
    assert all(sum(v) == pytest.approx(1) for k, v in shares.items() if k != rows - 2)
    assert {int(np.argmax(shares[k])) for k in range(0, 100, 2)} != {int(np.argmax(shares[k])) for k in range(1, 100, 2)}
    found = topics.predict(df.limit(100), loaded, n_term=3).collect()
    assert {tuple(sorted(t.term for t in r.terms)) for r in found} == {("rain", "sun", "wind"), ("cat", "cow", "dog")}
