"""Counted pairs, their tree and slopes by brute force; the trained vectors on planted contexts."""

import numpy as np
import pytest

from tagloom.operators import skipgram, vectors


def brute(lists, size, window):
    n = np.zeros((size, size + 1))
    for ids in lists:
        for p, a in enumerate(ids):
            n[a, size] += 1
            for d in range(1, window + 1):
                if p + d < len(ids):
                    n[a, ids[p + d]] += window + 1 - d
    return n


@pytest.mark.parametrize("held", [4, 1000])
def test_pairs_are_counted_whole(spark, monkeypatch, held):
    monkeypatch.setattr(skipgram, "PAIRS_AT_ONCE", held)
    lists = [[0, 1, 2, 1, 0, 0], [], [3], [2, 3, 3, 1] * 5, [1, 2]]
    df = spark.createDataFrame([(x,) for x in lists], "ids array<int>").coalesce(1)
    pairs = skipgram.count_pairs(df, "ids", 4, 2)
    got = np.zeros((4, 5))
    for r in pairs.collect():
        got[r.a, r.b] += r.n
    assert (got == brute(lists, 4, 2)).all()
    blocks = skipgram.pair_blocks(pairs, 4, 2, 2).collect()
    both = np.zeros((4, 4))
    for r in blocks:
        words, ends, contexts = (np.frombuffer(r[c], np.int64) for c in ("words", "ends", "contexts"))
        np.add.at(both, (np.repeat(words, np.diff(np.r_[0, ends])), contexts), np.frombuffer(r["counts"]))
    half = brute(lists, 4, 2)[:, :4] / 2
    assert (both == half + half.T).all()


def test_slopes_are_those_of_the_loss(monkeypatch):
    monkeypatch.setattr(skipgram, "DENSE_NUMBERS", 20)  # two words at once
    rng = np.random.default_rng(0)
    size, dim = 5, 3
    tree = skipgram.huffman(np.array([9, 4, 3, 1, 1]))
    n = rng.integers(0, 4, (size, size)).astype(float)
    vec, nodes = rng.standard_normal((size, dim)).astype(np.float32), rng.standard_normal((size - 1, dim)).astype(np.float32)
    paths = {k: [] for k in range(size)}
    for k, (left, right) in enumerate(tree):
        for child, code in ((left, 1), (right, -1)):
            todo = [child]
            while todo:
                c = todo.pop()
                if c < size:
                    paths[c].append((k, code))
                else:
                    todo += list(tree[c - size])

    def loss(vec, nodes):
        return sum(n[a, b] * np.log1p(np.exp(-code * (nodes[k] @ vec[a]))) for a in range(size) for b in range(size) for k, code in paths[b])

    words, contexts = np.arange(size), np.tile(np.arange(size), size)
    by_word, by_node, whole = skipgram.gradient(words, (words + 1) * size, contexts, n.ravel(), tree, vec, nodes)
    assert whole == pytest.approx(loss(vec, nodes), rel=1e-5)
    for x, slopes in ((vec, by_word), (nodes, by_node)):
        for at in np.ndindex(x.shape):
            parts = []
            for step in (1e-3, -1e-3):
                moved = [vec.astype(float), nodes.astype(float)]
                moved[0 if x is vec else 1][at] += step
                parts.append(loss(*moved))
            assert slopes[at] == pytest.approx((parts[0] - parts[1]) / 2e-3, abs=1e-3)


def test_words_of_equal_contexts_come_near(spark):
    rows = [(k, ["warm", x, "day"] if k % 2 else ["loud", y, "noise"]) for k, (x, y) in enumerate([("sun", "dog"), ("summer", "cat")] * 15)]
    rows += [(100 + k, ["warm", "summer", "day"]) for k in range(9)] + [(200 + k, ["loud", "cat", "noise"]) for k in range(9)]
    rows += [(300 + k, ["warm", "sun", "day"]) for k in range(9)] + [(None, ["alone"])]
    df = spark.createDataFrame(rows, "Id long, tokens array<string>")
    model = vectors.fit_word_vectors(df, "Id", "tokens", dim=8, epochs=4)
    assert model.losses[-1] < 0.7 * model.losses[0] and "alone" not in model.words
    found = dict(zip(model.words, model.vectors / np.linalg.norm(model.vectors, axis=1, keepdims=True), strict=True))
    assert found["sun"] @ found["summer"] > found["sun"] @ found["cat"]
    empty = vectors.fit_word_vectors(df.limit(0), "Id", "tokens", dim=8, epochs=1)
    assert empty.words == [] and vectors.word_vectors(empty).count() == 0
