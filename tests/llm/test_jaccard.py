"""The signature-tree join against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tagloom.llm import jaccard_tree
from tagloom.llm.components import components
from tagloom.llm.jaccard_tree import bitmap, jaccard_components, keep_one_each, least_shared, linked, prefix_length, tree_pairs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """Smallest reachable id of every id, over an inverted index of all shingles."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        common = Counter(j for g in s for j in where[g])
        for j, n in common.items():
            if linked(n, len(s), len(sets[j][1])):
                a, b = find(i), find(sets[j][0])
                parent[max(a, b)] = min(a, b)
        for g in s:
            where[g].append(k)
    return {i: find(i) for i in parent}


def corpus(seed, groups=6, copies=30, words=120, edits=6):
    """Near copies with more and fewer edits, exact copies, a passage that many share, short texts."""
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    passage = [rnd.choice(vocabulary) for _ in range(40)]
    rows = []
    for _ in range(groups):
        base = [rnd.choice(vocabulary) for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rnd.randint(0, edits)):
                text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
            rows.append(" ".join(text))
    for _ in range(80):
        text = [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 60))]
        rows.append(" ".join(text + passage if rnd.random() < 0.6 else text))
    rows += ["", None, " \n", "a", "A", "a b c d", "a b c d", *rows[:10], " ".join(passage), *[" ".join([*passage, f"x{k}"]) for k in range(9)]]
    rnd.shuffle(rows)
    return list(enumerate(rows, 10))


@pytest.mark.parametrize("seed, block", [(0, 1500), (1, 1500), (2, 20), (3, 7)])
def test_components_match_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard_tree, "BLOCK", block)
    monkeypatch.setattr(jaccard_tree, "ANCHORS", 4)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()}
    want = brute(rows)
    assert got == {i: (len(shingles(t)), want[i]) for i, t in rows}


def test_frequent_shingles_change_nothing(spark):
    rows = corpus(5, groups=2, copies=60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in jaccard_components(docs, sample=1).collect()}
    assert got == brute(rows)


def test_similarity_of_exactly_eight_tenths_links():
    assert linked(8, 9, 9) and not linked(8, 9, 10) and linked(4, 5, 4)


def test_linked_sets_share_what_the_prefixes_promise():
    rnd = random.Random(8)
    for _ in range(3000):
        n = rnd.randint(4, 60)
        x = set(rnd.sample(range(80), n))
        y = set(x)
        for _ in range(rnd.randint(0, 8)):
            y.symmetric_difference_update({rnd.randrange(80)})
        if y and linked(len(x & y), len(x), len(y)):
            a, b = (sorted(s)[: prefix_length(len(s)) - 1 + -(-len(s) // 10)] for s in (x, y))
            common = len(set(a) & set(b))
            assert common >= max(least_shared(len(x)), least_shared(len(y)), 1)
            assert set(sorted(x)[: prefix_length(len(x))]) & set(sorted(y)[: prefix_length(len(y))])


@pytest.mark.parametrize("seed", range(3))
def test_tree_drops_no_linked_pair(seed):
    rnd = np.random.default_rng(seed)
    sets = []
    for _ in range(40):
        base = rnd.integers(0, 1 << 63, int(rnd.integers(4, 400)), dtype=np.uint64)
        for _ in range(4):
            keep = base[rnd.random(len(base)) > rnd.choice([0, 0.05, 0.1])]
            sets.append(np.unique(np.r_[keep, rnd.integers(0, 1 << 63, 1 + len(base) // 20, dtype=np.uint64)]))
    sets.sort(key=len)
    i, j, _, _ = tree_pairs(np.array([len(s) for s in sets]), [np.frombuffer(bitmap(s), np.uint64) for s in sets])
    found = set(zip(i.tolist(), j.tolist())) | set(zip(j.tolist(), i.tolist()))
    for a in range(len(sets)):
        for b in range(a):
            if linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b])):
                assert (a, b) in found
    assert len(i) < len(sets) ** 2 / 8


def test_rows_with_nulls_repeats_and_clashing_columns(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(2, text), (2, text), (1, text + " x"), (None, text), (None, None), (5, None), (6, ""), (7, "a b"), (8, "A b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as block", "2 as n", "3 as token", "4 as a")
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard_components(docs).collect()))
    assert got == [(0, 0, 0), (0, 26, 0), (1, 27, 1), (2, 26, 1), (2, 26, 1), (5, 0, 5), (6, 0, 6), (7, 1, 7), (8, 1, 7)]
    kept = keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 5, 6, 7]
    assert jaccard_components(docs.limit(0)).count() == 0
    assert keep_one_each(docs.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(200)] + [(500, 499), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(201)}, 499: 499, 500: 499}
