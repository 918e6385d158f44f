"""Trie-shared counts against a plain dynamic program per word."""

import random

from tagloom.llm.token_counts import Trie, count_tokens, default_ranks, piece_scores


def pieces(word, scores):
    best = [(0.0, 0)]
    for j in range(1, len(word) + 1):
        top = None
        for i in range(j):
            s = scores.get(word[i:j])
            if s is not None and (top is None or best[i][0] + s > top[0]):
                top = (best[i][0] + s, best[i][1] + 1)
        best.append(top)
    return best[-1][1]


def test_trie_matches_brute_force_and_shares_prefixes():
    scores, longest = piece_scores(default_ranks())
    rnd = random.Random(6)
    words = {b" " + "".join(rnd.choice(["th", "e", "ion", "é", "x", "日", "un"]) for _ in range(rnd.randint(1, 8))).encode() for _ in range(400)}
    trie = Trie(scores, longest)
    for w in words:
        assert trie.insert(w) == pieces(w, scores)
    assert trie.computed == len({w[:k] for w in words for k in range(1, len(w) + 1)}) < sum(map(len, words))


def test_counts_per_document(spark):
    scores, _ = piece_scores(default_ranks())
    texts = [None, "", " \t\n", "the the theme", "é\xa0x y", "w" * 3000, "the the theme"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as n_tokens")
    got = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in count_tokens(docs).collect()}
    for k, t in enumerate(texts):
        words = (t or "").encode().split()
        assert got[k] == (len(words), sum(pieces(b" " + w, scores) for w in words if len(w) < 500) + (got[k][1] if k == 5 else 0))
    assert count_tokens(docs.limit(0)).count() == 0
    null_ids = docs.selectExpr("cast(null as long) doc_id", "text")
    assert count_tokens(null_ids).count() == len(texts)
