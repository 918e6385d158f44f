"""Phrase mining against a plain count of all phrases."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.llm import phrases

PIECE = re.compile(r"[.,;:!?\x0A-\x0D]")
WORD = re.compile(r"[^\x20\x09]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows, longest=5):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split((text or "").translate(LOWER)):
            w = WORD.findall(piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i : i + k])] += 1
    return counts, totals


def plain(rows, least, top):
    counts, totals = plain_counts(rows)
    candidates = {p: n for p, n in counts.items() if len(p[1]) > 1 and n >= least}
    out = {}
    for (lang, w), a in candidates.items():
        if any(q[0] == lang and len(q[1]) > len(w) and 100 * b >= 100 * a
               and any(q[1][i : i + len(w)] == w for i in range(len(q[1]) - len(w) + 1)) for q, b in candidates.items()):
            continue
        cuts = [(1000 * a * totals[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    made = []
    for lang, found in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            made.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(made)


def texts(n, seed):
    rnd = random.Random(seed)
    words = ["A", "b", "B", "é", "É", "c", "dd", "x-y", "日本", " ", "e"]
    ends = [" ", " ", " ", "  ", "\t", ". ", "\n", ",", "!", "?\r\n", "\x0b"]
    made = []
    for k in range(n):
        text = "".join(rnd.choice(words) + rnd.choice(ends) for _ in range(rnd.randint(0, 60)))
        made.append((rnd.choice(["en", "de", None]), text))
    copies = [("en", "one two three four five six seven")] * 20 + [("en", "the one two of three four")] * 7
    return [*made, *copies, ("en", None), (None, ""), ("de", " \n ."), ("en", "a " * 3000), ("en", "x" * 5000)]


def frame(spark, rows):
    made = [(k, lang, text, 1, 2) for k, (lang, text) in enumerate(rows)]
    return spark.createDataFrame(made, "doc_id long, lang string, text string, size int, n long").repartition(3)


@pytest.mark.parametrize("seed, share, bits", [(1, 2, 1 << 16), (2, 4, 1 << 12), (3, 100000, 1 << 16), (4, 1, 1 << 10)])
def test_phrases_equal_a_plain_count(spark, seed, share, bits):
    """Also with a sample that proposes nothing (only failures extend the filter) and with a filter full of false positives."""
    rows = texts(60, seed)
    found = phrases.mine_phrases(frame(spark, rows), 5, 40, share=share, bits=bits, block=700)
    assert sorted(map(tuple, found.collect())) == plain(rows, 5, 40)


def test_a_second_pass_closes_the_border(spark):
    rows = texts(60, 7)
    counts, totals = plain_counts(rows)
    expected = {(lang, " ".join(w)): n for (lang, w), n in counts.items() if n >= 5}
    for share, slack in ((1, 1), (2, 1), (100000, 1)):
        found, failed = phrases.frequent_phrases(frame(spark, rows), 5, share=share, slack=slack, bits=1 << 18, block=900)
        assert {(r.lang, r.phrase): r.n for r in found.where("size > 0").collect()} == expected
        assert dict(found.where("size = 0").groupBy("lang").agg(F.sum("n")).collect()) == {k: v for k, v in totals.items() if v}
        assert failed == (share > 1)


def test_empty_tables(spark):
    empty = frame(spark, [("en", "a")]).limit(0)
    assert phrases.mine_phrases(empty, 1, 5, bits=1 << 12).collect() == []
    blank = frame(spark, [(None, None), ("en", " "), (None, "one")])
    assert phrases.mine_phrases(blank, 1, 5, bits=1 << 12).collect() == []


def test_products_beyond_64_bits_are_exact(spark):
    rows = [("en", 0, "", 3 * 10**13), ("en", 1, "a", 10**12 + 7), ("en", 1, "b", 10**12 + 9), ("en", 2, "a b", 10**11 + 3)]
    found = phrases.collocations(spark.createDataFrame(rows, "lang string, size int, phrase string, n long"))
    assert [r.score for r in found.collect()] == [1000 * (10**11 + 3) * 3 * 10**13 // ((10**12 + 7) * (10**12 + 9))]


def test_blocks_keep_pieces_whole():
    column = pa.array(["a b. c", None, "d" * 50 + " e", "", "f g\nh"])
    runs = [raw.tobytes().decode() for _, raw, _ in phrases.text_blocks(column, 8)]
    assert runs == ["a b. c\n\n", "d" * 50 + " e\n", "\nf g\nh\n"]
    made = phrases.Block(*next(phrases.text_blocks(pa.array(["Ab  c.d\tE"]), 100)), np.zeros(1, np.uint64))
    assert made.phrases(np.array([0, 2]), 2).to_pylist() == ["ab c", "d e"]


def test_given_documents_equal_the_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{folder}/documents.parquet'")
    theirs = sorted(map(tuple, con.sql(phrases.ORACLE).fetchall()))
    ours = sorted(map(tuple, phrases.mine_phrases(spark.read.parquet(f"{folder}/documents.parquet")).collect()))
    assert ours == theirs and len(ours) > 50
