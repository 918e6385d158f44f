"""Word hashes, shingle sets and gapless numbers."""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tagloom.llm.common import gapless, shingle_sets, text_chunks, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def texts(n, seed=3):
    rnd = random.Random(seed)
    parts = ["a", "B", "b", "É", "é", " ", "  ", "\n", "\t", "word", "Word", "ﬀ", ".", " ", "x" * 40]
    return [None, "", " \n ", *("".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(n))]


def test_equal_words_have_equal_hashes_and_others_differ():
    sample = texts(400)
    seen: dict[str, int] = {}
    for _, _, data, bounds in text_chunks(pa.array(sample), most=500):
        hashes, firsts = word_hashes(data, bounds)
        raw = data.tobytes()
        for k in range(len(bounds) - 1):
            words = words_of(raw[bounds[k] : bounds[k + 1]].decode())
            mine = hashes[firsts[k] : firsts[k + 1]].tolist()
            assert len(words) == len(mine)
            for w, h in zip(words, mine):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_shingle_sets_match_tuples_of_words():
    sample = texts(300, seed=5)
    known: dict[tuple, int] = {}
    sizes = []
    for _, _, data, bounds in text_chunks(pa.array(sample), most=700):
        sizes += [len(s) for s in shingle_sets(*word_hashes(data, bounds), 3)]
    for text, n in zip(sample, sizes, strict=True):
        w = words_of(text)
        assert n == (len({tuple(w[k : k + 3]) for k in range(len(w) - 2)}) if len(w) >= 3 else bool(w))
    assert known == {}


def test_one_long_text_is_one_chunk():
    column = pa.array(["a " * 5000, "b", None, "c " * 10])
    runs = [(a, b) for a, b, _, _ in text_chunks(column, most=100)]
    assert runs == [(0, 1), (1, 4)]
    assert list(text_chunks(pa.array([], pa.string()))) == []


def test_gapless_numbers_every_group(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 7 == 0, None).otherwise("b").alias("g"))
    rows = gapless(df, ["g"], [F.col("id")], F.xxhash64("id"), "k", 1000).collect()
    for g in ("a", "b", None):
        mine = sorted(r.k for r in rows if r.g == g)
        assert mine == list(range(len(mine)))
    assert len(rows) == 1000
    assert np.unique([r.id for r in rows]).size == 1000
