"""Token ids against the tokenizers library, the packing plan, and whole packings."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tagloom.llm.packing import SIZE, candidate_patterns, fit_repeats, pack, pack_documents, pack_histogram, token_pieces
from tagloom.llm.tokens import Encoder, default_vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_vocabulary())


def ids_of(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_match_the_tokenizers_library(tokenizer):
    rnd = random.Random(4)
    parts = ["the", " ", "  ", "\n", "\n\n", "\t", "can't", "é", "ß", "12", "...", "<|endoftext|>", "\xa0", "日本", "😀", "\x1f", "\r\n", "a"]
    sample = ["", " ", "\n", "a\n", " a", *("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 25))) for _ in range(1500))]
    encoder = Encoder(default_vocabulary())
    for text in sample:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == ids_of(tokenizer, text), repr(text)


def test_ids_of_the_documents(spark, tokenizer):
    encoder = Encoder(default_vocabulary())
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        assert np.frombuffer(encoder.ids(r.text), "<u4").tolist() == ids_of(tokenizer, r.text)


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece_once(seed):
    rnd = np.random.default_rng(seed)
    counts = np.bincount(np.minimum(rnd.exponential(300, 5000).astype(int) + 1, 1024), minlength=1025)
    plan = pack_histogram(counts)
    used = np.zeros_like(counts)
    for pattern, times in plan:
        assert sum(pattern) <= 1024 and times > 0
        for n in pattern:
            used[n] += times
    assert (used == counts).all()
    sequences = sum(t for _, t in plan)
    assert sequences <= 1.01 * -(-int((counts * np.arange(1025)).sum()) // 1024) + 1


def test_plan_of_hard_histograms():
    for lengths in ([], [64], [33] * 7, [64] * 3, [1] * 65, [40, 30, 34, 24]):
        counts = np.bincount(lengths or [0], minlength=65)
        counts[0] = 0
        plan = pack_histogram(counts)
        assert sum(len(p) * t for p, t in plan) == len(lengths)
    counts = np.bincount([40, 30, 34, 24], minlength=65)
    assert sum(t for _, t in pack_histogram(counts)) == 2


def test_repeats_fit_an_exact_histogram():
    counts = np.zeros(11, dtype=np.int64)
    counts[[4, 6]] = 50
    patterns = candidate_patterns(counts)
    assert (6, 4) in patterns
    assert fit_repeats(counts, patterns)[patterns.index((6, 4))] == pytest.approx(50, abs=0.5)


def check(rows, size):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by_sequence)


def test_documents_round_trip(spark, tokenizer):
    long = "word " * 5000
    texts = {1: "one two", 2: None, 3: "", 4: long, 5: "one two", 6: "x" * 9000}
    docs = spark.createDataFrame([*texts.items(), (5, "one two")], "doc_id long, text string").selectExpr("*", "7 as length", "8 as offset")
    rows = pack(token_pieces(docs, with_ids=True)).collect()
    check(rows, SIZE)
    whole = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert r["length"] == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        if r.doc_id != 5:
            assert r.start == len(whole.setdefault(r.doc_id, []))
            whole[r.doc_id] += r.ids
    for k, text in texts.items():
        if k != 5:
            assert whole[k] == [*ids_of(tokenizer, text or ""), 0]
    assert sum(r.doc_id == 5 for r in rows) == 2
    assert all(r["length"] == SIZE for r in rows if r.piece > 0)
    assert pack_documents(docs.limit(0)).count() == 0


def test_given_documents(spark):
    rows = pack_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    total = sum(r["length"] for r in rows)
    assert check(rows, SIZE) <= -(-total // SIZE) + 1
    assert len({r.doc_id for r in rows}) == 1000
