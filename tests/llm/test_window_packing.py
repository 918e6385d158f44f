"""Window packing: the plan, and whole packings against the tokenizers library."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tagloom.llm.tokens import default_vocabulary
from tagloom.llm.window_packing import SIZE, combinations, cuts, layout, least_squares, narrow, pack_documents, wide, windows


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_vocabulary())


def exact(counts, made):
    """The same least squares by cyclic coordinate steps."""
    x, over = np.zeros(len(made)), -counts.astype(float)
    for _ in range(3000):
        for j, c in enumerate(made):
            need = np.bincount(c, minlength=len(counts))
            new = max(0.0, x[j] - need @ over / (need @ need))
            over += need * (new - x[j])
            x[j] = new
    return x


def test_least_squares_reach_the_least_error():
    rnd = np.random.default_rng(3)
    counts = rnd.integers(0, 40, 16)
    counts[0] = 0
    made = combinations(counts)
    assert all(sum(c) == 16 and len(c) in (2, 3) for c in made) and len(set(made)) == len(made)

    def error(x):
        return sum((np.bincount(np.repeat([n for c in made for n in c], 1), weights=np.repeat(x, [len(c) for c in made]), minlength=16) - counts) ** 2)

    ours, best = least_squares(counts, made, 4000), exact(counts, made)
    assert (ours >= 0).all() and error(ours) <= error(best) * 1.001 + 1e-6


def test_all_triples_are_listed_while_they_are_few():
    counts = np.ones(13, dtype=int)
    counts[0] = 0
    expected = {(a, b, c) for a in range(1, 13) for b in range(1, a + 1) for c in range(1, b + 1) if a + b + c == 13}
    assert {c for c in combinations(counts) if len(c) == 3} == expected
    assert len(combinations(np.ones(1025, dtype=int), most=500)) <= 500 + 512


@pytest.mark.parametrize("lengths", [[], [5], [63] * 3, [33] * 50, [1] * 130, [40, 24, 30, 34, 7], list(range(1, 64)) * 9])
def test_plans_use_each_remainder_once_and_leave_no_gap(lengths):
    counts = np.bincount(lengths or [0], minlength=64)
    counts[0] = 0
    plan = windows(counts)
    used = np.zeros_like(counts)
    for c, times in plan:
        assert sum(c) <= 64 and times > 0
        for n in c:
            used[n] += times
    assert (used == counts).all()
    runs, line = layout(plan)
    spans = []
    for n, (firsts, bases, strides) in runs.items():
        for number in range(counts[n]):
            k = np.searchsorted(firsts, number, side="right") - 1
            a = bases[k] + (number - firsts[k]) * strides[k]
            spans.append((a, a + n))
    spans.sort()
    assert [a for a, _ in spans] == [0, *(b for _, b in spans)][: len(spans)] and line == sum(lengths)


def test_the_last_sequences_are_powers_of_two():
    for line in (0, 1, 1023, 1024, 1024 * 7 + 700):
        ends = cuts(line)
        steps = np.diff([line - line % 1024, *ends])
        assert sum(steps) == line % 1024 and all(s & (s - 1) == 0 and s > 0 for s in steps.tolist())


def test_ids_keep_their_values_in_half_the_bytes():
    small, large = np.array([1, 65535], "<u4").tobytes(), np.array([1, 65536], "<u4").tobytes()
    assert len(narrow(small)) == 4 and wide(narrow(small), 2) == small
    assert narrow(large) == large == wide(large, 2)


def check(rows, size, texts, tokenizer):
    """Every id of every row in one piece, sequences without holes; the number of padded places."""
    sequences, whole = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r["offset"], r["length"]))
        whole.setdefault(r.doc_id, []).append(r)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(whole[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    return padding


def test_awkward_documents(spark, tokenizer):
    texts = {1: "one two", 2: None, 3: "", 4: "word " * 5000, 6: "x" * 9000, 7: "a " * 1023, 8: "a " * 1022 + "a"}
    texts |= {k: "same words here " * 200 for k in range(10, 60)}  # all of one length: none fills a window
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").selectExpr("*", "7 as length", "8 as sequence_id", "9 as key")
    rows = pack_documents(docs).collect()
    assert check(rows, SIZE, texts, tokenizer) == 0
    assert pack_documents(docs.limit(0)).count() == 0


def test_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "one two three")] * 3 + [(None, "b"), (None, None)], "doc_id long, text string")
    rows = pack_documents(docs, 4).collect()
    assert sum(r["length"] for r in rows if r.doc_id == 1) == 12 and sum(r["length"] for r in rows if r.doc_id is None) == 3
    assert check(rows, 4, {}, None) == 0


def test_given_documents(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pack_documents(docs).collect()
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert check(rows, SIZE, texts, tokenizer) == 0
    cut = sum(r["start"] % SIZE != 0 for r in rows)
    assert cut < len(texts) // 4  # most remainders stay whole
