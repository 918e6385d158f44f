"""Shards: the law of even counts, gapless slots, and that propagation brings groups together."""

import zlib
from collections import Counter, defaultdict

from tagloom.llm.sharding import SHARDS, shard_documents


def check(rows):
    counts = Counter(r.shard for r in rows)
    assert set(counts) <= set(range(SHARDS))
    assert max(counts.values()) - min([*counts.values(), *([0] if len(counts) < SHARDS else [])]) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def cut(rows):
    """Share of the documents with copies that are not in their group's largest part."""
    groups = defaultdict(Counter)
    for r in rows:
        groups[r.text_crc32][r.shard] += 1
    linked = [g for g in groups.values() if sum(g.values()) > 1]
    return 1 - sum(max(g.values()) for g in linked) / max(1, sum(sum(g.values()) for g in linked))


def test_groups_come_together(spark):
    rows = [(k, f"text {k // 4}") for k in range(1200)] + [(k, f"single {k}") for k in range(1200, 2000)]
    out = shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == 2000 and {r.law for r in out} == {"rows"}
    check(out)
    assert cut(out) < 0.1
    for r in out:
        text = dict(rows)[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text)) and r.grown_shard is None


def test_a_group_with_a_third_of_all_rows_is_spread(spark):
    rows = [(k, "copy" if k % 3 == 0 else f"é {k}") for k in range(900)]
    out = shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(out)
    assert len({r.shard for r in out if r.size == 5}) >= 6


def test_nulls_repeats_and_small_tables(spark):
    rows = [(1, None), (1, None), (None, ""), (2, "a"), (2, "a"), (3, "ü")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as shard", "2 as home", "3 as n", "4 as at")
    out = shard_documents(docs).collect()
    check(out)
    assert sorted(r.size for r in out) == [1, 1, 1, 2, 2, 3]
    assert shard_documents(docs.limit(0)).count() == 0


def test_given_documents(spark):
    out = shard_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    check(out)
    assert len({r.doc_id for r in out}) == 1000 and cut(out) < 0.1
