"""Decontamination, quality and archive operators against their SQL on awkward rows, and against plain Python."""

import re
from collections import Counter

import duckdb
import pandas as pd
import pytest

from tagloom.llm import decontaminate, quality, warc

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = [
    None, "", " \n ", ITEM, f"x {ITEM.upper()} y {ITEM}", ITEM.replace(" ", ", "), " ".join(ITEM.split()[:9]), " ".join(ITEM.split()[1:11]),
    "solo", "SOLO, solo!", "été solo été", "a b a b a b a b", "a b c\na b c\n\n a b c\nx", "# $ % & | < > *", "mot " * 60,
    " ".join(f"w{k}" for k in range(80)), " ".join(f"w{k % 20}" for k in range(80)), "line one\nline one\nline two\n" * 20, "x" * 5000,
    "a\x0bb\x0cc\rd", "É é \xa0 nbsp", "same words " * 3 + ITEM, " ".join(f"u{k}" for k in range(70)),
]
ITEMS = [("i1", ITEM), ("i1", ITEM), ("i2", "solo"), ("i10", "never seen words here"), ("i3", None), ("i4", " .,"), ("i5", "Été"), (None, "a b c"), (None, "w3 w4")]


def frames():
    docs = pd.DataFrame({"doc_id": range(len(TEXTS)), "text": TEXTS, "source": [["bad", None, "good"][k % 3] for k in range(len(TEXTS))]})
    return docs, pd.DataFrame(ITEMS, columns=["item_id", "text"])


def tables(spark):
    docs = [(k, t, ["bad", None, "good"][k % 3], k, "x", 5) for k, t in enumerate(TEXTS)]
    schema = "doc_id long, text string, source string, word long, _w string, n int"
    return spark.createDataFrame(docs, schema), spark.createDataFrame(ITEMS, "item_id string, text string")


def same(df, sql):
    documents, benchmark = frames()  # noqa: F841  read by name
    want = duckdb.sql(sql)
    order = sorted(df.columns)
    assert sorted(want.columns) == order
    place = [want.columns.index(c) for c in order]
    assert sorted(map(repr, (tuple(r) for r in df.select(*order).collect()))) == sorted(
        map(repr, (tuple(r[k] for k in place) for r in want.fetchall()))
    )


def test_decontamination_matches_sql(spark):
    docs, items = tables(spark)
    same(decontaminate.contamination(docs, items), decontaminate.ORACLE)


def test_decontamination_by_plain_python(spark):
    docs, items = tables(spark)
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for i, t in ITEMS:
        w = word.findall((t or "").translate(LOWER))
        windows |= {(i, tuple(w[k : k + 10])) for k in range(max(len(w) - 9, 1)) if w}
    got = {r.doc_id: r for r in decontaminate.contamination(docs, items).collect()}
    for k, t in enumerate(TEXTS):
        w = word.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for i, win in windows:
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s : s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    found.add(i)
        assert (got[k].n_words, got[k].n_hit, got[k].n_items, got[k].contaminated) == (len(w), len(hit), len(found), bool(hit))


def test_decontamination_joins_large_benchmarks_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "bounded", lambda df, rows=0: df)
    docs, items = tables(spark)
    same(decontaminate.contamination(docs, items), decontaminate.ORACLE)


def test_decontamination_repeated_rows_and_empty_tables(spark):
    docs, items = tables(spark)
    twice = docs.union(docs).unionByName(docs.selectExpr("cast(null as long) doc_id", "text", "source", "word", "_w", "n"))
    assert decontaminate.contamination(twice, items).count() == 3 * len(TEXTS)
    clean = decontaminate.drop_contaminated(twice, items)
    dirty = decontaminate.contamination(docs, items).where("contaminated").count()
    assert clean.columns == docs.columns and clean.count() == 3 * (len(TEXTS) - dirty)
    assert decontaminate.contamination(docs, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(docs.limit(0), items).count() == 0


def test_quality_matches_sql(spark):
    same(quality.quality(tables(spark)[0]), quality.ORACLE)


def test_quality_by_plain_python(spark):
    got = {r.doc_id: r for r in quality.quality(tables(spark)[0]).collect()}
    for k, t in enumerate(TEXTS):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        repeat = {i + d for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(repeat))
        assert (r.n_symbols, r.n_dup_lines) == (sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)))
        assert r.base_failed == (len(w) < 50 or 100 * len(repeat) > 50 * len(w))


def test_a_rejected_host_needs_clean_documents(spark):
    good, odd = " ".join(f"word{k}" for k in range(60)), " ".join(f"#word{k}" for k in range(60))
    rows = [(k, odd, "bad") for k in range(9)] + [(9, good, "bad")] + [(k, good, f"h{k}") for k in range(20, 40)] + [(50, odd, "h20")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in quality.quality(docs).collect() if r.kept}
    assert kept == {9, 50, *range(20, 40)}
    verdicts = {r.host: r for r in quality.host_verdicts(quality.measures(docs)).collect()}
    assert verdicts["bad"].rejected and 0.5 < verdicts["bad"].rate < 0.9
    assert 0 < verdicts["h20"].rate < 0.5
    assert quality.quality(docs.limit(0)).count() == 0


URLS = [
    ("HTTP://www.Host.com:80/a/#x", "host.com/a"), ("https://host.com/a?utm_source=q", "host.com/a"), ("host.com/a/?b=1&utm_x=2&c=3", "host.com/a?b=1&c=3"),
    ("http://host.com/?gclid=1&b=2", "host.com?b=2"), (None, ""), ("", ""), ("http://h/A//", "h/A"),
]


@pytest.mark.parametrize("url, want", URLS)
def test_canonical_urls(spark, url, want):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(url,)], "u string").select(warc.canonical_url(F.col("u")).alias("c")).first()
    assert row.c == want


def test_revisits(spark, monkeypatch):
    monkeypatch.setattr(warc, "ROWS_PER_CELL", 2)
    full = {"etag": '"1"', "content-type": "t", "cache-control": "old", "last-modified": "m1"}
    rows = [
        (1, "http://h/a", "response", 10, "d1", full), (2, "http://h/a/", "response", 30, "d2", {**full, "etag": '"2"'}),
        (3, "https://www.h/a#f", "revisit", 20, None, {"etag": 'W/"1"', "cache-control": "new", "content-length": "0"}),
        (4, "http://h/a", "revisit", 30, None, {"etag": '"1"'}),  # the response of the same time is not earlier
        (5, "http://h/a", "revisit", 40, None, {"etag": '"1"'}), (6, "http://h/a", "revisit", 5, None, {"etag": '"1"'}),
        (7, "http://h/a", "revisit", 99, None, {"last-modified": "m1"}), (8, "http://h/a", "revisit", 99, "d2", None),
        (9, "http://h/a", "revisit", 99, None, None), (10, None, "revisit", 99, None, None), (11, "http://h/a", "revisit", None, None, None),
        (12, "http://h/a", None, 1, None, None), (9, "http://h/a", "revisit", 99, None, None),
    ]
    schema = "record_id long, url string, kind string, at long, digest string, headers map<string,string>"
    records = spark.createDataFrame(rows, schema).selectExpr("*", "1 as canonical", "2 as state", "3 as _cell")
    got = {r.record_id: (r.ref_id, r.state, r.headers) for r in warc.resolve_revisits(records).collect()}
    assert got[3] == (1, "resolved", {"etag": 'W/"1"', "content-type": "t", "cache-control": "new", "last-modified": "m1"})
    assert {k: v[:2] for k, v in got.items()} == {
        3: (1, "resolved"), 4: (1, "resolved"), 5: (2, "mismatch"), 6: (None, "unresolved"), 7: (2, "resolved"),
        8: (2, "resolved"), 9: (2, "mismatch"), 10: (None, "unresolved"), 11: (None, "unresolved"),
    }
    assert warc.resolve_revisits(records.limit(0)).count() == 0


def test_pages_without_an_id_stay_as_unresolved_revisits(spark):
    pages = spark.createDataFrame([(1, "h/a", "x"), (None, "h/a", "y"), (99, "h/a", None), (None, None, None)], "page_id long, url string, html string")
    rows = warc.revisit_digest(pages).collect()
    assert len(rows) == 4 and sum(r.record_id is None for r in rows) == 2
    assert all(r.state == "unresolved" and r.ref_id is None for r in rows if r.record_id is None)


def test_as_of_join_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(warc, "ROWS_PER_CELL", 5)
    rows = [(k, "h/a" if k % 3 else f"h/{k % 5}", "response" if k * 7 % 4 else "revisit", k * 37 % 101, f"d{k % 4}", None) for k in range(200)]
    schema = "record_id long, url string, kind string, at long, digest string, headers map<string,string>"
    got = {r.record_id: r.ref_id for r in warc.resolve_revisits(spark.createDataFrame(rows, schema)).collect()}
    for k, url, kind, at, _, _ in rows:
        if kind == "revisit":
            earlier = [(r[3], r[0]) for r in rows if r[1] == url and r[2] == "response" and r[3] < at]
            assert got[k] == (max(earlier)[1] if earlier else None)
