"""The classifier: held-out accuracy, sparsity, awkward rows."""

import zlib

import numpy as np

from tagloom.llm.toxicity import BITS, drop_toxic, features, fit_toxicity, ftrl, score_toxicity, toxicity

SF = "/root/testdata/sf0.01"


def test_features_cover_words_stems_pairs_and_skips():
    from tagloom.llm.toxicity import _Hashes

    h = _Hashes()
    one, two, skip = (features(t, h) for t in ("alpha", "alpha beta", "alpha x beta"))
    assert len(one) == 2 and len(features("alphabet", h)) == 2  # word and stem
    assert len(np.intersect1d(one, features("alphabet", h))) == 1  # the stem
    assert len(two) == 5 and len(skip) == 9
    assert len(np.intersect1d(features("alpha y beta", h), skip)) == 5  # two words, two stems, the skip pair
    assert len(features("", h)) == len(features(None, h)) == len(features(" ,. ", h)) == 0


def test_ftrl_learns_a_sparse_rule():
    rnd = np.random.default_rng(0)
    rows = [np.unique(rnd.integers(0, 5000, 60)).astype(np.uint32) for _ in range(1500)]
    labels = np.array([float(k % 5 == 0) for k in range(1500)])
    rows = [np.unique(np.r_[x, 7777]).astype(np.uint32) if y else x for x, y in zip(rows, labels)]
    at, value, _ = ftrl(rows, labels)
    assert at[np.argmax(value)] == 7777 and len(at) < 500


def test_scores_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity(docs, labels).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    known = [(truth[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert not any(p for t, _, p in known if not t)
    bad, good = ([s for t, s, _ in known if t == k] for k in (1, 0))
    assert np.mean([b > g for b in bad for g in good]) > 0.85
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r.predicted for r in rows)


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 1 - toxic else toxic end as toxic")
    a, b = ({r.doc_id: r.score for r in toxicity(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_awkward_rows_and_empty_tables(spark):
    rows = [(1, None), (2, ""), (None, "idiot"), (3, "idiot " * 30_000), (3, "idiot " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as score", "'x' as toxic", "2 as at")
    labels = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (1, None), (9, 1)], "doc_id long, toxic int")
    out = toxicity(docs, labels).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    at, value, bias = fit_toxicity(docs, labels.limit(0))
    assert len(at) == 0 and {r.score for r in score_toxicity(docs, (at, value, bias)).collect()} == {0.5}
    assert toxicity(docs.limit(0), labels).count() == 0
    assert drop_toxic(docs, labels.limit(0)).count() == 5
    assert (1 << BITS) * 12 < 16e6  # the bound of the model that is sent
