"""The pipeline against a brute-force version of its stages, planted cases and awkward rows."""

import re

import corpus_pipeline
import pytest

from tagloom.llm import jaccard_tree, toxicity

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
TABLES = ("documents", "labels", "benchmark")


@pytest.fixture
def folder(spark, tmp_path):
    def write(**tables):
        for name in TABLES:
            df = tables.get(name, spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet"))
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def stages(spark, sf):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf), name)
        out[name] = docs
    return out


def brute_windows(items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lists = [word.findall((t or "").lower() if (t or "").isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t in items]
    return {tuple(w[k : k + 10]) for w in lists if w for k in range(max(len(w) - 9, 1))}, word


def test_stages_by_brute_force(spark, folder):
    sf = folder()
    out = stages(spark, sf)
    rows = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    model = toxicity.fit_toxicity(
        spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet").where(~toxicity.held_out())
    )
    scored = toxicity.score_toxicity(spark.read.parquet(f"{sf}/documents.parquet"), model).collect()
    clean = {r.doc_id for r in scored if not r.predicted}
    assert {r.doc_id for r in out["toxicity"].collect()} == clean

    sets = {i: next(iter(jaccard_tree.sets_of(corpus_array(rows[i].text)))) for i in clean}
    parent = {i: i for i in clean}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(clean)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(set(sets[a].tolist()) & set(sets[b].tolist()))
            if common and jaccard_tree.linked(common, len(sets[a]), len(sets[b])):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    single = {i for i in clean if find(i) == i}
    assert {r.doc_id for r in out["jaccard_join"].collect()} == single

    windows, word = brute_windows([r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    lengths = {len(w) for w in windows}

    def dirty(text):
        w = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        return any(tuple(w[s : s + n]) in windows for n in lengths for s in range(len(w) - n + 1))

    left = {i for i in single if not dirty(rows[i].text)}
    assert {r.doc_id for r in out["decontamination"].collect()} == left
    redacted = {r.doc_id: r for r in out["secrets"].collect()}
    assert set(redacted) == left
    for i, r in redacted.items():
        changed = r.text != rows[i].text
        assert r.n_chars == (len(r.text) if changed else rows[i].n_chars)
        assert not changed or "[" in r.text
    packed = out["packing"].collect()
    assert {r.doc_id for r in packed} == left
    assert sorted(map(tuple, packed)) == sorted(map(tuple, corpus_pipeline.run(spark, sf).select(*out["packing"].columns).collect()))


def corpus_array(text):
    import pyarrow as pa

    return pa.array([text])


def test_planted_cases(spark, folder):
    words = [f"clean{k}" for k in range(200)]
    item = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").first().text
    key = "AKIA" + "Q" * 16
    planted = [
        (1, " ".join(words)), (2, " ".join(words)), (3, " ".join([*words[:100], "edit", *words[101:]])),
        (4, " ".join([*[f"other{k}" for k in range(60)], item])), (5, f"prose with a key {key} in it, and more words"),
        (6, None), (7, ""), (None, "text without an id"), (8, "short"), (8, "short"),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in planted], DOCUMENTS)
    out = stages(spark, folder(documents=docs))
    assert [out[n].columns for n, _ in corpus_pipeline.STAGES[:-1]] == [docs.columns] * 4
    assert sorted((r.doc_id or 0) for r in out["secrets"].collect()) == [0, 1, 5, 6, 7, 8]
    assert {r.text for r in out["secrets"].where("doc_id = 5").collect()} == {"prose with a key [ACCESS] in it, and more words"}
    assert out["packing"].count() == 6


def test_empty_documents(spark, folder):
    assert corpus_pipeline.run(spark, folder(documents=spark.createDataFrame([], DOCUMENTS))).count() == 0
