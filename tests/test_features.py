import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.operators import features
from tagloom.operators.draws import Draws
from tagloom.plans import registry


def test_draws_are_those_of_the_hash():
    import numpy as np

    texts = [f"{'x' * n}|{n}|" for n in range(70)]
    found = Draws(pa.array(texts)).uniform(np.arange(70), 13)
    short = Draws(pa.array(texts[:40]).slice(3)).uniform(np.arange(5, 30), 7)
    assert found.tolist() == [int(hashlib.md5(f"{t}13".encode()).hexdigest()[:8], 16) / 2**32 for t in texts]
    assert short.tolist() == [int(hashlib.md5(f"{t}7".encode()).hexdigest()[:8], 16) / 2**32 for t in texts[8:33]]


def test_negative_samples_need_no_md5_column(spark):
    rows = [(7, p, p + 1, 3, c) for p, c in enumerate([0, 1, 2, 5])]
    pairs = spark.createDataFrame(rows, "Id long, pos int, context_pos int, target int, context int")
    df = features.negative_samples(pairs, "Id", 4, 6, 42)
    assert "md5" not in df._jdf.queryExecution().optimizedPlan().toString()
    for r in df.collect():
        draws = []
        for j in range(1, 17):
            u = int(hashlib.md5(f"42|7|{r.pos}|{r.context_pos}|{j}".encode()).hexdigest()[:8], 16) / 2**32
            draws.append(int(7**u) - 1)
        others = [x for x in dict.fromkeys([*draws, *range(5)]) if x != rows[r.pos][4]]
        assert r.contexts == [rows[r.pos][4], *others[:4]] and r.labels == [1, 0, 0, 0, 0]


def test_words_are_looked_up_inside_the_row(spark, monkeypatch):
    rows = [(1, list("aab")), (2, list("abz")), (2, list("ba")), (None, ["a"]), (3, None), (4, [])]
    df = spark.createDataFrame(rows, "Id long, tokens array<string>")
    inside = features.encode_sequences(df, "Id", "tokens", 4, None)
    assert "Join" not in inside._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(features, "SENT_WORDS", 0)
    by_join = features.encode_sequences(df, "Id", "tokens", 4, None)
    assert sorted(inside.collect(), key=str) == sorted(by_join.collect(), key=str)


@pytest.mark.parametrize("sent", [features.SENT_BYTES, 0])
def test_document_vectors_carry_no_vector_of_a_word(spark, monkeypatch, sent):
    monkeypatch.setattr(features, "SENT_BYTES", sent)
    monkeypatch.setattr(features, "GROUP_NUMBERS", 4)
    rows = [(1, list("aab")), (2, list("bz")), (2, ["a"]), (None, ["a"]), (3, None), (4, []), (5, ["z"])]
    df = spark.createDataFrame(rows, "Id long, tokens array<string>")
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [4.0, 0.0]), ("b", [0.0, 6.0]), (None, [9.0, 9.0])], "word string, vector array<float>")
    found = features.document_embedding(df, "Id", "tokens", vectors, 2)
    if sent:
        assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = sorted(((r.Id or 0, [round(x, 6) for x in r.embedding]) for r in found.collect()), key=str)
    assert got == sorted([(1, [2.0, round(10 / 3, 6)]), (2, [2.5, 4.0]), (2, [5.0, 8.0]), (0, [0.0, 0.0]), (3, [0.0, 0.0]), (4, [0.0, 0.0]), (5, [0.0, 0.0])], key=str)


def test_stream_reads_a_table_of_several_files(spark, tmp_path):
    rows = [(k, "Title word\nBody word", "en", "web", 20) for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    assert registry.suggest_tags_stream_query(spark, str(tmp_path)).agg(F.count("*"), F.countDistinct("Id")).first()[:] == (8, 8)


def test_equations_come_in_slices_of_the_matrix(spark, monkeypatch):
    from pyspark.ml.functions import array_to_vector

    rnd = [[float((7 * k + 3 * j * j) % 11) for j in range(5)] for k in range(30)]
    rows = spark.createDataFrame([(x, ["t" if sum(x) > 25 else "u"]) for x in rnd], "v array<double>, kept array<string>")
    monkeypatch.setattr(registry, "SIDE_ROWS", 2)
    found = registry.equations(rows.select(array_to_vector("v").alias("x"), "kept"))
    assert "LogicalRDD" not in found._jdf.queryExecution().optimizedPlan().toString()
    expected = {
        (tag, j): sum(x[j] * (1 if ("t" if sum(x) > 25 else "u") == tag else -1) for x in rnd) / 30 for tag in "tu" for j in range(5)
    }
    assert {(r.tag, r.dim): pytest.approx(r.side, abs=1e-6) for r in found.collect()} == expected


def test_draws_are_heads_of_digests():
    prefixes = ["", "42|1|2|3|", "42|-7|0|1|", "x" * 40, "42|123456789012345678|19999|20001|", "é" * 20, "y" * 53]
    for rows in (np.arange(len(prefixes)), np.array([1, 2]), np.array([], dtype=int)):
        for number in (1, 16, 123):
            want = [int(hashlib.md5(f"{prefixes[r]}{number}".encode()).hexdigest()[:8], 16) / 2.0**32 for r in rows]
            assert Draws(pa.array(prefixes)).uniform(rows, number).tolist() == want


def test_samples_as_texts(spark):
    """Ids of any type, also null: the texts are the lists, and the draws those of the text that SQL makes of the id."""
    rows = [(k // 4 if k % 5 else None, k, k + 1, 2 + k % 3, 3) for k in range(40)]
    for kind in ("long", "int", "string", "double", "decimal(6,2)"):
        pairs = spark.createDataFrame(rows, "Id long, pos int, context_pos int, target int, context int")
        pairs = pairs.withColumn("Id", F.col("Id").cast(kind))
        names = {r.pos: r.name for r in pairs.select("pos", F.col("Id").cast("string").alias("name")).collect()}
        lists = {r.pos: r for r in features.negative_samples(pairs, "Id", 4, 4096, 42).collect()}
        texts = features.negative_samples(pairs, "Id", 4, 4096, 42, joined="|").collect()
        assert len(texts) == 40 and texts[0].labels == "1|0|0|0|0"
        for r in texts:
            assert r.contexts == "|".join(map(str, lists[r.pos].contexts)) and r.labels == "|".join(map(str, lists[r.pos].labels))
            text = "|".join(x for x in ("42", names[r.pos], str(r.pos), str(r.context_pos), "1") if x is not None)
            first = math.floor(math.exp(int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 2.0**32 * math.log(4097))) - 1
            assert lists[r.pos].contexts[1] == first or first == 3
