import duckdb
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as contract
from tagloom.operators import membership, stats, topics
from tagloom.plans import experiments, grid, suggest
from tagloom.plans.oracles import ORACLES
from tagloom.plans.prepare import processed_questions
from tagloom.session import materialise
from tagloom.sources import processed, questions, results
from tagloom.streaming.suggest import TagTable, question_stream, suggest_tags_stream

QUERIES, SQL = contract.queries(), ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "labels", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    yield con
    con.close()


@pytest.fixture(scope="module")
def asked(spark):
    rows = [
        (k, f"How to parse {lang} number {k}?", f"<p>I use {lang} to read a file</p><code>x=1</code><p>Error in line",
         f"<{lang}><file><parsing><x{k % 4}><y>", 20, 100, 50, 3)
        for k, lang in enumerate(["python", "java", "c#", "haskell"] * 15)
    ]
    df = spark.createDataFrame(
        rows, "Id long, Title string, Body string, Tags string, Score int, ViewCount int, FavoriteCount int, AnswerCount int")
    return materialise(df)


def tidy(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind in "iuf":
            df[c] = df[c].astype(float)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def test_contract(spark):
    assert set(SQL) <= set(QUERIES)
    assert len(contract.entry(spark).collect()) == 20


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    ours = tidy(QUERIES[name](spark, SMALL).toPandas())
    theirs = tidy(duck.sql(SQL[name]).df())
    assert list(ours.columns) == list(theirs.columns)
    assert len(ours) == len(theirs)
    for c in ours.columns:
        a, b = ours[c].to_numpy(), theirs[c].to_numpy()
        if ours[c].dtype.kind == "f":
            np.testing.assert_allclose(a, b, atol=1.5e-6)
        else:
            assert [x for x in a if x == x] == [x for x in b if x == x]


def test_processed_questions_and_csv(spark, asked, tmp_path):
    rows = processed_questions(asked, exploration=True)
    first = rows.where("Id = 2").first()
    assert first["ntags"] == ["c#", "file", "parsing", "x2", "y"]
    assert "c#" in first["title-tokens"] and "c" in first["body-tokens"] and "x" not in first["body-tokens"]
    processed.write_processed(rows, str(tmp_path / "p"))
    assert processed.read_processed(spark, str(tmp_path / "p")).count() == 60
    questions.write_questions(asked.select(*questions.QUESTION_COLUMNS), str(tmp_path / "q"))
    assert sorted(questions.load_questions(spark, str(tmp_path / "q")).collect(), key=lambda r: r.Id) == sorted(
        asked.select(*questions.QUESTION_COLUMNS).collect(), key=lambda r: r.Id)


def test_extract_keeps_the_lowest_ids(asked):
    posts = asked.withColumn("PostTypeId", F.when(F.col("Id") == 1, 2).otherwise(1))
    got = questions.question_extract(posts, limit=5)
    assert sorted(r.Id for r in got.collect()) == [0, 2, 3, 4, 5]


def test_grid():
    values = {"a": [1, 2], "b": [3, 4], "c": [7]}
    assert [tuple(g.values()) for g in grid.param_grid(values)] == [(1, 3, 7), (1, 4, 7), (2, 3, 7), (2, 4, 7)]
    assert grid.param_grid({"a": [1]}, {"a": 0, "z": 5}) == [{"a": 1, "z": 5}]
    name = grid.config_name({"loss": "hinge"}, {"vect": "tfidf", "nb_tags": 50, "body_min_df": 0.0033})
    assert name == "Classifier-SVM&Vect-TfidfVectorizer&nb_tags-50&body_min_df-0.33%"
    config = {"model_params": {"loss": ["hinge"]}, "params": {"nb_tags": [5], "scaler": [True, False], "max_iter": [9]}}
    assert [n for n, _ in grid.run_settings(config)] == [
        "Classifier-SVM&nb_tags-5&scaler-True", "Classifier-SVM&nb_tags-5&scaler-False"]


@pytest.mark.parametrize("vect,scaler,fit_on", [("count", True, "all"), ("tfidf", False, "train")])
def test_supervised_run_and_serving(spark, asked, tmp_path, vect, scaler, fit_on):
    data = processed_questions(asked)
    run = experiments.supervised_bow(
        data, nb_tags=7, vect=vect, scaler=scaler, loss="squared_error", title_max_df=1.1, fit_on=fit_on)
    # Tags x0-x3 go with the languages, so the score is near perfect. Centred features
    # without an intercept cannot learn the tag that every question has.
    assert run.score().first().jaccard > (0.6 if scaler else 0.9)
    results.save_model(spark, str(tmp_path / "m"), "best", run.vectorizer, run.model)
    name, stages, model = results.load_model(spark, str(tmp_path / "m"))
    new = spark.createDataFrame([(1, ["parse", "java", "number"])], "Id long, tokens array<string>")
    assert name == "best" and "java" in suggest.predict_supervised(new, stages, model).first().supervised


def test_unsupervised_run(asked):
    run = experiments.unsupervised(processed_questions(asked), nb_tags=7, num_topics=3, passes=5, n_term=4, title_max_df=1.1)
    rows = run.predictions.collect()
    assert rows and all(len(r.predicted) == 4 for r in rows)
    assert 0 <= run.score().first().jaccard <= 1


def test_grid_run_and_results_table(spark, asked, tmp_path):
    data = materialise(processed_questions(asked))
    config = {"type": "bow", "model_params": {"loss": ["squared_error"]},
              "params": {"nb_tags": [4, 7], "vect": ["tfidf"], "scaler": [False], "title_max_df": [1.1]}}
    names = grid.run_grid(data, config, str(tmp_path / "bow"))
    assert len(names) == 2 == len(set(names))
    table = grid.results_table(spark, {str(tmp_path / "bow"): None})
    rows = table.collect()
    assert {r.nb_tags for r in rows} == {"4", "7"} and {r.vectorizer for r in rows} == {"TfidfVectorizer"}
    assert {r.run for r in rows} == set(names) and not any(r.scaler for r in rows)
    assert grid.results_table(spark, {str(tmp_path / "bow"): "w2v"}).first().vectorizer == "w2v"


def test_suggestions(spark, asked):
    data = processed_questions(asked)
    tags = suggest.tag_list(suggest.tag_vocabulary(data, "ntags"))
    direct = suggest.suggest_tags(asked, [], tags).where("Id = 1").first().tags
    assert direct == ["file", "java"]
    lookup = suggest.direct_match(
        data.select("Id", F.col("`title-tokens`").alias("t")), "Id", "t", suggest.tag_vocabulary(data, "ntags"))
    assert lookup.where("Id = 1").first().direct == ["java"]
    long_list = [*tags, *(f"tag{k}" for k in range(suggest.IN_LIST))]
    assert suggest.suggest_tags(asked, [], long_list).where("Id = 1").first().tags == direct
    rows = materialise(data.select("Id", F.col("`title-tokens`").alias("tokens")))
    model = topics.fit_topics(rows, "tokens", num_topics=2, passes=2)
    both = suggest.suggest_tags(asked, [], tags, topic_model=model, n_term=1).where("Id = 1").first().tags
    assert set(direct) <= set(both) and len(both) in (2, 3)


def test_a_table_of_many_tags_gives_what_a_list_gives(spark, asked, monkeypatch):
    """200,000 tags by the shuffle, with repeated ids, null ids and empty texts; one token is in every question."""
    monkeypatch.setattr(membership, "MAX_BROADCAST_BYTES", 0)
    monkeypatch.setattr(membership.token_lookup, "__defaults__", (0, 3, False))
    odd = [(1, None, None, None, 0, 0, 0, 0), (None, "python file", "", None, 0, 0, 0, 0), (1, "parse java", "", None, 0, 0, 0, 0)]
    rows = materialise(asked.unionByName(spark.createDataFrame(odd, asked.schema)))
    names = ["file", "java", "python", "haskell"]
    many = spark.range(200_000).select(F.concat(F.lit("tag"), "id").alias("tokens"))
    table = materialise(many.union(spark.createDataFrame([(t,) for t in names], "tokens string")).withColumn("doc_freq", F.lit(0.5)))
    by_table = suggest.suggest_tags(rows, [], table, written=True)
    by_list = suggest.suggest_tags(rows, [], names)
    order = lambda df: sorted((repr(r.Id), r.tags) for r in df.collect())
    assert order(by_table) == order(by_list) and by_table.count() == 63
    assert suggest.suggest_tags(rows, [], table.limit(0)).where("size(tags) > 0").count() == 0


def test_tags_are_looked_up_inside_the_row(spark, monkeypatch):
    """Nothing is shuffled for a table that is sent whole; a longer one gives the same, also for rows that come twice."""
    docs = [(1, ["x", "rare", "no", "x"]), (1, ["x", "rare", "no", "x"]), (None, ["rare", None, "y"]), (2, []), (3, None), (None, ["no"])]
    df = materialise(spark.createDataFrame(docs, "Id long, tokens array<string>"))
    many = spark.range(5000).select(F.concat(F.lit("tag"), "id").alias("tokens"), F.lit(0.1).alias("doc_freq"))
    named = spark.createDataFrame([("x", 0.9), ("y", 0.8), ("rare", 0.01), (None, 0.7)], "tokens string, doc_freq double")
    tags = materialise(many.unionByName(named))
    want = sorted(map(repr, [(1, ["x", "rare", "x"]), (1, ["x", "rare", "x"]), (None, ["rare", "y"]), (2, []), (3, []), (None, [])]))

    def found():
        rows = suggest.with_known_tags(df, "Id", "tokens", tags, "direct", written=True)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        return sorted(repr((r.Id, r.direct)) for r in rows.collect()), "Exchange" in plan

    assert found() == (want, False)
    monkeypatch.setattr(suggest, "SENT_BYTES", 0)
    monkeypatch.setattr(suggest, "SENT_TAGS", 2)
    assert found() == (want, True)


def test_tags_are_refreshed_and_learned_between_batches(spark, tmp_path):
    """A published tag and learned tags are used by the batches after; a restart repeats nothing."""
    schema = "Id long, Title string, Body string, Tags array<string>"
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))

    def arrive(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def learned(batch):
        return suggest.tag_vocabulary(batch, "Tags")

    def run():
        stream = question_stream(spark, source, T.StructType.fromDDL(schema), max_files=1)
        suggest_tags_stream(stream, out, mark, [], table, learn=learned).awaitTermination()
        return {(r.Id, tuple(r.tags)) for r in spark.read.parquet(out).collect()}, spark.read.parquet(out).count()

    table = TagTable(spark, str(tmp_path / "tags"))
    assert table.version() == 0 and table.latest().count() == 0
    arrive((1, "python file", "", ["java"]))
    assert run() == ({(1, ())}, 1)  # nothing is known before the first batch, which teaches java
    arrive((2, "python java", "", None), (3, None, None, []))
    assert run() == ({(1, ()), (2, ("java",)), (3, ())}, 3)
    before = table.version()
    assert table.publish(table.latest().union(spark.createDataFrame([("python", 1.0)], "tokens string, doc_freq double")), "by hand") == before + 1
    assert table.publish(table.latest().limit(0), "by hand") == before + 1  # a source counts once
    arrive((4, "python java", "", ["java", "file"]))
    assert run() == ({(1, ()), (2, ("java",)), (3, ()), (4, ("java", "python"))}, 4)
    assert run()[1] == 4
    weights = {r.tokens: r.doc_freq for r in table.latest().collect()}
    assert weights == {"java": 2.0, "python": 1.0, "file": 1.0}
    assert table.latest(before="by hand").select("tokens").collect() == [("java",)]
    assert table.latest(before="unknown").count() == 3


def test_stream_equals_batch(spark):
    batch = {(r.Id, r.tags) for r in QUERIES["suggest_tags"](spark, SMALL).collect()}
    stream = {(r.Id, r.tags) for r in QUERIES["suggest_tags_stream"](spark, SMALL).collect()}
    assert batch == stream and len(batch) == 200


def test_arrays_are_computed_once(spark):
    """The optimizer must not push a copy of the tokeniser below an explode."""
    counted = stats.count_tokens(
        questions.document_posts(spark, SMALL, False).select(F.split("Body", " ").alias("t")), "t", "doc_count")
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1


def test_runs_with_the_whole_tag_settings(spark):
    """Hinge and squared error see the same test rows; every label that a row can get is one of its classes."""
    hinge = {r.Id: r for r in QUERIES["supervised_bow_hinge"](spark, SMALL).collect()}
    squared = {r.Id: r for r in QUERIES["supervised_bow"](spark, SMALL).collect()}
    assert hinge.keys() == squared.keys() and all(hinge[k].truth == squared[k].truth for k in hinge)
    assert any(r.predicted for r in hinge.values())
