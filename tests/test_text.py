import re

import pytest
from pyspark.sql import functions as F

from tagloom.functions import arrays, lemma, stopwords, text
from tagloom.sources import processed


def one(spark, value, ddl, fn):
    return spark.createDataFrame([(value,)], f"v {ddl}").select(fn(F.col("v")).alias("r")).first().r


def test_extract_tags(spark):
    tags = "<C#><asp.net><c++><node.js><Java-8>"
    assert one(spark, tags, "string", text.extract_tags) == ["c#", "c++", "java-8"]
    with_dots = one(spark, tags, "string", lambda c: text.extract_tags(c, allow_dot=True))
    assert with_dots == ["c#", "asp.net", "c++", "node.js", "java-8"]
    assert one(spark, None, "string", text.extract_tags) is None or one(spark, None, "string", text.extract_tags) == []


def test_signs_keep_backslash_and_dollar(spark):
    value = ["a\\b", "c++", "d|e", "f(g)", "h_i", "$j", "c++x"]
    got = one(
        spark, value, "array<string>",
        lambda c: text.remove_signs_list(c, text.COMMON_SIGNS, " ", text.SIGN_EXCEPTIONS),
    )
    assert got == ["a\\b", "c++", "d e", "f g ", "h i", "$j", "c  x"]
    python = re.sub(text.sign_class(text.COMMON_SIGNS), " ", "a\\b|c (d) - e ` ^ §")
    assert one(spark, "a\\b|c (d) - e ` ^ §", "string",
               lambda c: text.remove_signs_str(c, text.COMMON_SIGNS)) == python


def test_missing_arguments_fail():
    with pytest.raises(ValueError):
        text.sign_class(None)
    with pytest.raises(ValueError):
        text.remove_patterns_list(F.lit(None), None)
    with pytest.raises(ValueError):
        text.filter_list(F.lit(None), ["a"], ["b"])


def test_filter_list(spark):
    value = ["a", "b", "c", "a"]
    assert one(spark, value, "array<string>", lambda c: text.filter_list(c, include=["a"])) == ["a", "a"]
    assert one(spark, value, "array<string>", lambda c: text.filter_list(c, exclude=["c"])) == ["a", "b", "a"]
    assert one(spark, value, "array<string>", text.filter_list) == value
    assert one(spark, value, "array<string>", lambda c: text.filter_list(c, include=[])) == []


def test_split_keeps_empty_ends(spark):
    assert one(spark, ["  a b "], "array<string>", text.tokenize_list) == ["", "a", "b", ""]
    assert one(spark, ["", "x", ""], "array<string>", text.filter_empty_list) == ["x"]


def test_white_space_is_the_unicode_set(spark):
    every = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    assert sorted(every) == sorted(text.WHITESPACE_CHARS)
    value = "x" + "y".join(every) + "z"
    assert one(spark, [value], "array<string>", text.tokenize_list) == re.split(r"\s+", value)
    assert one(spark, "  a b　", "string", text.strip) == "a b"


def test_remove_patterns_deletes_digits(spark):
    got = one(spark, ["a1b22", "333"], "array<string>",
              lambda c: text.remove_patterns_list(c, text.NUMBER_PATTERNS))
    assert got == ["ab", ""]


def test_lists_to_strings_and_back(spark):
    assert one(spark, ["b", "a"], "array<string>", text.list_to_str) == "a_b"
    assert one(spark, "['a', 'b']", "string", processed.deserialize_list) == ["a", "b"]
    assert one(spark, "[]", "string", processed.deserialize_list) == [""]
    assert one(spark, ["a", "b"], "array<string>", processed.serialize_list) == "['a', 'b']"


def test_bitmask(spark):
    rows = ["0000", "0001", "0010", "0100", "1000", "1001", "0110", "1111"]
    df = spark.createDataFrame([(k, [int(b) for b in r]) for k, r in enumerate(rows)], "k int, bits array<int>")
    got = df.orderBy("k").select(text.tags_bitmask(F.col("bits")).alias("m")).collect()
    assert [r.m for r in got] == [0, 1, 2, 4, 8, 9, 6, 15]
    with pytest.raises(Exception, match="63 labels"):
        one(spark, [0] * 64, "array<int>", text.tags_bitmask)


def test_title_keeps_exceptions_body_only_as_a_whole_node(spark):
    stop = ["the"]
    title = one(spark, "The C++ and c#: G++ 12x", "string", lambda c: text.title_words(c, stop))
    assert title == ["c++", "and", "c", "g++", "x"]
    nodes = one(spark, ["C++", "use c++ now"], "array<string>", lambda c: text.body_words(c, stop))
    assert nodes == ["c++", "use", "c", "now"]
    assert one(spark, None, "array<string>", lambda c: text.body_words(c, stop)) == []
    assert one(spark, None, "string", lambda c: text.title_tokens(c, stop)) == []


def test_body_words_equal_the_step_by_step_chain(spark):
    value = ["Don't STOP 42 tables_of (c++) a1b2 | x\\y", " c# ", "C#", "é§ü 7seven"]

    def steps(c):
        return text.apply_in_order(c, [
            text.lower_list,
            lambda t: text.remove_signs_list(t, text.COMMON_SIGNS, " ", text.SIGN_EXCEPTIONS),
            text.tokenize_list,
            lambda t: text.remove_patterns_list(t, text.NUMBER_PATTERNS),
            text.filter_empty_list,
            lambda t: text.filter_list(t, exclude=["stop"]),
        ])

    assert one(spark, value, "array<string>", lambda c: text.body_words(c, ["stop"])) == one(
        spark, value, "array<string>", steps)


def test_lemmas(spark):
    tokens = ["queries", "classes", "status", "running", "parsed", "quickly", "indices", "tables", "big", "node", "bus"]
    both = one(spark, tokens, "array<string>", lemma.lemmatize)
    assert both == ["query", "class", "status", "run", "pars", "", "index", "table", "", "node", "bus"]
    nouns = one(spark, tokens, "array<string>", lambda c: lemma.lemmatize(c, (lemma.NOUN,)))
    assert nouns == ["query", "class", "status", "", "", "", "index", "table", "", "node", "bus"]


def test_stop_words(spark, tmp_path):
    own = tmp_path / "own.txt"
    own.write_text("foo\nbar\n\n")
    merged = stopwords.merge_stop_words(["b", "a"], ["a", "c"], stopwords.stop_words_from(spark, str(own)))
    assert merged == ["a", "b", "bar", "c", "foo"]
    assert "the" in stopwords.spark_stop_words() and "le" in stopwords.spark_stop_words("french")


def test_run_lengths(spark):
    got = one(spark, list("abacab"), "array<string>", arrays.run_lengths)
    assert [(r.token, r.n) for r in got] == [("a", 3), ("b", 2), ("c", 1)]
    assert one(spark, [], "array<string>", arrays.run_lengths) == []


def test_question_text(spark):
    df = spark.createDataFrame([("How To", 'say "hi"\nnow')], "t string, b string")
    row = df.select(text.question_text(F.col("t"), F.col("b")).alias("q"),
                    text.embedding_input(F.col("t"), F.col("b")).alias("e")).first()
    assert row.q == 'How To. say "hi"\nnow' and row.e == "how to. say  hi  now"
