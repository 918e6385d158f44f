import html as stdlib_html
from html.parser import HTMLParser

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tagloom.functions import codelang, html


def segments(spark, body, **options):
    df = spark.createDataFrame([(body,)], "b string")
    return [tuple(s) for s in df.select(html.html_segments(F.col("b"), **options).alias("s")).first().s]


EXAMPLE = "lead <p>Use <code>x &lt; y</code> then call f().</p><p>tail"


def test_text_after_a_closed_tag_stays_with_the_last_opened(spark):
    assert segments(spark, EXAMPLE) == [
        ("NO_TAG", "lead"), ("p", "Use"), ("code", "x < y"), ("code", "then call f()."), ("p", "tail"),
    ]
    assert segments(spark, EXAMPLE, attribution="enclosing")[3] == ("p", "then call f().")
    assert segments(spark, EXAMPLE, exclude_tags=["code"]) == [("NO_TAG", "lead"), ("p", "Use"), ("p", "tail")]
    assert segments(spark, None) == [] and segments(spark, "") == []
    with pytest.raises(ValueError):
        html.html_segments(F.col("b"), attribution="other")


def test_awkward_markup(spark):
    body = "a < b <b title='x>y' data-x=\"1>0\">C++</b><br>t<img src=x>u<!-- c <p> -->v<script>if(a<b && c){'</p>'}</script>w"
    assert segments(spark, body) == [
        ("NO_TAG", "a"), ("NO_TAG", "<"), ("NO_TAG", "b"), ("b", "C++"), ("b", "t"), ("b", "u"), ("b", "v"),
        ("script", "if(a<b && c){'</p>'}"), ("script", "w"),
    ]
    assert segments(spark, " <p> x </p>", keep_blank=True) == [("NO_TAG", " "), ("p", " x ")]


def test_long_bodies_do_not_exhaust_the_stack(spark):
    body = "<p a='" + "x" * 50_000 + "'>" + "word &amp; " * 20_000 + "<b>y</b>" * 2_000
    got = segments(spark, body)
    assert len(got) == 2_001 and got[0][1].startswith("word & word")


def test_character_references(spark):
    values = ["&amp;lt; &#39;x&#39 &#x1F600; &copy2 &notit; &amp &am &nbsp;&eacute;&eacuteé &#0; &#128; &foo; a&b & && &#xD800;",
              "none", "&lt", "&hearts; &hearts x", "&apos;", "&#38;lt;", "&AMP; &Amp;", "&#1;x", "&#99999999;"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for row in df.select("v", html.unescape(F.col("v")).alias("u")).collect():
        assert row.u == stdlib_html.unescape(row.v)


class LastOpen(HTMLParser):
    def __init__(self):
        super().__init__()
        self.tag, self.nodes = "NO_TAG", []

    def handle_starttag(self, tag, attrs):
        if tag not in html.SINGLE_TAGS:
            self.tag = tag

    def handle_data(self, data):
        if data.strip():
            self.nodes.append((self.tag, data.strip()))


def test_pages_agree_with_the_standard_parser(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = pages.select("html", html.html_segments(F.col("html")).alias("s")).collect()
    assert len(rows) == 50
    for row in rows:
        parser = LastOpen()
        parser.feed(row.html)
        parser.close()
        assert [tuple(s) for s in row.s] == parser.nodes


def test_groups_by_tag_in_first_seen_order(spark):
    df = spark.createDataFrame([("<p>1<b>2</b><p>3<i>4",)], "b string")
    s = html.html_segments(F.col("b"))
    row = df.select(
        html.segments_by_tag(s, exclude=["i"]).alias("x"), html.segments_by_tag(s, include=["b", "i"]).alias("n"),
        html.segments_by_tag(s, ["p"], ["b"]).alias("both"), html.html_text(s).alias("t"),
    ).first()
    assert row.x == ["1", "3", "2"] and row.n == ["2", "4"] and row.both == ["1", "3", "2", "4"] and row.t == "1234"


def test_code_language_and_mixed_text(spark):
    body = ("<p>Why?</p><code>def f(x):\n    return x</code><p>or</p><code>just words</code><p>then</p>"
            "<code>@@@@ ####</code><p>end")
    df = spark.createDataFrame([(body,)], "b string")
    s = html.html_segments(F.col("b"))
    row = df.select(html.mixed_text(s).alias("m"),
                    codelang.code_sections(html.segments_by_tag(s, include=["code"])).alias("c")).first()
    assert row.m.text == " Why?  [Python]  or  just words  then  end "
    assert row.m.code == ["def f(x):\n    return x"]
    assert row.c.text == ["just words"] and row.c.lexer == ["Python"]
