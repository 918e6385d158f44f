"""Corpus preparation: tags, text nodes and token lists as one projection over questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import html, text
from tagloom.functions.lemma import NOUN, VERB
from tagloom.functions.stopwords import default_stop_words


def body_nodes(body: Column, exclude: Sequence[str] = ("code",)) -> Column:
    """Text nodes outside code."""
    return html.segments_by_tag(html.html_segments(body), exclude=list(exclude))


def processed_questions(
    questions: DataFrame, stop_words: Sequence[str] | None = None, exploration: bool = False
) -> DataFrame:
    """The processed table: ``ntags``, ``body-tokens``, ``body-tokens-wov`` (no verbs) and
    ``title-tokens``. The parsed body is bound once per row and shared by both token lists."""
    words = default_stop_words() if stop_words is None else list(stop_words)
    extra = text.TITLE_EXTRA_STOP_WORDS if exploration else []
    parsed = questions.withColumn("_words", text.body_words(body_nodes(F.col("Body")), words))

    def tokens(allowed: Sequence[str]) -> Column:
        return text.filter_empty_list(text.lemmatize(F.col("_words"), allowed))

    columns = {
        "body-tokens": tokens((VERB, NOUN)),
        "body-tokens-wov": text.filter_list(tokens((NOUN,)), exclude=text.BODY_EXTRA_STOP_WORDS),
        "title-tokens": text.title_tokens(F.col("Title"), words, extra_stop_words=extra),
    }
    if "Tags" in questions.columns:
        columns["ntags"] = text.extract_tags(F.col("Tags"))
    return parsed.withColumns(columns).drop("_words")
