"""Stop-word lists and their union.

Large lists are parameters: pass any iterables of words, or read them from a file. The
short list here holds the function words that every default needs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import SparkSession

# Common English function words.
FUNCTION_WORDS = """
a about above after again all also am an and any are as at be because been before being below
between both but by can could did do does doing don down during each few for from further had has
have having he her here hers him his how i if in into is it its just like me more most my no nor
not now of off on once only or other our out over own same she should so some such than that the
their them then there these they this those through to too under until up use using very want was
way we were what when where which while who whom why will with would you your
""".split()


def merge_stop_words(*lists: Iterable[str]) -> list[str]:
    """Sorted union."""
    return sorted(set().union(*lists))


def spark_stop_words(language: str = "english") -> list[str]:
    """The list that Spark ML ships for a language (needs a running session)."""
    return list(StopWordsRemover.loadDefaultStopWords(language))


def stop_words_from(spark: SparkSession, path: str, max_words: int = 50_000) -> list[str]:
    """A caller's own list, one word per line. It ends up in the plan, so its size is checked."""
    rows = spark.read.text(path).limit(max_words + 1).collect()
    if len(rows) > max_words:
        raise ValueError(f"more than {max_words} stop words in {path}")
    return [row.value.strip() for row in rows if row.value.strip()]


def default_stop_words() -> list[str]:
    return merge_stop_words(FUNCTION_WORDS)
