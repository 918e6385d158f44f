"""H5: the language of a code block, by weighted patterns.

The rules are a short fixed list, so they are part of the expression and need no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.arrays import let

TEXT_ONLY = "Text only"
THRESHOLD = 2

# Language, pattern, weight. Only syntax that Java and RE2 read alike.
RULES = [
    ("Python", "(?m)^\\s*def \\w+\\(.*\\):", 3),
    ("Python", "(?m)^\\s*(import \\w+|from [\\w.]+ import )", 2),
    ("Python", "\\bself\\b", 1),
    ("Java", "\\b(public|private|protected) (static |final )*[\\w<>]+ \\w+", 3),
    ("Java", "System\\.out\\.", 2),
    ("Java", "(?m)^\\s*import java", 3),
    ("C++", "#include\\s*<\\w+>", 3),
    ("C++", "std::", 3),
    ("C#", "(?m)^\\s*using [\\w.]+;", 3),
    ("C#", "Console\\.Write", 3),
    ("JavaScript", "\\b(var|let|const) \\w+\\s*=", 2),
    ("JavaScript", "\\bfunction\\b\\s*\\w*\\(", 2),
    ("JavaScript", "=>|console\\.log|document\\.", 1),
    ("CSS", "[\\w.#-]+\\s*\\{[^{}]*:[^{}]*\\}", 3),
    ("HTML", "</\\w+>", 2),
    ("SQL", "(?i)\\bselect\\b.*\\bfrom\\b", 3),
    ("SQL", "(?i)\\b(insert into|create table|update \\w+ set)\\b", 3),
    ("Bash", "(?m)^\\s*(\\$|sudo|echo|cd|ls) ", 2),
    ("PHP", "<\\?php|\\$\\w+\\s*=", 3),
    (TEXT_ONLY, "^[A-Za-z0-9 ,.'!?-]+$", 2),
]


def languages() -> list[str]:
    """In the order of the rules, which also breaks ties."""
    return list(dict.fromkeys(language for language, _, _ in RULES))


def code_language(code: Column) -> Column:
    """Best language, or null below the threshold."""

    def score(language: str) -> Column:
        total = F.lit(0)
        for name, pattern, weight in RULES:
            if name == language:
                total = total + F.when(code.rlike(pattern), weight).otherwise(0)
        return total

    ranked = [
        F.struct(score(lang).alias("score"), F.lit(-k).alias("order"), F.lit(lang).alias("language"))
        for k, lang in enumerate(languages())
    ]
    return let(
        F.array_max(F.array(*ranked)),
        lambda best: F.when(best["score"] >= THRESHOLD, best["language"]),
    )


def code_sections(blocks: Column, exclude: Sequence[str] = ()) -> Column:
    """``struct<text, lexer>``: blocks that are plain text, and the languages of the others."""
    excluded = [TEXT_ONLY, *exclude]
    guessed = F.transform(
        blocks, lambda c: F.struct(c.alias("code"), code_language(c).alias("language"))
    )
    return let(
        guessed,
        lambda g: F.struct(
            F.transform(F.filter(g, lambda s: s["language"] == TEXT_ONLY), lambda s: s["code"]).alias("text"),
            F.transform(
                F.filter(g, lambda s: ~s["language"].isin(excluded)), lambda s: s["language"]
            ).alias("lexer"),
        ),
    )
