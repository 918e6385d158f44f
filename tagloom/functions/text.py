"""String and token-list operators: P1-P13, P16-P19 of the survey.

Every function maps Columns to Columns, so a chain of them stays one projection.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.arrays import empty_strings, or_empty, replace_each
from tagloom.functions.lemma import NOUN, VERB, lemmatize

# The sign list, the tokens kept whole and the tag pattern that decide the results.
COMMON_SIGNS = [
    "\\(", "\\)", "\\[", "\\]", "\\{", "\\}", "\\?", "\\.", ";", ",", ":", "\\|", "\\=", "\\-",
    "\\+", '"', "'", "&", "%", "\\*", "\\", "/", "\\!", "#", "_", "<", ">", "@", "§", "~",
]
SIGN_EXCEPTIONS = ["c++", "g++", "c#"]
NUMBER_PATTERNS = ["[0-9]*"]
TAG_PATTERN = "\\<([a-z, A-Z, 0-9,\\-,\\+,#]*)\\>"
TAG_PATTERN_WITH_DOT = "\\<([a-z, A-Z, 0-9,\\-,\\+,#,\\.]*)\\>"
BODY_EXTRA_STOP_WORDS = ["code", "question", "problem", "data", "help", "thing", "idea", "imagine"]
TITLE_EXTRA_STOP_WORDS = ["code", "data"]

# All characters that count as white space in Unicode text, as a regex class body and as plain text.
# Single Latin characters share one bit set and the rare ones sit behind one range test, which
# makes the class about twice as fast as a list of ranges.
WHITESPACE = (
    "\\x09\\x0A\\x0B\\x0C\\x0D\\x1C\\x1D\\x1E\\x1F\\x20\\x85\\xA0"
    "[\\x{1680}-\\x{3000}&&[\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]]"
)
WHITESPACE_CHARS = "".join(
    chr(c)
    for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
SPACES = f"[{WHITESPACE}]+"

Action = Callable[[Column], Column]


def apply_in_order(value: Column, actions: Sequence[Action]) -> Column:
    """Feed a column through a list of functions."""
    return reduce(lambda acc, action: action(acc), actions, value)


def extract_pattern(value: Column, pattern: str, group: int = 1) -> Column:
    """All matches of a regex."""
    return or_empty(F.regexp_extract_all(value, F.lit(pattern), F.lit(group)))


def extract_tags(value: Column, allow_dot: bool = False) -> Column:
    """``<a><b>`` to lower-case tags; tags with a dot are lost unless ``allow_dot``."""
    return lower_list(extract_pattern(value, TAG_PATTERN_WITH_DOT if allow_dot else TAG_PATTERN))


def lower_str(value: Column) -> Column:
    return F.lower(value)


def lower_list(tokens: Column) -> Column:
    return F.transform(tokens, F.lower)


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE_CHARS))


def sign_class(signs: Sequence[str] | None) -> str:
    """One character class of all signs. The joiner puts blank and ``|`` into the class,
    and a lone backslash only escapes the blank after it, so backslash itself is kept."""
    if signs is None:
        raise ValueError("signs must be given")
    return "[" + " | ".join(signs) + "]"


def remove_list(tokens: Column, pattern: str, replacement: str, exceptions: Sequence[str] = ()) -> Column:
    """Regex replace on every element that is not an exception as a whole."""
    return replace_each(
        tokens, list(exceptions), lambda x: F.regexp_replace(x, F.lit(pattern), F.lit(replacement))
    )


def remove_signs_list(
    tokens: Column,
    signs: Sequence[str] | None = None,
    replacement: str = "",
    exceptions: Sequence[str] = (),
) -> Column:
    """P5."""
    return remove_list(tokens, sign_class(signs), replacement, exceptions)


def remove_signs_str(value: Column, signs: Sequence[str] | None = None) -> Column:
    """P6."""
    return F.regexp_replace(value, F.lit(sign_class(signs)), F.lit(" "))


def remove_patterns_list(
    tokens: Column,
    patterns: Sequence[str] | None = None,
    replacement: str = "",
    exceptions: Sequence[str] = (),
) -> Column:
    """The patterns are alternatives, joined with blanks around the bar."""
    if patterns is None:
        raise ValueError("patterns must be given")
    return remove_list(tokens, " | ".join(patterns), replacement, exceptions)


def filter_list(
    tokens: Column, exclude: Sequence[str] | None = None, include: Sequence[str] | None = None
) -> Column:
    """Keep or drop members; order and duplicates stay.

    The list becomes a hash set literal in the plan, so it must be small; for a
    vocabulary of any size see ``operators.membership``.
    """
    if exclude is not None and include is not None:
        raise ValueError("exclude and include are both set")
    if include is not None:
        words = list(include)
        return F.filter(tokens, lambda x: x.isin(words)) if words else empty_strings()
    if exclude:
        words = list(exclude)
        return F.filter(tokens, lambda x: ~x.isin(words))
    return tokens


def filter_empty_list(tokens: Column) -> Column:
    """P9."""
    return F.filter(tokens, lambda x: x != "")


def tokenize_list(tokens: Column, pattern: str = SPACES) -> Column:
    """P10: split every element and concatenate; blanks at the ends give empty tokens."""
    return F.flatten(F.transform(tokens, lambda x: F.split(x, pattern)))


def list_to_str(tokens: Column) -> Column:
    """P11."""
    return F.array_join(F.sort_array(tokens), "_")


def sort_list(tokens: Column) -> Column:
    """P12, natural order. By a count lookup: ``operators.membership.sort_by_count``."""
    return F.sort_array(tokens)


def merge_tokens(*columns: Column) -> Column:
    """P13."""
    return F.concat(*[or_empty(c) for c in columns])


def words_of(value: Column, signs: Sequence[str]) -> Column:
    """Lower-case words of one text: digits deleted, signs and white space are separators.

    Same result as blanking the signs, splitting at white space and then deleting the
    digits, in two regex passes and without a lambda per word.
    """
    separators = f"[{WHITESPACE}{' | '.join(signs)}]+"
    return F.split(F.regexp_replace(F.lower(value), F.lit("[0-9]+"), F.lit("")), separators)


def body_words(nodes: Column, stop_words: Sequence[str], signs=None, exceptions=None) -> Column:
    """P16 up to the stop words: text nodes to words. A node that as a whole is an
    exception (``c++``) stays whole."""
    signs = COMMON_SIGNS if signs is None else signs
    exceptions = SIGN_EXCEPTIONS if exceptions is None else exceptions
    dropped = ["", *stop_words]

    longest = max(map(len, exceptions), default=-1)

    def node_words(node: Column) -> Column:
        whole = (F.length(node) <= longest) & F.lower(node).isin(list(exceptions))
        return F.when(whole, F.array(F.lower(node))).otherwise(words_of(node, signs))

    return F.filter(F.flatten(F.transform(or_empty(nodes), node_words)), lambda x: ~x.isin(dropped))


def body_tokens(
    nodes: Column,
    stop_words: Sequence[str],
    allowed_pos: Sequence[str] = (VERB, NOUN),
    extra_stop_words: Sequence[str] = (),
) -> Column:
    """Words of the non-code nodes, lemmatised and restricted to parts of speech."""
    tokens = filter_empty_list(lemmatize(body_words(nodes, stop_words), allowed_pos))
    return filter_list(tokens, exclude=list(extra_stop_words))


def body_tokens_without_verbs(nodes: Column, stop_words: Sequence[str]) -> Column:
    """P16, noun-only variant with its own extra stop words."""
    return body_tokens(nodes, stop_words, allowed_pos=(NOUN,), extra_stop_words=BODY_EXTRA_STOP_WORDS)


def title_words(title: Column, stop_words: Sequence[str], signs=None, exceptions=None) -> Column:
    """P17 up to the stop words. The title is split first, so ``c++`` and ``c#`` survive."""
    signs = COMMON_SIGNS if signs is None else signs
    exceptions = SIGN_EXCEPTIONS if exceptions is None else exceptions
    dropped = ["", *stop_words]
    chunks = F.split(F.regexp_replace(F.lower(title), F.lit("[0-9]+"), F.lit("")), SPACES)
    words = F.flatten(
        F.transform(
            chunks,
            lambda x: F.when(x.isin(list(exceptions)), F.array(x)).otherwise(
                F.split(x, sign_class(signs) + "+")
            ),
        )
    )
    return or_empty(F.filter(words, lambda x: ~x.isin(dropped)))


def title_tokens(
    title: Column,
    stop_words: Sequence[str],
    allowed_pos: Sequence[str] = (VERB, NOUN),
    extra_stop_words: Sequence[str] = (),
) -> Column:
    """P17."""
    tokens = filter_empty_list(lemmatize(title_words(title, stop_words), allowed_pos))
    return filter_list(tokens, exclude=list(extra_stop_words))


def question_text(title: Column, body_text: Column) -> Column:
    """Title and body text as one string."""
    return F.concat(title, F.lit(". "), body_text)


def embedding_input(title: Column, body_text: Column) -> Column:
    """P18, variant for sentence encoders: newlines and quotes blanked, lower-case."""
    blanked = remove_signs_str(remove_signs_str(body_text, ["\n"]), ['"'])
    return F.lower(question_text(title, blanked))


def tags_bitmask(bits: Column) -> Column:
    """Label row to integer, first label most significant; 63 labels at most."""
    return F.when(
        F.size(bits) <= 63,
        F.aggregate(bits, F.lit(0).cast("long"), lambda acc, b: acc * 2 + b.cast("long")),
    ).otherwise(F.raise_error(F.lit("a bit mask holds 63 labels at most")).cast("long"))
