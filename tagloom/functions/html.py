"""H1-H4: text nodes of HTML bodies, without leaving the row.

A body is cut by one regex into comments, script and style elements, tags and text. Under
the default attribution a text node belongs to the most recently opened tag and closing a
tag changes nothing, so it is enough to cut the body at opening tags: everything up to the
next one belongs to it. That makes the parse a linear string operation inside a projection,
with no explode, window or shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.arrays import empty_strings, let
from tagloom.functions.text import strip

NO_TAG = "NO_TAG"
SINGLE_TAGS = ["br", "img", "hr"]
SEGMENT_TYPE = "array<struct<tag:string,text:string>>"

# Control characters that HTML forbids serve as marks; they are deleted from the input first.
_OPEN, _NAME_END, _CUT, _RAW_AMP = "\x01", "\x02", "\x03", "\x04"
_MARKS = _OPEN + _NAME_END + _CUT + _RAW_AMP

# Quotes matter only after "="; possessive runs keep the match linear and shallow.
_ATTRIBUTES = "(?:[^>\"'=]++|=\\s*+\"[^\"]*+\"|=\\s*+'[^']*+'|[\"'=])*+"
PIECES = (
    "(?is)<!--.*?-->"
    f"|<script(?=[\\s/>]){_ATTRIBUTES}>.*?</script\\s*>"
    f"|<style(?=[\\s/>]){_ATTRIBUTES}>.*?</style\\s*>"
    "|<[!?][^>]*>"
    f"|</?[a-z]{_ATTRIBUTES}>"
    "|<"
    "|[^<]+"
)
_NAME = "^</?([a-zA-Z][^\\s/>]*)"


def html_pieces(body: Column) -> Column:
    """Comments, elements with raw text, tags, stray ``<`` and text runs, in order."""
    return F.regexp_extract_all(_unmarked(body), F.lit(PIECES), F.lit(0))


def _unmarked(body: Column) -> Column:
    return F.when(body.rlike(f"[{_MARKS}]"), F.translate(body, _MARKS, "")).otherwise(body)


# Names that count without the closing semicolon, all known names, and the Windows
# characters that the references 128-159 stand for.
_BARE_NAMES = {name: char for name, char in html5.items() if not name.endswith(";")}
_NAMES = {**{name: chr(code) for name, code in name2codepoint.items()}, **_BARE_NAMES, "apos": "'"}
_WINDOWS = {n: bytes([n]).decode("cp1252", "ignore") for n in range(0x80, 0xA0)}


def _lookup(table: dict) -> Column:
    """A constant map: one literal that Spark folds, instead of hundreds of expressions."""
    text = _OPEN.join(f"{key}{_NAME_END}{value}" for key, value in table.items())
    return F.str_to_map(F.lit(text), F.lit(_OPEN), F.lit(_NAME_END))


def _numbered(code: Column) -> Column:
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    windows = _lookup({n: c for n, c in _WINDOWS.items() if c})[code.cast("string")]
    invalid = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    control = code.between(1, 8) | code.isin(11, 127) | code.between(14, 31)
    return (
        F.when(invalid, F.lit("\ufffd"))
        .when(control, F.lit(""))
        .when(code.between(0x80, 0x9F) & windows.isNotNull(), windows)
        .otherwise(plain)
    )


def unescape(text: Column) -> Column:
    """Character references (numbers, HTML 4 names), each decoded once: the text is cut at
    ``&`` and the start of every part is looked up."""
    bare = f"^({'|'.join(sorted(_BARE_NAMES, key=len, reverse=True))})"

    def decoded(part: Column) -> Column:
        decimal = F.regexp_extract(part, "^(#[0-9]{1,9});?", 1)
        hexadecimal = F.regexp_extract(part, "^(#[xX][0-9a-fA-F]{1,7});?", 1)
        named = F.regexp_extract(part, "^([0-9A-Za-z]{1,32});", 1)
        prefix = F.regexp_extract(part, bare, 1)

        def with_rest(char: Column, reference: Column) -> Column:
            end = F.length(reference)
            skip = F.when(F.substr(part, end + 1, F.lit(1)) == ";", 2).otherwise(1)
            return F.concat(char, F.substr(part, end + skip))

        return (
            F.when(decimal != "", with_rest(_numbered(F.substr(decimal, F.lit(2)).cast("long")), decimal))
            .when(
                hexadecimal != "",
                with_rest(_numbered(F.conv(F.substr(hexadecimal, F.lit(3)), 16, 10).cast("long")), hexadecimal),
            )
            .when(_lookup(_NAMES)[named].isNotNull(), with_rest(_lookup(_NAMES)[named], named))
            .when(prefix != "", F.concat(_lookup(_BARE_NAMES)[prefix], F.substr(part, F.length(prefix) + 1)))
            .otherwise(F.concat(F.lit("&"), part))
        )

    def rebuilt(parts: Column) -> Column:
        return F.array_join(
            F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(decoded(p))), ""
        )

    return F.when(text.contains("&"), let(F.split(text, "&"), rebuilt)).otherwise(text)


def _marked(piece: Column) -> Column:
    name = F.lower(F.regexp_extract(piece, _NAME, 1))
    raw = F.regexp_extract(piece, f"(?is)^<(?:script|style){_ATTRIBUTES}>(.*)</(?:script|style)\\s*>$", 1)
    return (
        F.when(~piece.startswith("<"), piece)
        .when(piece == "<", F.lit(f"{_CUT}<{_CUT}"))
        .when(name == "", F.lit(_CUT))
        .when(
            name.isin("script", "style") & piece.rlike("(?i)</(?:script|style)\\s*>$") & ~piece.startswith("</"),
            F.concat(F.lit(_OPEN), name, F.lit(_NAME_END), F.translate(raw, "&", _RAW_AMP), F.lit(_CUT)),
        )
        .when(piece.startswith("</") | name.isin(SINGLE_TAGS), F.lit(_CUT))
        .otherwise(F.concat(F.lit(_OPEN), name, F.lit(_NAME_END)))
    )


def _last_open(body: Column) -> Column:
    """The marked body, decoded as a whole, then cut at opening tags and inside those at
    the other marks. A body without any ``<`` is one text node."""

    def chunk_nodes(chunk: Column, k: Column) -> Column:
        tag = F.when(k == 0, F.lit(NO_TAG)).otherwise(F.substring_index(chunk, _NAME_END, 1))
        text = F.when(k == 0, chunk).otherwise(F.substr(chunk, F.instr(chunk, _NAME_END) + 1))
        return F.transform(
            F.split(text, _CUT), lambda t: F.struct(tag.alias("tag"), _raw_decoded(t).alias("text"))
        )

    marked = F.array_join(F.transform(html_pieces(body), _marked), "")
    decoded = unescape(F.when(body.contains("<"), marked).otherwise(_unmarked(body)))
    return F.flatten(F.transform(F.split(decoded, _OPEN), chunk_nodes))


def _raw_decoded(text: Column) -> Column:
    return F.when(text.contains(_RAW_AMP), F.translate(text, _RAW_AMP, "&")).otherwise(text)


def _enclosing(pieces: Column) -> Column:
    """True nesting: a fold over the pieces with a stack of open tags."""
    start = F.struct(
        empty_strings().alias("stack"), F.array().cast(SEGMENT_TYPE).alias("nodes")
    )

    def step(acc: Column, piece: Column) -> Column:
        marked, stack, nodes = _marked(piece), acc["stack"], acc["nodes"]
        closes = piece.startswith("</")
        name = F.lower(F.regexp_extract(piece, _NAME, 1))
        raw = marked.startswith(_OPEN) & marked.endswith(_CUT)
        behind = F.array_position(F.reverse(stack), name).cast("int")
        at = F.size(stack) - behind
        popped = F.when(closes & (behind > 0), F.concat(
            F.slice(stack, F.lit(1), at), F.slice(stack, at + 2, F.greatest(behind, F.lit(1)))
        )).otherwise(stack)
        pushed = F.when(marked.startswith(_OPEN) & ~raw, F.concat(stack, F.array(name))).otherwise(popped)
        text = (
            F.when(raw, F.translate(F.substr(marked, F.instr(marked, _NAME_END) + 1), _CUT, ""))
            .when(marked.startswith(_OPEN) | (marked == _CUT), F.lit(""))
            .otherwise(F.translate(marked, _CUT, ""))
        )
        tag = F.when(raw, name).otherwise(F.coalesce(F.try_element_at(stack, F.lit(-1)), F.lit(NO_TAG)))
        node = F.struct(tag.alias("tag"), _raw_decoded(unescape(text)).alias("text"))
        return F.struct(
            pushed.alias("stack"),
            F.when(text != "", F.concat(nodes, F.array(node))).otherwise(nodes).alias("nodes"),
        )

    return F.aggregate(pieces, start, step, lambda acc: acc["nodes"])


def html_segments(
    body: Column,
    exclude_tags: Sequence[str] = (),
    keep_blank: bool = False,
    attribution: str = "last_open",
) -> Column:
    """H1: ``array<struct<tag, text>>`` in document order.

    ``attribution='enclosing'`` gives a node to the innermost tag still open instead.
    """
    if attribution == "last_open":
        nodes = _last_open(body)
    elif attribution == "enclosing":
        nodes = _enclosing(html_pieces(body))
    else:
        raise ValueError(f"unknown attribution: {attribution}")
    if not keep_blank:
        nodes = F.transform(nodes, lambda s: F.struct(s["tag"].alias("tag"), strip(s["text"]).alias("text")))
    segments = F.coalesce(F.filter(nodes, lambda s: s["text"] != ""), F.array().cast(SEGMENT_TYPE))
    if exclude_tags:
        excluded = list(exclude_tags)
        segments = F.filter(segments, lambda s: ~s["tag"].isin(excluded))
    return segments


def segments_by_tag(
    segments: Column, exclude: Sequence[str] | None = None, include: Sequence[str] | None = None
) -> Column:
    """H2: texts of the chosen tags, grouped by tag in first-seen order. Both lists set
    means no choice at all."""

    def texts(bound: Column) -> Column:
        tags = F.array_distinct(F.transform(bound, lambda s: s["tag"]))
        if include is None and exclude is not None:
            dropped = list(exclude)
            tags = F.filter(tags, lambda t: ~t.isin(dropped)) if dropped else tags
        elif exclude is None and include is not None:
            kept = list(include)
            tags = F.filter(tags, lambda t: t.isin(kept))
        return F.flatten(
            F.transform(
                tags,
                lambda tag: F.transform(
                    F.filter(bound, lambda s: s["tag"] == tag), lambda s: s["text"]
                ),
            )
        )

    return let(segments, texts)


def html_text(segments: Column, separator: str = "") -> Column:
    """H3: all kept text as one string; without a separator words of neighbours glue."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), separator)


def mixed_text(segments: Column, code_tags: Sequence[str] = ("code",)) -> Column:
    """H4: ``struct<text, code>``: padded text in which recognised code is replaced by
    ``[language]`` and collected; plain text in code tags stays text, unknown code is dropped."""
    from tagloom.functions.codelang import TEXT_ONLY, code_language

    tags = list(code_tags)

    def parts(tagged: Column) -> Column:
        text = F.transform(
            tagged,
            lambda s: F.when(
                s["is_code"] & s["language"].isNull(), F.lit("")
            ).when(
                s["is_code"] & (s["language"] != TEXT_ONLY), F.concat(F.lit(" ["), s["language"], F.lit("] "))
            ).otherwise(F.concat(F.lit(" "), s["text"], F.lit(" "))),
        )
        code = F.filter(tagged, lambda s: s["is_code"] & (s["language"] != TEXT_ONLY))
        return F.struct(
            F.array_join(text, "").alias("text"), F.transform(code, lambda s: s["text"]).alias("code")
        )

    tagged = F.transform(
        segments,
        lambda s: F.struct(
            s["tag"].isin(tags).alias("is_code"),
            F.when(s["tag"].isin(tags), code_language(s["text"])).alias("language"),
            s["text"].alias("text"),
        ),
    )
    return let(tagged, parts)
