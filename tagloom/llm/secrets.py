"""Secret scans: all rules in one deterministic automaton that reads every byte once.

The searching automaton tells which pieces of a text hold the end of a match of which rule. A piece runs up to a byte
that leads back to the start state from everywhere and is part of no rule (a line end, a comma, any byte beyond
ASCII ...), so no match crosses two pieces. Only in the few pieces with a match does the anchored automaton find the exact
spans: leftmost, longest, not overlapping within a rule.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.automaton import Automaton, compile_rules, scan
from tagloom.llm.common import text_chunks

_KEY = "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
_VALUE = "[A-Za-z0-9+/_.=\\-]"
# Kind, pattern of the scan, pattern of the spans, any case, least length, whether the length counts the
# value only. The first three are the base kinds, in the order in which spans of one start are listed. Where long
# counted runs would multiply the states of the combined automaton, the scan looks for a part that every match has.
RULES = [
    ("assign", _KEY + _VALUE + "{6,}", _KEY + _VALUE + "+", True, 6, True),
    ("access", "AKIA[A-Z0-9]", "AKIA[A-Z0-9]+", False, 20, False),
    ("hex", "[0-9a-f]{24,}", "[0-9a-f]+", False, 24, False),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----BEGIN [A-Z ]*PRIVATE KEY-----", False, 0, False),
    ("jwt", "\\.eyJ[A-Za-z0-9_\\-]",
     "eyJ[A-Za-z0-9_\\-]{8,}\\.eyJ[A-Za-z0-9_\\-]{8,}\\.[A-Za-z0-9_\\-]{8,}", False, 0, False),
    ("hub", "gh[oprsu]_[A-Za-z0-9]", "gh[oprsu]_[A-Za-z0-9]{36,}", False, 0, False),
    ("chat", "xox[abeprs]-[A-Za-z0-9\\-]", "xox[abeprs]-[A-Za-z0-9\\-]{10,}", False, 0, False),
    ("login_url", "://[A-Za-z0-9_.\\-]+:",
     "[a-z]{2,10}://[A-Za-z0-9_.\\-]+:[A-Za-z0-9_.!$%\\-]+@[A-Za-z0-9]", False, 0, False),
]
KINDS = [r[0] for r in RULES]
BASE = 3


@lru_cache(maxsize=1)
def searcher() -> Automaton:
    return compile_rules([(r[1], r[3]) for r in RULES], search=True)


@lru_cache(maxsize=1)
def anchored() -> tuple[Automaton, ...]:
    """One automaton for each rule, and last the one of the keys, which ends where an assigned value begins."""
    return tuple(compile_rules([(p, c)], search=False) for p, c in [*((r[2], r[3]) for r in RULES), (_KEY, True)])


@lru_cache(maxsize=1)
def cut_bytes() -> np.ndarray:
    """Bytes after which a text can be cut: they lead the searching automaton back to its start, and no rule has them."""
    cut = np.zeros(256, dtype=bool)
    cut[searcher().resets] = True
    for auto in anchored():
        cut &= (auto.table.reshape(-1, 256) == auto.dead).all(axis=0)
    return cut


def _longest(auto: Automaton, data: bytes, at: int, seen: array) -> int:
    """End of the longest match that begins at ``at``, or -1.

    ``seen`` has the state of the last run after each byte. Runs begin ever further right and never before the end of a
    match, so a run that meets an earlier one in its state finds no more than that one did, and stops there.
    """
    state, end, table, accepts, dead = 0, -1, auto.table, auto.accepts, auto.dead
    for i in range(at, len(data)):
        state = int(table[(state << 8) + data[i]])
        if state == dead or state == seen[i]:
            break
        seen[i] = state
        if accepts[state]:
            end = i + 1
    return end


@lru_cache(maxsize=len(RULES))
def _first_bytes(kind: int) -> frozenset[int]:
    auto = anchored()[kind]
    return frozenset(np.flatnonzero(auto.table[:256] != auto.dead).tolist())


def _spans(data: bytes, kind: int) -> Iterator[tuple[int, int]]:
    """Leftmost, longest, non-overlapping matches of one rule; too short ones use up their text and are dropped."""
    _, _, _, _, least, value_only = RULES[kind]
    auto, first, at = anchored()[kind], _first_bytes(kind), 0
    seen = array("i", [-1]) * len(data)
    while at < len(data):
        end = _longest(auto, data, at, seen) if data[at] in first else -1
        if end < 0:
            at += 1
            continue
        begin = at
        if value_only:
            # The longest key part that still leaves a value: the whole match minus its run of value bytes.
            begin = _value_start(data, at, end)
        if end - begin >= least:
            yield at, end
        at = end


def _value_start(data: bytes, at: int, end: int) -> int:
    """Where the value of an assignment begins: after key, quote, blanks, sign, blanks, quote, as far as these go."""
    auto, state, found = anchored()[-1], 0, at
    for i in range(at, end - 1):
        state = auto.table[(state << 8) + data[i]]
        if state == auto.dead:
            break
        if auto.accepts[state]:
            found = i + 1
    return found


def find_secrets(column: pa.Array) -> list[list[tuple[int, int, int]]]:
    """For each text the spans ``(start, end, kind)`` in code points, ordered. Null and empty texts have none."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(column))]
    auto, reset = searcher(), cut_bytes()
    for first, _, data, bounds in text_chunks(column):
        if not len(data):
            continue
        cut = np.flatnonzero(reset[data]) + 1
        edges = np.unique(np.r_[bounds, cut])
        starts, ends = edges[:-1], edges[1:]
        bits = scan(auto, data, starts, ends)
        hits = np.flatnonzero(bits)
        rows = np.searchsorted(bounds, starts[hits], side="right") - 1
        for i, row in zip(hits.tolist(), rows.tolist(), strict=True):
            piece = data[starts[i] : ends[i]].tobytes()
            before = int(np.count_nonzero((data[bounds[row] : starts[i]] & 0xC0) != 0x80))
            # Only the byte at the end of a piece can be beyond ASCII, so bytes are code points inside.
            out[first + row] += [
                (before + a, before + b, kind)
                for kind in range(len(RULES)) if bits[i] >> kind & 1
                for a, b in _spans(piece, kind)
            ]
    for spans in out:
        spans.sort(key=lambda s: (s[0], s[2]))
    return out


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` and ``found``: the spans of every row as ``array<struct<start, end, kind>>``.

    ``end`` is exclusive, both count code points. Rows keep their number; repeated rows are scanned each, null
    and empty texts give an empty array, and other columns are not read.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for batch in batches:
            spans = find_secrets(batch["text"])
            rows = [[{"start": a, "end": b, "kind": KINDS[k]} for a, b, k in s] for s in spans]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(rows, kind)], ["doc_id", "found"])

    out = "doc_id long, found array<struct<start: long, end: long, kind: string>>"
    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(find, out)


def redact(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans go as one."""
    if not spans:
        return text
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact_secrets(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, with the secrets in ``text`` replaced and ``n_chars``, if there is such a column,
    counted again where a text has changed. Texts without secrets, null and empty ones stay as they are."""
    names = docs.columns

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch["text"]
            spans = find_secrets(column)
            if any(spans):
                texts = [redact(t.as_py(), s) for t, s in zip(column, spans, strict=True)]
                new = {"text": pa.array(texts, batch["text"].type)}
                if "n_chars" in names:
                    counts = batch["n_chars"].to_pylist()
                    counts = [len(t) if s else n for t, s, n in zip(texts, spans, counts, strict=True)]
                    new["n_chars"] = pa.array(counts, batch["n_chars"].type)
                batch = pa.RecordBatch.from_arrays([new[n] if n in new else batch[n] for n in names], names)
            yield batch

    return docs.mapInArrow(clean, docs.schema)


def spans_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secrets_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every row."""
    base = F.filter("found", lambda s: s["kind"].isin(KINDS[:BASE]))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS[:BASE]]
    return scan_secrets(docs).select(
        "doc_id", *counts, F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("found")).alias("spans")
    )
