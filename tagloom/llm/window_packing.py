"""Packing of token windows by non-negative least squares.

A document's tokens are cut into full windows and one remainder. The remainders' lengths make a histogram of fewer counts than a
window has places. Shallow combinations (two or three lengths that fill a window exactly) get repeat counts from a non-negative
least squares fit to that histogram; the counts are rounded to whole ones that the histogram still has. What is left is packed
greedily, best fit first, into windows that may stay open. All windows are then laid end to end, the open ones without their
gaps, and cut at every ``size`` tokens, so a remainder is cut only where an open window has to be filled up. The last
tokens, less than a window, go into sequences of falling powers of two, which need no padding.

The plan is made from the histogram alone. Its rows say where the pieces of one length lie: the ``t``-th of a run at
``base + t * stride``. Its size does not depend on the number of documents.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import gapless, stored
from tagloom.llm.tokens import Encoder, default_vocabulary

SIZE = 1024
END_ID = 0
MOST_COMBINATIONS = 20_000
Combination = tuple[int, ...]

_PIECES = "key long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
_OUT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
_MOST_ROWS = 4096


def token_windows(docs: DataFrame, size: int = SIZE, vocabulary: str | None = None) -> DataFrame:
    """``key, doc_id, start, length, ids_crc32, doc_tokens, ids``: full windows, and the remainder of each row with its ids.

    A document is its ids and one end id; null and empty texts are the end id alone. ``key`` differs for all pieces.
    """
    path = vocabulary or default_vocabulary()
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, key = Encoder(path), TaskContext.get().partitionId() << 40
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = encoder.ids(text.as_py()) + end
                n = len(ids) // 4
                for a in range(0, n, size):
                    part = ids[4 * a : 4 * (a + size)]
                    m = len(part) // 4
                    rows.append((key, doc_id, a, m, zlib.crc32(part), n, narrow(part) if m < size else None))
                    key += 1
                    if len(rows) >= _MOST_ROWS:
                        yield _batch(rows)
                        rows = []
            if rows:
                yield _batch(rows)

    return docs.select("doc_id", "text").mapInArrow(cut, _PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.binary()]
    arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["key", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])


def narrow(ids: bytes) -> bytes:
    """32-bit ids in 16 bits each where they fit."""
    wide = np.frombuffer(ids, "<u4")
    return wide.astype("<u2").tobytes() if not len(wide) or int(wide.max()) < 1 << 16 else ids


def wide(ids: bytes, length: int) -> bytes:
    """The 32-bit ids of ``length`` ids that ``narrow`` may have shortened."""
    return np.frombuffer(ids, "<u2").astype("<u4").tobytes() if len(ids) == 2 * length else ids


# --- the plan ------------------------------------------------------------------------------


def combinations(counts: np.ndarray, most: int = MOST_COMBINATIONS) -> list[Combination]:
    """Two and three lengths with counts that fill a window exactly, in falling order: all pairs, and of the triples at
    most about ``most``, spread evenly over the largest length and the split of the rest."""
    size = len(counts)  # lengths 1 .. size - 1
    there = np.flatnonzero(counts[1:]) + 1
    pairs = [(size - a, a) for a in there.tolist() if 2 * a <= size and counts[size - a]]
    triples = []
    for a in there[::-1].tolist():
        rest = size - a
        small = there[(2 * there <= rest) & (rest - there <= a)]
        small = small[counts[rest - small] > 0]
        triples.append(np.c_[np.full(len(small), a), rest - small, small])
    rows = np.concatenate(triples) if triples else np.zeros((0, 3), int)
    if len(rows) > most:
        rows = rows[np.linspace(0, len(rows) - 1, most).astype(int)]
    return pairs + [tuple(r) for r in rows.tolist()]


def least_squares(counts: np.ndarray, made: list[Combination], steps: int = 400) -> np.ndarray:
    """Repeats ``x >= 0`` that bring ``A x`` near ``counts``: projected gradient steps, scaled for each combination by the
    sum of its row sums (a bound of the curvature, so no step goes up), with momentum that restarts when the error rises."""
    if not made:
        return np.zeros(0)
    at = np.repeat(np.arange(len(made)), [len(c) for c in made])
    lengths = np.concatenate([np.array(c) for c in made])
    rows = np.bincount(lengths, minlength=len(counts))
    scale = np.bincount(at, weights=rows[lengths], minlength=len(made))
    x = y = np.zeros(len(made))
    momentum, last = 1.0, np.inf
    for _ in range(steps):
        over = np.bincount(lengths, weights=y[at], minlength=len(counts)) - counts
        over[0] = 0
        error = float(over @ over)
        if error > last:
            y, momentum, last = x, 1.0, np.inf
            continue
        last = error
        new = np.maximum(y - np.bincount(at, weights=over[lengths], minlength=len(made)) / scale, 0)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = np.maximum(new + (momentum - 1) / following * (new - x), 0)
        x, momentum = new, following
    return x


def windows(counts: np.ndarray) -> list[tuple[Combination, int]]:
    """``(lengths, repeats)`` that use every remainder of ``counts[length]`` once; full windows come first, then the fullest."""
    size, left = len(counts), counts.astype(np.int64).copy()
    left[0] = 0
    made = combinations(left)
    repeats = least_squares(left, made)
    plan: list[tuple[Combination, int]] = []
    for k in np.argsort(-repeats, kind="stable").tolist():
        need = defaultdict(int)
        for n in made[k]:
            need[n] += 1
        times = min(int(repeats[k] + 0.5), *(int(left[n]) // m for n, m in need.items()))
        if times > 0:
            plan.append((made[k], times))
            for n, m in need.items():
                left[n] -= m * times
    # The rest, longest first, each into the open window with the least room that takes it. ``room[r]`` has the windows with ``r`` free places.
    room: dict[int, list[tuple[Combination, int]]] = defaultdict(list)
    for n in range(size - 1, 0, -1):
        todo = int(left[n])
        while todo:
            best = min((r for r, open_ in room.items() if r >= n and open_), default=0)
            if not best:
                each = size // n
                for lengths, times in (((n,) * each, todo // each), ((n,) * (todo % each), 1)):
                    if lengths and times:
                        room[size - n * len(lengths)].append((lengths, times))
                break
            lengths, times = room[best].pop()
            taken = min(times, todo)
            if taken < times:
                room[best].append((lengths, times - taken))
            room[best - n].append(((*lengths, n), taken))
            todo -= taken
    return plan + [w for r in sorted(room) for w in room[r]]


def layout(plan: list[tuple[Combination, int]]) -> tuple[dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], int]:
    """For each length the first number, the base and the stride of its runs on the line of all windows; and the line's length."""
    used: dict[int, int] = defaultdict(int)
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    line = 0
    for lengths, times in plan:
        stride, base = sum(lengths), line
        for n in lengths:
            runs[n].append((used[n], base, stride))
            used[n] += times
            base += n
        line += stride * times
    return {n: tuple(np.array(c) for c in zip(*r, strict=True)) for n, r in runs.items()}, line


def cuts(line: int, size: int = SIZE) -> list[int]:
    """The ends of the last sequences, those after the last full window: falling powers of two."""
    at, rest, out = line - line % size, line % size, []
    while rest:
        step = 1 << (rest.bit_length() - 1)
        at, rest = at + step, rest - step
        out.append(at)
    return out


# --- the pieces ----------------------------------------------------------------------------


def pack_windows(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of the written pieces of ``token_windows``.

    Every id lies in one piece. Sequences hold ``size`` tokens, but for at most log2(size) ones at the end, which
    hold powers of two. An empty table stays empty; remainders of one length are exchangeable, ties only decide which comes where.
    """
    full = pieces.where(F.col("length") == size)
    full = full.withColumn("sequence_id", -1 - F.col("key")).withColumn("offset", F.lit(0).cast("long")).select(*_OUT)
    rest = pieces.where(F.col("length") < size).drop("ids")
    counts = np.zeros(size, dtype=np.int64)
    for r in rest.groupBy("length").agg(F.count("*").alias("n")).collect():  # fewer rows than a window has places
        counts[r["length"]] = r.n
    runs, line = layout(windows(counts))
    sent = pieces.sparkSession.sparkContext.broadcast(runs)
    numbered = gapless(rest, ["length"], [F.col("key")], F.xxhash64("key"), "_number", int(counts.sum()))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length, number = frame["length"].to_numpy(), frame.pop("_number").to_numpy()
            line_at = np.empty(len(frame), np.int64)
            for n in np.unique(length).tolist():
                mine = length == n
                firsts, bases, strides = sent.value[n]
                run = np.searchsorted(firsts, number[mine], side="right") - 1
                line_at[mine] = bases[run] + (number[mine] - firsts[run]) * strides[run]
            yield frame.assign(line_at=line_at)

    kinds = "key long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    numbered = numbered.select("key", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "_number")
    placed = stored(numbered.mapInPandas(place, f"{kinds}, line_at long"), "placed-windows")
    last, ends = line - line % size, cuts(line, size)
    window = F.expr(f"line_at div {size}")
    whole = (window == F.expr(f"(line_at + length - 1) div {size}")) & (F.col("line_at") < last)
    kept = placed.where(whole).withColumn("sequence_id", window).withColumn("offset", F.col("line_at") % size).select(*_OUT)
    apart = stored(placed.where(~whole).select("key", "line_at"), "cut-windows")
    with_ids = pieces.where(F.col("length") < size).select("key", "doc_id", "start", "length", "doc_tokens", "ids")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * len(_OUT)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                ids, a, end = wide(r["ids"], r["length"]), r["line_at"], r["line_at"] + r["length"]
                at = a
                while at < end:
                    if at < last:
                        sequence, first, stop = at // size, at - at % size, at - at % size + size
                    else:
                        k = int(np.searchsorted(ends, at, side="right"))
                        sequence, first, stop = last // size + k, ends[k - 1] if k else last, ends[k]
                    stop = min(stop, end)
                    part = ids[4 * (at - a) : 4 * (stop - a)]
                    rows.append((r["doc_id"], r["start"] + at - a, stop - at, zlib.crc32(part), r["doc_tokens"], sequence, at - first))
                    at = stop
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(arrays, _OUT)

    parts = with_ids.join(apart, "key").select("doc_id", "start", "length", "doc_tokens", "ids", "line_at")
    return full.union(kept).union(parts.mapInArrow(split, ", ".join(f"`{c}` long" for c in _OUT)))


def pack_documents(docs: DataFrame, size: int = SIZE, vocabulary: str | None = None) -> DataFrame:
    """Tokens of all rows of ``docs`` (``doc_id, text``), cut and packed: one row per piece.

    Repeated rows give repeated pieces, a null ``doc_id`` stays null, other columns are ignored; a text of any length is cut
    into windows.
    """
    return pack_windows(stored(token_windows(docs, size, vocabulary), "token-windows"), size)
