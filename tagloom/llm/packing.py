"""Best-fit packing by patterns: few-document length patterns, repeat counts by non-negative least squares.

The lengths of all pieces make a histogram of at most ``size`` counts. Patterns (one to three lengths that fill a
sequence) get repeat counts from a non-negative least squares fit to that histogram, rounded down to what is there;
the rest is packed best-fit decreasing. All of this works on counts: the plan is a table of
(pattern, repeats), and its size depends on the number of different lengths, not on the number of documents.
The pieces then find their places by their number among the pieces of the same length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import gapless, stored
from tagloom.llm.tokens import Encoder, default_vocabulary

SIZE = 2048
END_ID = 0
Pattern = tuple[int, ...]


def token_pieces(docs: DataFrame, size: int = SIZE, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids`` if asked for) of every row.

    A document is its ids and one end id. Only one longer than ``size`` is cut: the first piece takes what is over,
    all others are full. Null and empty texts are the end id alone; repeated rows give repeated pieces.
    """
    path = vocabulary or default_vocabulary()
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = encoder.ids(text.as_py()) + end
                n = len(ids) // 4
                first = n % size or min(n, size)
                starts = [0, *range(first, n, size)]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                    part = ids[4 * a : 4 * b]
                    rows.append((doc_id, k, a, b - a, zlib.crc32(part), *([np.frombuffer(part, "<u4")] if with_ids else [])))
            columns = list(zip(*rows, strict=True)) or [[]] * (6 if with_ids else 5)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    out = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(cut, out)


def candidate_patterns(counts: np.ndarray, thirds: int = 12) -> list[Pattern]:
    """Patterns of one to three lengths that fill a sequence exactly, from the lengths that occur."""
    size = len(counts) - 1
    there = np.flatnonzero(counts)
    patterns: list[Pattern] = [(size,)] if counts[size] else []
    patterns += [(size - a, a) for a in there.tolist() if 2 * a <= size and counts[size - a]]
    for a in there[::-1].tolist():
        rest = size - a
        small = there[(there <= rest // 2) & (there >= 1)]
        small = small[(counts[rest - small] > 0) & (rest - small <= a)]
        if len(small):
            pick = small[np.unique(np.linspace(0, len(small) - 1, thirds).astype(int))]
            patterns += [(a, rest - b, b) for b in pick.tolist()]
    return patterns


def fit_repeats(counts: np.ndarray, patterns: list[Pattern], steps: int = 300) -> np.ndarray:
    """Non-negative least squares by multiplicative steps: repeats ``x`` with ``A x`` near ``counts``."""
    if not patterns:
        return np.zeros(0)
    at = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    lengths = np.concatenate([np.array(p) for p in patterns])
    x = np.ones(len(patterns))
    top = np.bincount(at, weights=counts[lengths], minlength=len(patterns))
    for _ in range(steps):
        made = np.bincount(lengths, weights=x[at], minlength=len(counts))
        x *= top / np.maximum(np.bincount(at, weights=made[lengths], minlength=len(patterns)), 1e-12)
    return x


def pack_histogram(counts: np.ndarray) -> list[tuple[Pattern, int]]:
    """``(pattern, repeats)`` that use every piece of the histogram ``counts[length]`` exactly once."""
    size, left = len(counts) - 1, counts.astype(np.int64).copy()
    plan: list[tuple[Pattern, int]] = []
    patterns = candidate_patterns(left)
    repeats = fit_repeats(left, patterns)
    for k in np.argsort(-repeats, kind="stable").tolist():
        need = defaultdict(int)
        for n in patterns[k]:
            need[n] += 1
        times = min(int(repeats[k] + 0.5), *(int(left[n]) // m for n, m in need.items()))
        if times > 0:
            plan.append((patterns[k], times))
            for n, m in need.items():
                left[n] -= m * times
    # The rest, best-fit decreasing: ``room[r]`` are the open sequences with r places left.
    room: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)
    for n in range(size, 0, -1):
        todo = int(left[n])
        while todo:
            fit = min((r for r, open_ in room.items() if r >= n and open_), default=None)
            if fit is None:
                many = size // n
                times, over = divmod(todo, many)
                for pattern, t in (((n,) * many, times), ((n,) * over, 1)):
                    if pattern and t:
                        room[size - n * len(pattern)].append((pattern, t))
                break
            pattern, times = room[fit].pop()
            take = min(times, todo)
            if take < times:
                room[fit].append((pattern, times - take))
            room[fit - n].append(((*pattern, n), take))
            todo -= take
    return plan + [x for open_ in room.values() for x in open_]


def places(plan: list[tuple[Pattern, int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length the first number of each run of pieces, the run's first sequence and its offset there."""
    used: dict[int, int] = defaultdict(int)
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for pattern, times in plan:
        offset = 0
        for n in pattern:
            runs[n].append((used[n], sequence, offset))
            used[n] += times
            offset += n
        sequence += times
    return {n: tuple(np.array(c) for c in zip(*r, strict=True)) for n, r in runs.items()}


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; no sequence is longer than ``size``.

    Needs ``doc_id``, ``piece`` and ``length`` (1 to ``size``). An empty table stays empty; pieces of one length are
    exchangeable, so ties only decide which of them comes where.
    """
    rows = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most ``size`` rows
    counts = np.zeros(size + 1, dtype=np.int64)
    for r in rows:
        counts[r["length"]] = r.n
    names = pieces.columns
    hashed = F.xxhash64("doc_id", "piece")
    order = [F.col("doc_id"), F.col("piece")]
    numbered = gapless(pieces, ["length"], order, hashed, "_number", int(counts.sum()))
    # The plan follows from at most ``size`` counts, so its size does not grow with the documents.
    sent = pieces.sparkSession.sparkContext.broadcast(places(pack_histogram(counts)))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length, number = frame["length"].to_numpy(), frame.pop("_number").to_numpy()
            sequence, offset = np.empty(len(frame), np.int64), np.empty(len(frame), np.int64)
            for n in np.unique(length).tolist():
                mine = length == n
                firsts, sequences, offsets = sent.value[n]
                run = np.searchsorted(firsts, number[mine], side="right") - 1
                sequence[mine] = sequences[run] + number[mine] - firsts[run]
                offset[mine] = offsets[run]
            yield frame.assign(sequence_id=sequence, offset=offset)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return numbered.select(*names, "_number").mapInPandas(place, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, size: int = SIZE, vocabulary: str | None = None) -> DataFrame:
    """Tokens of all ``docs``, cut and packed: one row per piece."""
    return pack(stored(token_pieces(docs, size, vocabulary), "pieces"), size)
