"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.session import scratch_path

ROWS_PER_RANK_GROUP = 50_000
LEAST_CELLS = 16


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    Cuts the lineage, so that a lost executor costs a reread and no recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, *names: str) -> str:
    """A column name that neither ``df`` nor ``names`` has (Spark compares without case)."""
    taken = {c.lower() for c in df.columns} | {n.lower() for n in names}
    name = "_row"
    while name in taken:
        name += "_"
    return name


def gapless(df: DataFrame, groups: Sequence[str], order: Sequence[Column], spread: Column, out: str, rows: int) -> DataFrame:
    """Number the rows of each group from 0 without gaps, with no task that holds a whole group.

    ``spread`` (a hash of the row) cuts each group into cells of about ``ROWS_PER_RANK_GROUP`` rows; a window
    numbers the rows of a cell, and a running sum over the cells' counts gives each cell its first number.
    ``rows`` is the number of rows of ``df``, from which the number of cells follows.
    """
    cells = max(LEAST_CELLS, -(-rows // ROWS_PER_RANK_GROUP))
    cut = df.withColumn("_cell", F.pmod(spread, F.lit(cells)))
    counts = cut.groupBy(*groups, "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(*[F.col(g).alias(f"_of_{g}") for g in groups], F.col("_cell").alias("_of_cell"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(*groups, "_cell").orderBy(*order)
    numbered = cut.withColumn("_at", F.row_number().over(inside) - 1)
    same = [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in groups] + [F.col("_cell") == F.col("_of_cell")]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return numbered.join(firsts, on).select(*df.columns, (F.col("_first") + F.col("_at")).alias(out))


# --- words of UTF-8 texts as 64-bit hashes ------------------------------------------------

_RANDOM = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_BYTE[_BLANK] = 0
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _STEP
    return h ^ (h >> np.uint64(32))


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        base = np.full(size, _STEP, dtype=np.uint64)
        base[0] = 1
        _powers = np.cumprod(base, dtype=np.uint64)
    return _powers


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all blank-separated words (A-Z lower-cased) of the texts ``data[bounds[i]:bounds[i + 1]]``, and
    for each text the place of its first word (one entry more than texts)."""
    word = ~_BLANK[data]
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    begin[heads] = word[heads]
    starts = np.flatnonzero(begin)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(bounds), dtype=np.int64)
    place = np.arange(len(data)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(data)]))
    place[~word] = 0
    values = _BYTE[data] * _powers_to(int(place.max()) + 1)[place]
    return mixed(np.add.reduceat(values, starts)), np.searchsorted(starts, bounds)


def shingle_sets(words: np.ndarray, firsts: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``size``-word shingles; a text with fewer words has its
    whole sequence as one, a text without words none."""
    rolled = np.zeros(0, dtype=np.uint64)
    if len(words) >= size:
        n = len(words) - size + 1
        rolled = words[:n].copy()
        for k in range(1, size):
            rolled = mixed(rolled + _STEP) + words[k : k + n]
        rolled = mixed(rolled)
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        if b - a >= size:
            yield np.unique(rolled[a : b - size + 1])
        elif b > a:
            h = words[a : a + 1] + np.uint64(b - a)
            for k in range(a + 1, b):
                h = mixed(h + _STEP) + words[k]
            yield mixed(h)
        else:
            yield np.zeros(0, dtype=np.uint64)


def text_chunks(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut an Arrow string column into runs of rows with about ``most`` bytes (one longer text is a run of its
    own): ``(first row, end row, bytes, bounds)``. Null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + most, side="right")) - 1)
        yield a, b, data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
        a = b
