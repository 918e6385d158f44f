"""skip-gram word vectors from counted pairs.

The skip-gram loss with hierarchical softmax depends on the texts only by how often a word stands near another one. One pass counts
these pairs, whose number the vocabulary bounds, and each training step then reads the counted pairs: its cost does not grow with the
texts, and every pair counts in every step with its whole number. A step adds up the exact gradient over blocks of words.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import materialise

STEPS = 5  # gradient steps of an epoch
RATE = 0.1  # length of the first step, falls to 0
BLOCKS = 16  # blocks of words: a step works on them side by side
PAIRS_AT_ONCE = 4_000_000  # pairs that a task holds before it counts them
DENSE_NUMBERS = 4_000_000  # scores of words against tree nodes that a task holds at once

_PAIRS = "a int, b int, n long"
_BLOCK = "block int, words binary, ends binary, contexts binary, counts binary"
_SLOPES = "block int, words binary, by_word binary, by_node binary, loss double, pairs double"


@dataclass
class WordVectors:
    """``words`` by falling count, their ``vectors`` (rows), and the mean loss of a pair before each step and after the last one."""

    words: list[str]
    vectors: np.ndarray
    losses: list[float]


def count_pairs(sequences: DataFrame, col: str, size: int, window: int) -> DataFrame:
    """``(a, b, n)`` for lists of ids below ``size``: how often a stands before b at most ``window`` apart, times ``window``: a pair d apart
    counts ``window + 1 - d``, as often as a window of random width up to ``window`` holds it. Rows with b = ``size`` count the uses of a."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [[] for _ in range(window + 1)], 0
        for batch in batches:
            lists = batch["_ids"]
            ids = np.asarray(lists.flatten()).astype(np.int64)
            row = np.repeat(np.arange(len(lists)), np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
            for a in range(0, max(len(ids), 1), PAIRS_AT_ONCE):
                mine = ids[a : a + PAIRS_AT_ONCE]
                held[0].append(mine * (size + 1) + size)
                for d in range(1, window + 1):
                    left, right = slice(a, a + len(mine)), slice(a + d, a + len(mine) + d)
                    other = ids[right]
                    same = row[left][: len(other)] == row[right]
                    held[d].append((mine[: len(other)] * (size + 1) + other)[same])
                many += len(mine) * (window + 1)
                if many >= PAIRS_AT_ONCE:
                    yield counted(held)
                    held, many = [[] for _ in range(window + 1)], 0
        if many:
            yield counted(held)

    def counted(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        codes, numbers = [], []
        for d, parts in enumerate(held):
            code, number = np.unique(np.concatenate(parts), return_counts=True)
            codes.append(code)
            numbers.append(number * (1 if d == 0 else window + 1 - d))
        code, number = np.concatenate(codes), np.concatenate(numbers)
        columns = [pa.array((code // (size + 1)).astype(np.int32)), pa.array((code % (size + 1)).astype(np.int32)), pa.array(number.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "n"])

    rows = sequences.select(F.col(col).alias("_ids")).mapInArrow(count, _PAIRS)
    return rows.groupBy("a", "b").agg(F.sum("n").alias("n"))


def pair_blocks(pairs: DataFrame, size: int, window: int, blocks: int = BLOCKS) -> DataFrame:
    """The counted pairs, both ways round, as a written table of ``blocks`` blocks of words with their contexts."""
    pairs = pairs.where(F.col("b") < size)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    # A word has at most 2 * size entries, so a group is bounded by the vocabulary.
    lists = both.groupBy("a").agg(F.collect_list(F.struct("b", "n")).alias("_l"))
    lists = lists.select("a", F.col("_l.b").alias("b"), F.col("_l.n").alias("n"), F.pmod("a", F.lit(blocks)).alias("block"))

    def cut(table: pa.Table) -> pa.Table:
        table = table.sort_by("a").combine_chunks()
        b, n = (table[c].combine_chunks() for c in ("b", "n"))
        ends = np.cumsum(np.asarray(pc.list_value_length(b)))
        parts = [np.asarray(table["a"]).astype(np.int64), ends.astype(np.int64), np.asarray(b.flatten()).astype(np.int64), np.asarray(n.flatten()) / window]
        return pa.table([pa.array([table["block"][0].as_py()], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]], names=[c.split()[0] for c in _BLOCK.split(", ")])

    return materialise(lists.groupBy("block").applyInArrow(cut, _BLOCK).repartition(blocks, "block"))


def huffman(counts: np.ndarray) -> np.ndarray:
    """``(left, right)`` of each inner node of the Huffman tree over words with these counts, children before parents; a child below the
    number of words is a word, node k has the number words + k."""
    heap = [(int(c), k) for k, c in enumerate(counts)]
    heapq.heapify(heap)
    nodes = []
    while len(heap) > 1:
        (c, left), (d, right) = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (c + d, len(counts) + len(nodes)))
        nodes.append((left, right))
    return np.array(nodes, dtype=np.int64).reshape(-1, 2)


def gradient(words, ends, contexts, counts, tree, vectors, nodes) -> tuple[np.ndarray, np.ndarray, float]:
    """Slopes of the loss by the vectors of ``words`` and by all tree nodes, and the loss, summed over the pairs of these words."""
    size, inner = len(vectors), len(tree)
    starts = np.r_[0, ends[:-1]]
    by_word, by_node, loss = np.zeros((len(words), vectors.shape[1]), np.float32), np.zeros_like(nodes), 0.0
    step = max(1, DENSE_NUMBERS // max(2 * size, 1))
    for a in range(0, len(words), step):
        mine = words[a : a + step]
        span = slice(starts[a], ends[min(a + step, len(words)) - 1])
        row = np.repeat(np.arange(len(mine)), (ends - starts)[a : a + step])
        # How often the path to a context of a word (column) goes through a tree node (row).
        met = np.zeros((size + inner, len(mine)), np.float32)
        met[:size] = np.bincount(contexts[span] * len(mine) + row, counts[span], size * len(mine)).reshape(size, -1)
        for k, (left, right) in enumerate(tree.tolist()):
            np.add(met[left], met[right], out=met[size + k])
        score = nodes @ vectors[mine].T
        went, passed = met[tree[:, 0]], met[size:]
        small = np.exp(-np.abs(score))
        loss += float((passed * (np.maximum(score, 0) + np.log(1 + small)) - went * score).sum(dtype=np.float64))
        slope = passed * np.where(score >= 0, 1, small) / (1 + small) - went
        by_word[a : a + step] = slope.T @ nodes
        by_node += slope @ vectors[mine]
    return by_word, by_node, loss


def train(blocks: DataFrame, counts: np.ndarray, dim: int, steps: int, seed: int) -> tuple[np.ndarray, list[float]]:
    """Vectors of the words and the mean losses. ``steps`` steps by the exact gradient, each number scaled by its own past slopes (Adam);
    what travels in a step are the vectors and, from each block, its slopes."""
    size, context = len(counts), blocks.sparkSession.sparkContext
    vectors = ((np.random.default_rng(seed).random((size, dim)) - 0.5) / dim).astype(np.float32)
    if size < 2:
        return vectors, []
    tree = huffman(counts)
    nodes = np.zeros((len(tree), dim), np.float32)
    shared_tree = context.broadcast(tree)
    state = [np.zeros((2, *x.shape), np.float32) for x in (vectors, nodes)]
    losses = []

    def slopes() -> tuple[np.ndarray, np.ndarray, float]:
        sent = context.broadcast((vectors, nodes))

        def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    ints = [np.frombuffer(row[c], np.int64) for c in ("words", "ends", "contexts")]
                    by_word, by_node, loss = gradient(*ints, np.frombuffer(row["counts"]), shared_tree.value, *sent.value)
                    values = [[row["block"]], [row["words"]], [by_word.tobytes()], [by_node.tobytes()], [loss], [np.frombuffer(row["counts"]).sum()]]
                    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=[c.split()[0] for c in _SLOPES.split(", ")])

        rows = blocks.mapInArrow(one, _SLOPES).toArrow().to_pylist()
        sent.destroy()
        by_word, by_node = np.zeros_like(vectors), np.zeros_like(nodes)
        for r in sorted(rows, key=lambda r: r["block"]):  # in one order, so a fit can be repeated
            by_word[np.frombuffer(r["words"], np.int64)] = np.frombuffer(r["by_word"], np.float32).reshape(-1, dim)
            by_node += np.frombuffer(r["by_node"], np.float32).reshape(-1, dim)
        return by_word, by_node, sum(r["loss"] for r in rows) / max(sum(r["pairs"] for r in rows), 1)

    for k in range(steps):
        *found, loss = slopes()
        losses.append(loss)
        rate = RATE * (1 - k / steps)
        for x, g, (first, second) in zip((vectors, nodes), found, state, strict=True):
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            x -= rate * (first / (1 - 0.9 ** (k + 1))) / (np.sqrt(second / (1 - 0.99 ** (k + 1))) + 1e-8)
    losses.append(slopes()[2])
    return vectors, losses
