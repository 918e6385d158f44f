"""N-gram Jaccard join by signature trees.

Two texts link when their sets of 5-word shingles have a Jaccard similarity of 0.8 or more. The steps:

1. *Sketches.* One map over the texts gives each text its set size, a digest of the set, a bitmap of its shingles (four bits per
   shingle) and the shingles of its prefix: in a fixed order of all shingles, linked sets x and y share k of their first
   ``n - ceil(0.8 n) + k``, for every k. Shingles that are frequent in a bounded sample come last in that order, so
   passages shared by many texts rarely matter. The sample only sets the order; the result does not depend on it.
2. *Blocks.* With k a tenth of the set, a text whose prefix has too few shingles that occur in any other prefix is linked with
   nothing (``least_shared``). The texts that are left form a block for each shingle that two of their first
   ``n - ceil(0.8 n) + 1`` have in common; equal blocks are kept once. A block beyond ``BLOCK`` members is dealt into pairs
   of sub-blocks.
3. *Trees.* In each block the members, ordered by size, become the leaves of a tree whose nodes hold OR-combined bitmaps
   and size ranges. A dual traversal drops node pairs whose sizes or whose greatest possible overlap rule out a link.
   Of what passes, pairs that look linked are kept as a forest (enough for the components), doubtful ones all.
4. *Exact check* of these pairs on the texts' sets. Blocks in which a pair of the forest fails, and large blocks with several
   components, are traversed again, this time keeping every pair between different components.
5. *Components* of the verified links over classes of equal sets.

Nothing is capped: every pair that can link is either verified or inside one component already.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import mixed, shingle_sets, stored, text_chunks, word_hashes
from tagloom.llm.components import components
from tagloom.llm.decontaminate import bounded

SHINGLE = 5
SAMPLE = 6_000
FREQUENT_SHARE = 0.0005
FREQUENT_MOST = 1 << 17
BITS_PER_SHINGLE = 4
LEAF = 16
FANOUT = 8
BLOCK = 1_500
ANCHORS = 32
SALTS = 16
CHUNK = 64
LIST = 1_000
LEAST_LINKABLE = 4  # a smaller set only links with an equal one
EXTRA = 10  # the counted prefix is longer by one EXTRA-th of the set


def sets_of(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The shingle set of every text of the column, in order."""
    for _, _, data, bounds in text_chunks(column):
        yield from shingle_sets(*word_hashes(data, bounds), size)


def linked(common: int, n: int, m: int) -> bool:
    return 100 * common >= 80 * (n + m - common)


# --- sketches -----------------------------------------------------------------------------


def frequent_shingles(docs: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Shingles in many of about ``sample`` documents, rarest first; at most ``FREQUENT_MOST``."""
    rows = max(docs.count(), 1)
    picked = docs.select("text").where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(rows)) < min(sample, rows))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([s.tobytes() for s in sets_of(batch["text"])], pa.binary())], ["s"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.frombuffer(s, np.uint64) for b in batches for s in b["s"].to_pylist()]
        if found:
            value, n = np.unique(np.concatenate(found), return_counts=True)
            many = n >= max(3, FREQUENT_SHARE * len(found))
            value, n = value[many], n[many]
            value = value[np.lexsort((value, n))][-FREQUENT_MOST:]
            yield pa.RecordBatch.from_arrays([pa.array([value.tobytes()], pa.binary())], ["s"])

    # A bounded sample: one task counts it.
    rows = picked.mapInArrow(sets, "s binary").repartition(1).mapInArrow(count, "s binary").collect()
    return np.frombuffer(rows[0].s, np.uint64) if rows else np.zeros(0, np.uint64)


def bitmap(shingles: np.ndarray) -> bytes:
    bits = max(64, 1 << int(BITS_PER_SHINGLE * len(shingles) - 1).bit_length())
    marks = np.zeros(bits, dtype=bool)
    marks[(shingles & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(marks, bitorder="little").tobytes()


def prefix_length(n: int) -> int:
    """Linked sets share one of so many first shingles."""
    return n - -(-4 * n // 5) + 1


def least_shared(n: int) -> int:
    """How many shingles of the counted prefix a linked text must share with its partner, which has at least
    ``ceil(0.8 n)`` shingles and therefore a k of at least a tenth of that."""
    smallest = -(-4 * n // 5)
    return -(-smallest // EXTRA)


def prefix(shingles: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The counted prefix, its rare and its frequent part. ``frequent`` is sorted, ``rank`` its order of frequency."""
    n = len(shingles)
    most = prefix_length(n) - 1 + -(-n // EXTRA)
    if not len(frequent):
        return shingles[:most], shingles[:0]
    at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
    often = frequent[at] == shingles
    rare = shingles[~often][:most]
    rest = shingles[often]
    return rare, rest[np.argsort(rank[at[often]], kind="stable")][: most - len(rare)]


def sketches(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``doc_id, n, d1, d2`` of every row, and ``bits, rare, often`` of the first row with its set in each batch."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)  # at most FREQUENT_MOST numbers

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(sent.value, kind="stable")
        common = sent.value[order]
        for batch in batches:
            seen: set[bytes] = set()
            rows: list[tuple] = []
            for doc_id, s in zip(batch["doc_id"].to_pylist(), sets_of(batch["text"]), strict=True):
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                d1, d2 = np.frombuffer(digest, np.int64).tolist()
                if doc_id is None or len(s) < LEAST_LINKABLE or digest in seen:
                    rows.append((doc_id, len(s), d1, d2, None, None, None))
                else:
                    seen.add(digest)
                    rare, often = prefix(s, common, order)
                    rows.append((doc_id, len(s), d1, d2, bitmap(s), rare.view(np.int64), often.view(np.int64)))
            kinds = [pa.int64()] * 4 + [pa.binary()] + [pa.list_(pa.int64())] * 2
            columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else []
            if columns:
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "d1", "d2", "bits", "rare", "often"])

    out = "doc_id long, n long, d1 long, d2 long, bits binary, rare array<long>, often array<long>"
    return docs.select("doc_id", "text").mapInArrow(sketch, out)


# --- blocks -------------------------------------------------------------------------------


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows ordered by shingle: the ids of each shingle with two or more, in parts of ``LIST``, named by a digest
    of the ids."""
    seen: set[int] = set()

    def blocks(token: np.ndarray, ids: np.ndarray) -> pa.RecordBatch | None:
        starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        size = np.diff(np.r_[starts, len(token)])
        name = mixed(np.add.reduceat(mixed(ids.view(np.uint64) + np.uint64(77)), starts) + size.astype(np.uint64))
        first = np.zeros(len(starts), dtype=bool)
        first[np.unique(name, return_index=True)[1]] = True
        keep = first & (size > 1) & np.array([x not in seen for x in name.tolist()])
        if len(seen) > 1_000_000:
            seen.clear()
        seen.update(name[keep].tolist())
        rows = [
            (int(name[k]), part, ids[a : min(a + LIST, starts[k] + size[k])])
            for k in np.flatnonzero(keep).tolist()
            for part, a in enumerate(range(starts[k], starts[k] + size[k], LIST))
        ]
        if not rows:
            return None
        block, part, members = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(block, np.uint64).view(np.int64)), pa.array(part, pa.int32()), pa.array(members, pa.list_(pa.int64()))],
            ["block", "part", "ids"],
        )

    token, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        token = np.r_[token, batch["token"].to_numpy(zero_copy_only=False)]
        ids = np.r_[ids, batch["doc_id"].to_numpy(zero_copy_only=False)]
        end = np.searchsorted(token, token[-1]) if len(token) else 0  # the last run may go on
        if end:
            made = blocks(token[:end], ids[:end])
            token, ids = token[end:], ids[end:]
            if made is not None:
                yield made
    if len(token):
        made = blocks(token, ids)
        if made is not None:
            yield made


def _shared_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows ordered by shingle: how many of each id's shingles occur with another id (in parts).

    Of a shingle that goes on in the next batch only its first id, as long as it is alone, is carried.
    """
    last, alone = None, None
    for batch in batches:
        token, ids = (batch[c].to_numpy(zero_copy_only=False) for c in ("token", "doc_id"))
        if not len(token):
            continue
        starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        size = np.diff(np.r_[starts, len(token)])
        shared = np.repeat(size > 1, size)
        found = []
        if last is not None and token[0] == last:
            shared[: size[0]] = True
            if alone is not None:
                found.append(alone)
        elif len(starts) == 1:
            last = None
        first_goes_on = last is not None and token[0] == last and len(starts) == 1
        last = token[-1]
        alone = None if size[-1] > 1 or first_goes_on else ids[-1]
        value, n = np.unique(np.r_[ids[shared], np.array(found, dtype=ids.dtype)], return_counts=True)
        if len(value):
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(n)], ["doc_id", "c"])


def possible(sketched: DataFrame) -> DataFrame:
    """The sketches of texts whose prefixes share enough with others."""
    # 48 bits tell shingles apart here: two that meet by chance only count as shared.
    rare = sketched.where(F.size("rare") > 0).select("doc_id", F.explode("rare").alias("token"))
    rare = rare.withColumn("token", F.col("token").bitwiseAND(F.lit((1 << 48) - 1)))
    rare = rare.repartition("token").sortWithinPartitions("token")
    counts = rare.mapInArrow(_shared_counts, "doc_id long, c long").groupBy("doc_id").agg(F.sum("c").alias("_c"))
    # A frequent shingle counts as shared. An id with several texts has the sum of their counts.
    narrow = sketched.where(F.col("bits").isNotNull()).select("doc_id", "n", F.size("often").alias("_o"))
    least = F.ceil(F.ceil(F.col("n") * 4 / 5) / EXTRA)
    enough = narrow.join(counts, "doc_id", "left").where(F.coalesce("_c", F.lit(0)) + F.col("_o") >= least)
    enough = stored(enough.select("doc_id").distinct(), "enough")
    return sketched.where(F.col("bits").isNotNull()).join(bounded(enough), "doc_id")


def block_members(candidates: DataFrame) -> DataFrame:
    """``block, doc_id, m`` (members of the block)."""
    base = (F.col("n") - F.ceil(F.col("n") * 4 / 5) + 1).cast("int")
    rare = candidates.select("doc_id", F.explode(F.slice("rare", 1, F.greatest(base, F.lit(0)))).alias("token"))
    lists = rare.repartition("token").sortWithinPartitions("token", "doc_id")
    lists = lists.mapInArrow(_runs, "block long, part int, ids array<long>").dropDuplicates(["block", "part"])
    runs = lists.select("block", F.explode("ids").alias("doc_id"))
    # Frequent shingles never meet in one task: each is a block by itself and is dealt out below.
    left = F.greatest(base - F.size("rare"), F.lit(0))
    often = candidates.select(F.explode(F.slice("often", 1, left)).alias("block"), "doc_id")
    rows = stored(runs.union(often).distinct(), "blocks")
    sizes = rows.groupBy("block").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("doc_id")).alias("x"))
    single = sizes.where(F.col("m") > 1).groupBy("m", "x").agg(F.min("block").alias("block"))
    return rows.join(single.select("block", "m"), "block")


# --- signature trees ----------------------------------------------------------------------


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (last axis: 64-bit words) folded to a smaller power of two of words."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


class Node:
    """Members ``rows`` (places in the size order), their size range, OR-combined bitmap, the most shingles of a member that
    share a bit with another (``spare``), and the label that all members have, if they have one."""

    __slots__ = ("rows", "low", "high", "bits", "spare", "label", "children")

    def __init__(self, rows, low, high, bits, spare, label, children):
        self.rows, self.low, self.high, self.bits = rows, low, high, bits
        self.spare, self.label, self.children = spare, label, children


def build_tree(sizes: np.ndarray, bits: list[np.ndarray], labels: np.ndarray | None) -> Node:
    """Bottom-up from members in size order."""

    def label_of(rows) -> int | None:
        if labels is None:
            return None
        mine = labels[rows]
        return int(mine[0]) if (mine == mine[0]).all() else None

    level = []
    for a in range(0, len(sizes), LEAF):
        rows = np.arange(a, min(a + LEAF, len(sizes)))
        words = min(len(bits[r]) for r in rows)
        stacked = np.stack([folded(bits[r], words) for r in rows])
        spare = int((sizes[rows] - np.bitwise_count(stacked).sum(axis=1)).max())
        level.append(Node(rows, int(sizes[a]), int(sizes[rows[-1]]), np.bitwise_or.reduce(stacked), spare, label_of(rows), []))
    while len(level) > 1:
        upper = []
        for a in range(0, len(level), FANOUT):
            part = level[a : a + FANOUT]
            words = min(len(p.bits) for p in part)
            joined = np.bitwise_or.reduce([folded(p.bits, words) for p in part])
            # A spare holds for its own width only; at a smaller one every shingle may share its bit.
            spare = max(p.spare if len(p.bits) == words else p.high for p in part)
            label = part[0].label if all(p.label == part[0].label for p in part) else None
            upper.append(Node(None, part[0].low, part[-1].high, joined, spare, label, part))
        level = upper
    return level[0]


def may_link(a: Node, b: Node) -> bool:
    """Whether sizes and the greatest possible overlap allow a link between members of two nodes."""
    if 5 * a.high < 4 * b.low or 5 * b.high < 4 * a.low:
        return False
    if a.label is not None and a.label == b.label:
        return False
    words = min(len(a.bits), len(b.bits))
    spare = min(x.spare for x in (a, b) if len(x.bits) == words)
    most = int(np.bitwise_count(folded(a.bits, words) & folded(b.bits, words)).sum()) + spare
    return 9 * most >= 4 * (a.low + b.low)


def tree_pairs(sizes: np.ndarray, bits: list[np.ndarray], labels: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Member pairs ``(i, j, estimate says linked, estimated overlap)`` that may link, by dual traversal.

    ``sizes`` must ascend. Pairs with equal ``labels`` are left out.
    """
    root = build_tree(sizes, bits, labels)
    todo, out = [(root, root)], []
    while todo:
        a, b = todo.pop()
        if not may_link(a, b):
            continue
        if a.children or b.children:
            if a is b:
                kids = a.children
                todo += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids))]
            elif a.children and (not b.children or a.high - a.low >= b.high - b.low):
                todo += [(k, b) for k in a.children]
            else:
                todo += [(a, k) for k in b.children]
            continue
        words = min(len(bits[r]) for r in (*a.rows, *b.rows))
        x, y = (np.stack([folded(bits[r], words) for r in n.rows]) for n in (a, b))
        n, m = sizes[a.rows][:, None], sizes[b.rows][None, :]
        only_x = np.bitwise_count(x[:, None, :] & ~y[None, :, :]).sum(axis=2, dtype=np.int64)
        only_y = np.bitwise_count(y[None, :, :] & ~x[:, None, :]).sum(axis=2, dtype=np.int64)
        most = np.minimum(n - only_x, m - only_y)
        need = -(-4 * (n + m) // 9)
        fits = (most >= need) & (5 * np.minimum(n, m) >= 4 * np.maximum(n, m))
        if a is b:
            fits &= np.triu(np.ones_like(fits), 1)
        if labels is not None:
            fits &= labels[a.rows][:, None] != labels[b.rows][None, :]
        if fits.any():
            i, j = np.nonzero(fits)
            clear_x = 1 - np.bitwise_count(x).sum(axis=1) / (64 * words)
            clear_y = 1 - np.bitwise_count(y).sum(axis=1) / (64 * words)
            guess = (n - only_x / clear_y[None, :] + m - only_y / clear_x[:, None]) / 2
            out.append((a.rows[i], b.rows[j], guess[i, j] >= need[i, j], guess[i, j] / need[i, j]))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, bool, float))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def spanning(i: np.ndarray, j: np.ndarray, good: np.ndarray, guess: np.ndarray, n: int) -> list[tuple[int, int, bool]]:
    """A forest of the pairs that look linked, best first, and all doubtful pairs between its trees."""
    parent = list(range(n))

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    kept = []
    for k in np.flatnonzero(good)[np.argsort(-guess[good], kind="stable")].tolist():
        a, b = find(int(i[k])), find(int(j[k]))
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append((int(i[k]), int(j[k]), True))
    return kept + [(int(i[k]), int(j[k]), False) for k in np.flatnonzero(~good).tolist() if find(int(i[k])) != find(int(j[k]))]


def neighbouring(pairs: list[tuple[int, int, bool]]) -> list[tuple[int, int, bool]]:
    """The pairs in the order of a walk over the graph that they make, so that neighbours in the list share ends."""
    at: dict[int, list[int]] = {}
    for k, (x, y, _) in enumerate(pairs):
        at.setdefault(x, []).append(k)
        at.setdefault(y, []).append(k)
    used, out = [False] * len(pairs), []
    for start in list(at):
        todo = [start]
        while todo:
            node = todo[-1]
            edges = at[node]
            while edges and used[edges[-1]]:
                edges.pop()
            if not edges:
                todo.pop()
                continue
            k = edges.pop()
            used[k] = True
            out.append(pairs[k])
            x, y, _ = pairs[k]
            todo.append(y if x == node else x)
    return out


def block_pairs(rows: DataFrame, everything: bool) -> DataFrame:
    """``block, chunk, a, b, good`` from rows ``block, p, q, doc_id, n, bits`` (and ``label``), one tree per (block, p, q).

    With ``everything`` all possible pairs between different labels are kept, else a forest and the doubtful ones. ``chunk`` names at
    most ``CHUNK`` pairs with common ends.
    """

    def pairs(group: dict[str, list]) -> list[tuple[int, int, bool]]:
        ids, first = np.unique(np.array(group["doc_id"]), return_index=True)
        n = np.array(group["n"])[first]
        order = np.argsort(n, kind="stable")
        ids, first, n = ids[order], first[order], n[order]
        if len(ids) < 2:
            return []
        bits = [np.frombuffer(group["bits"][k], np.uint64) for k in first.tolist()]
        labels = np.array(group["label"])[first] if everything else None
        i, j, good, guess = tree_pairs(n, bits, labels)
        found = list(zip(i.tolist(), j.tolist(), good.tolist(), strict=True)) if everything else spanning(i, j, good, guess, len(ids))
        return [(int(min(ids[x], ids[y])), int(max(ids[x], ids[y])), bool(g)) for x, y, g in neighbouring(found)]

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, None

        def made() -> list[tuple]:
            if not key:
                return []
            return [(key[0], ((key[1] << 20) + key[2] << 20) + at // CHUNK, *p) for at, p in enumerate(pairs(group))]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64()] * 4 + [pa.bool_()]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["block", "chunk", "a", "b", "good"]
            )

        for batch in batches:
            data, out = batch.to_pydict(), []
            keys = list(zip(data["block"], data["p"], data["q"], strict=True))
            edges = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                if s == e:
                    continue
                if keys[s] != key:
                    out += made()
                    key, group = keys[s], {c: [] for c in data}
                for c, values in data.items():
                    group[c] += values[s:e]
            if out:
                yield batch_of(out)
        out = made()
        if out:
            yield batch_of(out)

    dealt = rows.repartition("block", "p", "q").sortWithinPartitions("block", "p", "q")
    return dealt.mapInArrow(traverse, "block long, chunk long, a long, b long, good boolean")


def block_stars(pairs: DataFrame) -> DataFrame:
    """``a, b``: the links ``block, a, b`` of each task's blocks as stars around their smallest ids."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # of one batch only: more would not change the components
            parent: dict[int, int] = {}

            def find(k: int) -> int:
                while parent.setdefault(k, k) != k:
                    parent[k] = parent[parent[k]]
                    k = parent[k]
                return k

            for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
            rows = [(find(k), k) for k in list(parent)]
            rows = [r for r in rows if r[0] != r[1]]
            if rows:
                a, b = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    rows = pairs.repartition("block").sortWithinPartitions("block").select("a", "b")
    return rows.mapInArrow(contract, "a long, b long").distinct()


def _parts():
    return F.ceil(F.col("m") / BLOCK).cast("int")


# --- exact check --------------------------------------------------------------------------


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``a, b, link`` for distinct ``pairs`` (a, b), from the whole texts.

    Pairs come in chunks (``block, chunk``) of at most ``CHUNK`` that lie next to each other in their block's forest, so they share
    ends. A text goes once to each chunk that needs it, not once for each pair; a pair that several chunks have is checked in one.
    """
    pairs = stored(pairs.groupBy("a", "b").agg(F.min(F.struct("block", "chunk")).alias("_g")).select(
        "a", "b", F.col("_g.block").alias("g"), F.col("_g.chunk").alias("c")), "pairs")
    ends = pairs.select("g", "c", F.inline(F.array(
        F.struct(F.col("a").alias("doc_id"), F.col("b").alias("other")), F.struct(F.col("b").alias("doc_id"), F.lit(None).cast("long").alias("other")))))
    # At most CHUNK partners: lists leave nulls out.
    targets = stored(ends.groupBy("g", "c", "doc_id").agg(F.collect_list("other").alias("others")), "targets")
    sent = docs.select("doc_id", "text").join(bounded(targets), "doc_id").select("g", "c", "doc_id", "others", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sets, wanted = None, {}, {}

        def found() -> list[tuple]:
            # An id may have several texts: one that links is enough.
            return [
                (a, b, any(linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)) for x in sets[a] for y in sets[b]))
                for a, others in wanted.items() for b in others
            ]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            a, b, link = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(link)], ["a", "b", "link"])

        for batch in batches:
            out = []
            columns = [batch[c].to_pylist() for c in ("g", "c", "doc_id", "others")]
            for (g, c, doc_id, others), s in zip(zip(*columns, strict=True), sets_of(batch["text"]), strict=True):
                if (g, c) != key:
                    out += found()
                    key, sets, wanted = (g, c), {}, {}
                sets.setdefault(doc_id, []).append(s)
                wanted[doc_id] = others
            if out:
                yield batch_of(out)
        if rest := found():
            yield batch_of(rest)

    rows = sent.repartition("g", "c").sortWithinPartitions("g", "c")
    return rows.mapInArrow(compare, "a long, b long, link boolean")


# --- the join -----------------------------------------------------------------------------


def jaccard_components(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (doc_id, text).

    Repeated rows and equal sets are one class; texts that share an id count as one document. Null and empty texts
    and texts without words have 0 shingles and are linked with nothing. A row with a null id gets a null component.
    """
    frequent = frequent_shingles(docs, sample)
    sketched = stored(sketches(docs, frequent), "sketches")
    narrow = sketched.select("doc_id", "n", "d1", "d2", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"))

    # Classes of equal sets, first within salts, so that a set with very many copies is no hot key.
    full = narrow.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    salted = full.groupBy("d1", "d2", "salt").agg(F.min("doc_id").alias("_m"))
    classes = stored(salted.join(salted.groupBy("d1", "d2").agg(F.min("_m").alias("rep")), ["d1", "d2"]), "classes")

    candidates = stored(possible(sketched), "candidates")
    members = stored(block_members(candidates), "members")
    signed = candidates.select("doc_id", "n", "bits").dropDuplicates(["doc_id", "n", "bits"])
    spread = F.pmod(F.xxhash64("doc_id", "block"), _parts()).cast("int")
    anchor = (F.col("m") > BLOCK) & (F.pmod(F.xxhash64("block", "doc_id", F.lit(1)), F.col("m")) < ANCHORS)
    own = F.array(spread)
    dealt = members.withColumn("p", F.explode(F.when(anchor, F.sequence(F.lit(0), _parts() - 1)).otherwise(own)))
    first = stored(block_pairs(dealt.withColumn("q", F.col("p")).join(signed, "doc_id"), everything=False), "pairs-1")
    checked = stored(verified(docs, first), "checked-1")
    # Stars of the links within each block: a large group of near copies gets a short way to its centre.
    links = stored(block_stars(first.join(checked.where("link").select("a", "b"), ["a", "b"])), "links")

    def over_classes(pairs: DataFrame) -> DataFrame:
        """Links between documents and the classes of their sets as one edge list."""
        ids = candidates.select("doc_id", "d1", "d2").distinct()
        reps = ids.join(classes.select("d1", "d2", "rep").distinct(), ["d1", "d2"])
        same = reps.where(F.col("doc_id") != F.col("rep")).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        return components(pairs.union(same))

    labels = over_classes(links)
    failed = first.where("good").join(checked.where(~F.col("link")), ["a", "b"]).select("block").distinct()
    large = members.where(F.col("m") > BLOCK)
    again = members.join(failed.union(large.select("block")).distinct(), "block", "left_semi")
    if not again.isEmpty():
        named = again.join(labels, again["doc_id"] == labels["node"], "left")
        named = named.select("block", "doc_id", "m", F.coalesce("component", "doc_id").alias("label"))
        mixed_blocks = named.groupBy("block").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).where("_a < _b")
        named = named.join(mixed_blocks.select("block"), "block", "left_semi")
        # Each member of a large block meets every sub-block once: pairs (p, q) with p <= q.
        last = _parts() - 1
        both = F.transform(
            F.sequence(F.lit(0), last), lambda k: F.struct(F.least(k, F.col("_p")).alias("p"), F.greatest(k, F.col("_p")).alias("q"))
        )
        named = named.withColumn("_p", spread).withColumn("_pq", F.explode(both)).select(
            "block", "doc_id", "label", "_pq.p", "_pq.q"
        )
        second = block_pairs(named.join(signed, "doc_id"), everything=True)
        second = second.join(checked.select("a", "b"), ["a", "b"], "left_anti")
        more = stored(verified(docs, second), "checked-2").where("link").select("a", "b")
        if not more.isEmpty():
            labels = over_classes(links.union(more))

    joined = classes.join(labels, classes["rep"] == labels["node"], "left").select(
        F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), F.col("salt").alias("_salt"),
        F.coalesce("component", "rep").alias("component"),
    )
    on = (narrow["d1"] == joined["_d1"]) & (narrow["d2"] == joined["_d2"]) & (narrow["salt"] == joined["_salt"])
    own_id = F.when(narrow["doc_id"].isNotNull(), F.coalesce(F.when(narrow["n"] > 0, F.col("component")), "doc_id"))
    return narrow.join(joined, on, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own_id.alias("component_id")
    )


def keep_one_each(docs: DataFrame) -> DataFrame:
    """One row of each component, the one with the smallest id; all columns kept.

    Rows without words and rows with a null id all stay. Of repeated rows of the smallest id one stays. The ids to keep are
    found on narrow columns.
    """
    found = jaccard_components(docs.select("doc_id", "text"))
    heads = found.where((F.col("doc_id") == F.col("component_id")) & (F.col("n_shingles") > 0)).select("doc_id").distinct()
    free = F.col("doc_id").isNull() | (F.coalesce(F.length(F.translate("text", " \t\n\x0b\f\r", "")), F.lit(0)) == 0)
    kept = docs.where(~free).join(heads, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return docs.where(free).union(kept.select(*docs.columns))
