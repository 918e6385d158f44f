"""Repair of conversation structure: cheapest edits by dynamic programming, the least of them by prefix-doubling path ranking.

After the cost run (from the last row to the first, four states, see below) only optimal arcs are left. Each node of them gets
the letter of its least arc as a first rank; ranks over one letter become ranks over two, four, eight, ... letters, by the pair of
a node's rank and that of the node that many letters on, whose pointer is doubled in the same step. The ranks select
each node's arc, and the doubled pointers spell the whole least path at once. All conversations of a batch are ranked together.

A conversation of more than ``LONG`` rows is cut into fragments in turn order, which tasks take apart from each other: a fragment
sends the costs between its four entry and exit states, a conversation's fragments are chained by these small tables, and
each then finds its own part of the path. Only the audit and the hash of the whole are put together in one task, text by text.

States: 0 nothing yet, 1 after ``s``, 2 after ``u``, 3 after ``a``; the end is allowed in 0 and 3.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import stored

LONG = 2048
BATCH_ROWS = 8192
_INF = 1 << 40
_LETTERS = np.frombuffer(b" DIKR", np.uint8)
_DELETE, _INSERT, _KEEP, _REROLE = 1, 2, 3, 4
_NEXT = np.array([2, 2, 3, 2])  # the state after a user or assistant that is put where one is due
_KEEP_TO = np.full((4, 4), -1)  # by role initial (other, s, u, a) and state
_KEEP_TO[1, 0], _KEEP_TO[2, [0, 1, 3]], _KEEP_TO[3, 2] = 1, 2, 3
_INITIALS = {"s": 1, "u": 2, "a": 3}
_LEGAL = {"su", "ua", "au"}
_BLANKS = " \t\n\x0b\x0c\r"
_OUT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, times``: the rows with the damage that their key's checksum says; ``times`` is 0 for a dropped row."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
                       F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("_harm"))
    harm = F.col("_harm")
    text = F.when(harm == 1, "").when(harm == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(harm == 4, "user").when(harm > 0, F.col("role")).alias("role"), F.when(harm > 0, text).alias("text"),
        F.when(harm == 0, 0).when(harm == 3, 2).otherwise(1).alias("times"),
    )


class Rows:
    """The rows of a run of conversations or fragments, in order: ``bounds[k]`` is the first row of the ``k``-th."""

    def __init__(self):
        self.ids, self.bounds, self.roles, self.texts, self.faults, self.turns = [], [0], [], [], [], []
        self.seen: set = set()

    def begin(self, key) -> None:
        self.ids.append(key)
        self.bounds.append(len(self.roles))
        self.seen = set()

    def add(self, turn, role: str, text: str, before: bool = False) -> None:
        """One row of the last begun conversation; ``before`` if an earlier fragment has its role and text."""
        words = text.strip(_BLANKS)
        again = before or (role, text) in self.seen
        self.seen.add((role, text))
        self.faults.append("b" if not words else "d" if again else "" if words[-1] in ".!?" else "t")
        self.roles.append(role)
        self.texts.append(text)
        self.turns.append(turn)
        self.bounds[-1] = len(self.roles)


class Paths:
    """Costs and least paths of a run of fragments. ``ends[k]`` has the costs of what follows the ``k``-th by exit state; None
    stands for the end of the conversation."""

    def __init__(self, rows: Rows, ends: list[np.ndarray | None]):
        self.rows = rows
        self.bounds = np.array(rows.bounds)
        self.sizes = np.diff(self.bounds)
        count = len(self.sizes)
        self.first = self.bounds[:-1] + np.arange(count)  # the level before a fragment's first row
        self.initial = np.array([_INITIALS.get(r[:1], 0) for r in rows.roles], dtype=np.int64)
        self.must = np.array([f in ("b", "d") for f in rows.faults], dtype=bool)
        self.extra = np.array([f == "t" for f in rows.faults], dtype=np.int64)
        self.final = np.array([e is None for e in ends], dtype=bool)
        self.costs = np.full((self.bounds[-1] + count, 4), _INF, dtype=np.int64)
        self._run(ends)

    def _arcs(self, row: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For rows and the costs behind them: the costs of deleting, keeping and re-roling in each state, and the state after keeping."""
        to = _KEEP_TO[self.initial[row]]
        extra = self.extra[row][:, None]
        keep = np.where(to >= 0, np.take_along_axis(after, np.maximum(to, 0), 1) + extra, _INF)
        rerole = after[:, _NEXT] + 2 + extra
        must = self.must[row][:, None]
        return after + 3, np.where(must, _INF, keep), np.where(must, _INF, rerole), to

    def _run(self, ends: list[np.ndarray | None]) -> None:
        last = np.array([[0, 4, 2, 0] if e is None else e for e in ends], dtype=np.int64).reshape(-1, 4)
        self.costs[self.first + self.sizes] = last
        order = np.argsort(-self.sizes, kind="stable")
        lengths = self.sizes[order]
        for t in range(1, int(lengths[0]) + 1 if len(lengths) else 1):
            mine = order[: np.searchsorted(-lengths, -t, side="right")]
            at = self.first[mine] + self.sizes[mine] - t
            delete, keep, rerole, _ = self._arcs(self.bounds[mine] + self.sizes[mine] - t, self.costs[at + 1])
            best = np.minimum(np.minimum(delete, keep), rerole)
            two, three = best[:, 2:3], best[:, 3:4]
            once, twice = np.concatenate([two, two, three, two], 1), np.concatenate([three, three, two, three], 1)
            self.costs[at] = np.minimum(np.minimum(np.minimum(best, once + 2), twice + 4), _INF)

    def rank(self) -> None:
        """Letters, pointers and ranks of all nodes (level, state), by doubling."""
        levels = len(self.costs)
        node = np.arange(levels * 4).reshape(levels, 4)
        letter, to = np.zeros((levels, 4), dtype=np.int64), node.copy()
        has_row = np.ones(levels, dtype=bool)
        has_row[self.first + self.sizes] = False
        inserts = has_row.copy()
        inserts[(self.first + self.sizes)[self.final]] = True
        at = np.flatnonzero(has_row)
        delete, keep, rerole, keep_to = self._arcs(np.arange(len(at)), self.costs[at + 1])
        here = self.costs[at]
        # From the greatest letter to the least, so that the least of the optimal arcs stays.
        for kind, cost, state in ((_REROLE, rerole, np.broadcast_to(_NEXT, here.shape)), (_KEEP, keep, keep_to)):
            hit = cost == here
            letter[at] = np.where(hit, kind, letter[at])
            to[at] = np.where(hit, (at + 1)[:, None] * 4 + np.maximum(state, 0), to[at])
        hit = inserts[:, None] & (self.costs[:, _NEXT] + 2 == self.costs)
        letter, to = np.where(hit, _INSERT, letter), np.where(hit, node[:, _NEXT], to)
        hit = delete == here
        letter[at] = np.where(hit, _DELETE, letter[at])
        to[at] = np.where(hit, node[at + 1], to[at])
        self.letter = letter.ravel()
        pointer = to.ravel()
        ranks, steps = self.letter, (self.letter > 0).astype(np.int64)
        self.pointers = []
        while True:
            self.pointers.append(pointer)
            if not self.letter[pointer].any():
                break
            ranks = np.unique(ranks * (int(ranks.max()) + 1) + ranks[pointer], return_inverse=True)[1]
            steps = steps + steps[pointer]
            pointer = pointer[pointer]
        self.ranks, self.steps, self.exits = ranks, steps, pointer % 4

    def spell(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nodes of the least paths from each fragment's first level in ``states``; their letters; each path's first place."""
        start = self.first * 4 + states
        lengths = self.steps[start]
        firsts = np.r_[0, np.cumsum(lengths)]
        nodes = np.repeat(start, lengths)
        place = np.arange(firsts[-1]) - np.repeat(firsts[:-1], lengths)
        for k, pointer in enumerate(self.pointers):
            nodes = np.where(place >> k & 1, pointer[nodes], nodes)
        return nodes, self.letter[nodes], firsts

    def repaired(self, states: np.ndarray) -> Iterator[tuple[str, list[str]]]:
        """For each fragment, entered in ``states``, its audit and its repaired lines."""
        nodes, letters, firsts = self.spell(states)
        audit = _LETTERS[letters].tobytes().decode()
        fragment = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        row = (nodes // 4 - fragment).tolist()  # a fragment has one level more than rows
        put = np.array(["user", "user", "assistant", "user"])[nodes % 4].tolist()
        roles, texts = self.rows.roles, self.rows.texts
        kinds = letters.tolist()
        for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            lines = []
            for p in range(a, b):
                if kinds[p] == _KEEP:
                    lines.append(f"{roles[row[p]]}:{texts[row[p]]}")
                elif kinds[p] == _REROLE:
                    lines.append(f"{put[p]}:{texts[row[p]]}")
                elif kinds[p] == _INSERT:
                    lines.append(f"{put[p]}:")
            yield audit[a:b], lines


def _illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in _LEGAL for a, b in zip(roles, roles[1:], strict=False))


def _solved(rows: Rows) -> pa.RecordBatch:
    """The result rows of whole conversations."""
    paths = Paths(rows, [None] * len(rows.ids))
    paths.rank()
    out = []
    answers = paths.repaired(np.zeros(len(rows.ids), dtype=np.int64))
    for k, (audit, lines) in enumerate(answers):
        a, b = rows.bounds[k], rows.bounds[k + 1]
        turns = [t for t in rows.turns[a:b] if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = rows.faults[a:b]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((rows.ids[k], gaps, faults.count("b"), faults.count("d"), faults.count("t"), _illegal(rows.roles[a:b]),
                    int(paths.costs[paths.first[k], 0]), audit, digest))
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    names = [c.split()[0] for c in _OUT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results from rows that come conversation by conversation in turn order."""
    rows = Rows()
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "times")]
        for conv, turn, role, text, times in zip(*columns, strict=True):
            if not rows.ids or rows.ids[-1] != conv:
                if len(rows.roles) >= BATCH_ROWS:
                    yield _solved(rows)
                    rows = Rows()
                rows.begin(conv)
            for _ in range(times):
                rows.add(turn, role, text)
    if rows.ids:
        yield _solved(rows)


def _sorted_turns() -> list:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]


# --- long conversations --------------------------------------------------------------------

_FRAGMENT = "conv_id long, frag long, pos long, turn long, role string, text string, digest binary, times int"


def _fragments(rows: DataFrame, most: int) -> DataFrame:
    """The rows in turn order, cut into fragments of at most ``most`` rows; ``frag`` grows with the turns of a conversation."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frag, pos, last = (TaskContext.get().partitionId() << 32) - 1, most, object()
        for batch in batches:
            frags, places, digests = [], [], []
            for conv, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if pos >= most or conv != last:
                    frag, pos, last = frag + 1, 0, conv
                frags.append(frag)
                places.append(pos)
                pos += 1
                digests.append(hashlib.blake2b(f"{len(role or '')}:{role}{text}".encode(), digest_size=16).digest())
            arrays = [batch["conv_id"], pa.array(frags, pa.int64()), pa.array(places, pa.int64()), batch["turn"], batch["role"],
                      batch["text"], pa.array(digests, pa.binary()), batch["times"]]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _FRAGMENT.split(", ")])

    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = rows.repartitionByRange(parts, *_sorted_turns()).sortWithinPartitions(*_sorted_turns())
    cut_rows = stored(ranged.mapInArrow(cut, _FRAGMENT), "conversation-fragments")
    # Rows whose role and text an earlier fragment has. Each fragment sends a text once.
    live = cut_rows.where("times > 0").select("conv_id", "frag", "digest").distinct()
    firsts = live.groupBy(F.col("conv_id").alias("_c"), F.col("digest").alias("_d")).agg(F.min("frag").alias("_first"))
    again = live.join(firsts, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("digest") == F.col("_d")))
    again = again.where(F.col("frag") > F.col("_first")).select(F.col("frag").alias("_f"), F.col("digest").alias("_d"), F.lit(True).alias("before"))
    met = cut_rows.join(again, (F.col("frag") == F.col("_f")) & (F.col("digest") == F.col("_d")), "left")
    return stored(met.select("conv_id", "frag", "pos", "turn", "role", "text", "times", F.coalesce("before", F.lit(False)).alias("before")),
                  "conversation-fragments")


def _each_fragment(batches: Iterator[pa.RecordBatch], told: tuple[str, ...] = ()) -> Iterator[tuple[Rows, list[tuple]]]:
    """Runs of whole fragments from rows that come fragment by fragment; ``told`` columns are the same on all rows of one."""
    rows, more = Rows(), []
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("conv_id", "frag", "turn", "role", "text", "times", "before", *told)]
        for conv, frag, turn, role, text, times, before, *rest in zip(*columns, strict=True):
            if not rows.ids or rows.ids[-1] != (conv, frag):
                if len(rows.roles) >= BATCH_ROWS:
                    yield rows, more
                    rows, more = Rows(), []
                rows.begin((conv, frag))
                more.append(tuple(rest))
            for k in range(times):
                rows.add(turn, role, text, before or k > 0)
    if rows.ids:
        yield rows, more


_SUMMARY = ("conv_id long, frag long, matrix array<long>, last array<long>, blank long, duplicate long, truncated long, illegal long, "
            "head string, tail string")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each fragment the costs from entry to exit states, those to the end of a conversation, and its faults."""
    for rows, _ in _each_fragment(batches):
        n = len(rows.ids)
        units = np.where(np.eye(4, dtype=bool), 0, _INF)
        by_exit = np.stack([(p := Paths(rows, [units[j]] * n)).costs[p.first] for j in range(4)], axis=2)
        final = Paths(rows, [None] * n)
        out = []
        for k, (conv, frag) in enumerate(rows.ids):
            a, b = rows.bounds[k], rows.bounds[k + 1]
            faults, roles = rows.faults[a:b], rows.roles[a:b]
            out.append((conv, frag, by_exit[k].ravel().tolist(), final.costs[final.first[k]].tolist(), faults.count("b"), faults.count("d"),
                        faults.count("t"), _illegal(roles), roles[0] if roles else None, roles[-1] if roles else None))
        yield _table(out, _SUMMARY)


def _table(out: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "boolean": pa.bool_()}
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*out, strict=True)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[t]) for c, (_, t) in zip(columns, fields, strict=True)], [f for f, _ in fields])


_CHAIN = "conv_id long, frag long, ends array<long>, final boolean, blank long, duplicate long, truncated long, illegal long, cost long"


def _chain_back(table: pa.Table) -> pa.Table:
    """From a conversation's summaries what follows each fragment costs, and the conversation's sums on its first fragment."""
    rows = sorted(table.to_pylist(), key=lambda r: r["frag"])
    ends, after = [None] * len(rows), None
    for k in range(len(rows) - 1, -1, -1):
        ends[k] = after
        if after is None:
            after = np.array(rows[k]["last"])
        else:
            after = np.minimum((np.array(rows[k]["matrix"]).reshape(4, 4) + after).min(axis=1), _INF)
    edges = [(r["head"], r["tail"]) for r in rows if r["head"] is not None]
    illegal = sum(r["illegal"] for r in rows) + sum(a[1][:1] + b[0][:1] not in _LEGAL for a, b in zip(edges, edges[1:], strict=False))
    out = []
    for k, r in enumerate(rows):
        sums = [sum(x[c] for x in rows) for c in ("blank", "duplicate", "truncated")] + [illegal, int(after[0])] if k == 0 else [None] * 5
        out.append((r["conv_id"], r["frag"], None if ends[k] is None else ends[k].tolist(), ends[k] is None, *sums))
    return pa.Table.from_batches([_table(out, _CHAIN)])


def _ranked(rows: Rows, more: list[tuple]) -> Paths:
    paths = Paths(rows, [None if final else np.array(ends, dtype=np.int64) for ends, final, *_ in more])
    paths.rank()
    return paths


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each fragment's least paths leave it, by entry state."""
    for rows, more in _each_fragment(batches, ("ends", "final")):
        paths = _ranked(rows, more)
        by_entry = paths.exits[paths.first[:, None] * 4 + np.arange(4)].tolist()
        yield _table([(c, f, e) for (c, f), e in zip(rows.ids, by_entry, strict=True)], "conv_id long, frag long, exits array<long>")


def _chain_on(table: pa.Table) -> pa.Table:
    rows, state, out = sorted(table.to_pylist(), key=lambda r: r["frag"]), 0, []
    for r in rows:
        out.append((r["frag"], state))
        state = r["exits"][state]
    return pa.Table.from_batches([_table(out, "frag long, entry long")])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, more in _each_fragment(batches, ("ends", "final", "entry")):
        paths = _ranked(rows, more)
        states = np.array([m[2] for m in more], dtype=np.int64)
        out = [(c, f, audit, "\n".join(lines) if lines else None) for (c, f), (audit, lines) in zip(rows.ids, paths.repaired(states), strict=True)]
        yield _table(out, "conv_id long, frag long, audit string, text string")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and hash of each conversation from its fragments' pieces, which come in order; no text is kept."""
    schema = "conv_id long, audit string, repaired_sha256 string"
    last, audit, digest, begun = object(), [], None, False
    for batch in batches:
        for r in batch.to_pylist():
            if digest is None or r["conv_id"] != last:
                if digest is not None:
                    yield _table([(last, "".join(audit), digest.hexdigest())], schema)
                last, audit, digest, begun = r["conv_id"], [], hashlib.sha256(), False
            audit.append(r["audit"])
            if r["text"] is not None:
                digest.update((("\n" if begun else "") + r["text"]).encode())
                begun = True
    if digest is not None:
        yield _table([(last, "".join(audit), digest.hexdigest())], schema)


def _by_fragment(rows: DataFrame, told: DataFrame | None = None) -> DataFrame:
    if told is not None:
        names = [c for c in told.columns if c != "frag"]
        told = told.withColumnRenamed("frag", "_f")
        rows = rows.join(told, F.col("frag") == F.col("_f")).select(*rows.columns, *names)
    return rows.repartition("frag").sortWithinPartitions("frag", "pos")


def _long_conversations(rows: DataFrame, most: int) -> DataFrame:
    cut = _fragments(rows, most)
    summaries = _by_fragment(cut).mapInArrow(_summaries, _SUMMARY)
    # A conversation's fragments meet as rows of a few numbers each: their audits, longer than that, meet in one value of the result.
    chain = stored(summaries.groupBy("conv_id").applyInArrow(_chain_back, _CHAIN), "conversation-chain")
    known = chain.select("frag", "ends", "final")
    exits = _by_fragment(cut, known).mapInArrow(_exits, "conv_id long, frag long, exits array<long>")
    entries = stored(exits.groupBy("conv_id").applyInArrow(_chain_on, "frag long, entry long"), "conversation-entries")
    known = known.join(entries.withColumnRenamed("frag", "_e"), F.col("frag") == F.col("_e")).drop("_e")
    pieces = _by_fragment(cut, known).mapInArrow(_pieces, "conv_id long, frag long, audit string, text string")
    order = [F.col("conv_id").asc_nulls_first(), F.col("frag")]
    joined = pieces.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_joined, "conv_id long, audit string, repaired_sha256 string")
    live = cut.where("times > 0").select("conv_id", "turn").where("turn is not null").distinct()
    gaps = live.groupBy(F.col("conv_id").alias("_g")).agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    sums = chain.where("cost is not null").select(F.col("conv_id").alias("_s"), "blank", "duplicate", "truncated", "illegal", "cost")
    out = joined.join(sums, F.col("conv_id").eqNullSafe(F.col("_s"))).join(gaps, F.col("conv_id").eqNullSafe(F.col("_g")), "left")
    names = [c.split()[0] for c in _OUT.split(", ")]
    return out.withColumn("gaps", F.coalesce("gaps", F.lit(0))).select(*names)


def repair(conversations: DataFrame, long: int = LONG) -> DataFrame:
    """Damage, faults and cheapest repair of each conversation of ``conv_id, turn, role, text``: one row per ``conv_id``.

    Rows of one turn follow in the order of role and text, null turns first. Null roles and texts are one space, so such a
    text is blank and such a role fits nowhere; null ids are one conversation. Repeated rows count as duplicates. An empty table gives
    no rows; a conversation that loses all rows gives zeros, an empty audit and the hash of nothing. Other columns are ignored.
    ``long`` is the number of rows beyond which a conversation is cut; it does not change the result.
    """
    rows = damaged(conversations)
    many = rows.groupBy(F.col("conv_id").alias("_id")).agg(F.count("*").alias("_n")).where(F.col("_n") > long)
    many = stored(many.select("_id"), "long-conversations")
    same = F.col("conv_id").eqNullSafe(F.col("_id"))
    empty = many.isEmpty()
    short = rows if empty else rows.join(many, same, "left_anti")
    out = short.repartition("conv_id").sortWithinPartitions(*_sorted_turns()).mapInArrow(_whole, _OUT)
    if empty:
        return out
    return out.union(_long_conversations(stored(rows.join(many, same, "left_semi"), "long-conversations"), long))
