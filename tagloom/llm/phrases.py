"""Phrase collocations by Toivonen's sampling method.

A hash sample of the documents proposes phrases: every phrase of up to four words that is frequent in the sample at a lowered
bound. One full pass then counts, over all documents, the proposed phrases and their negative border: each word, and each
longer phrase whose first and whose last words (all but one) are both proposed. The border is never listed; the pass counts what
occurs of it, by hashes. A border phrase that turns out frequent is a failure. The second full pass counts two kinds
of phrases by their words: those that came out frequent, and those that the failures had kept out, which contain a failure and
no phrase that was counted as infrequent. Then the count is closed: a frequent phrase that the first pass left out has a smallest part that
was not proposed; that part lies on the border and is frequent, so it is a failure, and the second pass counts the phrase.
The result is exact whatever the sample held.

Proposed, frequent and failed phrases are sent as bit tables of fixed size (two bits a phrase), whatever their number. A phrase
that only seems to be in one is counted too, so false positives cost time and never change the result. Within a task, equal
phrases are told by their hash before Spark adds up the counts by the phrases themselves.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.llm.common import mixed, stored

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
SAMPLE_SHARE = 8  # one of so many documents
SAMPLE_SLACK = 2.0  # the bound in the sample is so many times below its share of the full bound
FILTER_BITS = 1 << 26
BLOCK_BYTES = 1 << 20
HOT_PARTS = 2000
NO_LANG = "und"

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[*b".,;:!?", 10, 11, 12, 13]] = True
_WORD = ~_SEPARATOR
_WORD[[32, 9]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)
SHORT = np.uint64((1 << 48) - 1)  # what is sent of a hash; phrases that meet by chance are told apart by the second pass


def text_blocks(column: pa.Array, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of about ``most`` bytes of the texts, each text closed by a line end and each run ending at a separator, so
    that no piece is cut: ``(first row, bytes, places of the first bytes of the texts from that row on)``. Only a piece longer than
    ``most`` makes a longer run."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    big = pa.large_string()
    column = column.cast(big)
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0)) + 1)
    row = 0
    while row < len(ends):
        last = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + most, side="right")))
        part = column.slice(row, last - row).fill_null("")
        closed = pc.binary_join_element_wise(part, pa.scalar("", big), pa.scalar("\n", big))
        bounds = np.frombuffer(closed.buffers()[1], dtype=np.int64)[closed.offset : closed.offset + len(closed) + 1]
        data = np.frombuffer(closed.buffers()[2], dtype=np.uint8)
        a, end = int(bounds[0]), int(bounds[-1])
        while a < end:
            b = min(a + most, end)
            if b < end:
                cuts = np.flatnonzero(_SEPARATOR[data[a:b]])
                if len(cuts):
                    b = a + int(cuts[-1]) + 1
                else:
                    while not _SEPARATOR[data[b - 1]]:
                        step = np.flatnonzero(_SEPARATOR[data[b : b + most]])
                        b = b + int(step[0]) + 1 if len(step) else min(b + most, end)
            yield row, data[a:b], bounds - a
            a = b
        row = last


_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_LONG_WORD = 256


def _hashes(norm: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each word ``norm[at[i] : at[i] + lengths[i]]``, eight bytes at a time; very long words by a digest."""
    padded = np.r_[norm, np.zeros(8, np.uint8)]
    eights = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(norm) + 1,), (1,))
    out = mixed(lengths.astype(np.uint64) + _STEP)
    todo = np.arange(len(at))
    long = lengths > _LONG_WORD
    if long.any():
        for k in np.flatnonzero(long).tolist():
            digest = hashlib.blake2b(norm[at[k] : at[k] + lengths[k]].tobytes(), digest_size=8).digest()
            out[k] = int.from_bytes(digest, "little")
        todo = todo[~long]
    done = 0
    while len(todo):
        rest = lengths[todo] - done
        out[todo] = mixed((out[todo] ^ (eights[at[todo] + done] & _MASKS[np.minimum(rest, 8)])) + _STEP)
        done += 8
        todo = todo[rest > 8]
    return out


class Block:
    """The words of one run of text: ``norm`` has them lower-cased and parted by single blanks, word ``i`` at ``at[i]``."""

    def __init__(self, row: int, raw: np.ndarray, firsts: np.ndarray, seeds: np.ndarray):
        data = _LOWER[raw]
        word = _WORD[data]
        edge = np.flatnonzero(np.r_[word[:1], word[1:] != word[:-1]])
        starts, ends = edge[::2], edge[1::2]  # a run ends at a separator, so each word has an end
        self.count = len(starts)
        self.row = row + np.searchsorted(firsts, starts, side="right") - 1
        self.piece = np.searchsorted(np.flatnonzero(_SEPARATOR[data]), starts)
        word[ends] = True
        data[ends] = 32
        self.norm = data[word]
        self.at = np.r_[0, np.cumsum(ends - starts + 1)]
        self.words = _hashes(self.norm, self.at[:-1], ends - starts)
        self.first = mixed(self.words ^ seeds[self.row]) if self.count else self.words

    def longer(self, hashes: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
        """The hashes of the phrases of ``size`` words at ``places``, from those of one word less."""
        return mixed(hashes + _STEP) + self.words[places + size - 1]

    def phrases(self, places: np.ndarray, size: int) -> pa.Array:
        """The words at ``places``, joined by single blanks."""
        begin, lengths = self.at[places], self.at[places + size] - self.at[places] - 1
        bounds = np.r_[0, np.cumsum(lengths)]
        index = np.arange(bounds[-1]) + np.repeat(begin - bounds[:-1], lengths)
        return pa.Array.from_buffers(
            pa.large_string(), len(places), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(self.norm[index])]
        ).cast(pa.string())


def _seeds(langs: pa.Array) -> np.ndarray:
    coded = langs.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    made = [int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little") for w in coded.dictionary.to_pylist()]
    return np.array(made, dtype=np.uint64)[np.asarray(coded.indices)] if made else np.zeros(0, np.uint64)


def tagged(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hashes with the number of words in their last three bits."""
    return (hashes & ~np.uint64(7)) | np.uint64(size)


def _in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the tagged hashes the table has."""
    found = np.ones(len(hashes), dtype=bool)
    for p in _positions(len(bits) * 8, hashes):
        found &= (bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 != 0
    return found


def _positions(bits: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each hash in a table of ``bits`` bits, a power of two."""
    mask, h = np.uint64(bits - 1), mixed(hashes & SHORT)
    return h & mask, (h >> np.uint64(32)) & mask


Places = Iterator[tuple[int, np.ndarray, np.ndarray]]


def countable(block: Block, sizes: int, now: np.ndarray | None) -> Places:
    """``(size, places, tagged hashes)`` of all words, and of the longer phrases whose first and last ``size - 1`` words are
    proposed. A phrase is proposed if it is countable itself and in the filter ``now``."""
    hashes, made = block.first, tagged(block.first, 1)
    yield 1, np.arange(block.count), made
    if now is None:
        return
    known = _in_filter(now, made)
    for size in range(2, sizes + 1):
        # ``known[i]`` tells of the phrase of one word less at place ``i`` of the block.
        n = max(block.count - size + 1, 0)
        places = np.flatnonzero((known[:-1] & known[1:])[:n] & (block.piece[:n] == block.piece[size - 1 :]))
        longer = block.longer(hashes[places], places, size)
        made = tagged(longer, size)
        yield size, places, made
        if size < sizes:
            known, hashes = np.zeros(block.count, dtype=bool), np.zeros(block.count, dtype=np.uint64)
            hashes[places], known[places] = longer, _in_filter(now, made)


def wanted(block: Block, sizes: int, frequent: np.ndarray, failed: np.ndarray | None, now: np.ndarray | None) -> Places:
    """``(size, places, tagged hashes)`` of the phrases of ``frequent``, and of those that contain one of the ``failed`` and no phrase
    that was counted (countable with ``now``) without being frequent."""
    hashes = block.first
    whole, holds, dead = np.ones(block.count, dtype=bool), np.zeros(block.count, dtype=bool), np.zeros(block.count, dtype=bool)
    counted = countable(block, sizes if failed is not None else 0, now)
    for size in range(1, sizes + 1):
        n = max(block.count - size + 1, 0)
        if size > 1:
            whole = whole[:n] & whole[1 : n + 1] & (block.piece[:n] == block.piece[size - 1 :])
            hashes, holds, dead = hashes[:n], holds[:n] | holds[1 : n + 1], dead[:n] | dead[1 : n + 1]
        whole = whole & ~dead
        at = np.flatnonzero(whole)
        full = np.zeros(n, dtype=np.uint64)
        full[at] = hashes[at] if size == 1 else block.longer(hashes[at], at, size)
        hashes, made = full, tagged(full[at], size)
        known = _in_filter(frequent, made)
        take = known
        if failed is not None:
            able = np.zeros(block.count, dtype=bool)
            able[next(counted)[1]] = True
            lost = ~known & able[at]
            dead[at[lost]] = True
            take = known | (holds[at] & ~lost)
            holds[at] |= _in_filter(failed, made)
            whole[at[lost]] = False
        else:
            whole[at[~known]] = False
        yield size, at[take], made[take]
        tail = np.zeros(block.count - n, dtype=bool)
        whole, holds, dead = np.r_[whole, tail], np.r_[holds, tail], np.r_[dead, tail]
        hashes = np.r_[hashes, np.zeros(block.count - n, dtype=np.uint64)]


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, the place of one of each, the order that sorts all, and where each value begins in it."""
    order = np.argsort(hashes)
    sorted_ = hashes[order]
    heads = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]) if len(hashes) else np.zeros(0, np.int64)
    return sorted_[heads], order[heads], order, heads


def _langs_of(batch: pa.RecordBatch) -> pa.Array:
    return batch["lang"].cast(pa.string()).fill_null(NO_LANG)


class Tally:
    """Counts of phrases by hash, given out in batches when ``most`` rows do not shrink any more."""

    def __init__(self, most: int):
        self.most, self.rows, self.parts = most, 0, []

    def add(self, hashes: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((hashes, times))
        self.rows += len(hashes)
        if self.rows > self.most:
            self.merge()
            if self.rows > self.most // 2:
                yield from self.out()

    def merge(self) -> None:
        if len(self.parts) > 1:
            hashes, times = (np.concatenate(c) for c in zip(*self.parts, strict=True))
            values, _, order, heads = _distinct(hashes)
            self.parts, self.rows = [(values, np.add.reduceat(times[order], heads))], len(values)

    def out(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        for hashes, times in self.parts:
            batch = pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(times)], ["h", "n"])
            for a in range(0, len(times), _OUT_ROWS):
                yield batch.slice(a, _OUT_ROWS)
        self.parts, self.rows = [], 0


_COUNTS = "lang string, size int, phrase string, n long"
_OUT_ROWS = 1 << 16
TALLY_ROWS = 800_000


def hash_pass(docs: DataFrame, sizes: range, now=None, block: int = BLOCK_BYTES) -> DataFrame:
    """``h, n``: the tagged hashes of the countable phrases of ``docs`` of these ``sizes`` and how often they occur."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(now.value, np.uint8) if now is not None else None
        tally = Tally(TALLY_ROWS)
        for batch in batches:
            seeds = _seeds(_langs_of(batch))
            for run in text_blocks(batch["text"], block):
                made = Block(*run, seeds)
                for size, _, hashes in countable(made, sizes[-1], bits):
                    if size in sizes and len(hashes):
                        values, _, order, heads = _distinct(hashes & SHORT)
                        yield from tally.add(values, np.diff(np.r_[heads, len(order)]))
        yield from tally.out()

    # The tasks have added up their own counts: rows go straight to the shuffle. Most hashes are rare, so the parts get as
    # many as the input asks for, and the sum of one part stays small.
    texts = docs.select("lang", "text")
    parts = max(4 * texts.rdd.getNumPartitions(), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counted = texts.mapInArrow(count, "h long, n long").repartition(parts, "h")
    return counted.groupBy("h").agg(F.sum("n").alias("n"))


def phrase_pass(docs: DataFrame, sizes: int, frequent, failed=None, now=None, block: int = BLOCK_BYTES) -> DataFrame:
    """``lang, size, phrase, n`` of the phrases of ``docs`` in the table ``frequent`` or kept out by those in ``failed``, and per lang
    the number of words under size 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(frequent.value, np.uint8)
        more, old = (np.frombuffer(t.value, np.uint8) if failed is not None else None for t in (failed, now))
        names, totals = ["lang", "size", "phrase", "n"], Counter()
        for batch in batches:
            langs = _langs_of(batch)
            seeds = _seeds(langs)
            for run in text_blocks(batch["text"], block):
                made = Block(*run, seeds)
                if not made.count:
                    continue
                for size, places, hashes in wanted(made, sizes, bits, more, old):
                    _, one, order, heads = _distinct(hashes)
                    places = places[one]
                    if len(places):
                        sizes_ = pa.array(np.full(len(places), size, dtype=np.int32))
                        times = np.diff(np.r_[heads, len(order)])
                        found = [langs.take(pa.array(made.row[places])), sizes_, made.phrases(places, size), pa.array(times)]
                        yield pa.RecordBatch.from_arrays(found, names)
                rows, times = np.unique(made.row, return_counts=True)
                for lang, n in zip(langs.take(pa.array(rows)).to_pylist(), times.tolist(), strict=True):
                    totals[lang] += n
        if totals:
            n = len(totals)
            columns = [pa.array(list(totals)), pa.array([0] * n, pa.int32()), pa.array([""] * n), pa.array(list(totals.values()))]
            yield pa.RecordBatch.from_arrays(columns, names)

    pieces = docs.select("lang", "text").mapInArrow(count, _COUNTS)
    return pieces.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def filter_of(hashes: DataFrame, bits: int) -> np.ndarray:
    """The bit table of a column ``h``. Words of 64 bits are put together by Spark, so at most ``bits`` / 64 reach the driver."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.concatenate(_positions(bits, np.asarray(batch["h"]).view(np.uint64)))
            mask = (np.uint64(1) << (place & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((place >> np.uint64(6)).astype(np.int32)), pa.array(mask)], ["word", "mask"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [np.asarray(batch["word"]).astype("<i4"), np.asarray(batch["mask"]).astype("<i8")]
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], ["word", "mask"])

    table = hashes.select("h").mapInArrow(words, "word int, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    out = np.zeros(bits // 64, dtype=np.int64)
    for r in table.mapInArrow(packed, "word binary, mask binary").collect():
        out[np.frombuffer(r.word, "<i4")] |= np.frombuffer(r["mask"], "<i8")
    return out.view(np.uint8)


def frequent_phrases(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    share: int = SAMPLE_SHARE,
    slack: float = SAMPLE_SLACK,
    bits: int = FILTER_BITS,
    block: int = BLOCK_BYTES,
) -> tuple[DataFrame, bool]:
    """``lang, size, phrase, n`` of all phrases of at most ``longest`` words with n >= ``min_count``, and the number of words of
    each lang as size 0; and whether border phrases failed. All counts are exact."""
    spark = docs.sparkSession
    sample = docs.select("lang", "text").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(share)) == 0)
    sample = stored(sample, "phrase-sample")
    least = max(2, int(min_count / share / slack))
    proposed, sent = np.zeros(bits // 8, dtype=np.uint8), None
    for size in range(1, longest):
        found = hash_pass(sample, range(size, size + 1), sent, block).where(F.col("n") >= least)
        fresh = filter_of(found, bits)
        _drop(sent)
        proposed |= fresh
        sent = _send(spark, proposed)
        if not fresh.any():
            break
    # By hash first: what is not frequent here, alone or with what shares its hash, is not frequent.
    found = hash_pass(docs, range(1, longest + 1), sent, block).where(F.col("n") >= min_count)
    found = stored(found.select("h"), "frequent-hashes")
    frequent = _send(spark, filter_of(found, bits))
    failures = filter_of(_missed(found, sent, longest), bits)
    failed = _send(spark, failures) if failures.any() else None
    counts = phrase_pass(docs, longest, frequent, failed, sent, block)
    counts = stored(counts.where((F.col("n") >= min_count) | (F.col("size") == 0)), "phrases")
    for table in (sent, frequent, failed):
        _drop(table)
    return counts, failed is not None


def _missed(found: DataFrame, sent, longest: int) -> DataFrame:
    """The frequent hashes of phrases with fewer than ``longest`` words that were not proposed: the failures of the border."""

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            h = np.asarray(batch["h"])
            lost = ~_in_filter(bits, h.view(np.uint64)) & (h & 7 < longest)
            yield pa.RecordBatch.from_arrays([pa.array(h[lost])], ["h"])

    return found.mapInArrow(left, "h long")


def _send(spark: SparkSession, bits: np.ndarray):
    return spark.sparkContext.broadcast(bits.tobytes())


def _drop(sent) -> None:
    if sent is not None:
        sent.unpersist()


def part_counts(parts: DataFrame, counts: DataFrame) -> DataFrame:
    """``parts`` (with ``lang``, ``part``) and the count ``f`` of each part. The parts that occur in most phrases are among the
    most frequent; these few are answered by a broadcast of fixed length, all others by a join."""
    hot = counts.orderBy(F.col("n").desc(), "lang", "phrase").limit(HOT_PARTS)
    hot = stored(hot.select(F.col("lang").alias("_hl"), F.col("phrase").alias("_hp"), F.col("n").alias("_hn")), "hot-parts")
    met = parts.join(F.broadcast(hot), (parts["lang"] == F.col("_hl")) & (parts["part"] == F.col("_hp")), "left").drop("_hl", "_hp")
    met = stored(met, "parts")
    names = [c for c in met.columns if c != "_hn"]
    of = counts.select(F.col("lang").alias("_l"), F.col("phrase").alias("_p"), F.col("n").alias("f"))
    cold = met.where("_hn is null").drop("_hn")
    cold = cold.join(of, (F.col("lang") == F.col("_l")) & (F.col("part") == F.col("_p"))).select(*names, "f")
    return met.where("_hn is not null").select(*names, F.col("_hn").alias("f")).union(cold)


def collocations(frequent: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best ``top`` phrases of each lang."""
    total = frequent.where("size = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    counts = frequent.where("size > 0").select("lang", "phrase", "n")
    candidates = frequent.where("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"))
    # A phrase lies inside a longer one that is as frequent exactly if one with a single word more is.
    words = F.split("phrase", " ", -1)
    cut = candidates.withColumn("_w", words)
    inner = cut.where("size > 2").select(
        "lang", "a", F.explode(F.array(F.concat_ws(" ", F.slice("_w", 1, F.col("size") - 1)),
                                       F.concat_ws(" ", F.slice("_w", F.lit(2), F.col("size") - 1)))).alias("phrase"))
    inner = inner.groupBy(F.col("lang").alias("_il"), F.col("phrase").alias("_ip")).agg(F.max("a").alias("_longer"))
    cut = cut.join(inner, (F.col("lang") == F.col("_il")) & (F.col("phrase") == F.col("_ip")), "left")
    cut = cut.where(F.col("_longer").isNull() | (100 * F.col("_longer") < 100 * F.col("a")))
    ways = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
        k.alias("k"), F.concat_ws(" ", F.slice("_w", F.lit(1), k)).alias("l"),
        F.concat_ws(" ", F.slice("_w", k + 1, F.col("size") - k)).alias("r")))
    cuts = cut.select("lang", "phrase", "a", F.explode(ways).alias("_c"))
    sides = cuts.select("lang", "phrase", "a", F.col("_c.k").alias("k"), F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("_c.l").alias("part")),
        F.struct(F.lit(1).alias("side"), F.col("_c.r").alias("part")))).alias("_s"))
    sides = sides.select("lang", "phrase", "a", "k", F.col("_s.side").alias("side"), F.col("_s.part").alias("part"))
    known = part_counts(sides, counts).groupBy("lang", "phrase", "k").agg(
        F.first("a").alias("a"), F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"),
        F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    wide = "decimal(19,0)"
    known = known.join(F.broadcast(total), "lang").withColumn("score", F.expr(
        f"(cast(1000 * cast(a as {wide}) as decimal(23,0)) * cast(n as decimal(15,0))) div (cast(l as {wide}) * cast(r as {wide}))"))
    least = known.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("_b"))
    rows = least.select("lang", "phrase", *[F.col(f"_b.{c}").alias(c) for c in ("a", "l", "r", "n", "score")])
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # First the best of each cell of a lang, then the best of these: no task holds a lang.
    cell = Window.partitionBy("lang", "_cell").orderBy(*order)
    best = rows.withColumn("_cell", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("_at", F.row_number().over(cell))
    best = best.where(F.col("_at") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return best.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def mine_phrases(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, **settings) -> DataFrame:
    """The best collocations of each lang of ``docs`` (``doc_id, lang, text``).

    Null texts are empty, a null lang is ``und``, an empty table gives no rows. Repeated rows count as often as they occur; a
    text of any length is cut into runs at its separators only. Ties are ordered by count, then by the phrase's bytes. Other columns are ignored.
    """
    frequent, _ = frequent_phrases(docs, min_count, **settings)
    return collocations(frequent, top)


#: The same rows in SQL: all phrases are listed, without a sample.
ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS p, piece FROM (
    SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
full_lists AS (SELECT lang, w, len(w) AS m FROM lists WHERE len(w) > 0),
grams AS (
  SELECT lang, s.size AS size, unnest(list_transform(range(1, m - s.size + 2), lambda i: array_to_string(w[i:i + s.size - 1], ' '))) AS phrase
  FROM full_lists, (SELECT unnest([1, 2, 3, 4, 5]) AS size) s WHERE m >= s.size),
f AS (SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 100),
inner_ AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(w[1:size - 1], ' ') AS phrase FROM cand WHERE size > 2
    UNION ALL SELECT lang, a, array_to_string(w[2:size], ' ') FROM cand WHERE size > 2) GROUP BY ALL),
kept AS (SELECT c.* FROM cand c LEFT JOIN inner_ i ON c.lang = i.lang AND c.phrase = i.phrase WHERE i.longer IS NULL OR 100 * i.longer < 100 * c.a),
cuts AS (
  SELECT k.lang, k.phrase, k.a, s.k, array_to_string(w[1:s.k], ' ') AS lp, array_to_string(w[s.k + 1:size], ' ') AS rp
  FROM kept k, (SELECT unnest([1, 2, 3, 4]) AS k) s WHERE s.k < size),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, fl.n AS l, fr.n AS r, t.n,
    ((1000::HUGEINT * c.a * t.n) // (fl.n::HUGEINT * fr.n))::BIGINT AS score
  FROM cuts c JOIN f fl ON fl.lang = c.lang AND fl.phrase = c.lp JOIN f fr ON fr.lang = c.lang AND fr.phrase = c.rp
  JOIN total t ON t.lang = c.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS pick FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE pick = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
