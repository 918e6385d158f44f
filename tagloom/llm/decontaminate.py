"""Benchmark decontamination: a prefix-filtered set join with exact containment, in built-in functions only.

A window is ``size`` consecutive item words. It occurs in a document only if its rarest word does, so that word is the
window's necessary prefix: words are ordered by how often they occur in all documents, and only positions that
hold the rarest word of some window become candidates. The place of the word in the window gives the candidate's start, which
must leave room on both sides (positional and length bounds); the words there are then compared exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.arrays import let, unfolded
from tagloom.llm.common import stored

SIZE = 10
BROADCAST_ROWS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_list(text: Column) -> Column:
    """Words of letters, digits and characters beyond ASCII; only A-Z are lower-cased. Null gives none."""
    words = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _GAP)
    return F.filter(words, lambda w: w != "")


def item_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """``item_id, window (words joined by blanks), length``: each window of each item once.

    An item with fewer words is one window, an item without words (or with null text) has none. Items with a null id
    are kept: their windows hit words like any other, together they count as one item, and they name nothing.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), word_list(F.col("text")).alias("w"))
    items = items.where(F.size("w") > 0)
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0))))
    cut = items.select("item_id", "w", start.alias("s")).select("item_id", F.slice("w", F.col("s") + 1, size).alias("w"))
    return cut.select("item_id", F.array_join("w", " ").alias("window"), F.size("w").alias("length")).distinct()


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if the written table ``df`` has at most ``rows`` rows; else Spark joins by shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def find_windows(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``n_words`` and ``found``, the distinct occurrences of windows in every row, as
    ``array<struct<start, length, item_id>>``.

    Rows with the same id and text share their occurrences; every input row gives one output row.
    """
    windows = stored(windows, "windows")
    marked = docs.select("doc_id", "text", F.xxhash64("text").alias("_text"))
    words = marked.select("doc_id", "_text", word_list(F.col("text")).alias("_w"))

    # How often each word of a window occurs in all documents.
    vocabulary = stored(windows.select(F.explode(F.split("window", " ")).alias("word")).distinct(), "window-words")
    seen = words.select(F.explode(unfolded("_w")).alias("word"))
    counts = seen.join(bounded(vocabulary), "word").groupBy("word").agg(F.count("*").alias("n"))

    # The rarest word of each window and its place; a window with a word that no document has cannot occur.
    placed = windows.select("*", F.posexplode(F.split("window", " ")).alias("offset", "word"))
    placed = placed.join(counts, "word", "left").groupBy("item_id", "window", "length").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset")).alias("rarest")
    )
    keys = placed.where(F.col("rarest.n") > 0).select("item_id", "window", "length", "rarest.word", "rarest.offset")
    keys = stored(keys, "window-keys")

    spots = words.select("doc_id", "_text", F.size("_w").alias("_n"), F.posexplode(unfolded("_w")).alias("_at", "word"))
    start = F.col("_at") - F.col("offset")
    candidates = spots.join(bounded(keys), "word").where((start >= 0) & (start + F.col("length") <= F.col("_n")))
    candidates = candidates.groupBy("doc_id", "_text").agg(
        F.collect_set(F.struct(start.alias("start"), "length", "item_id", "window")).alias("_c")
    )
    candidates = candidates.select(F.col("doc_id").alias("_id"), F.col("_text").alias("_same"), "_c")

    on = marked["doc_id"].eqNullSafe(candidates["_id"]) & marked["_text"].eqNullSafe(candidates["_same"])
    joined = marked.join(candidates, on, "left").select("doc_id", "text", "_c", word_list(F.col("text")).alias("_w"))
    exact = let(
        F.col("_w"),
        lambda w: F.filter("_c", lambda c: F.array_join(F.slice(w, c["start"] + 1, c["length"]), " ") == c["window"]),
    )
    found = F.transform(exact, lambda c: F.struct(c["start"], c["length"], c["item_id"]))
    none = F.array().cast("array<struct<start:int,length:int,item_id:string>>")
    return joined.select("doc_id", "text", F.size("_w").cast("long").alias("n_words"), F.coalesce(found, none).alias("found"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every row of ``docs``.

    All items with a null id count as one in ``n_items`` and are not in the hash, which has the known ids only.
    """
    found = find_windows(docs, item_windows(benchmark, size))
    covered = F.transform("found", lambda c: F.sequence(c["start"], c["start"] + c["length"] - 1))
    items = F.array_sort(F.array_distinct(F.transform("found", lambda c: c["item_id"])))
    rows = found.select(
        "doc_id", "n_words", F.size(F.array_distinct(F.flatten(covered))).cast("long").alias("n_hit"), items.alias("items")
    )
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, all their columns kept; rows are told apart by id and text."""
    found = find_windows(docs, item_windows(benchmark, size)).where(F.size("found") > 0)
    dirty = found.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_same")).distinct()
    on = docs["doc_id"].eqNullSafe(dirty["_id"]) & F.xxhash64(docs["text"]).eqNullSafe(dirty["_same"])
    return docs.join(dirty, on, "left_anti")


_SQL_WORDS = (
    "list_filter(string_split_regex(translate(coalesce({0}, ''), '" + _UPPER + "', '" + _LOWER + "'), "
    "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
)
ORACLE = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_SQL_WORDS.format("text")} AS w FROM benchmark),
starts AS (SELECT item_id, w, unnest(range(0, greatest(len(w) - {SIZE}, 0) + 1)) AS s FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, array_to_string(w[s + 1 : s + {SIZE}], ' ') AS win,
               least(len(w), {SIZE}) AS n FROM starts),
doc AS (SELECT doc_id, {_SQL_WORDS.format("text")} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM win),
spot AS (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM doc, sizes WHERE len(w) >= n),
hit AS (SELECT doc_id, s, win.n, item_id FROM spot
        JOIN win ON win.n = spot.n AND win.win = array_to_string(w[s + 1 : s + spot.n], ' ')),
place AS (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS p FROM hit),
covered AS (SELECT doc_id, count(*) AS n_hit FROM place GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
          FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
