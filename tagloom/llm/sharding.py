"""Sharding by balanced label propagation, in DataFrame operations only.

Documents with equal texts are linked. Each starts in the shard that a hash of its id names; rounds of propagation then move
documents to the shard that holds most of their group, as far as the target's quota allows, and a last step
evens the counts out exactly (the law ``rows``: no two shards differ by more than one row), giving away
unlinked documents first.

The rounds work on units, the documents of one group in one shard, with their number: a group has at most ``shards`` units
however many copies it has, so a group with a third of all rows is neither a large key nor a large row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import gapless, stored

SHARDS = 16
ROUNDS = 4
MILLION = 1_000_000


def _amounts(df: DataFrame, by: str, n: str = "n") -> dict[int, int]:
    """Sums for each shard: at most as many rows as shards."""
    return {int(r[by]): int(r["n"]) for r in df.groupBy(by).agg(F.sum(n).alias("n")).collect()}


def _by_shard(shard: Column, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), shard + 1)


def propagate(units: DataFrame, capacity: int, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Rounds of balanced label propagation over ``units`` (group columns ``g1, g2``, first shard ``home``, current
    shard ``at``, documents ``n``); a shard takes at most about ``capacity`` linked documents. Unlinked ones do not
    count: they make room in the last step."""
    for k in range(rounds):
        per_shard = Window.partitionBy("g1", "g2", "at")
        held = units.withColumn("_held", F.sum("n").over(per_shard))
        # Ties go by a hash, so that no shard is everybody's wish.
        best = F.max(F.struct("_held", F.xxhash64("g1", "g2", "at").alias("_t"), "at")).over(Window.partitionBy("g1", "g2"))
        wish = stored(held.select("g1", "g2", "home", "at", "n", best["at"].alias("to")), f"wishes-{k}")
        movers = wish.where(F.col("at") != F.col("to"))
        now, into, out = _amounts(wish, "at"), _amounts(movers, "to"), _amounts(movers, "at")
        if not into:
            break
        quota = []
        for s in range(shards):
            free = capacity - now.get(s, 0) + out.get(s, 0)
            quota.append(int(MILLION * min(1.0, max(0.0, free / max(into.get(s, 0), 1)))))
        lucky = F.pmod(F.xxhash64(F.lit(k), "g1", "g2"), F.lit(MILLION)) < _by_shard(F.col("to"), quota)
        units = stored(
            wish.select("g1", "g2", "home", F.when(lucky, F.col("to")).otherwise(F.col("at")).alias("at"), "n"), f"units-{k}"
        )
    return units


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    ``size`` is the UTF-8 length plus 1, a null text counts as empty (and as equal to an empty one); ids may be null or repeat.
    An empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    nodes = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("g1"), F.xxhash64(F.lit(7), text, F.octet_length(text)).alias("g2"),
        F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("home"),
    )
    nodes = stored(nodes, "nodes")
    all_units = nodes.groupBy("g1", "g2", "home").agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy("g1", "g2"))
    all_units = stored(all_units.withColumn("_all", whole), "all-units")
    units = all_units.where(F.col("_all") > 1).select("g1", "g2", "home", F.col("home").alias("at"), "n")
    units = propagate(stored(units, "units"), nodes.count() // shards, shards, rounds)

    placed = nodes.join(units.select("g1", "g2", "home", "at"), ["g1", "g2", "home"], "left")
    placed = placed.select(
        "doc_id", "size", "text_crc32", "g1", F.coalesce("at", "home").alias("at"), F.col("at").isNotNull().alias("linked")
    )
    placed = stored(placed, "placed")

    # Even out: what a shard has too much goes, unlinked rows first, to the shards that have too little.
    have = {(r["at"], r.linked): r.n for r in placed.groupBy("at", "linked").agg(F.count("*").alias("n")).collect()}
    count = [have.get((s, False), 0) + have.get((s, True), 0) for s in range(shards)]
    total = sum(count)
    richest = sorted(range(shards), key=lambda s: (-count[s], s))
    wanted = [total // shards] * shards
    for s in richest[: total % shards]:
        wanted[s] += 1
    give = [max(0, count[s] - wanted[s]) for s in range(shards)]
    give_single = [min(give[s], have.get((s, False), 0)) for s in range(shards)]
    give_linked = [give[s] - give_single[s] for s in range(shards)]
    before, taken = [], 0
    for s in range(shards):
        before.append(taken)
        taken += give[s]
    takers = [(s, wanted[s] - count[s]) for s in range(shards) if wanted[s] > count[s]]

    mixed = F.xxhash64(F.lit(3), "doc_id", "g1")
    numbered = gapless(placed, ["at", "linked"], [F.col("g1"), F.col("doc_id")], mixed, "_k", total)
    limit = F.when(F.col("linked"), _by_shard(F.col("at"), give_linked)).otherwise(_by_shard(F.col("at"), give_single))
    # The number of a leaving row among all leaving rows tells where it goes.
    turn = F.col("_k") + _by_shard(F.col("at"), before) + F.when(F.col("linked"), _by_shard(F.col("at"), give_single)).otherwise(0)
    goes, start = F.col("at"), 0
    for s, n in takers:
        goes = F.when((turn >= start) & (turn < start + n), F.lit(s)).otherwise(goes)
        start += n
    shard = F.when(F.col("_k") < limit, goes).otherwise(F.col("at")).cast("int")
    sharded = stored(numbered.select("doc_id", "size", "text_crc32", shard.alias("shard")), "sharded")
    slotted = gapless(sharded, ["shard"], [F.col("doc_id"), F.col("text_crc32")], F.xxhash64("doc_id", "text_crc32"), "slot", total)
    return slotted.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
