"""Conversation repair against a search over all states with whole strings."""

import hashlib
import random
import re
import zlib

import pytest

from tagloom.llm.conversations import repair

NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def least_repair(rows):
    """``(cost, audit, repaired)`` by a search over prefixes: each row is taken up with every state that can be reached."""
    # state -> (cost, audit, lines); inserts are tried until nothing improves
    put = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    best = {0: (0, "", ())}

    def offer(table, state, cost, audit, lines):
        if state not in table or (cost, audit) < table[state][:2]:
            table[state] = (cost, audit, lines)
            return True
        return False

    def inserted(table):
        moved = True
        while moved:
            moved = False
            for s, (cost, audit, lines) in list(table.items()):
                role, to = put[s]
                moved |= offer(table, to, cost + 2, audit + "I", (*lines, f"{role}:"))
        return table

    best = inserted(best)
    for role, text, fault in rows:
        new = {}
        for s, (cost, audit, lines) in best.items():
            offer(new, s, cost + 3, audit + "D", lines)
            if fault in ("b", "d"):
                continue
            extra = fault == "t"
            if (s, role[:1]) in keep:
                offer(new, keep[s, role[:1]], cost + extra, audit + "K", (*lines, f"{role}:{text}"))
            name, to = put[s]
            offer(new, to, cost + 2 + extra, audit + "R", (*lines, f"{name}:{text}"))
        best = inserted(new)
    return min((c, a, lines) for s, (c, a, lines) in best.items() if s in (0, 3))


def plain(table):
    groups = {}
    for conv, turn, role, text in table:
        mine = groups.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(key.encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub(r"[.!?]", "", text) if harm == 2 else text
        role = "user" if harm == 4 else role
        mine += [(turn, role, text)] * (2 if harm == 3 else 1)
    out = []
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, told = set(), []
        for _, role, text in rows:
            solid = SOLID.findall(text)
            told.append((role, text, "b" if not solid else "d" if (role, text) in seen else "" if solid[-1] in ".!?" else "t"))
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        faults = [f for _, _, f in told]
        initials = [r[:1] for r, _, _ in told]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = least_repair(told)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"),
                    faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def invented(n, seed, longest):
    rnd = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "User", "", None]
    texts = ["Yes.", "No!", "cut", " ", "", "\x0b", "\x1c", "é?", "a. b", "why? \n", None, "x" * 300]
    made = []
    for conv in [*range(n), None, -5]:
        turn = rnd.randint(-3, 3)
        for _ in range(rnd.randint(1, longest)):
            made.append((conv, None if rnd.random() < 0.05 else turn, rnd.choice(roles), rnd.choice(texts) or rnd.choice(["", None])))
            turn += rnd.choice([0, 1, 1, 1, 2, 5])
    return made


def frame(spark, rows):
    made = [(*r, 0, "k") for r in rows]
    return spark.createDataFrame(made, "conv_id long, turn long, role string, text string, cost int, audit string").repartition(5)


def ours(df):
    assert df.columns == NAMES
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed, longest", [(1, 9), (2, 40)])
def test_repairs_equal_a_search(spark, seed, longest):
    rows = invented(250, seed, longest)
    assert ours(repair(frame(spark, rows))) == plain(rows)


@pytest.mark.parametrize("long", [1, 3, 7])
def test_cut_conversations_give_the_same(spark, long):
    rows = invented(60, 5, 30)
    assert ours(repair(frame(spark, rows), long=long)) == plain(rows)


def test_good_conversations_stay(spark):
    rows = [(7, t, r, f"line {t}.") for t, r in enumerate(["system", *["user", "assistant"] * 8])]
    rows = [r for r in rows if zlib.crc32(f"7:{r[1]}".encode()) % 20 > 4]
    (found,) = ours(repair(frame(spark, rows)))
    assert found == plain(rows)[0]
    assert repair(frame(spark, rows).limit(0)).collect() == []


def test_lost_conversations_are_told(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    for long in (100, 0):
        (found,) = ours(repair(frame(spark, [(gone, 0, "user", "a.")]), long=long))
        assert found == (gone, 0, 0, 0, 0, 0, 0, "", nothing)


def test_one_long_conversation_is_spread(spark):
    rnd = random.Random(8)
    roles = ["user", "assistant", "user", "assistant", "system"]
    rows = [(1, t, rnd.choice(roles), rnd.choice(["Yes.", f"{t}.", "cut", ""])) for t in range(3000)]
    assert ours(repair(frame(spark, rows), long=100)) == plain(rows)


def test_given_conversations(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert ours(repair(given)) == plain([(r.conv_id, r.turn, r.role, r.text) for r in given.collect()])
