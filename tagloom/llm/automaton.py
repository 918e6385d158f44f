"""One deterministic automaton for several byte patterns: parse, subset construction, minimisation, scan.

Patterns use literals, ``\\xHH``, classes ``[a-z]``, groups, ``|``, ``?``, ``*``, ``+``, ``{m}`` and ``{m,n}``/``{m,}``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class _Nfa:
    """States are numbers; ``steps[s]`` are (set of bytes, target), ``free[s]`` the targets without a byte."""

    steps: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1


class _Pattern:
    """Recursive descent; each part is built between two states, and may be built again for a repeat."""

    def __init__(self, text: str, ignore_case: bool):
        self.text, self.at, self.ignore_case = text, 0, ignore_case

    def parse(self):
        tree = self.choice()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} in {self.text!r}")
        return tree

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def choice(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return ("choice", parts)

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeat())
        return ("sequence", parts)

    def repeat(self):
        part = self.atom()
        while self.peek() and self.peek() in "?*+{":
            c = self.take()
            low, high = {"?": (0, 1), "*": (0, None), "+": (1, None), "{": (0, 0)}[c]
            if c == "{":
                end = self.text.index("}", self.at)
                first, comma, last = self.text[self.at : end].partition(",")
                low, high = int(first), (int(last) if last else None) if comma else int(first)
                self.at = end + 1
            part = ("repeat", part, low, high)
        return part

    def atom(self):
        c = self.take()
        if c == "(":
            tree = self.choice()
            self.take()
            return tree
        if c == "[":
            members: set[int] = set()
            while self.peek() != "]":
                a = self.byte(self.take())
                if self.peek() == "-" and self.text[self.at + 1] != "]":
                    self.take()
                    members |= set(range(a, self.byte(self.take()) + 1))
                else:
                    members.add(a)
            self.take()
        else:
            members = {self.byte(c)}
        if self.ignore_case:
            members |= {x ^ 32 for x in members if chr(x).isalpha() and x < 128}
        return ("bytes", frozenset(members))

    def byte(self, c: str) -> int:
        if c != "\\":
            return ord(c)
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)


def _build(nfa: _Nfa, tree, start: int) -> int:
    """Add ``tree`` from ``start`` on; returns its end."""
    kind = tree[0]
    if kind == "bytes":
        end = nfa.state()
        nfa.steps[start].append((tree[1], end))
        return end
    if kind == "sequence":
        for part in tree[1]:
            start = _build(nfa, part, start)
        return start
    if kind == "choice":
        end = nfa.state()
        for part in tree[1]:
            head = nfa.state()
            nfa.free[start].append(head)
            nfa.free[_build(nfa, part, head)].append(end)
        return end
    _, part, low, high = tree
    for _ in range(low):
        start = _build(nfa, part, start)
    end = nfa.state()
    nfa.free[start].append(end)
    if high is None:
        head = nfa.state()
        nfa.free[start].append(head)
        last = _build(nfa, part, head)
        nfa.free[last] += [head, end]
    else:
        for _ in range(high - low):
            start = _build(nfa, part, start)
            nfa.free[start].append(end)
    return end


@dataclass
class Automaton:
    """``table[state * 256 + byte]`` is the next state, ``accepts[state]`` the bits of the rules that end there.

    State 0 is the start. ``dead`` is the state that nothing leaves (-1 in a searching automaton), ``resets``
    are the bytes that lead back to the start from every state.
    """

    table: np.ndarray
    accepts: np.ndarray
    dead: int
    resets: np.ndarray


def compile_rules(patterns: list[tuple[str, bool]], search: bool) -> Automaton:
    """The minimal automaton of all rules ``(pattern, ignore case)``. With ``search`` a rule may begin at any byte,
    else at the first."""
    nfa = _Nfa()
    start = nfa.state()
    ends: dict[int, int] = {}
    for k, (text, ignore_case) in enumerate(patterns):
        head = nfa.state()
        nfa.free[start].append(head)
        end = _build(nfa, _Pattern(text, ignore_case).parse(), head)
        ends[end] = ends.get(end, 0) | 1 << k

    def closed(states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in nfa.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    # Bytes that no step tells apart are one class; subsets are built for one byte of each.
    sets = list({members for steps in nfa.steps for members, _ in steps})
    marks = [tuple(b in members for members in sets) for b in range(256)]
    classes = {m: k for k, m in enumerate(dict.fromkeys(marks))}
    of_byte = np.array([classes[m] for m in marks])
    sample = {classes[m]: b for b, m in enumerate(marks)}

    first = closed([start])
    numbers, order, rows = {first: 0}, [first], []
    for subset in order:  # grows while it is walked
        steps = [x for s in subset for x in nfa.steps[s]]
        row = []
        for k in range(len(classes)):
            found = closed([t for members, t in steps if sample[k] in members])
            found = found | first if search else found
            if found not in numbers:
                numbers[found] = len(order)
                order.append(found)
            row.append(numbers[found])
        rows.append(row)
    accepts = np.array([sum({ends[s] for s in subset if s in ends}) for subset in order], dtype=np.int64)
    table = np.array(rows, dtype=np.int64)

    block = np.unique(accepts, return_inverse=True)[1]
    while True:  # split blocks until states of a block agree on the blocks they lead to
        signature = np.c_[block, block[table]]
        finer = np.unique(signature, axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    # Number the blocks by their first state, so that the start is 0.
    firsts = np.sort(np.unique(block, return_index=True)[1])
    rename = np.empty(len(firsts), dtype=np.int64)
    rename[block[firsts]] = np.arange(len(firsts))
    small = rename[block[table[firsts]]][:, of_byte]
    dead = np.flatnonzero((small == np.arange(len(firsts))[:, None]).all(axis=1) & (accepts[firsts] == 0))
    return Automaton(
        small.astype(np.int32).reshape(-1), accepts[firsts].astype(np.uint32),
        int(dead[0]) if len(dead) and not search else -1, np.flatnonzero((small == 0).all(axis=0)),
    )


def scan(auto: Automaton, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bits of all rules that end somewhere in each piece ``data[starts[i]:ends[i]]``; every byte is read once.

    The pieces advance side by side, longest first, so that one array operation moves all that are not over.
    """
    length = ends - starts
    order = np.argsort(-length, kind="stable")
    at, found = starts[order], np.zeros(len(starts), dtype=np.uint32)
    state = np.zeros(len(starts), dtype=np.int32)
    alive = np.searchsorted(-length[order], -np.arange(int(length.max(initial=0))), side="left")
    for t, k in enumerate(alive.tolist()):
        state[:k] = auto.table[(state[:k] << 8) + data[at[:k] + t]]
        found[:k] |= auto.accepts[state[:k]]
    out = np.empty_like(found)
    out[order] = found
    return out
