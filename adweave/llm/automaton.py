"""Several regular expressions as one minimal automaton over bytes.

Patterns are read into trees, turned into a nondeterministic automaton, made deterministic
by subset construction and minimised by refining the partition of states. The result is one
array of transitions (state x byte class) and one array of bits: which patterns a state
accepts. Patterns know literals, escapes, classes, groups, ``|``, ``?``, ``*``, ``+`` and
counts in braces; they stand for the longest match from a place.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LANE, LANES = 256, 2048  # bytes a lane walks, lanes walked at once
ESCAPES = {"n": 10, "t": 9, "r": 13}


class _Reader:
    """A pattern as a tree of ("set", bytes), ("cat" | "alt", parts), ("rep", part, lo, hi)."""

    def __init__(self, pattern: str):
        self.p, self.at = pattern, 0

    def peek(self) -> str:
        return self.p[self.at:self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.p[self.at - 1]

    def either(self):
        parts = [self.row()]
        while self.peek() == "|":
            self.take()
            parts.append(self.row())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def row(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.counted(self.one()))
        return ("cat", parts)

    def one(self):
        c = self.take()
        if c == "(":
            if self.p.startswith("?:", self.at):
                self.at += 2
            inner = self.either()
            self.take()
            return inner
        if c == "[":
            return ("set", self.members())
        return ("set", frozenset([self.byte(c)]))

    def byte(self, c: str) -> int:
        if c != "\\":
            return ord(c)
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.p[self.at - 2:self.at], 16)
        return ESCAPES.get(c, ord(c))

    def members(self) -> frozenset:
        out, negated = set(), self.peek() == "^"
        if negated:
            self.take()
        while self.peek() != "]":
            lo = hi = self.byte(self.take())
            if self.peek() == "-" and self.p[self.at + 1] != "]":
                self.take()
                hi = self.byte(self.take())
            out.update(range(lo, hi + 1))
        self.take()
        return frozenset(range(256)) - out if negated else frozenset(out)

    def counted(self, part):
        while (c := self.peek()) in ("?", "*", "+", "{") and c:
            self.take()
            if c == "{":
                stop = self.p.index("}", self.at)
                lo, _, hi = self.p[self.at:stop].partition(",")
                part = ("rep", part, int(lo),
                        int(hi) if hi else None if "," in self.p[self.at:stop] else int(lo))
                self.at = stop + 1
            else:
                part = ("rep", part, int(c == "+"), 1 if c == "?" else None)
        return part


class _Nfa:
    """States with empty steps and steps on byte sets."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.steps: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.steps.append([])
        return len(self.empty) - 1

    def add(self, tree, start: int, backward: bool) -> int:
        """Add a tree from ``start`` on; the state after it."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.steps[start].append((tree[1], end))
            return end
        if kind == "cat":
            for part in reversed(tree[1]) if backward else tree[1]:
                start = self.add(part, start, backward)
            return start
        end = self.state()
        if kind == "alt":
            for part in tree[1]:
                self.empty[self.add(part, start, backward)].append(end)
            return end
        _, part, lo, hi = tree
        for _ in range(lo):
            start = self.add(part, start, backward)
        if hi is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(part, loop, backward)].append(loop)
            self.empty[loop].append(end)
            return end
        for _ in range(hi - lo):
            self.empty[start].append(end)
            start = self.add(part, start, backward)
        self.empty[start].append(end)
        return end

    def closures(self) -> list[int]:
        """Per state the bits of all states reached by empty steps."""
        out = []
        for s in range(len(self.empty)):
            seen, todo = {s}, [s]
            while todo:
                for t in self.empty[todo.pop()]:
                    if t not in seen:
                        seen.add(t)
                        todo.append(t)
            out.append(sum(1 << t for t in seen))
        return out


@dataclass(frozen=True)
class Automaton:
    """State 0 is the start; ``step[state * width + byte class]`` is the next state * width."""

    classes: np.ndarray
    step: np.ndarray
    accepts: np.ndarray
    width: int


def compiled(patterns: list[str], backward: bool = False, search: bool = False) -> Automaton:
    """One automaton of all patterns; bit i of ``accepts`` belongs to pattern i.

    ``backward`` reads matches from their last byte, ``search`` lets one begin anywhere.
    """
    nfa = _Nfa()
    start, ends = nfa.state(), []
    for pattern in patterns:
        first = nfa.state()
        nfa.empty[start].append(first)
        ends.append(nfa.add(_Reader(pattern).either(), first, backward))
    closure = nfa.closures()
    sets = sorted({s for steps in nfa.steps for s, _ in steps}, key=sorted)
    kinds: dict[tuple, int] = {}
    classes = np.array([kinds.setdefault(tuple(b in s for s in sets), len(kinds))
                        for b in range(256)], np.uint8)
    example = [int(np.argmax(classes == k)) for k in range(len(kinds))]
    moves = [[(k, closure[t]) for s, t in steps for k, b in enumerate(example) if b in s]
             for steps in nfa.steps]
    # Subset construction: a set of states is one integer.
    base = closure[start] if search else 0
    index, todo, table = {closure[start]: 0}, [closure[start]], []
    for now in todo:
        out, left = [base] * len(kinds), now
        while left:
            low = left & -left
            for k, t in moves[low.bit_length() - 1]:
                out[k] |= t
            left ^= low
        for t in out:
            if t not in index:
                index[t] = len(todo)
                todo.append(t)
        table.append([index[t] for t in out])
    accepts = np.array([sum(1 << i for i, e in enumerate(ends) if now >> e & 1)
                        for now in todo], np.uint32)
    return _minimal(classes, np.array(table, np.int64), accepts)


def _minimal(classes: np.ndarray, table: np.ndarray, accepts: np.ndarray) -> Automaton:
    """Merge states that no input tells apart, by refining groups until none splits."""
    _, group = np.unique(accepts, return_inverse=True)
    while True:
        _, first, finer = np.unique(np.column_stack([group, group[table]]), axis=0,
                                    return_index=True, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == group.max():
            break
        group = finer
    order = np.argsort(np.where(finer[first] == finer[0], -1, first))  # the start comes first
    place = np.empty(len(first), np.int64)
    place[order] = np.arange(len(first))
    step = place[finer[table[first[order]]]] * table.shape[1]
    return Automaton(classes, step.reshape(-1).astype(np.int32), accepts[first[order]],
                     table.shape[1])


def match_starts(a: Automaton, buf: np.ndarray, start: np.ndarray,
                 end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where matches start in each span of a buffer, and the bits of their patterns.

    ``a`` is a backward searching automaton. Spans are cut into lanes that walk at the same
    time, each from the start state; a lane whose successor ended in another state walks
    again until it meets the states it went through before, so the result is that of one
    walk over the whole span.
    """
    per = -(-(end - start) // LANE)
    span = np.repeat(np.arange(len(start)), per)
    nth = np.arange(len(span)) - np.repeat(np.cumsum(per) - per, per)
    stop = end[span] - nth * LANE
    begin = np.maximum(start[span], stop - LANE)
    found, bits, carry = [], [], 0
    for at in range(0, len(span), LANES):
        lanes = slice(at, at + LANES)
        where = stop[lanes][None, :] - 1 - np.arange(LANE)[:, None]
        inside = where >= begin[lanes][None, :]
        kind = a.classes[buf[np.maximum(where, 0)]]
        n = kind.shape[1]
        states = np.empty((LANE, n), np.int32)
        fresh = nth[lanes] == 0
        entry = np.zeros(n, np.int32)
        if not fresh[0]:
            entry[0] = carry
        now = entry
        for k in range(LANE):
            now = a.step[now + kind[k]]
            states[k] = now
        while True:
            need = np.where(fresh, 0, np.concatenate([entry[:1], states[-1, :-1]]))
            live = np.flatnonzero(need != entry)
            if not len(live):
                break
            entry, now = need, need[live]
            for k in range(LANE):
                now = a.step[now + kind[k, live]]
                new = states[k, live] != now
                live, now = live[new], now[new]
                if not len(live):
                    break
                states[k, live] = now
        carry = int(states[-1, -1])
        mask = a.accepts[states // a.width]
        k, lane = np.nonzero((mask != 0) & inside)
        found.append(where[k, lane])
        bits.append(mask[k, lane])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    pos, mask = np.concatenate(found), np.concatenate(bits)
    order = np.argsort(pos)
    return pos[order], mask[order]


def longest(a: Automaton, data: memoryview, start: int, end: int) -> int:
    """Where the longest match from ``start`` ends (0 if there is none)."""
    step, accepts, width, classes = a.step, a.accepts, a.width, a.classes
    now, last, dead = 0, 0, _dead(a)
    for at in range(start, end):
        now = step[now + classes[data[at]]]
        if accepts[now // width]:
            last = at + 1
        elif now == dead:
            break
    return last


def _dead(a: Automaton) -> int:
    """The state that nothing leaves and that accepts nothing, or -1."""
    rows = a.step.reshape(-1, a.width)
    stuck = (rows == (np.arange(len(rows)) * a.width)[:, None]).all(axis=1) & (a.accepts == 0)
    return int(np.argmax(stuck)) * a.width if stuck.any() else -1
