"""Secrets in texts, found by one automaton of all rules.

The rules' expressions become one minimal automaton that reads bytes backward: one pass over
a text tells at which bytes a match of which rule starts. Per rule the leftmost start gives
the first match, an automaton of the rule alone walks its bytes to the longest end, and the
next match is the leftmost one from there on. A match that fails its rule's test is dropped
and not tried again. Rules are ASCII, so bytes suffice; positions are code points.

Null and empty texts have no spans. Rows are judged alone: repeated rows and ties get equal
results, an empty table gives an empty result. Memory follows the longest text; columns of
the input that are not asked for, or are named ``spans``, are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from adweave.llm import automaton as A, textbatch as T

SPANS = "array<struct<start:int,ord:int,kind:string,end:int>>"


@dataclass(frozen=True)
class Rule:
    """What proposes a span, and how long it must be, less a head that does not count."""

    name: str
    pattern: str
    least: int
    head: str = ""
    base: bool = True

    def keeps(self, match: bytes) -> bool:
        return len(match) - re.match(self.head.encode(), match).end() >= self.least


def any_case(words: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


# A name, a sign of assignment, and what stands before the value.
HEAD = any_case("(?:password|passwd|secret|token|api_?key)") + r"""["']?\x20*[:=]\x20*["']?"""
# In the order in which spans of one start are listed. A run of hex digits has no head that
# makes its starts rare, so its expression counts; maximal runs are the same either way.
RULES = (
    Rule("assign", HEAD + "[A-Za-z0-9+/_.=-]+", 8, HEAD),
    Rule("access", "AKIA[A-Z0-9]+", 16),
    Rule("hex", "[0-9a-f]{32,}", 32),
    Rule("github", "gh[opsu]_[A-Za-z0-9]+", 40, base=False),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 15, base=False),
    Rule("google", "AIza[A-Za-z0-9_-]+", 39, base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30, base=False),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 20, base=False),
)


@lru_cache
def automata(rules: tuple[Rule, ...]) -> tuple[A.Automaton, list[A.Automaton]]:
    """The backward one of all rules, and a forward one of each."""
    return (A.compiled([r.pattern for r in rules], backward=True, search=True),
            [A.compiled([r.pattern]) for r in rules])


def spans(p: T.Piece, rules: tuple[Rule, ...], built: tuple) -> list[list[dict]]:
    """Per row of a piece its spans, by start and rule."""
    every, single = built
    pos, bits = A.match_starts(every, p.buf, p.start, p.end)
    data, found = memoryview(p.buf), []
    for i, rule in enumerate(rules):
        own = pos[bits >> np.uint32(i) & np.uint32(1) != 0]
        stops = p.end[p.row_of(own)]
        k = 0
        while k < len(own):
            s = int(own[k])
            e = A.longest(single[i], data, s, int(stops[k]))
            if rule.keeps(bytes(data[s:e])):
                found.append((s, i, e))
            k = int(np.searchsorted(own, e))
    out: list[list[dict]] = [[] for _ in range(p.n)]
    if not found:
        return out
    found.sort()
    # Code points up to every border, counted border by border.
    row = p.row_of(np.array([s for s, _, _ in found])).tolist()
    edge = np.unique(np.array([x for s, _, e in found for x in (s, e)] + [int(p.start[r]) for r in row]))
    chars = np.add.reduceat(np.append(~T.CONTINUES[p.buf], False), edge, dtype=np.int64)
    upto = dict(zip(edge.tolist(), (np.cumsum(chars) - chars).tolist()))
    for r, (s, i, e) in zip(row, found):
        zero = upto[int(p.start[r])]
        out[r].append({"start": upto[s] - zero, "ord": i, "kind": rules[i].name, "end": upto[e] - zero})
    return out


def findings(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
             rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``keep`` columns and ``spans``: array of (start, rule number, kind, end) by start.

    ``pii.redacted`` turns a kept text with its spans into one without secrets.
    """
    keep = [c for c in (["doc_id"] if keep is None else keep) if c.lower() != "spans"]
    slim = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    built = docs.sparkSession.sparkContext.broadcast(_plain(automata(rules)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, single = built.value
        ready = A.Automaton(*every), [A.Automaton(*s) for s in single]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("ord", pa.int32()),
                                   ("kind", pa.string()), ("end", pa.int32())]))
        for p in T.pieces(batches, "__text"):
            yield pa.RecordBatch.from_arrays(
                [p.column(c) for c in keep] + [pa.array(spans(p, rules, ready), kind)],
                [*keep, "spans"])

    schema = ", ".join([f"`{n}` {t}" for n, t in slim.drop("__text").dtypes] + [f"spans {SPANS}"])
    return slim.mapInArrow(run, schema)


def _plain(built: tuple) -> tuple:
    """Arrays and numbers only, so that a broadcast needs no class of this package."""
    def fields(a: A.Automaton) -> tuple:
        return a.classes, a.step, a.accepts, a.width

    return fields(built[0]), [fields(a) for a in built[1]]


def listed(only_base: bool) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    base = ", ".join(f"'{r.name}'" for r in RULES if r.base)
    which = f"filter(spans, s -> s.kind in ({base}))" if only_base else "spans"
    return F.expr(f"array_join(transform({which}, "
                  "s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")
