"""Every run of consecutive sentences counts, whatever its number of words."""

import hashlib
import random
import re
from collections import defaultdict

from adweave.llm import sentences

SCHEMA = "doc_id bigint, text string"


def parted(text):
    """Words of every sentence, and where each sentence begins."""
    out, begin, before = [], [], None
    for m in re.finditer(r"\S+", text):
        stops = len(re.findall(r"[.!?\n]", text[:m.start()]))
        if stops != before:
            out.append([])
            begin.append(m.start() if begin else 0)
        out[-1].append(m[0].lower())
        before = stops
    return [tuple(x) for x in out], begin


def all_runs(rows):
    """(doc_id, removed sentences, digest of the rest), from all runs of two or more sentences."""
    where = defaultdict(list)
    for i, text in rows:
        said, _ = parted(text)
        for a in range(len(said)):
            for b in range(a + 1, len(said)):
                where[tuple(said[a:b + 1])].append((i, a, b))
    gone = defaultdict(set)
    for places in where.values():
        for i, a, b in sorted(places)[1:]:
            gone[i].update(range(a, b + 1))
    out = []
    for i, text in rows:
        said, begin = parted(text)
        stop = begin[1:] + [len(text)]
        kept = "".join(text[a:b] for k, (a, b) in enumerate(zip(begin, stop)) if k not in gone[i])
        out.append((i, len(gone[i]), hashlib.sha256((kept if said else text).encode()).hexdigest()))
    return sorted(out)


def got(spark, rows):
    out = sentences.removals(spark.createDataFrame(rows, SCHEMA))
    return sorted(map(tuple, out.select("doc_id", "n_removed", "kept_sha256").collect()))


def said(name, n):
    return " ".join(f"{name}{k}" for k in range(n)) + "."


def test_the_end_of_a_repeated_passage_goes(spark):
    passage = " ".join([said("a", 30), said("b", 12), said("c", 5)])
    rows = [(1, passage), (2, "Own start here. " + passage + " Own end."), (3, passage)]
    assert [r[1] for r in got(spark, rows)] == [0, 3, 3]


def test_short_runs_go(spark):
    rows = [(1, "Call us today. Ask for Ann. One more."), (2, "No. CALL us\ttoday. Ask for Ann. Bye."),
            (3, "Ask for Ann. Call us today.")]
    assert [r[1] for r in got(spark, rows)] == [0, 2, 0]
    assert got(spark, rows) == all_runs(rows)


def test_lines_broken_elsewhere_still_match(spark):
    words = [f"w{k}" for k in range(24)]
    rows = [(1, " ".join(words[:12]) + "\n" + " ".join(words[12:]) + ". Short one."),
            (2, " ".join(words[:20]) + "\n" + " ".join(words[20:]) + ". Own end.")]
    assert [r[1] for r in got(spark, rows)] == [0, 2]


def test_as_all_runs(spark):
    rng = random.Random(4)
    pool = [said(f"s{k}x", rng.randrange(1, 30)) for k in range(25)]
    rows = [(i, " ".join(rng.choice(pool) if rng.random() < 0.8 else said(f"own{i}x{k}y", 3)
                         for k in range(rng.randrange(0, 25)))) for i in range(60)]
    want = all_runs(rows)
    assert sum(r[1] > 0 for r in want) > 30
    assert got(spark, rows) == want
