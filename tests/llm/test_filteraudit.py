"""Filter orders against a walk over every document and order."""

import itertools
import random
import re

from adweave.llm import filteraudit

DOCS = "doc_id bigint, text string, lang string, mask int, digest string, part string"
LABELS = "doc_id bigint, quality int, toxic int, n int"


def failing(text, i, smaller):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = {"A"} if len(w) < 100 else set()
    out |= {"B"} if 100 * len(set(w)) < 80 * len(w) else set()
    out |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else set()
    out |= {"D"} if re.search("[#$%&*|]", text) else set()
    return out | ({"E"} if i is not None and smaller is not None and smaller < i else set())


def plain(docs, labels):
    low, out = {}, {}
    for i, text, _ in docs:
        if i is not None:
            low[text or ""] = min(i, low.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    for part in {lang or "" for _, _, lang in docs}:
        lost = dict.fromkeys("ABCDE", 0)
        rows = [(i, failing(t or "", i, low.get(t or ""))) for i, t, lang in docs if (lang or "") == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            there = list(rows)
            for step, f in enumerate(order, 1):
                gone = [r for r in there if f in r[1]]
                early = [r for r in rows if f in r[1] and r not in there]
                there = [r for r in there if f not in r[1]]
                lost[f] += len(gone)
                out[part, order, step] = [
                    len(there), len(gone), sum(f in r[1] for r in rows) - len(gone),
                    sum(r[1] == {f} for r in rows), sum(r[0] in good for r in gone),
                    sum(r[0] in toxic for r in gone)]
                assert len(early) >= out[part, order, step][2] > -1
        for (p, order, step), row in out.items():
            if p == part:
                row.append(lost[order[step - 1]])
    return sorted((*k, *v) for k, v in out.items())


def got(spark, docs, labels):
    df = spark.createDataFrame([(*d, 7, "x", "y") for d in docs], DOCS)
    out = filteraudit.audit(df, spark.createDataFrame([(*x, 1) for x in labels], LABELS))
    return sorted(map(tuple, out.select("part", "filter_order", "step", *filteraudit.COUNTS, "shapley").collect()))


def test_every_order(spark):
    rng = random.Random(3)
    pool = [" ".join(rng.choice(["a", "Bb", "CCC", "x#", f"w{k}", f"v{k}"]) if rng.random() < 0.5 else f"u{j}{k}"
                     for j in range(rng.choice([3, 99, 100, 150]))) for k in range(12)]
    docs = [(rng.randrange(40), rng.choice(pool), rng.choice(["en", "de", "", None])) for _ in range(60)]
    docs += [(None, pool[0], "en"), (None, pool[0], "en"), (1, None, None), (2, "", "de"), (2, "", "de"),
             (50, "A" * 1_000_000, "en"), (51, "a b " * 200_000, "en"), (0, "x\x0by\x85z " * 60, "fr")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 60, 2)] + [(2, 0, 1), (2, None, None), (None, 1, 1)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    want = plain(docs, labels)
    assert len(want) == 600 * 4 and got(spark, docs, labels) == want


def test_empty_tables(spark):
    assert got(spark, [], []) == []
    rows = got(spark, [(1, "a", "en")], [])
    assert len(rows) == 600 and {r[9] for r in rows} == {0, 120}
