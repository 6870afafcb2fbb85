"""Operators that look for the same passage elsewhere, against plain versions."""

import random

from brute import contamination, repeated_bytes, sentence_spans

from adweave.llm import decontam, sentences, substrings

SCHEMA = "doc_id bigint, text string"


def corpus(seed=5):
    """Texts with shared passages, copies, periodic and odd texts."""
    rng = random.Random(seed)
    words = [f"wo{i}" for i in range(500)] + ["é", "ñandú", "日本"]
    talk = lambda n: " ".join(
        rng.choice(words) + rng.choice(["", "", "", "", ".", "!", "\n"]) for _ in range(n))
    passages = [talk(n) for n in (12, 30, 60, 90)]
    rows = []
    for i in range(60):
        text = talk(rng.randrange(0, 60))
        for _ in range(rng.randrange(0, 3)):
            text += rng.choice([" ", "\n", ". "]) + rng.choice(passages) + " " + talk(rng.randrange(0, 20))
        rows.append((i, text))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, passages[3][20:]), (103, rows[7][1] + " more")]
    rows += [(200, None), (201, ""), (202, "a" * 199), (203, "a" * 200), (204, "a" * 900),
             (205, "ab" * 300), (206, "é" * 150), (207, "x" + "é" * 150), (208, "One. Two. " * 60),
             (209, " \n. ! "), (210, "\n".join(["Same line here."] * 40)), (211, "日本語。" * 80),
             (None, passages[2] + " tail words"), (212, talk(30_000) + passages[1])]
    return rows, passages


def test_repeated_bytes(spark):
    rows, _ = corpus()
    rows += [(100, rows[3][1]), (100, "something else " * 3)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", k int, n_bytes string")
    out = substrings.removals(df, kept=True)
    got = sorted((tuple(r)[:5] for r in out.collect()), key=repr)
    want = repeated_bytes(rows)
    assert sum(r[2] > 0 for r in want) > 25
    assert got == want
    assert substrings.removals(df.limit(0)).count() == 0
    one = substrings.removals(spark.createDataFrame([(1, "short")], SCHEMA)).first()
    assert (one.n_removed, one.n_spans, one.n_bytes) == (0, 0, 5)


def test_sentence_spans(spark):
    rows, _ = corpus(6)
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", key int")
    out = sentences.removals(df, kept=True)
    got = sorted((tuple(r)[:6] for r in out.collect()), key=repr)
    want = sentence_spans(rows)
    assert sum(r[3] > 0 for r in want) > 25
    assert got == want
    assert sentences.removals(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "A b. " * 30)] * 2 + [(2, "Nothing like it. At all.")], SCHEMA)
    both = sorted(map(tuple, sentences.removals(twice).select("doc_id", "n_removed").collect()))
    assert both[0] == both[1] and both[2] == (2, 0)


def test_contamination(spark):
    rows, passages = corpus(7)
    items = [(1, passages[1]), (2, passages[2]), (3, passages[1] + " " + passages[3]), (4, "wo1 WO2"),
             (5, "é"), (6, None), (7, " .!"), (8, "not, in any document of this corpus at all, really not one"),
             (9, "One two One two One two One two One two one"), (10, "one. TWO"), (None, passages[0])]
    rows = [(i, t) for i, t in rows] + [(3, rows[3][1])]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", h int, words string")
    bench = spark.createDataFrame([(*r, 2) for r in items], "item_id bigint, text string, size int")
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r.item_ids))
                  for r in decontam.hits(docs, bench).collect()), key=repr)
    want = contamination(rows, [(i, t) for i, t in items if i is not None])
    assert got == want
    assert sum(r[2] > 0 for r in want) > 20
    assert decontam.hits(docs.limit(0), bench).count() == 0
    none = decontam.hits(docs.limit(5), bench.limit(0)).collect()
    assert len(none) == 5 and all(r.n_hit == 0 and not r.item_ids for r in none)
