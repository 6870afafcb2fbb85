import random

import numpy as np
from brute import near_groups, shingle_set

from adweave.llm import neardup as N
from adweave.llm import textbatch as T
from adweave.llm.components import components

SCHEMA = "doc_id bigint, text string"


def got(spark, rows, schema=SCHEMA):
    out = N.groups(spark.createDataFrame(rows, schema)).select(
        "doc_id", "n_shingles", "component_id", "kept").collect()
    return sorted((tuple(r) for r in out), key=repr)


def edited(rng, base, edits, words):
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = rng.choice(words)
    return w


def test_edited_copies_match_all_pairs(spark):
    """Copies of copies around the threshold, shared passages, several hubs."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    rows, passage = [], text(30)
    for _ in range(3):
        base = text(100)
        made = [base]
        for _ in range(45):
            made.append(edited(rng, rng.choice(made[:12]), rng.randrange(0, 7), words))
        rows += [" ".join(m) for m in made]
    rows += [" ".join(passage + text(rng.randrange(1, 40))) for _ in range(40)]
    rows += [" ".join(made[5][:rng.randrange(60, 100)]) for _ in range(20)]
    rng.shuffle(rows)
    rows = [(7 * i + 3, t) for i, t in enumerate(rows)]
    want = near_groups(rows)
    assert 10 < sum(k for *_, k in want) < len(rows) - 60
    assert got(spark, rows) == sorted(want, key=repr)


def test_edges(spark):
    long = " ".join(f"x{i % 5000}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one  TWO\n"), (6, "one two three"),
            (7, "a b c d e"), (8, "A B C D E"), (9, "a b c d e f"), (10, long), (11, long + " end"),
            (12, "é É"), (13, "É é")]
    assert got(spark, rows) == sorted(near_groups(rows), key=repr)
    assert got(spark, []) == []
    # Repeated rows and ids, ids that are null, and columns with names used inside.
    text = "p q r s t u v w"
    again = [(5, text, "c", 1), (5, text, "c", 1), (None, text, "c", 1), (None, "only here now", "c", 1),
             (5, "something else entirely for this one", "c", 1)]
    out = got(spark, again, SCHEMA + ", cls string, n bigint")
    assert out == sorted([(5, 4, 5, True), (5, 4, 5, True), (None, 4, 5, False), (None, 1, None, True),
                          (5, 2, 5, True)], key=repr)


def test_one_of_each_group_stays(spark):
    text = "p q r s t u v w"
    rows = [(5, text, 1), (5, text, 1), (2, text, 1), (None, text, 1), (9, "", 1), (None, None, 1),
            (7, "some other text of this sort", 1)]
    kept = N.firsts(spark.createDataFrame(rows, SCHEMA + ", n_chars int")).select("doc_id", "text")
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [(2, text), (9, ""), (None, None), (7, "some other text of this sort")], key=repr)


def test_signature_follows_the_element_wise_algorithm():
    """The same values as walking one permutation after another with early stopping."""
    def plain(elements, m):
        sig, top = [float("inf")] * m, m
        for x in elements:
            perm = list(range(m))
            for j in range(m):
                if all(v < j for v in sig):
                    break
                r = int(T.mix(np.array([(x + (j + 1) * 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])
                k = j + ((r & 0xFFFFFFFF) * (m - j) >> 32)
                perm[j], perm[k] = perm[k], perm[j]
                sig[perm[j]] = min(sig[perm[j]], j + (r >> 32) / 2**32)
        return sig

    rng = np.random.default_rng(0)
    for n in (1, 3, 20, 200):
        x = rng.integers(0, 2**63, n, dtype=np.uint64)
        mine = N.signatures(x, np.zeros(n, np.int64), 1, 16)[0]
        assert [int(v) / 2**32 for v in mine] == plain([int(v) for v in x], 16)


def test_signatures_estimate_similarity():
    a = {f"{i}" for i in range(400)}
    b = {f"{i}" for i in range(60, 460)}
    name = {v: T.mix(np.array([i], np.uint64))[0] for i, v in enumerate(sorted(a | b))}
    x = np.array([name[v] for v in a] + [name[v] for v in b], np.uint64)
    row = np.repeat([0, 1], [len(a), len(b)])
    sig = N.signatures(x, row, 2, 1024)
    assert abs((sig[0] == sig[1]).mean() - len(a & b) / len(a | b)) < 0.05


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(200, 300)] \
        + [(50, 51), (51, 52), (52, 50), (7, 7), (None, 3), (60, 61), (61, 60)]
    out = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    want = {i: 100 for i in range(101, 161)} | {i: 1 for i in range(200, 300)} | {51: 50, 52: 50, 61: 60}
    assert out == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_short_texts_are_one_shingle():
    assert shingle_set("a b") == {("a", "b")}


def test_a_large_group_costs_few_comparisons_a_member(spark, monkeypatch):
    """Copies whose edits put them in many components of one bucket, against all pairs."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(60)]
    rows = [" ".join(edited(rng, base, rng.randrange(0, 8), words)) for _ in range(700)]
    rows += [" ".join(base[:38] + [rng.choice(words) for _ in range(22)]) for _ in range(300)]
    rows = list(enumerate(rows))
    compared = []
    plain = N._linked
    monkeypatch.setattr(N, "_linked", lambda pairs, sets: compared.append(pairs.count()) or plain(pairs, sets))
    want = near_groups(rows)
    assert 100 < sum(k for *_, k in want) < 900
    assert got(spark, rows) == sorted(want, key=repr)
    assert sum(compared) < 60 * len(rows) < len(rows) ** 2 / 10


def thue_morse(n, flip=False):
    return "".join("ab"[bin(k).count("1") % 2 ^ flip] for k in range(n))


def test_texts_that_collide_modulo_a_power_of_two(spark):
    a, b = thue_morse(1024), thue_morse(1024, True)
    rows = [(1, a), (2, b), (3, a), (4, f"{a} {b} {a} {b} {a} x"), (5, f"{b} {a} {b} {a} {b} x")]
    assert got(spark, rows) == sorted(near_groups(rows), key=repr)
