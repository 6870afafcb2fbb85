"""Spelling variants against the pairs that share a word with a letter left out."""

import random

import numpy as np
import pytest
from brute import one_edit, spellings, word_counts

from adweave.llm import spelling

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def got(spark, n):
    df = spark.createDataFrame(list(n.items()), "word string, n bigint")
    return sorted(map(tuple, spelling.variants(df).select(*COLUMNS).collect()), key=repr)


def some_words(rng, many, letters, longest):
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(5, longest))) for _ in range(many)}
    return {w: rng.choice([3, 4, 7, 20, 90]) for w in words}


@pytest.mark.parametrize("most", [1024, 6])
def test_all_pairs(spark, monkeypatch, most):
    monkeypatch.setattr(spelling, "MOST", most)  # 6: lists are taken apart to the last place
    rng = random.Random(most)
    n = some_words(rng, 500, "abé", 9) | some_words(rng, 100, "xyz", 40)
    n |= {"q" * k: k for k in range(5, 40)} | {"long" * 5000: 3, "long" * 5000 + "x": 9}
    want = spellings(n)
    assert sum(r[4] for r in want) > 1000 and len({r[2] for r in want}) < len(want)
    assert got(spark, n) == want


def test_a_hot_list(spark):
    """Thousands of words with one first half, beyond what one list may hold."""
    rng = random.Random(9)
    n = {"aaaaaa" + "".join(rng.choice("abcdefghij") for _ in range(6)): rng.randrange(3, 50) for _ in range(4000)}
    assert got(spark, n) == spellings(n)


def test_chains_and_ties(spark):
    chain = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48}
    tie = {"zzzzz": 3, "zzzzy": 9, "zzzzx": 9, "zzzz": 9}
    rows = {r[0]: r for r in got(spark, chain | tie)}
    assert [rows[w][2] for w in chain] == ["abbbb"] * 5 and rows["zzzzz"][1] == "zzzz"
    assert got(spark, chain | tie) == spellings(chain | tie)


def test_sorted_list_walk():
    rng = random.Random(1)
    for _ in range(150):
        rows = []
        for k in range(rng.randrange(1, 4)):
            rows += [(k, w) for w in sorted({"".join(rng.choice("abc"[:rng.randrange(1, 4)]) for _ in range(
                rng.randrange(1, 8))) for _ in range(rng.randrange(1, 40))})]
        length = np.array([len(w) for _, w in rows])
        chars = np.zeros((len(rows), length.max()), np.uint32)
        for i, (_, w) in enumerate(rows):
            chars[i, :len(w)] = [ord(c) for c in w]
        i, j = spelling.one_edit(chars, length, np.array([k for k, _ in rows]))
        assert sorted(zip(i.tolist(), j.tolist())) == [
            (i, j) for i in range(len(rows)) for j in range(i + 1, len(rows))
            if rows[i][0] == rows[j][0] and one_edit(rows[i][1], rows[j][1])]


def test_words_of_odd_rows(spark):
    rows = [(1, "Straße STRASSE naïve Ünïcode×x÷y short four"), (1, "Straße STRASSE naïve Ünïcode×x÷y short four"),
            (None, "straße straSSE naïve"), (2, None), (3, ""), (4, "a" * 100_000), (5, "A" * 100_000),
            (6, "a" * 100_000 + "1" + "b" * 7), (7, "Áccent áccent áccent ÁCCENT")]
    rows += [(i, "alpha beta gamma delta epsilon " * 3) for i in range(100, 200)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, n int, word string")
    out = {r.word: r.n for r in spelling.vocabulary(df).collect()}
    assert out == word_counts(rows) and sum(out.values()) > 1000
    assert got(spark, {}) == [] and spelling.vocabulary(df.where("false")).count() == 0
