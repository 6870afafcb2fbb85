"""Names of spans: equal for equal spans, different for texts built to collide."""


import numpy as np
from brute import repeated_bytes
from test_neardup import thue_morse

from adweave.llm import langid, quality, sentences, substrings, textbatch as T


def test_equal_spans_have_equal_names(monkeypatch):
    rng = np.random.default_rng(3)
    half = rng.integers(0, 256, 1500, dtype=np.uint8)
    names = T.mix(np.arange(700, dtype=np.uint64))
    s = rng.integers(0, 600, 80)
    e = s + rng.integers(0, 100, 80)
    for summed in (1 << 22, 64):  # sums of one block, and of many
        monkeypatch.setattr(T, "_SUMMED", summed)
        for which in (0, 1):
            h = T.Hashes(np.concatenate([half, half]), which)
            assert (h.span(s, e) == h.span(s + 1500, e + 1500)).all()
            assert (h.every(50)[:1400] == h.every(50)[1500:2900]).all()
            q = T.Hashes.of(np.concatenate([names, names]), which)
            assert (q.span(s, e) == q.span(s + 700, e + 700)).all()
            plain = []
            for a, b in zip(s.tolist(), e.tolist()):
                x, y = (sum((int(half[k]) + 1) * pow(base, k - a, 2**31 - 1) for k in range(a, b)) % (2**31 - 1)
                        for base in T._BASE[which])
                plain.append(int(T.mix(np.array([x << 32 | y], np.uint64))[0]))
            assert h.span(s, e).tolist() == plain


def test_families_that_collide_modulo_powers_of_two(spark):
    a, b = thue_morse(1024), thue_morse(1024, True)
    rows = [(1, f"{a}\n{b}\n{a}\n"), (2, f"First one. {a} {b}. Shared."), (3, f"Own one. {b} {a}. Shared."),
            (4, a), (5, b), (6, a[:300] + b[:300])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert quality.ledger(df).where("doc_id = 1").first().n_dup_lines == 1
    kept = {r.doc_id: r.n_removed for r in sentences.removals(df).collect()}
    assert kept[2] == kept[3] == 0
    out = sorted(map(tuple, substrings.removals(df).collect()), key=repr)
    assert out == repeated_bytes(rows)


def test_a_language_of_long_texts_is_learned(spark):
    words = {"de": "der die das und nicht eine über", "en": "the and of not with which over"}
    rows = [(i, " ".join(words[lang].split()[k % 7] for k in range(n + i)), lang)
            for lang, n in (("de", 6000), ("en", 60)) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.train(df)
    assert model.languages == ["de", "en"]
    assert {r.lang_pred for r in langid.predict(df.where("lang = 'de'"), model).collect()} == {"de"}


def test_broadcasts_need_no_class_of_the_package(spark, monkeypatch):
    """What tasks get by value is arrays, numbers and texts."""
    seen = []
    real = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, v: seen.append(v) or real(self, v))
    df = spark.createDataFrame([(1, "a few words", "en")], "doc_id bigint, text string, lang string")
    langid.predict(df, langid.train(df)).collect()

    def plain(v):
        if isinstance(v, (list, tuple)):
            return all(map(plain, v))
        return isinstance(v, (np.ndarray, int, float, str, bytes, type(None)))

    assert seen and all(map(plain, seen))
