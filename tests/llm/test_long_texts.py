"""Long texts and pages: fair scores, bounded memory."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adweave.llm import bittable, htmltext, toxicity

SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def said():
    rng = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    clean = lambda: " ".join(rng.choice(words) for _ in range(8)) + "."
    bad = lambda: clean()[:-1] + f" {rng.choice(['vile', 'nasty', 'foul'])} stuff!"
    rows = []
    for i in range(800):
        parts, toxic = [clean() for _ in range(rng.randrange(1, 9))], int(i % 3 == 0)
        if toxic:
            parts[rng.randrange(len(parts))] = bad()
        rows.append((i, " ".join(parts), toxic))
    # 1 MB each: clean, one offensive sentence, one clean text again and again
    many = [clean() for _ in range(30_000)]
    rows += [(1000, " ".join(many), 0), (1001, " ".join(many[:15_000] + [bad()] + many[15_000:]), 1),
             (1002, (" ".join(clean() for _ in range(6)) + "\n") * 5_000, 0)]
    return rows


def test_one_megabyte_of_clean_text_is_clean(spark, said):
    df = spark.createDataFrame(said, SCHEMA + ", toxic int")
    model = toxicity.train(df, df, "doc_id < 500")
    score = {r.doc_id: r.score for r in toxicity.scores(df, model).collect()}
    assert all(len(t) > 1_000_000 for i, t, _ in said if i >= 1000)
    assert score[1000] < toxicity.THRESHOLD and score[1002] < toxicity.THRESHOLD <= score[1001]
    held = [(score[i] >= toxicity.THRESHOLD, t) for i, _, t in said if 500 <= i < 1000]
    assert sum(p for p, t in held if t) >= 0.97 * sum(t for _, t in held)
    assert sum(p for p, t in held if not t) <= 0.03 * len(held)


def test_long_texts_are_in_the_sample(spark, said):
    df = spark.createDataFrame(said, SCHEMA + ", toxic int")
    got = {(r.toxic, len(r.text)) for r in toxicity.sample(df, df, "doc_id >= 1000").collect()}
    assert got == {(0, toxicity.CLEAN_CHARS), (1, len(said[-2][1]))}


def test_a_page_of_open_tags_and_one_of_many_blocks():
    w = htmltext.train()
    deep = "<div class='a b'>x " * 100_000
    assert sum(map(len, htmltext.main_texts(w, [deep]))) >= 0
    found = htmltext.blocks(deep)
    assert len(found) == 100_000 and found[5].path is found[99_999].path  # paths are shared
    many = "".join(f"<p>word {i} of the page goes on.</p>" for i in range(30_000))
    article = "<html><body><article><p>" + "A sentence of the text. " * 20 + "</p></article></body></html>"
    alone = htmltext.main_texts(w, [article])
    assert htmltext.main_texts(w, [many, article, "</b>" * 50_000])[1:] == [*alone, ""]


def test_bit_tables_follow_the_names(spark):
    assert [bittable.bits_for(n) for n in (0, 1 << 17, 1 << 30)] == [1 << 20, 1 << 21, 1 << 27]
    names = spark.range(200_000).select(F.xxhash64("id").alias("h"))
    want = bittable.Wanted(bittable.bit_table(names))
    held = np.array([r.h for r in names.limit(5000).collect()]).view(np.uint64)
    other = np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64)
    assert want(held).all() and want(other).mean() < 0.12
