"""Registered queries: checks, contract columns, held-out accuracy, the pipeline."""

import hashlib
import html
import json
import re
import zlib

import public_tokenizers
import pytest
from brute import contamination, near_groups, repeated_bytes, sentence_spans
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from adweave.llm import pii, toxicity
from adweave.llm.queries import fold
from adweave.llm.registry import CHECKS, QUERIES
from tools.compare import compare, duck

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("select doc_id, text from documents").fetchall()


def rows(spark, sf_dir, name, *columns):
    out = entry.queries()[name](spark, sf_dir)
    return sorted(map(tuple, out.select(*(columns or out.columns)).collect()), key=repr)


def test_every_operator_and_the_pipeline_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(CHECKS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_check(spark, sf_dir, con, name):
    assert compare(entry.queries()[name](spark, sf_dir), con, CHECKS[name]) is None


def test_passages_near_copies_and_contamination(spark, sf_dir, con, docs):
    assert rows(spark, sf_dir, "op3_repeated_substrings") == repeated_bytes(docs)
    assert rows(spark, sf_dir, "op10_near_duplicates") == sorted(near_groups(docs), key=repr)
    assert rows(spark, sf_dir, "op7_sentence_spans") == sentence_spans(docs)
    items = con.execute("select item_id, text from benchmark").fetchall()
    want = sorted(((i, n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0)
                   for i, n, hit, ids in contamination(docs, items)), key=repr)
    assert rows(spark, sf_dir, "op2_decontamination") == want


def test_tokens(spark, sf_dir, docs):
    want = []
    for i, t in docs:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert rows(spark, sf_dir, "op8_bpe") == sorted(want, key=repr)


def test_held_out_accuracy(spark, sf_dir, con):
    lang = dict(con.execute("select doc_id, lang from documents where lang is not null").fetchall())
    got = rows(spark, sf_dir, "op4_language", "doc_id", "held_out", "lang_pred", "score")
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= s <= 1 for i, h, _, s in got)
    held = [(lang[i], p) for i, h, p, _ in got if h and i in lang]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    toxic = dict(con.execute("select doc_id, toxic from labels").fetchall())
    got = rows(spark, sf_dir, "op6_toxicity", "doc_id", "held_out", "score", "predicted")
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) and p == (s >= 0.7) for i, h, s, p in got)
    held = [(toxic[i], p) for i, h, _, p in got if h and i in toxic]
    assert sum(p for t, p in held if not t) <= 0.03 * len(held)


def test_toxic_texts_are_found(spark):
    """Recall and false alarms on held-out rows, on tables large enough to learn from."""
    folder = "/root/testdata/sf0.1"
    toxic = dict(duck(folder).execute("select doc_id, toxic from labels").fetchall())
    got = rows(spark, folder, "op6_toxicity", "doc_id", "held_out", "predicted")
    held = [(toxic[i], p) for i, h, p in got if h and i in toxic]
    assert sum(p for t, p in held if t) >= 0.75 * sum(t for t, _ in held) > 50
    assert sum(p for t, p in held if not t) <= 0.01 * len(held)


def test_pages(spark, sf_dir, con):
    """The text of every page is that of its article, white space aside."""
    raw = dict(con.execute("select page_id, html from pages").fetchall())
    for page, text in rows(spark, sf_dir, "op1_html_text", "page_id", "text"):
        inside = re.search(r"<article>(.*?)</article>", raw[page] or "", re.S)
        want = html.unescape(re.sub(r"<[^>]*>", "", inside[1])) if inside else ""
        assert "".join(text.split()) == "".join(want.split()), page


def test_pipeline_against_a_plain_version(spark, sf_dir, con):
    """Each stage's decision made anew, on what the stages before it kept."""
    table = con.execute("select doc_id, text, lang, source, n_chars from documents").fetchall()
    model = toxicity.train(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                           spark.read.parquet(f"{sf_dir}/labels.parquet"), f"{fold(3)} <> 1")
    score = {r.doc_id: r.score for r in toxicity.scores(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), model).collect()}
    left = [r for r in table if score[r[0]] < 0.7]
    first = {i for i, _, _, kept in near_groups([r[:2] for r in left]) if kept}
    left = [r for r in left if r[0] in first]
    items = con.execute("select item_id, text from benchmark").fetchall()
    clean = {i for i, _, hit, _ in contamination([r[:2] for r in left], items) if not hit}
    left = [r for r in left if r[0] in clean]
    spans = {r.doc_id: sorted((s.start, s.end, s.kind) for s in r.spans) for r in pii.findings(
        spark.createDataFrame([r[:2] for r in left], "doc_id bigint, text string")).collect()}
    want = []
    for i, text, lang, source, _ in left:
        parts, at = [], 0
        for a, b, kind in spans[i]:
            if b > at:
                parts += [(text or "")[at:max(a, at)], f"[{kind.upper()}]"]
                at = b
        ids = LIBRARY.encode("".join(parts) + (text or "")[at:], add_special_tokens=False).ids
        want.append((i, lang, source, len(ids), json.dumps(ids)))
    out = corpus_pipeline.run(spark, sf_dir)
    got = [(r.doc_id, r.lang, r.source, r.n_tokens, json.dumps(r.ids)) for r in out.collect()]
    assert sorted(got) == sorted(want) and 0.5 * len(table) < len(got) < len(table)
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_keep_the_columns_and_stand_odd_rows(spark, sf_dir):
    odd = [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 1), (1, "", "en", "s", 0, 1),
           (2, "a b c d e f", "en", None, 11, 1), (3, "a b c d e f", "de", "s", 11, 1),
           (4, "mail me at a@b.cc now", "en", "s", 21, 1)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score int"
    for given in (odd, []):
        now = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, sf_dir)
            now = spark.createDataFrame(now.collect(), now.schema)
            if name != "bpe":
                assert now.columns == corpus_pipeline.COLUMNS
            if name == "pii" and given:
                mail = now.where("doc_id = 4").first()
                assert (mail.text, mail.n_chars) == ("mail me at [EMAIL] now", 22)
        assert now.count() == (4 if given else 0)
