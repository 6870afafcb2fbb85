"""Script, style, title and textarea hold no markup."""

import time

import pytest

from adweave.llm import htmltext

ARTICLE = "<article><h1>Some title</h1><p>The first paragraph of it.</p><p>And a second one.</p></article>"
WANT = ["Some title", "The first paragraph of it.", "And a second one."]


def texts(page):
    return [b.text() for b in htmltext.blocks(page)]


@pytest.mark.parametrize("raw", [
    "<script>for(var i=0;i<n;i++){x()}</script>", "<script>var s='<!-- not closed';</script>",
    "<script>a<b;c='\"'</SCRIPT >", "<style>a:after{content:'<!--'}</style>",
    "<style>p{} /* <b \" */</style>", "<textarea>1 <2 <!-- </textarea>", "<script>'<![CDATA['</script>",
    "<title>If a<b then</title>", "<iframe>x<y</iframe>", "<svg><style/><title>a<b</title></svg>",
    "<script>'</scripts>'; x<y</script>"])
def test_the_article_stays(raw):
    assert texts(f"<html><head>{raw}</head><body>{ARTICLE}</body></html>") == WANT
    assert texts(f"<html><body>{raw}{ARTICLE}{raw}</body></html>") == WANT


def test_elements_without_an_end():
    assert texts(ARTICLE + "<script>var a; <p>hidden") == WANT
    assert texts("<head><title>no end</head><body>" + ARTICLE) == WANT
    begin = time.monotonic()
    assert texts("<head>" + "<title>x" * 200_000 + "</head><body>" + ARTICLE) == WANT
    assert time.monotonic() - begin < 20


def test_main_text_of_such_pages(spark):
    rows = [(1, "u", f"<html><body><script>for(;i<n;)x()</script>{ARTICLE}</body></html>"),
            (2, "u", f"<html><body><script>s='<!--'</script>{ARTICLE}</body></html>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert [r.text for r in htmltext.extract(df).collect()] == ["\n".join(WANT)] * 2
