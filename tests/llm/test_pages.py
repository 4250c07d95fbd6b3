"""Operator 12: main text of pages."""

import html
import re

import pytest

from strata.llm import html_text
from strata.llm.html_text import main_text

SF = "/root/testdata/sf0.001"
P = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore."


def article_text(page):
    """The given tables' pages mark their article: its blocks, without markup."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner).replace("<br>", " "))
    return " ".join(t for t in (" ".join(html.unescape(x).split()) for x in parts) if t)


def test_pages_of_the_tables(spark):
    rows = html_text.query(spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/pages.parquet").count() and len(rows) > 10
    for r in rows:
        assert r["text"] == article_text(r["html"]) and r["n_chars"] == len(r["text"])


PLAIN = f"""<html><head><title>No</title></head><body><div><a href=/>Home</a> <a href=/a>About us</a> <a href=/b>Contact</a></div>
<div><div><ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul></div>
<div><h1>Title here</h1><p>{P} {P}<p>{P} {P} {P} {P}<p>AT&amp;T &#8212; <b>bo</b>ld<br>line&nbsp;two</p><p>Short.</p></div>
<div>Copyright by me.</div></div></body></html>"""


def test_density_without_names():
    assert main_text(PLAIN) == f"Title here {P} {P} {P} {P} {P} {P} AT&T — bold line two Short."


def test_sections_beside_the_densest():
    page = f"<body><div id=x><div><p>{P}</p><p>{P}</p></div><div><p>{P}</p></div><div><a href=1>a b</a><a href=2>c d</a></div></div><div>end</div></body>"
    assert main_text(page) == f"{P} {P} {P}"


@pytest.mark.parametrize("other", [
    "<nav><p>{}</p></nav>", "<header><p>{}</p></header>", "<footer>{}</footer>", "<aside><p>{}</p></aside>", "<form><p>{}</p><input></form>",
    "<script>var x = '<p>{}</p>';</script>", "<style>p:after{{content:'{}'}}</style>", "<div class='ad-slot'><p>{}</p></div>", "<!-- <p>{}</p> -->",
    "<section id=comments><article><p>{}</p></article><article><p>{}</p></article></section>", "<div class=cookie-notice><p>{}</p></div>",
    "<div role=navigation>{}</div>", "<div hidden>{}</div>", "<ul class=menu><li>{}</ul>", "<div class=\"sidebar left\"><p>{}</p></div>"])
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div>{}</div>"])
def test_what_is_no_text(other, wrap):
    junk = " ".join(["noise words here"] * 60)
    text = f"<h1>Head</h1><p>{P}</p><p>{P} x</p>"
    want = f"Head {P} {P} x"
    other = other.replace("{}", junk).replace("{{", "{").replace("}}", "}")
    assert main_text(f"<html><body>{other}{wrap.replace('{}', text)}{other}</body></html>") == want
    assert main_text(f"<html><body>{wrap.replace('{}', other + text + other)}</body></html>") == want


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain  text", "plain text"), ("<p>a<p>b<i>c</i>", "a bc"), ("<p>a<script>x<y", "a"), ("<!-- x", ""),
    ("<body><p>ok</p><div cla", "ok"), ("<p>1 < 2 & 3 &lt; 4</p>", "1 < 2 & 3 < 4"), ("<p title='a>b'>c", "c"), ("</p></b>x", "x"),
    ("<ul><li>a<li>b</ul>", "a b"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<body><form><main><p>in</p></main></form>", "in"),
    ("<p>don't <a b=c'>x</a> y'", "don't x y'")])
def test_small_pages(page, text):
    assert main_text(page) == text


def test_long_and_deep_pages():
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert len(main_text("<p>" + "word " * 300000)) == 5 * 300000 - 1
    assert main_text("<p class=x>hi</i>" * 2000) == " ".join(["hi"] * 2000)


def test_column_cases(spark):
    rows = [(1, "u", PLAIN, "m", "d"), (1, "u", PLAIN, "m", "d"), (None, None, None, None, None), (2, "v", "", "m", "d")]
    got = html_text.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, `a.b` string, density string"))
    assert got.columns == ["page_id", "url", "html", "a.b", "density", "main_text"]
    out = sorted((tuple(r) for r in got.collect()), key=str)
    want = f"Title here {P} {P} {P} {P} {P} {P} AT&T — bold line two Short."
    assert out == sorted([r + (want if r[2] == PLAIN else "",) for r in rows], key=str)
    assert html_text.extract_pages(spark.createDataFrame([], "html string")).count() == 0
