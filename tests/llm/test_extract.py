"""Main text: pages with known articles, broken markup, and all pages of the tables."""

import html
import re
import time

from plumbline.llm.extract import extract, main_text

SHELL = ("<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=/a>Menu</a></ul></nav>"
         "<!-- <p>hidden, text</p> --><div class='ad'>Buy, now, here.</div>{}<div id=comments><p>Reader, says, this.</p></div>"
         "<form><input name=q><label>Mail</label></form><footer>&copy; me</footer></body></html>")
LONG = "A sentence, with commas, and some length so that it scores as a paragraph of the article should."


def test_containers():
    inner = f"<h1>Head &amp; line</h1><p>{LONG}<p>Second <b>bo</b>ld,\n para<br>graph.</p><aside>Side</aside><p>&nbsp;Third&#33;</p>"
    expected = f"Head & line {LONG} Second bold, para graph. Third!"
    for shell in ("<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>", "<div class='page has-sidebar'><div id=story>{}</div></div>",
                  "<div role=main>{}</div>", "<table><tr><td>{}</td></tr></table>"):
        assert main_text(SHELL.format(shell.format(inner))) == expected, shell


def test_siblings_and_short_pages():
    assert main_text(SHELL.format(f"<section><p>{LONG}</p></section><section><p>{LONG} B</p></section>")) == f"{LONG} {LONG} B"
    assert main_text(SHELL.format("<article><h1>Only</h1><p><b>Only.<br></article>")) == "Only Only."
    assert main_text("no markup, at all") == "no markup, at all" and main_text("a < b <p title='x>y'>c</p>") == "a < b c"


def test_broken_and_long():
    assert main_text("") == "" and main_text("<") == "<" and main_text("<script>x") == "" and main_text("<!-- x") == ""
    assert main_text("<div>" * 20_000 + "deep, text") == "deep, text"
    assert main_text("<article>" + "<p>x, y" * 50_000).count("x, y") == 50_000
    assert main_text("<p a='" * 20_000) == ""


def test_all_pages(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    for r in extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        body = r["html"][r["html"].index("<article>") + 9:r["html"].index("</article>")]
        assert r["text"] == " ".join(html.unescape(re.sub("<[^>]*>", " ", body)).split()) and r["n_chars"] == len(r["text"])


def test_edge_cases(spark):
    rows = [(1, "u", None), (2, None, ""), (2, None, ""), (None, "v", f"<p>{LONG}</p>")]
    pages = spark.createDataFrame([(*r, "x", 7) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = sorted(map(tuple, extract(pages).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), (2, None, "", 0), (None, "v", LONG, len(LONG))], key=str)
    assert extract(pages.limit(0)).collect() == []


def test_form_around_the_page_and_lists_of_sources():
    form = "<body><form id=aspnetForm action=x><input name=v><nav><a href=/>Home</a></nav><div>{}</div><label>Mail</label><button>Send</button></form></body>"
    assert main_text(form.format(f"<p>{LONG}</p><p>{LONG}</p>")) == f"{LONG} {LONG}"
    assert main_text(form.format(f"<article><h1>Head</h1><p>{LONG}</p></article>")) == f"Head {LONG}"
    assert main_text(f"<div><p>{LONG}</p><p>{LONG}</p></div><form><p>Write, to, us</p><input></form>") == f"{LONG} {LONG}"
    sources = "<ul><li><a href=/1>Source one</a><li><a href=/2>Source two</a></ul>"
    assert main_text(f"<article><p>{LONG}</p>{sources}</article>") == f"{LONG} Source one Source two"
    assert main_text(f"<body><div class=content><p>{LONG}</p><p>{LONG}</p>{sources}</div></body>") == f"{LONG} {LONG} Source one Source two"


def test_stray_tags_are_read_in_linear_time():
    started = time.perf_counter()
    assert main_text("<div>" * 50_000 + "deep, text" + "</p>" * 100_000 + "</b>" * 100_000) == "deep, text"
    assert main_text("<p><div>" + "<button>" * 50_000 + "<hr>" * 50_000 + "</td>" * 50_000) == ""
    main_text("<td><table>" + "<b>" * 30_000 + "<td>" * 30_000 + "<li>" * 30_000)
    assert time.perf_counter() - started < 8


def test_prose_under_names_of_boilerplate_stays_within_the_article():
    prose = "The search went on for days, and nobody found the tool they had lost."
    for name in ("search", "tool", "legal", "byline", "tags", "reply", "rail", "side"):
        for block in (f"<p class='{name}'>{prose}</p>", f"<div class='{name}'><p>{prose}</p></div>"):
            assert main_text(SHELL.format(f"<article><p>{LONG}</p>{block}<p>{LONG}</p></article>")) == f"{LONG} {prose} {LONG}", name
    for block in (f"<div class='search'><form><input></form>{prose}</div>", "<div class=tags><a href=/a>one</a> <a href=/b>two</a></div>",
                  f"<div class='share'>{prose}</div>", f"<div class=cookie-notice>{prose}</div>"):
        assert main_text(SHELL.format(f"<article><p>{LONG}</p>{block}</article>")) == LONG
    assert main_text(SHELL.format(f"<div class=widget>{prose}</div><article><p>{LONG}</p></article>")) == LONG


def test_formulas_stay():
    formula = "<math><mi>x</mi><mo>=</mo><mn>1</mn></math>"
    assert main_text(SHELL.format(f"<article><p>{LONG} {formula} holds.</p></article>")) == f"{LONG} x=1 holds."


def test_articles_side_by_side():
    two = f"<article><h2>One</h2><p>{LONG}</p></article><article><h2>Two</h2><p>{LONG}</p></article><article class=teaser><p>{LONG}</p></article>"
    assert main_text(SHELL.format(f"<div>{two}</div>")) == f"One {LONG} Two {LONG}"
