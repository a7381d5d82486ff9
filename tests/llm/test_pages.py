"""Main text of pages and URL rules."""

import html
import re
import time

import pytest

from hazardmart.llm.common import read
from hazardmart.llm.page_template import main_text, parse
from hazardmart.llm.queries import RULES
from hazardmart.llm.url_filter import Cascade, Bloom, judge_urls


def test_articles_of_the_pages(spark):
    pages = read(spark, "/root/testdata/sf0.01", "pages")
    found = {row["page_id"]: row for row in main_text(pages).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*?)</article>", row["html"], re.DOTALL).group(1)
        plain = re.sub(r"</?[a-z][^>]*>", "", re.sub(r"</?(?:h1|p|br)[^>]*>", " ", article))
        text = " ".join(html.unescape(plain).split())
        assert (found[row["page_id"]]["text"], found[row["page_id"]]["n_chars"]) == (text, len(text))


def site_page(number: int) -> str:
    body = "".join(f"<p>Paragraph {i} of page {number} has its own words &amp; more.</p>" for i in range(2 + number % 3))
    return (
        "<html><body><header>Site name</header><nav><a href=/a>Home</a></nav><div class='cookie-notice'>We use cookies</div>"
        f"<div id=content><div class=post-{number}><h2>Title {number}</h2>{body}<form><input>Subscribe</form>"
        "<div>Written for the weekly page.</div></div></div>"
        "<aside>Other</aside><section class=comments><p>Reader comment, quite long, about this and that.</p></section>"
        "<footer>Imprint</footer></body></html>"
    )


def test_boilerplate_goes_and_text_stays(spark):
    rows = [(i, f"http://site.example/{i}", site_page(i)) for i in range(20)]
    found = {row["page_id"]: row["text"] for row in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for number, text in found.items():
        own = [f"Paragraph {i} of page {number} has its own words & more." for i in range(2 + number % 3)]
        assert text == " ".join([f"Title {number}", *own])


def test_copies_of_one_page_keep_their_text(spark):
    rows = [(i, "http://a.example/x", "<body><article><p>Same text.</p></article></body>") for i in range(30)]
    found = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {row["text"] for row in found} == {"Same text."}


def test_odd_pages(spark):
    sources = [None, "", "<", "plain  text", "<p>a<b>b</b>&nbsp;c<br>d", "<div class='x", "<script>var a='<p>no</p>'</script>yes", "<!-- x"]
    rows = [(i, None, source) for i, source in enumerate(sources)]
    found = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [found[i] for i in range(len(rows))] == ["", "", "<", "plain text", "ab c d", "", "yes", ""]
    assert parse("<div>" * 3000 + "x").blocks[0].text == "x"
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_rules_on_odd_urls(spark):
    urls = [
        "http://WWW.Example.COM/en/1", "http://example.com/en/", "http://a.example.com/en/x?q", "https://x.net/es/", "https://x.net/ES/",
        "https://net/fr/#a", "https://xnet/fr/", "http://a.com", "http://a.com?x=/en/", "no scheme/com/", None, "a://b://c.com/", "http:///en/",
    ]
    rows = [(i, url) for i, url in enumerate(urls)]
    judged = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string"), RULES).collect()}
    assert [judged[i] for i in range(len(urls))] == [
        ("www.example.com/en/", "allow"), ("example.com/en/", "block"), ("example.com/en/", "block"), ("net/es/", "block"), (None, "allow"),
        ("net/fr/", "block"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"),
    ]
    assert judge_urls(spark.createDataFrame([], "page_id long, url string"), RULES).collect() == []


def test_cascade_is_exact_over_its_universe():
    listed = frozenset(f"k{i}" for i in range(300))
    others = [f"o{i}" for i in range(5000)]
    first = Bloom(listed, 0.3, 0)
    cascade = Cascade(first, listed, [key for key in others if key in first])
    assert len(cascade.levels) > 2
    assert all(key in cascade for key in listed) and not any(key in cascade for key in others)


def test_wrappers_with_names_of_junk_keep_their_text(spark):
    long = "<p>This is the running text of the page, which goes on for a while.</p><p>It has a second part.</p>"
    text = "This is the running text of the page, which goes on for a while. It has a second part."
    around = "<nav><a href=/>Home</a></nav>{}<footer>Imprint</footer>"
    comments = "<section class=comments><article class=comment>" + "<p>A reader has a lot to say about this.</p>" * 9 + "</article></section>"
    bodies = [
        f"<div class='wrapper with-sidebar'><article>{long}</article><div class=sidebar>Other</div></div>",
        f"<div class='overflow-hidden'>{long}</div>",
        f"<article style='overflow:hidden' class=overflow-hidden>{long}</article>{comments}",
        f"<div class=no-sidebar><div class=has-sidebar>{long}</div></div>",
        "".join(f"<div class=elementor-widget-container>{part}</p></div>" for part in long.split("</p>")[:-1]),
        f"<form action=/page>{long}</form>",
        f"<main><div class=with-sidebar>{long}</div></main>{comments}",
        f"<div hidden><p>Hidden words.</p></div><div class=text data-id=search>{long}</div>",
        f"<div class=story>{long}</div><div class='related'><article><p>Another story.</p></article></div>",
    ]
    rows = [(i, f"http://host{i}.example/", f"<body class='x overflow-hidden'>{around.format(body)}</body>") for i, body in enumerate(bodies)]
    found = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == dict.fromkeys(range(len(rows)), text)


def test_text_of_an_optional_part_of_the_template_goes(spark):
    part = "<div class=extra><p>This story has links to shops, for which we are paid.</p><p>Prices may change.</p></div>"
    rows = []
    for i in range(30):
        paragraphs = "".join(f"<p>Words number {n} that only story {i} has.</p>" for n in range(4))
        rows.append((i, f"http://a.example/{i}", f"<body><div id=content>{part if i % 3 else ''}{paragraphs}</div></body>"))
    found = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: " ".join(f"Words number {n} that only story {i} has." for n in range(4)) for i in range(30)}


def test_odd_pages_leave_the_template_of_their_host(spark):
    def text(i):
        return " ".join(f"Words number {n} that only story {i} has." for n in range(4))

    line = "<p class=line>Read on with a trial month at half the price.</p>"
    rows = []
    for i in range(1000):
        article = f"<article><p>{text(i)}</p>{line}</article>" + (f"<article><p>More of {i}.</p>{line}</article>" if i == 7 else "")
        side = f"<div class=column><p>Teaser {i} with some words of its own.</p></div>"
        rows.append((i, f"http://a.example/{i}", "" if i == 3 else f"<body><div id=page>{article}{side}</div></body>"))
    found = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: "" if i == 3 else f"{text(i)} More of 7." if i == 7 else text(i) for i in range(1000)}


def test_text_beside_an_element_of_its_class_goes(spark):
    rows = []
    for i in range(30):
        paragraphs = "".join(f"<p>Words number {n} that only story {i} has.</p>" for n in range(4))
        part = "<div class=line></div><h4>Paid for by a shop.</h4>" if i % 3 else ""
        rows.append((i, f"http://a.example/{i}", f"<body><div id=content>{paragraphs}{part}</div></body>"))
    found = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: " ".join(f"Words number {n} that only story {i} has." for n in range(4)) for i in range(30)}


def test_main_path_counts_only_where_it_holds_the_running_text(spark):
    def text(i):
        return " ".join(f"Words number {n} that only story {i} has." for n in range(4))

    rows, expected = [], {}
    for i in range(40):
        intro, story = (f"Intro of {i}.", text(i)) if i % 4 == 0 else (text(i), "")
        box = f"<div class=story><p>{story}</p></div>" if story else "<div class=story></div>" if i % 2 else ""
        tag = "article" if i >= 20 else "div"
        rows.append((i, f"http://{tag}.example/{i}", f"<body><{tag} class=intro><p>{intro}</p></{tag}>{box}</body>"))
        expected[i] = f"{intro} {story}".strip()
    # A short article beside a part that all pages have stays alone.
    rows += [
        (i, f"http://short.example/{i}", f"<body><div class=body><p>{text(i) * (1 if i == 50 else 4)}</p></div><div class=column><p>{text(-i)}</p></div></body>")
        for i in range(50, 70)
    ]
    expected |= {i: text(i) * (1 if i == 50 else 4) for i in range(50, 70)}
    rows = [(i, url, source.replace(text(-50), text(-50)[:100])) for i, url, source in rows]
    found = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == expected


@pytest.mark.parametrize(
    "hostile",
    ["<span>" * 20_000 + "x</p>" * 20_000, "<i>" * 20_000 + "</x>" * 20_000, "<p><table>" + "<span>" * 20_000 + "<hr>" * 20_000, "<svg>" * 20_000],
)
def test_odd_nesting_takes_time_in_proportion(hostile):
    start = time.process_time()
    parse(hostile)
    assert time.process_time() - start < 2


def test_formulas_stay_and_endless_elements_swallow_nothing():
    page = parse("<article><p>a <math><mi>x</mi></math> b</p><svg><p>rest</p><titlex>c</titlex></article>")
    assert [block.text for block in page.blocks] == ["a x b", "rest", "c"]
    assert [block.text for block in parse("<p>a<title>b</titlex>c</title>d").blocks] == ["a", "d"]
