import pytest
from pyspark.sql import functions as F

from paymart.llm.html_text import extract, host_of, main_text

SHELL = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a = "</p><article>no</article>";</script></head>
<body><header class="site-header"><a href="/">Home</a> Site name</header><nav><ul><li><a href="/a">Menu one</a><li>Menu two</ul></nav>
<div class="cookie-notice">We use cookies and more cookies</div><!-- <article>hidden comment</article> -->
<div id="wrap-{n}"><div class="content main-{n}"><h1>Title &amp; more</h1><p>First   paragraph of some length, with <b>bold</b> words.
<p>Second paragraph<br>goes on &lt;here&gt; 1 < 2.</p><ul><li>Item one<li>Item two</ul><div class="ad">Buy this now</div>
<form><input name=q><button>Go</button></form></div><div class="sidebar">Side matter that is not the text</div></div>
<section id="comments"><p>Reader says a very long thing that goes on and on and on, longer than the article itself is by far.</p></section>
<footer>&copy; Foot</footer></body></html>"""
TEXT = "Title & more\nFirst paragraph of some length, with bold words.\nSecond paragraph goes on <here> 1 < 2.\nItem one\nItem two"


def test_boilerplate_goes_and_blocks_stay():
    assert extract(SHELL.format(n=1)) == TEXT


@pytest.mark.parametrize("cut", range(0, 1400, 37))
def test_broken_pages_do_not_fail(cut):
    assert isinstance(extract(SHELL.format(n=1)[:cut]), str)


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"), ("<div>" * 3000 + "deep", "deep"), ("<p>a &am b &amp c&nbsp;d</p>", "a &am b & c d"),
        ("<script>x", ""), ("<!-- x", ""), ("<p title='a>b'>c</p", "c"), ("<article><header><h1>H</h1><p>by me</p></header><p>text</article>", "H\ntext"),
        ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</table>", "a b\nc"), ("<pre>a\n  b</pre>", "a b"), ("<p>x</p>" * 5000, "\n".join(["x"] * 5000)),
    ],
)
def test_small_pages(page, text):
    assert extract(page) == text


def test_hosts_vote_for_a_path(spark):
    menu = "<nav>" + "Menu with many words. " * 12 + "</nav>"
    odd = f"<body>{menu}<div class='box-9'>Short.</div><div class='teaser'>A teaser that is longer than the text of this page is, by quite a bit.</div></body>"
    usual = f"<body>{menu}<div class='box-{{0}}'>{{1}}</div><div class='teaser'>Short teaser.</div></body>"
    rows = [(i, f"https://www.H.example:80/{i}", usual.format(i, "Long text of the usual page. " * 4)) for i in range(5)]
    rows += [(9, "http://h.example/9", odd.replace("Short.", "Text of sixty letters, just enough to count as its own one.")), (10, "http://other.example/", odd), (11, None, None), (11, None, None)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id LONG, url STRING, html STRING, path STRING")
    found = {r["page_id"]: r for r in main_text(pages).collect()}
    assert found[9]["path"] == ">body>div.box-#" and found[9]["text"].startswith("Text of sixty")
    assert found[10]["text"].startswith("A teaser") and found[11]["text"] == "" and found[11]["n_chars"] == 0
    assert main_text(pages).count() == len(rows)
    assert main_text(pages.limit(0)).collect() == []


def test_hosts(spark):
    urls = ["http://User@WWW.a.b:8080/x?y", "https://m.a.b", "//a.b/c", "a.b/c", "", None]
    df = spark.createDataFrame([(u,) for u in urls], "url STRING")
    assert [r[0] for r in df.select(host_of(F.col("url"))).collect()] == ["a.b", "m.a.b", "a.b", "", "", ""]


PROSE = "<h1>Heading of it</h1><p>" + "Words of the article that go on for a while. " * 6 + "</p><p>" + "And a second paragraph of it. " * 4 + "</p>"
PLAIN = "Heading of it\n" + ("Words of the article that go on for a while. " * 6).strip() + "\n" + ("And a second paragraph of it. " * 4).strip()
NEXT = "<div class='neighbour'><p>A neighbour with some text of its own.</p></div>"


@pytest.mark.parametrize("name", ["content with-sidebar", "content no-sidebar", "post tags-none", "overflow-hidden", "has-header", "post search-off", "widget", "form"])
def test_class_that_only_sounds_like_boilerplate(name):
    assert extract(f"<body><nav>Menu</nav><div class='{name}'>{PROSE}</div>{NEXT}</body>") == PLAIN


@pytest.mark.parametrize("name", ["sidebar", "sidebar-left", "main-nav", "cookie-notice", "post-comments", "related-articles", "ad", "ad-slot", "share-buttons", "site-footer", "comments", "Newsletter"])
def test_class_that_names_boilerplate(name):
    noise = f"<div class='{name}'><p>{'Noise that is not part of the article. ' * 3}</p></div>"
    assert extract(f"<body><div class='text'>{PROSE}</div>{noise}</body>") == PLAIN
    assert extract(f"<body><article>{PROSE}{noise}</article></body>") == PLAIN


def test_long_comments_cost_the_article_nothing():
    comments = "<section class='comments'>" + "<p>A reader who writes and writes, far more than the article has.</p>" * 40 + "</section>"
    inner = PROSE.replace("</h1>", "</h1><div class='body'>") + "</div>"
    assert extract(f"<body><article>{inner}{comments}</article></body>") == PLAIN
    two = PROSE.replace("<h1>", "<section class='first'><h1>").replace("</p><p>", "</p></section><section class='second'><p>") + "</section>"
    assert extract(f"<body><article>{two}{comments}</article></body>") == PLAIN
    assert extract(f"<body><div class='story'>{two}{comments}</div><footer>Foot</footer></body>") == PLAIN


def test_article_in_many_containers_of_one_kind():
    parts = "".join(f"<div class='para-{i}'>Part {i} of the article, with some words.</div>" for i in range(8))
    assert extract(f"<body><div class='menu'>Menu</div><div class='story'>{parts}</div></body>").count("\n") == 7


@pytest.mark.parametrize("tag", ["<div class='level'>", "<span>", "<section><b>", "<p><i>"])
def test_depth_costs_nothing_special(tag):
    import time

    page = tag * 100_000 + "deep text" + "<div></div>" * 20_000 + "<hr>" * 20_000
    start = time.process_time()
    assert extract(page) == "deep text"
    assert time.process_time() - start < 12


def test_votes_that_tie_and_very_long_pages(spark):
    long = f"<body><div class='a'><p>{'word ' * 200_000}</p></div></body>"
    rows = [(1, "http://h.x/", long), (2, "http://t.x/1", f"<div class='a'>{PROSE}</div>"), (3, "http://t.x/2", f"<div class='b'>{PROSE}</div>")]
    pages = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")
    found = {r["page_id"]: r for r in main_text(pages).collect()}
    assert found[1]["n_chars"] == 5 * 200_000 - 1
    assert found[2]["path"] == found[3]["path"] == ">div.b" and found[2]["text"] == found[3]["text"] == PLAIN
