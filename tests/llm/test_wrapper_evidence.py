"""What the slots of a host's wrapper decide where no tag or name does, and names that tell boilerplate."""

import re
from collections import Counter

import pytest

from sluicegate.llm import wrappers
from sluicegate.llm.wrappers import Page, decide, extract_pages, read_page

PAGES = "/root/testdata/sf0.01/pages.parquet"


def neutral(html):
    """The page without a tag or name that tells what its parts are."""
    html = re.sub(r"(?s)<head>.*?</head>", "", html)
    html = re.sub(r"<(/?)(?:article|nav|footer)>", r"<\1div>", html)
    return re.sub(r"<div class=[^>]*>", "<div>", html)


def overlap(found, wanted):
    one, other = Counter(found.split()), Counter(wanted.split())
    both = sum((one & other).values())
    return both, sum(one.values()), sum(other.values())


def test_neutral_pages_give_their_articles(spark):
    """No article, nav, footer or class is left, and the wrappers still find the main text."""
    given = spark.read.parquet(PAGES).select("page_id", "url", "html")
    wanted = {r.page_id: r.text for r in extract_pages(given).collect()}
    rows = [(r.page_id, r.url, neutral(r.html)) for r in given.collect()]
    assert not any("<article" in html or "<nav" in html or "class=" in html for _, _, html in rows)
    found = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, given.schema)).collect()}
    counts = [overlap(found[key], wanted[key]) for key in wanted]
    both, got, all_ = map(sum, zip(*counts))
    f1 = 2 * both / (got + all_)
    alone = [overlap(decide(read_page(html)), wanted[key]) for key, _, html in rows]
    both_alone, got_alone, all_alone = map(sum, zip(*alone))
    same = sum(found[key] == wanted[key] for key in wanted)
    print(f"F1 {f1:.4f}, pages alone {2 * both_alone / (got_alone + all_alone):.4f}, exact {same} of {len(wanted)}")
    assert f1 >= 0.98


@pytest.fixture
def texts(spark):
    def run(rows):
        frame = spark.createDataFrame(rows, "page_id long, url string, html string")
        return {r.page_id: r.text for r in extract_pages(frame).collect()}

    return run


def words(i, n):
    return " ".join(f"w{i}x{k}" for k in range(n))


def test_evidence_of_a_host_decides_on_a_page_that_has_little_text(texts):
    """A page with a short article: alone, its teaser outweighs it; the host's slots tell which is which."""
    page = "<body><div><p>{}</p><p>{}</p></div><section><h2>{}</h2><p>{}</p><p>{}</p></section></body>"
    rows = [(i, "http://h.example/", page.format(words(f"t{i}", 9), words(f"u{i}", 9), f"Head {i}", words(i, 60), words(f"b{i}", 60))) for i in range(8)]
    short = page.format(words("t9", 9), words("u9", 9), "Head 9", "brief", "text")
    got = texts([*rows, (9, "http://h.example/", short)])
    assert got[9] == "Head 9 brief text" and got[0] == f"Head 0 {words(0, 60)} {words('b0', 60)}"
    assert decide(read_page(short)) != got[9]


def test_linked_text_weighs_against_its_slot(texts):
    links = "".join(f"<li><a href='/{k}'>{words(k, 12)}</a></li>" for k in range(6))
    rows = [(i, "http://l.example/", f"<body><ul>{links.replace('w', f'v{i}')}</ul><div><h1>T {i}</h1><p>{words(i, 20)}</p></div></body>") for i in range(4)]
    assert texts(rows) == {i: f"T {i} {words(i, 20)}" for i in range(4)}


def test_names_are_one_vote(texts):
    """An article element with next to nothing in it does not outvote the text beside it."""
    page = "<body><article>more</article><div><h1>T {0}</h1><p>{1}</p></div></body>"
    rows = [(i, "http://v.example/", page.format(i, words(i, 50))) for i in range(4)]
    assert texts(rows) == {i: f"T {i} {words(i, 50)}" for i in range(4)}


@pytest.mark.parametrize(
    "part",
    [
        "<title>No</title>", "<div class='comments-v2'><p>No</p></div>", "<section id=disqus_thread>No</section>",
        "<div class='article-sidebar'>No</div>", "<div class=blog-footer>No</div>", "<div class='ad-300x250'>No</div>",
        "<span class=advert>No</span>", "<span hidden>No</span>", "<b style='display: none'>No</b>", "<div style=\"display:none\">No</div>",
        "<ul class='topnav'><li>No</li></ul>", "<div id='cookie-consent'>No</div>", "<em class=ad>No <em>no</em> no</em>",
        "<p style='visibility:hidden'>No</p>",
    ],
)
def test_boilerplate_by_name(part):
    assert decide(read_page(f"<body>{part}<h1>one</h1><p>two</p>{part}</body>")) == "one two"
    assert decide(read_page(f"<article>one{part}<p>two</p></article>")) == "one two"


def test_an_unclosed_inline_drop_ends_with_its_element():
    assert decide(read_page("<div><p>a <span class=advert>x</p><p>b</p></div>")) == "a b"
    assert decide(read_page("<div><p>a <span class=advert>x <i>y</i></span> z</p></div>")) == "a z"


@pytest.mark.parametrize("name", ["article-header", "content-header-wrapper", "has-sidebar", "blog-title", "entry-content", "article-notice"])
def test_names_of_main_text_are_no_boilerplate(name):
    assert decide(read_page(f"<body><div class='{name}'><h1>one</h1><p>two</p></div></body>")) == "one two"


def test_links_are_counted_and_pages_come_back(spark):
    page = read_page("<body><p>see <a href=x>this one</a> and <a>that</a></p><div><p><a href=y>all</a></p>tail</div></body>")
    assert [(linked, text) for _, _, linked, text in page.blocks] == [(8, "see this one and that"), (3, "all"), (0, "tail")]
    again = Page.loads(page.dumps())
    assert again.tokens == page.tokens and [tuple(b) for b in again.blocks] == page.blocks and [tuple(s) for s in again.spans] == page.spans
    assert (0, 3) in page.spans and (1, 3) in page.spans


def test_streams_without_common_tokens_stay_quick(monkeypatch):
    monkeypatch.setattr(wrappers, "CELLS", 100)
    one, other = [f"x{i % 7}" for i in range(20_000)], [f"y{i}" for i in range(20_000)] + ["z"]
    got = wrappers.aligned([*one, "z"], other)
    assert got[-1] == "z" and len(got) == 3
