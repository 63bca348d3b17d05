import html
import random
import re

from sluicegate.llm import wrappers
from sluicegate.llm.wrappers import Wrapper, aligned, extract_pages, folded, infer_wrappers, read_page

SHOP = (
    "<html><body><div class='top-menu'><a>Home</a><a>Shop</a></div><div class=wrap><h2>{title}</h2>{rows}</div>"
    "<div>Call us any time</div><div id='comments'><p>Nice!</p></div></body></html>"
)


def test_repeats_are_folded():
    assert folded(["ul", "li", "#", "/li", "li", "#", "/li", "li", "#", "/li", "/ul"]) == ["ul", ["+", ["li", "#", "/li"]], "/ul"]
    assert folded([]) == []


def test_mismatches_become_options_and_rounds():
    one, other = folded(["b", "p", "#", "/p", "/b"]), folded(["b", "p", "#", "/p", "p", "#", "/p", "ad", "#", "/ad", "/b"])
    assert aligned(one, other) == ["b", ["+", ["p", "#", "/p"]], ["?", ["ad", "#", "/ad"]], "/b"]
    assert aligned(aligned(one, other), one) == aligned(one, other)
    assert aligned([], ["x"]) == [["?", ["x"]]]


def test_wide_streams_align_between_common_tokens(monkeypatch):
    monkeypatch.setattr(wrappers, "CELLS", 40)
    one = ["a", *(f"x{i}" for i in range(20)), "m", "#", "z"]
    other = ["a", *(f"y{i}" for i in range(20)), "m", "#", "z"]
    got = aligned(one, other)
    assert got[0] == "a" and got[-3:] == ["m", "#", "z"] and len(got) == 6


def test_host_without_article_keeps_what_changes(spark):
    rows = [
        (i, "https://u:p@Shop.example.org:8080/x", SHOP.format(title=f"Thing {i}", rows="".join(f"<p>row {i} {j}</p>" for j in range(i % 4 + 1))))
        for i in range(12)
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in extract_pages(pages).collect()}
    assert texts == {i: " ".join([f"Thing {i}", *(f"row {i} {j}" for j in range(i % 4 + 1))]) for i in range(12)}
    row = infer_wrappers(pages).collect()
    assert [r.host for r in row] == ["shop.example.org"]
    assert "(<p> #text /p)+" in Wrapper.loads(row[0].wrapper).pattern()


def test_article_without_its_surroundings():
    page = (
        "<!DOCTYPE html><title>No</title><script>var t='<p>no</p>';</script><header>No</header><main><article>"
        "<header><h1>A &amp; B&nbsp;&lt;x&gt;</h1></header><p>one <b>t</b>wo<br>three\n  four<p>five<aside>no</aside>"
        "<form>no<input></form><div class='comments-list'>no</div><ul><li>six<li>seven</ul></article></main>"
        "<footer>No</footer><div hidden>no</div>tail"
    )
    wrapper = Wrapper.of_page(read_page(page))
    assert wrapper.has_main()
    assert wrappers.main_text(read_page(page), True, set()) == "A & B <x> one two three four five six seven"


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "nonsense", "<"), (4, "http://a.b", "plain & text"), (4, "http://a.b", "plain & text"), (None, "http://c.d/", "<p>" * 500 + "x")]
    pages = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in extract_pages(pages).collect()), key=str)
    assert got == sorted([(1, "", 0), (2, "", 0), (3, "<", 1), (4, "plain & text", 12), (4, "plain & text", 12), (None, "x", 1)], key=str)
    assert extract_pages(pages.limit(0)).collect() == []
    for hostile in ("<a " + "x='" * 20_000, "<" * 50_000, "<div>" * 20_000, "<!--" * 20_000):
        read_page(hostile)


def test_given_pages_match_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    wanted = {}
    for row in pages.collect():
        inner = re.search(r"(?s)<article>(.*)</article>", row.html)[1]
        blocks = re.split(r"</?(?:p|h1|br)>", inner.replace("<b>", "").replace("</b>", ""))
        wanted[row.page_id] = " ".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
    assert {r.page_id: r.text for r in extract_pages(pages).collect()} == wanted


def test_every_page_matches_the_expression_of_its_host():
    chance = random.Random(3)

    def some(depth):
        kinds = chance.choices("pqdr", k=chance.randrange(4))
        inner = {"p": lambda: "<p>x</p>", "q": lambda: "<h2>x</h2>", "r": lambda: "<p>x</p>" * chance.randrange(4)}
        return "".join(f"<div>{some(depth + 1)}</div>" if k == "d" and depth < 3 else inner.get(k, str)() for k in kinds)

    for _ in range(150):
        pages = [read_page(some(0)) for _ in range(chance.randint(2, 8))]
        found = [Wrapper.of_page(page) for page in pages]
        while len(found) > 1:
            found.append(found.pop(chance.randrange(len(found))).merge(found.pop(chance.randrange(len(found)))))
        matcher = wrappers.Matcher(found[0].expression)
        for page in pages:
            assert len(matcher.slots(page.tokens)) == len(page.blocks)


def test_slots_tell_apart_what_has_the_same_path(spark):
    row = "<body><div><p>Call us</p><h2>title {0}</h2><p>first {0}</p><p>second {0}</p><p>Best shop</p></div></body>"
    frame = spark.createDataFrame([(i, "http://s.example/", row.format(i)) for i in range(6)], "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in extract_pages(frame).collect()}
    assert texts == {i: f"title {i} first {i} second {i}" for i in range(6)}


def texts_of(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in extract_pages(frame).collect()}


def test_pages_without_main_text_on_mixed_hosts_and_copies_keep_their_text(spark):
    plain = "<body><div>Call us</div><p>plain {0}</p></body>"
    rows = [(i, "http://mixed.example/", f"<body><article>own {i}</article><div>Call us</div></body>") for i in range(3)]
    rows += [(i, "http://mixed.example/", plain.format(i)) for i in range(3, 8)]
    rows += [(i, "http://copies.example/", plain.format("same")) for i in range(8, 14)]
    rows += [(14, None, "<article>no host</article>")] + [(i, None, plain.format("alone")) for i in range(15, 20)]
    wanted = {i: f"own {i}" for i in range(3)} | {i: f"plain {i}" for i in range(3, 8)}
    wanted |= {i: "Call us plain same" for i in range(8, 14)} | {14: "no host"} | {i: "Call us plain alone" for i in range(15, 20)}
    assert texts_of(spark, rows) == wanted


def test_main_text_within_layout_is_kept():
    def text(html):
        page = read_page(html)
        return wrappers.main_text(page, page.has_main(), set())

    for name in ("has-sidebar", "no-sidebar", "layout with-banner", "content-header-wrapper", "social-science", "header", "modal"):
        assert text(f"<div class='{name}'><article>a</article></div>x") == "a"
        assert text(f"<article>a<div class='{name if '-' in name else 'x'}'>b</div></article>") == "a b"
    assert text("<form><article>a<p class='related-work'>b<p class='notice-period'>c<p class=notice>x</article></form>") == "a b c"
    assert text("<div class=sidebar><main>a</main></div>x") == "a"
    for around in ("<nav>", "<aside>", "<footer>", "<div hidden>", "<div class=comments>", "<div class='related-posts'>", "<aside><form>"):
        assert text(f"<article>a</article>{around}<article>x</article>") == "a"
    reply = "<article class='comment odd' id='comment-7'><p>b</p></article>"
    assert text(f"<article>a{reply}</article>{reply}") == "a"
    assert text(f"<main>{reply}</main>") == "b"
