import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from sparcel.llm import html_text

SCHEMA = "page_id long, url string, html string, text string"


def test_markup():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
    <div class="top-nav">menu <a>x</a></div><header>site</header><!-- <p>no</p> -->
    <article><header><h1>Head&amp;line</h1></header><p>One <b>two</b>three<br>four&nbsp; five<p>six &lt;b&gt; &#233;&eacute &copy
    <aside>side</aside><div class='comment-list'><p>reader</div><script>var a = "</p><p>bad";</script>
    <form><input value="a>b">f</form><ul><li>i1<li>i2</ul></article><div id="comments">c</div><footer>foot"""
    assert html_text.main_text(page, None) == "Head&line One twothree four five six <b> éé © i1 i2"
    assert html_text.main_text("<p>a < b and c > d</p><div hidden>x</div><p>tail <i", None) == "a < b and c > d tail"
    assert html_text.main_text(None, None) == html_text.main_text("", None) == html_text.main_text("<nav>x</nav>", None) == ""
    assert html_text.main_text("plain &amp; text\n\n here", None) == "plain & text here"
    assert html_text.main_text("<div class=ad>x</div><div>keep<div class=advert>y</div>more</div>", None) == "keep more"
    assert html_text.main_text("<article class='comment'>no</article><main><p>yes</main>", None) == "yes"
    assert html_text.main_text("<p>" + "word " * 200_000, None).count("word") == 200_000


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=25), st.lists(st.integers(0, 5), max_size=25))
def test_common_lines(a, b):
    places = html_text.common_lines(np.array(a, np.int64), np.array(b, np.int64))
    assert list(places) == sorted(set(places.tolist())) and len(places) == lcs_length(a, b)
    rest = iter(b)
    assert all(any(x == y for y in rest) for x in np.array(a, np.int64)[places])


def test_nearest_is_the_neighbour_of_the_whole_order(spark):
    rng = random.Random(2)
    rows = [(f"u{i}", rng.choice(["a.com", "a.com", "a.com", "b.org", f"h{i}.net"]), "/" + "".join(rng.choice("ab/") for _ in range(rng.randrange(6)))) for i in range(200)]
    got = {r.unit: r.near for r in html_text.nearest(spark.createDataFrame(rows, "unit string, host string, path string")).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[2], r[0]))

    def shared(x, y):
        return next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))

    want = {}
    for i, (u, h, p) in enumerate(order):
        sides = [order[j] for j in (i - 1, i + 1) if 0 <= j < len(order) and order[j][1] == h]
        if sides:
            want[u] = max(sides, key=lambda r: shared(p, r[2]))[0] if len(sides) == 1 or shared(p, sides[1][2]) > shared(p, sides[0][2]) else sides[0][0]
    assert got == want


def test_template_lines_go(spark):
    def page(i, extra=""):
        return f"<div>Site {'x' * 3}</div><div>Menu of all pages</div><p>Story number {i} is told here at some length, so it is text.</p>{extra}<div>Imprint</div>"

    rows = [(i, f"http://s.example/a/{i:03d}?q=1", page(i), "old") for i in range(20)]
    rows += [(100, "http://s.example/a/005#x", page(5), "old"), (101, "http://alone.example/", page(5), "o"), (102, None, page(1), "o"), (103, "http://s.example/b", None, "o")]
    rows += [(104, "http://t.example/1", page(7), "o"), (105, "http://t.example/2", page(7, "<p>x</p>"), "o"), (None, "http://s.example/c", "", "o"), (0, rows[0][1], rows[0][2], "o")]
    rows += [(200 + k, f"http://r.example/{k}", f"<div>Shared menu</div><article><p>Quoted by both.</p><p>Own {k}</p></article><div>Shared end</div>", "o") for k in range(2)]
    out = html_text.extract(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = {(r.page_id, r.url): r for r in out.collect()}
    assert out.count() == len(rows)
    for i in range(20):
        assert got[i, rows[i][1]].text == f"Story number {i} is told here at some length, so it is text."
    assert got[100, rows[20][1]].text == got[5, rows[5][1]].text
    whole = "Site xxx Menu of all pages Story number 5 is told here at some length, so it is text. Imprint"
    assert got[101, rows[21][1]].text == whole and got[101, rows[21][1]].n_chars == len(whole)
    assert got[102, None].text.startswith("Site") and got[103, "http://s.example/b"].text == ""
    assert "Story number 7" in got[104, "http://t.example/1"].text and "Story number 7" in got[105, "http://t.example/2"].text
    assert got[200, "http://r.example/0"].text == "Quoted by both. Own 0"
    assert html_text.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_template_inside_articles_goes(spark):
    def page(i):
        quote = "<p>Quoted by two neighbours.</p>" if i in (4, 5) else ""
        return f"<article><p>Share this story</p><p>Story number {i} is told here at some length, so it is text.</p>{quote}<p>Leave a note</p></article>"

    rows = [(i, f"http://s.example/a/{i:03d}", page(i), "") for i in range(700)]
    rows += [(1000 + i, f"http://t.example/{i}", page(4 + i), "") for i in range(2)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(700):
        assert got[i] == f"Story number {i} is told here at some length, so it is text." + (" Quoted by two neighbours." if i in (4, 5) else "")
    assert got[1000].startswith("Share this story") and "Quoted" in got[1001]


def test_template_longer_than_the_text_goes(spark):
    menu = "".join(f"<div>Entry {k} of the menu that all pages have</div>" for k in range(8))
    notice = "".join(f"<div>Paragraph {k} of a notice that is longer than anything else on the pages of this host</div>" for k in range(40))

    def story(i):
        return f"Story number {i} is told here at some length, and much shorter than the menu."

    def flood(k):
        return f"A text that stands here many times. Part {k}."

    rows = [(i, f"http://s.example/a/{i:02d}", f"{menu}<p>{story(i)}</p>", "") for i in range(6)]
    # the nearest page is a copy, the next has the same menu
    rows += [(100 + i, f"http://c.example/{'aab'[i]}/{i}", f"<div>Menu</div><p>{story(i // 2) * 3}</p>{'<p>x</p>' if i == 1 else ''}", "") for i in range(3)]
    rows += [(200 + i, f"http://n.example/{i:02d}", f"{notice}<p>{story(i)}</p>", "") for i in range(20)]
    # copies alone on their host stay whole
    rows += [(300 + i, f"http://d.example/{i}", "".join(f"<p>{flood(k)}</p>" for k in range(9)) + f"<p>{i}</p>", "") for i in range(5)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] == story(i) for i in range(6))
    assert got[100] == story(0) * 3 and got[101] == story(0) * 3 + " x" and got[102] == story(1) * 3
    assert all(got[200 + i] == story(i) for i in range(20))
    assert all(got[300 + i] == " ".join([*(flood(k) for k in range(9)), str(i)]) for i in range(5))


def test_classes_of_wrappers_keep_the_text():
    story = "<h1>Head</h1><p>The story is told here.</p>"
    told = "Head The story is told here."
    wrappers = ["<div class='layout has-sidebar'>", "<div id=page class='no-sidebar'>", "<div class='social-sciences'>", "<div class='sidebar-left'>", "<form id=f>", "<div class='widget'><div class='overlay wrapper'>"]
    for wrapper in wrappers:
        close = "</div>" * wrapper.count("<div") + "</form>" * wrapper.count("<form")
        aside = "<div class='sidebar'>side</div><div class='comments'><article>reader</article></div>"
        assert html_text.main_text(f"<body>{wrapper}{story}{aside}{close}", None) == told, wrapper
        assert html_text.main_text(f"<body><p>Site</p>{wrapper}<article>{story}</article>{aside}{close}<nav>x</nav>", None) == told, wrapper
        assert html_text.main_text(f"<body><article>{wrapper}{story}{aside}{close}</article>", None) == told, wrapper
    assert html_text.main_text(f"<article class='post comments-open'>{story}</article><p>more</p>", None) == told
    # what readers say may be longer than the text, and teasers may be articles
    assert html_text.main_text(f"{story}<div class='comment-list'><article>{'reader ' * 50}</article></div>", None) == told
    assert html_text.main_text(f"{story}<div class='related-posts'><article>teaser</article></div>", None) == told
    assert html_text.main_text(f"<article>{story}</article><div class='related'><article>{'teaser ' * 50}</article></div>", None) == told


def test_in_an_article_only_what_stands_at_one_end_goes():
    def page(*texts):
        return np.array([(xxhash.xxh64_intdigest(t.encode()), len(t), html_text.ARTICLE) for t in texts], html_text._LINE)

    own = page("Share this", "Title", "One two three four.", "A quote that others have.", "What is new here today.", "All rights reserved")
    near = [
        page("Share this", f"Title {i}", f"Story number {i} has its own words.", *(["A quote that others have."] if i < 3 else []),
             f"More words of story {i}.", f"Its end {i}.", "All rights reserved")
        for i in range(8)
    ]
    assert html_text.deleted_lines(own, near) == [0, 5]
    # a line that stands twice stays, if one of the two has to
    twice = page("Share this", "Title", "One two three four.", "What is new here today.", "Share this", "Another line of it.")
    assert html_text.deleted_lines(twice, near) == []
