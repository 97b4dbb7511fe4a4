import collections
import math
import random
import re

import pytest

from tarmac.llm import sitetree
from tarmac.llm.common import ship


def text_of(source, low=()):
    return sitetree.main_text(sitetree.parse(source), set(low))


@pytest.mark.parametrize("source, want", [
    ("<html><body><nav>Menu</nav><article><h1>T &amp; t</h1><p>One\n two<p>Three<br>four</article><footer>f</footer>", "T & t\nOne two\nThree four"),
    ("<p>a<b>b</b>c &lt;x&gt;</p><script>var t='</p>';</script><p>d</p>", "abc <x>\nd"),
    ("<div class='side-bar sidebar'>s</div><div id=content><p>x</p></div><div class=\"ad\">a</div>", "x"),
    ("<article><p>x</p><div class='comments'><p>first!</p></div><form><p>Name</p></form><aside>s</aside></article>", "x"),
    ("<article><header><h1>T</h1></header><p>x</article><section class='comment-list'><article class='comment'>c</article></section>", "T\nx"),
    ("<main><ul><li>a<li>b</ul><table><tr><td>1<td>2</table></main>", "a\nb\n1\n2"),
    ("<p>cut off &am", "cut off &am"), ("<p>cut <a href='x", "cut"), ("<!-- never closed <p>x", ""),
    ("a < b and c > d", "a < b and c > d"), ("", ""), ("<p>x</p><div hidden>h</div><div style='display: none'>n</div>", "x"),
    ("<title>t</title><style>p{}</style><p>A&nbsp;&#233;&eacute;  b</p><noscript>n</noscript>", "A éé b"),
    ("<div role=navigation>n</div><div role='main'><p>m</p></div><dialog>d</dialog><button>b</button>", "m"),
    ("</p></div></article>text<b><i>x</b></i>y", "textxy"), ("<p>" + "word " * 50000 + "</p>", ("word " * 50000).strip()),
])
def test_single_pages(source, want):
    assert text_of(source) == want


def site(n):
    """Pages without any telling names: the same boxes around different texts."""
    return [(i, f"https://Host.example.org/p/{i}", "<html><body><div class='q1'><div class='q2'>Same words on every page</div></div>"
             f"<div class='q3'><p>Story {i} begins here {i * 7}.</p><p>It goes on {i * 13}.</p></div>"
             "<div class='q4'><p>Legal text of the site</p></div></body></html>") for i in range(n)]


def test_low_entropy_branches_of_a_host_are_removed(spark):
    ship(spark)
    pages = site(40) + [(100, "https://other.example.org/", site(1)[0][2])]
    got = {r["page_id"]: r["text"] for r in sitetree.extract(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Story {i} begins here {i * 7}.\nIt goes on {i * 13}." for i in range(40))
    assert got[100].startswith("Same words on every page\nStory 0")  # one page tells nothing about its host


def test_importance_of_the_tree(spark):
    ship(spark)
    tree = {r["path"]: r for r in sitetree.style_tree(
        spark.createDataFrame(site(40), "page_id long, url string, html string")).collect()}
    assert tree["/html/body/div.q3/p"]["m"] == 80
    tree = {r["path"]: r["importance"] for r in sitetree.style_tree(spark.createDataFrame(
        [(i, u, h.replace("'q3'", "'story'").replace("'q1'", "'top'")) for i, u, h in site(40)],
        "page_id long, url string, html string")).collect()}
    assert tree["/html/body/div.top"] < 0.1 < 0.9 < tree["/html/body/div.story/p"]


def test_copies_of_one_page_keep_their_text(spark):
    ship(spark)
    same = [(i, "https://h.example.org/x", "<body><div><p>Only text.</p></div></body>") for i in range(50)]
    same += [(60 + i, "https://h.example.org/y", "<article><p>Only text.</p></article>") for i in range(50)]
    got = sitetree.extract(spark.createDataFrame(same, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {"Only text."}


def test_odd_rows_and_empty_table(spark):
    ship(spark)
    rows = [(1, None, None, "x"), (None, "no url", "<p>x</p>", "y"), (2, "", "", "z"), (2, "", "", "z"),
            (3, "ftp://H/", "<article></article><p>outside</p>", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sitetree.extract(pages)
    assert got.columns == ["page_id", "url", "text"]
    assert sorted((r["page_id"] or 0, r["text"]) for r in got.collect()) == [
        (0, "x"), (1, ""), (2, ""), (2, ""), (3, "outside")]
    assert sitetree.extract(pages.filter("false")).count() == 0


@pytest.mark.parametrize("source, want", [
    ("<body><form id=aspnetForm><div class=menu>m</div><article><p>The story.</p></article></form>", "The story."),
    ("<form id=aspnetForm><div class=menu>m</div><p>The whole long story.</p></form>", "The whole long story."),
    ("<div class='content-with-sidebar'><p>x</p></div><p>A longer text beside it.</p>", "x\nA longer text beside it."),
    ("<div class='has-header no-sidebar'><p>x</p><div class=sidebar>s</div></div><p>y z</p>", "x\ny z"),
    ("<div class='social-layout'><p>The story.</p><div class=share>s</div></div>", "The story."),
    ("<div id='page-login-free'><main><p>t</p></main></div><p>A much longer text around the site.</p>", "t"),
    ("<article><p>x</p></article><div class=related><article><p>Another story, longer.</p></article></div>", "x"),
    ("<div><p>Short.</p></div><div class=comments><p>A long comment by a reader.</p></div>", "Short."),
    ("<article><div class='comment-free widget'><p>only</p></div></article>", "only"),
])
def test_marked_elements_around_the_article(source, want):
    assert text_of(source) == want


PARAGRAPHS = [f"Paragraph {i} of the story goes on for some words." for i in range(12)]
STORY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)


@pytest.mark.parametrize("source, before", [
    ("<article><h1>Title</h1><div class='article-body share-enabled'>{}</div></article>", ["Title"]),
    ("<article><h1>Title</h1><div class='entry-content alert-box-wrapper'>{}</div></article>", ["Title"]),
    ("<main><h1>Title</h1><form id=aspnetForm>{}</form></main>", ["Title"]),
    ("<main><h1>Title</h1><div class='notice-board'>{}</div></main>", ["Title"]),
    ("<p>A short line.</p><div class='post comments-open'>{}</div>", ["A short line."]),
    ("<h1>Title</h1><fieldset>{}</fieldset>", ["Title"]), ("<h1>Title</h1><div role=dialog>{}</div>", ["Title"]),
    ("<body role=dialog>{}</body>", []), ("<h1>Title</h1><div class=comments>{}</div>", ["Title"]),
    ("<article><div class=promo><p>Buy.</p></div>{}<div class='share'>Share it</div></article>", []),
    ("<article>{}</article><div class=comments><p>" + "A very long comment by a reader. " * 60 + "</p></div>", []),
    ("<article>{}<div class=comments><p>" + "A very long comment by a reader. " * 60 + "</p></div></article>", []),
    ("<div class='widget'><p>w</p></div><div class='main-wrapper sidebar-layout'>{}<div class=sidebar>s</div></div>", []),
])
def test_an_article_in_marked_elements_stays(source, before):
    assert text_of(source.format(STORY)) == "\n".join(before + PARAGRAPHS)


def brute_importance(pages):
    """``path: importance`` of one host by the definition, over its distinct pages."""
    styles, contents, seen = {}, {}, set()
    for _, _, source in pages:
        page = sitetree.parse(source)
        blocks = [(b[0], b[1]) for b in page.blocks] + page.noise
        key = tuple(blocks)
        if key in seen:
            continue
        seen.add(key)
        for path, children in page.styles:
            styles.setdefault(path, []).append(children)
        for path, text in blocks:
            contents.setdefault(path, []).append(text)

    def diversity(values):
        m = len(values)
        return 1.0 if m == 1 else -sum(c / m * math.log(c / m, m) for c in collections.Counter(values).values())

    out = {}
    for path, seen_styles in styles.items():
        below = [(len(t), diversity(t)) for p, t in contents.items() if p == path or p.startswith(path + "/")]
        if path.count("/") and below:
            content = sum(m * d for m, d in below) / sum(m for m, _ in below)
            fade = sitetree.GAMMA ** (sum(map(len, seen_styles)) / len(seen_styles))
            out[path] = (1 - fade) * diversity(seen_styles) + fade * content
    return out


def test_the_tree_equals_its_definition(spark):
    ship(spark)
    pages = [(i, "http://one.example.org/", source) for i, _, source in site(30)]
    pages += [(100 + i, "http://one.example.org/x", f"<nav><ul><li>a{i % 3}</li><li>b</li></ul></nav><div><p>t{i}</p></div>")
              for i in range(25)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["path"]: r["importance"] for r in sitetree.style_tree(frame).collect()}
    want = brute_importance(pages)
    assert got.keys() == want.keys()
    assert all(abs(got[p] - want[p]) < 1e-9 for p in got)


def test_menus_fall_against_the_articles_of_their_host(spark):
    """Menus whose links differ from page to page, on a host that no word list helps with."""
    ship(spark)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    pages = []
    for i in range(60):
        links = "".join(f"<li>{word()}</li>" for _ in range(6))
        story = "".join(f"<p>{' '.join(word() for _ in range(20))}</p>" for _ in range(rng.randrange(2, 9)))
        pages.append((i, "http://two.example.org/", f"<div class=top><ul>{links}</ul></div><div class=text>{story}</div>"))
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    for r in sitetree.extract(frame).collect():
        assert r["text"].split("\n") == re.findall(r"<p>(.*?)</p>", pages[r["page_id"]][2])


@pytest.mark.parametrize("source, want", [
    ("<p>a</p><svg class=icon/><p>b</p>", "a\nb"), ("<p>a <math/> b</p>", "a b"),
    ("<p>a</p><svg/><p>b</p><svg><title>t</title></svg><p>c</p>", "a\nb\nc"),
    ("<p>a</p><svg class=icon><path d='M0'><p>b</p><svg><text>t</text></svg><p>c</p>", "a\nb\nc"),
    ("<p>a</p><svg><foreignObject><div>t</div></foreignObject></svg><p>c</p>", "a\nc"),
    ("<p>a</p><object data=x><p>b</p>", "a\nb"), ("<p>a</p><select><p>b</p>", "a\nb"),
    ("<p>a</p><script>never closed <p>b</p>", "a"), ("<p>a</p><select><option>o</select><p>b</p>", "a\nb"),
])
def test_elements_without_their_end_tag(source, want):
    assert text_of(source) == want


def test_copies_do_not_outweigh_the_distinct_pages_of_a_host(spark):
    ship(spark)
    pages = site(40)
    pages += [(100 + i, "https://host.example.org/copy", pages[0][2]) for i in range(360)]
    got = {r["page_id"]: r["text"] for r in sitetree.extract(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Story {i} begins here {i * 7}.\nIt goes on {i * 13}." for i in range(40))
    assert all(got[100 + i] == got[0] for i in range(360))
