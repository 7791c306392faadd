"""Main text of pages."""

import math
import random
from collections import Counter, defaultdict

import pytest

from siglake.llm import html_extract

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">menu</a></li></ul></nav><!-- no --><div class="ad">buy</div>
<div class="cookie-notice">cookies</div><article><h1>Head &amp; more</h1><p>One <b>bold</b>
 text.<p>Two&#33;<br>lines &lt;x&gt;</p><form>name<input></form><section class="comments"><p>me too</p></section></article>
<aside>side</aside><footer>&copy; host</footer></body></html>"""


def test_blocks():
    assert [t for _, t in html_extract.blocks(PAGE)] == ["Head & more", "One bold text.", "Two! lines <x>"]


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<div class='layout has-sidebar'><p>text</p><div class=sidebar>side</div></div>", ["text"]),
        ("<main class='content with-sidebar'><p>text</p></main>", ["text"]),
        ("<article class='post social-policy'><p>text</p></article>", ["text"]),
        ("<article class='widget'><h1 class='page-header'>Title</h1><p>text</p></article>", ["Title", "text"]),
        ("<article><div class='page-header'><h2>Title</h2></div><p>text<div class='social-share'>x</div></article>", ["Title", "text"]),
        ("<form id=f><header>top</header><div><h1>Title</h1><p>text</p></div></form>", ["Title", "text"]),
        ("<form><nav>n</nav><article><p>text</p></article></form>", ["text"]),
        ("<main><h1>Title</h1><div class=widget><article><p>text</p></article></div></main>", ["Title", "text"]),
        ("<main><form><article><p>text</p></article></form></main>", ["text"]),
        ("<div class=sidebar><main><p>text</p></main></div>", ["text"]),
        ("<article><p>text</p><div class=comments><article>me too</article></div></article><aside><article>more</article></aside>", ["text"]),
        ("<div><p>text</p></div><aside><article>more</article></aside>", ["text", "more"]),
        ("<article><p>a <span class=ad>buy</span> b</p><form>name</form></article>", ["a b"]),
        ("<div class='site-footer'>f</div><div id='main-nav'>n</div><p>text</p>", ["text"]),
    ],
)
def test_roles_do_not_take_an_article(page, texts):
    assert [t for _, t in html_extract.blocks(page)] == texts


@pytest.mark.parametrize("page", ["", "<", "<p", "</p></p>", "<p>a<p>b</div>", "&amp;&bogus;&#x41;", "<script>x", "a < b"])
def test_broken_pages(page):
    html_extract.blocks(page)


def test_repeated_branch_is_removed(spark):
    rows = [(i, f"http://h.example/{i}", f"<div class=c><p>text {i} is here</p></div><div class=k><p>Always the same</p></div>") for i in range(30)]
    rows += [(100, "http://other.example/", rows[0][2]), (101, None, None), (102, "x", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    assert all(got[i] == f"text {i} is here" for i in range(30))
    assert got[100] == "text 0 is here\nAlways the same" and got[101] == got[102] == ""


def test_copies_keep_their_text_and_no_rows(spark):
    rows = [(i, "http://h.example/", "<p>the same</p>") for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 host", "2 text", "3 path")
    assert {r["text"] for r in html_extract.extract(pages).collect()} == {"the same"}
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_articles_and_copies_lose_nothing(spark):
    """Titles of copied articles, recurring subheadings and copies of a page without an article."""
    article = "<article><h1>The title</h1><p>one</p><p>two</p><p>three</p></article>"
    rows = [(i, "http://copies.example/", article) for i in range(40)]
    heads = "<article><h2>Ingredients</h2><p>with {0}</p><h2>Steps</h2><p>do {0}</p><h2>Notes</h2><p>see {0}</p></article>"
    rows += [(100 + i, "http://recipes.example/", heads.format(i)) for i in range(100)]
    plain = "<div class=c><p>{}</p></div>"
    rows += [(300 + i, "http://plain.example/", plain.format("</p><p>".join(f"page {min(i, 3)} {k}" for k in range(3)))) for i in range(2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    assert all(got[i] == "The title\none\ntwo\nthree" for i in range(40))
    assert all(got[100 + i] == f"Ingredients\nwith {i}\nSteps\ndo {i}\nNotes\nsee {i}" for i in range(100))
    importance = {r["host"]: r for r in html_extract.importance(pages).where("path like '%p'").collect()}
    assert importance["plain.example"]["blocks"] == 12 and importance["plain.example"]["importance"] == 1


def test_inner_nodes_have_composite_importances(spark):
    page = "<div class=c><p>text {0}</p></div><div class='k w-1/2'><p>Same</p><ul><li>Always</li></ul></div><nav>n</nav>"
    rows = [(f"http://a.example/{i}", page.format(i)) for i in range(20)]
    rows += [(f"http://b.example/{i}", f"<section><p>one {i}</p>{'<p>two %d</p>' % i * (i % 2)}</section>") for i in range(20)]
    rows += [(f"http://c.example/{i}", f"<div><p>Same</p></div><article><h1>Title</h1><p>text {i}</p></article>") for i in range(20)]
    pages = spark.createDataFrame(rows, "url string, html string")
    trees = html_extract.composite(html_extract._distinct_pages(pages, "html", "url"))
    found = {(r["host"], r["path"]): r["importance"] for r in trees.collect()}
    aside = "div.k.w-1\x1f2"
    assert found["a.example", "div.c/p"] == 1 and found["a.example", aside + "/ul/li/#text"] == found["a.example", aside] == 0
    assert found["a.example", "div.c"] == pytest.approx(0.9)
    assert found["a.example", ""] == pytest.approx(0.9 * 0.9 / 3)  # of three children
    entropy = 1 / math.log2(20)  # of two presentation styles, equally often
    assert found["b.example", "section"] == pytest.approx(0.19 * entropy + 0.81)
    assert found["c.example", ""] == pytest.approx(0.9 / 2) and found["c.example", "article"] == 1  # beside a div without main text
    assert [(r["host"], r["path"]) for r in html_extract.noise(trees).collect()] == [("a.example", aside)]
    texts = {r["url"]: r["text"] for r in html_extract.extract(pages).collect()}
    assert texts["http://a.example/3"] == "text 3" and texts["http://b.example/3"] == "one 3\ntwo 3" and texts["http://c.example/3"] == "Title\ntext 3"


def test_deeply_nested_page(spark):
    pages = spark.createDataFrame([("http://h.example/", "<div>" * 5_000 + "deep" + "</div>" * 5_000 + "<p>end")], "url string, html string")
    assert html_extract.extract(pages).first()["text"] == "deep\nend"


def _trees(pages, settings=html_extract.Settings()):
    """Plain version of ``composite`` and ``noise`` for one host: (importance, stays) by path, and the branches."""
    texts, styles, main, held, up = defaultdict(Counter), defaultdict(Counter), set(), defaultdict(int), {}
    for page in set(pages):
        found = html_extract._parsed(page)
        for x in found.blocks:
            path = found.elements[x.at].path
            node = html_extract._child(path, found.elements[x.at].level, "#text")
            up[node], held[node] = path, max(held[node], x.held)
            texts[node][x.text] += x.held > 0
            if x.main and x.held == 2:
                main.add(node)
        for x, what in zip(found.elements, found.held):
            if what >= 0:
                up[x.path], held[x.path] = found.elements[x.up].path if x.up >= 0 else None, max(held[x.path], what)
                styles[x.path][tuple(html_extract._child(x.path, x.level, c) for c in x.children)] += what > 0
                if x.main and what == 2:
                    main.add(x.path)

    def entropy(counts):
        n = sum(counts.values())
        return 1 - sum(c * math.log2(c) for c in counts.values() if c) / n / math.log2(n) if n > 1 else 1.0

    def value(path):
        if path not in held or path in main or not held[path]:
            return float(path in main)
        if path in texts:
            return entropy(texts[path])
        rows = {k: c for k, c in styles[path].items() if c}
        inner = any(not c.endswith("#text") for k in styles[path] for c in k)
        d = settings.damping ** len(rows) if inner else 1.0
        below = sum(c * sum(map(value, k)) / max(len(k), 1) for k, c in rows.items()) / sum(rows.values())
        return (1 - d) * entropy(styles[path]) + d * below

    values = {x: value(x) for x in held}
    rare = {x for x, counts in texts.items() if sum(counts.values()) < settings.min_blocks}
    stays = {x: held[x] > 0 and (x in rare or values[x] >= settings.least) for x in held}
    busy = set()
    for x in [x for x in held if stays[x]]:
        while x is not None:
            busy.add(x)
            x = up[x]
    whole = {x for x in held if held[x] == 2 and x not in busy}
    return {x: (values[x], stays[x]) for x in held}, {x for x in whole if up[x] not in whole}


def _random_page(rng, i):
    def text():
        return rng.choice([f"own {i} {rng.random()}", "Same", "Same", "Twice"])

    def branch(depth):
        if depth == 0 or rng.random() < 0.3:
            return f"<p>{text()}</p>"
        tag = rng.choice(["div", "div class=k", "div class='c/d'", "ul", "nav", "form", "div class=widget", "aside"])
        return f"<{tag}>{''.join(branch(depth - 1) for _ in range(rng.randint(0, 3)))}</{tag.split()[0]}>"

    article = f"<article><h1>Title</h1>{branch(2)}</article>" if rng.random() < 0.5 else "<h1>Title</h1>" * rng.randint(0, 1)
    around = "<div>" * rng.choice([0, 0, 0, 63, 64, 130])
    return f"<html><body>{around}{branch(3)}{article}{branch(2)}{text()}<footer>f</footer></body></html>"


def test_trees_agree_with_plain_version(spark):
    rng = random.Random(4)
    pages = [_random_page(rng, i) for i in range(150)]
    table = spark.createDataFrame([("http://h.example/", x) for x in pages + pages[:20]], "url string, html string").repartition(3)
    trees = html_extract.composite(html_extract._distinct_pages(table, "html", "url")).cache()
    expected, branches = _trees(pages)
    found = {r["path"]: (r["importance"], r["stays"]) for r in trees.collect()}
    assert found.keys() == expected.keys() and trees.count() == len(found) and branches
    assert all(found[x][0] == pytest.approx(v) and found[x][1] == stays for x, (v, stays) in expected.items())
    noise = [r["path"] for r in html_extract.noise(trees).collect()]
    assert set(noise) == branches and len(noise) == len(branches)
    assert any("\x1e" in x for x in expected) and any(not x for x, _ in expected.values()) and any("nav" in x for x in expected)


def test_trees_have_given_importances(spark):
    """Menus, footers and what is in an article are nodes like all others."""
    page = "<nav><ul><li>menu</ul></nav><article><h1>Title</h1><div><p>text {0}</div></article><footer>host</footer>"
    pages = spark.createDataFrame([(f"http://h.example/{i}", page.format(i)) for i in range(20)], "url string, html string")
    trees = html_extract.composite(html_extract._distinct_pages(pages, "html", "url"))
    found = {r["path"]: (r["importance"], r["stays"]) for r in trees.collect()}
    quiet = ["nav", "nav/ul", "nav/ul/li", "nav/ul/li/#text", "footer", "footer/#text"]
    loud = ["article", "article/h1", "article/h1/#text", "article/div", "article/div/p", "article/div/p/#text"]
    assert found == {"": (pytest.approx(0.3), True)} | dict.fromkeys(quiet, (0, False)) | dict.fromkeys(loud, (1, True))
    assert html_extract.noise(trees).count() == 0


def test_text_beside_articles_counts(spark):
    """What is the same on all pages is removed from the few that have no article."""
    aside = "<div class=k><p>Always the same</p></div>"
    rows = [(f"http://h.example/{i}", f"<article><p>text {i}</p></article>{aside}") for i in range(30)]
    rows += [(f"http://h.example/x{i}", f"<div class=c><p>plain {i}</p></div>{aside}") for i in range(5)]
    got = {r["url"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert got == {u: f"text {i}" for i, (u, _) in enumerate(rows[:30])} | {u: f"plain {i}" for i, (u, _) in enumerate(rows[30:])}


def test_deep_branches_are_told_apart(spark):
    page = "<div class=c><p>text {0}</p></div><div class=k><ul><li>Same</li></ul></div><nav>n</nav>"
    rows = [(f"http://{depth}.example/{i}", "<div>" * depth + page.format(i)) for depth in (62, 63, 64, 65, 127, 128, 300) for i in range(20)]
    got = html_extract.extract(spark.createDataFrame(rows, "url string, html string")).collect()
    assert len(got) == 140 and all(r["text"] == "text " + r["url"].rpartition("/")[2] for r in got)


@pytest.mark.parametrize(
    "page",
    [
        "<html><head><title>T</title><meta charset=utf-8><body><p>text</p></body></html>",
        "<html><head><title>T</title><style>p{}</style><p>text",
        "<html><head><title>T</title>\n<script>s</script> text",
        "<html><head><title>T</title></head><body><p>text",
    ],
)
def test_end_of_head_may_be_left_out(page):
    assert [t for _, t in html_extract.blocks(page)] == ["text"]
