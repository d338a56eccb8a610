"""Main text of pages with and without marked articles."""

import math
from collections import Counter

import pytest

from pointlake.llm import site_style

SCHEMA = "page_id bigint, url string, html string, text string, host string, styles string"
FRAME = "<html><head><title>T</title><style>p{{}}</style></head><body>{}</body></html>"


def extract(spark, pages):
    rows = [(i, u, h, "clash", "clash", "clash") for i, u, h in pages]
    return site_style.extract(spark.createDataFrame(rows, SCHEMA).repartition(2))


ARTICLES = [
    ("<nav><ul><li><a href='/x'>menu</a></ul></nav><article><h1>Head</h1><p>One <b>two</b>three<br>four<p>five</article><footer>f</footer>",
     "Head One twothree four five"),
    ("<header>site</header><main><p>a &amp; b &lt;c&gt; &copy &#233;</p><aside>side</aside><form>f<button>b</button></form></main>", "a & b <c> © é"),
    ("<div class='ad'>buy</div><article><p>text<script>var t='</p>';</script> goes  on\n\there<div class='comments'><p>troll</div></article>",
     "text goes on here"),
    ("<article><p>not closed <i>at <!-- no > end --> all", "not closed at all"),
    ("<article><div class='share-bar'>share</div><p>body</p><div id='newsletter'>join</div><p hidden>x</p></article>", "body"),
    ("<div role='main'><p>by role</div><div class='cookie-notice'>cookies</div>", "by role"),
    ("<article class='comment'>troll</article><article>real</article>", "real"),
    ("<article>1 < 2 and 3 > 2<p data-x='a>b'>quoted</article>", "1 < 2 and 3 > 2 quoted"),
]


@pytest.mark.parametrize("body, text", ARTICLES)
def test_marked_articles(body, text):
    assert site_style.Page(FRAME.format(body)).main_text() == text


def test_a_table_of_pages(spark):
    pages = [(i, f"http://h{i % 3}.example.com/{i}", FRAME.format(body)) for i, (body, _) in enumerate(ARTICLES)]
    pages += [(100, None, None), (101, "x", ""), (None, "http://h", FRAME.format(ARTICLES[0][0])), (0, *pages[0][1:])]
    found = extract(spark, pages).collect()
    assert set(found[0].asDict()) == {"page_id", "url", "text", "n_chars"}
    want = [(str(i), text) for i, (_, text) in enumerate(ARTICLES)]
    want += [("100", ""), ("101", ""), ("None", ARTICLES[0][1]), ("0", ARTICLES[0][1])]
    assert sorted((str(r.page_id), r.text) for r in found) == sorted(want)
    assert all(r.n_chars == len(r.text) for r in found)


def unmarked(i):
    words = " ".join(f"word{i}x{k}" for k in range(40))
    return (
        "<div class='top'>The daily site of news and things</div><div class='links'>"
        + "".join(f"<a href='/{k}'>link{k}</a> " for k in range(6))
        + f"</div><div class='text'><p>{words}</p><p>more{i} of it</p></div><div class='low'>All rights reserved by us</div>"
    ), f"{words} more{i} of it"


def test_repeated_branches_of_a_site_go(spark):
    pages = [(i, f"http://site.example.com/{i}", FRAME.format(unmarked(i)[0])) for i in range(12)]
    pages += [(100 + i, f"http://site.example.com/copy{i}", pages[3][2]) for i in range(30)]
    found = {r.page_id: r.text for r in extract(spark, pages).collect()}
    assert found == {i: unmarked(i)[1] for i in range(12)} | {100 + i: unmarked(3)[1] for i in range(30)}


def test_a_lone_page_keeps_what_is_not_links(spark):
    text = "The daily site of news and things " + unmarked(1)[1] + " All rights reserved by us"
    assert [r.text for r in extract(spark, [(1, "http://a/", FRAME.format(unmarked(1)[0]))]).collect()] == [text]


def marked(i):
    words = " ".join(f"word{i}x{k}" for k in range(40))
    return (
        f"<nav><a href='/'>home</a></nav><article><p>{words}</p><div class='bio'>Written by the staff of us</div></article>"
        "<div class='low'>All rights reserved by us</div>"
    ), words


def test_the_tree_decides_on_marked_pages(spark):
    pages = [(i, f"http://site.example.com/{i}", FRAME.format(marked(i)[0])) for i in range(12)]
    assert {r.page_id: r.text for r in extract(spark, pages).collect()} == {i: marked(i)[1] for i in range(12)}


def test_an_unmarked_page_goes_by_the_marked_pages_of_its_host(spark):
    pages = [(i, f"http://site.example.com/{i}", FRAME.format(marked(i)[0])) for i in range(12)]
    pages.append((50, "http://site.example.com/50", FRAME.format("<p>only here</p><div class='low'>All rights reserved by us</div>")))
    assert {r.page_id: r.text for r in extract(spark, pages).collect()}[50] == "only here"


def test_marked_text_that_a_host_repeats_comes_back(spark):
    body = "<div class='ad'>buy {}</div><article><p>one text on many pages</p></article>"
    pages = [(i, f"http://site.example.com/{i}", FRAME.format(body.format(i))) for i in range(5)]
    assert {r.text for r in extract(spark, pages).collect()} == {"one text on many pages"}


@pytest.mark.parametrize("share", [0, 256, 1 << 40], ids=["none hot", "some hot", "all hot"])
def test_removed_paths_of_hosts_large_and_small(spark, share, monkeypatch):
    monkeypatch.setattr(site_style, "HOT_SHARE", share)
    pages = [(i, f"http://h{max(0, i - 55)}/", ["/own", f"/p#post-{i % 7}", "/menu", "/menu"]) for i in range(60)]
    parsed = spark.createDataFrame(
        [(i, url, [(path,) for path in paths]) for i, url, paths in pages], "__row long, host string, blocks array<struct<path:string>>"
    )
    low = [(url, path) for _, url, paths in pages for path in set(paths) if path == "/menu" or path == "/p#post-3"]
    removed = site_style.removed_of(parsed, spark.createDataFrame(sorted(set(low)), "host string, path string"))
    want = {i: ["/menu", "/p#post-3"] if i % 7 == 3 else ["/menu"] for i, _, _ in pages}
    assert {r["__row"]: sorted(r.removed) for r in removed.collect()} == want


def test_no_row_holds_the_tree_of_a_host(spark, monkeypatch):
    held = []
    monkeypatch.setattr(site_style, "texts", lambda rows, _: held.extend(rows.collect()) or rows)
    body = "<nav><a class='post-{0}' href='/'>x</a></nav><a id='{0}' href='/'>y</a><p>own{0}</p>"
    names = ["".join("abcd"[i >> k & 3] for k in (0, 2, 4)) for i in range(64)]
    extract(spark, [(i, "http://h/", FRAME.format(body.format(name))) for i, name in enumerate(names)])
    assert len(held) == 64 and max(len(r.removed) for r in held) == 2


FRAGMENTS = [
    ("a\n\n b ", "a b"), ("before <article> </article> after", "before after"), ("<nav>menu</nav> left\u00a0 over ", "left over"),
    ("x &amp;\ty<script>1</script>", "x & y"), (" \n ", ""), ("<article></article>", ""), ("<!-- c --> bare", "bare"),
]


def test_pages_without_undecided_elements(spark):
    found = extract(spark, [(i, f"http://h{i}/", html) for i, (html, _) in enumerate(FRAGMENTS)]).collect()
    assert {r.page_id: r.text for r in found} == {i: text for i, (_, text) in enumerate(FRAGMENTS)}
    assert all(r.n_chars == len(r.text) for r in found)


def test_empty(spark):
    assert extract(spark, []).count() == 0


def many_pages():
    pages = [(i, f"http://h{i % 3}.example.com/{i}", FRAME.format((marked, unmarked)[i % 2](i % 17)[0])) for i in range(40)]
    return [*pages, *[(100 + i, *pages[i][1:]) for i in range(9)], (200, None, pages[0][2])]


def test_neither_pages_nor_words_are_kept_in_tables(spark, monkeypatch):
    kept, written = [], site_style.written
    monkeypatch.setattr(site_style, "written", lambda rows, name: kept.append(rows.columns) or written(rows, name))
    assert extract(spark, many_pages()).count() == 50
    assert kept and not {c for columns in kept for c in columns} & {"blocks", "__html", "word", "text"}


def plain_importances(pages):
    """The sums of the module's head, page by page."""
    words, sizes, shown = {}, {}, {}
    for host, html in {((site_style.HOST.match(u or "") or ["", ""])[1], h) for _, u, h in pages}:
        page, found = site_style.Page(html), {}
        for path, text, _, linked in page.blocks():
            if text.split():
                found.setdefault(path, Counter()).update(["<a>"] * len(text.split()) if linked else text.split())
        for path, counts in found.items():
            sizes[host, path] = sizes.get((host, path), 0) + 1
            for word, n in counts.items():
                words.setdefault((host, path), {}).setdefault(word, []).append(n)
        for path, style, children, n in page.styles():
            shown.setdefault((host, path), Counter())[style, children] += n
    out = {}
    for node, of in words.items():
        m, total = sizes[node], sum(map(sum, of.values()))
        entropy = sum(-sum(n / sum(ns) * math.log(n / sum(ns)) for n in ns) for ns in of.values()) / len(of)
        content = (1 - (entropy / math.log(m) if m > 1 else 0)) * (1 - sum(of.get("<a>", [])) / total)
        styles, m = shown.get(node, {}), sum(shown.get(node, {}).values())
        presented = -sum(n / m * math.log(n / m) for n in styles.values()) / math.log(m) if m > 1 else 1
        share = 0.9 ** (sum(children * n for (_, children), n in styles.items()) / m if m else 0)
        out[node] = share * content + (1 - share) * presented
    return out


@pytest.mark.parametrize(
    "limits", [{}, {"HELD_WORDS": 1, "BUCKET_LETTERS": 100}, {"MOST_COPIED": 0}, {"LOW_BYTES": 0}], ids=lambda limits: "-".join(limits) or "as set"
)
def test_importances_and_texts_whatever_the_limits(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(site_style, name, value)
    pages = many_pages()
    source = site_style.pages_of(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), "page_id", "url", "html")
    got = {(r.host, r.path): r.importance for r in site_style.importances(source).collect()}
    assert got == pytest.approx(plain_importances(pages))
    texts = {r.page_id: r.text for r in extract(spark, pages).collect()}
    assert all(texts[i] == (marked, unmarked)[i % 2](i % 17)[1] for i in range(40) if i % 2 == 0)
    assert all(texts[100 + i] == texts[i] for i in range(9)) and len(texts) == 50
