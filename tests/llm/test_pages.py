"""HTML extraction, the pipeline and what holds for all of the subpackage."""

from __future__ import annotations

import html
import random
import re
import time

import plain
import pytest

from cardloom.llm import html_extract as h


def article(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    return re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", "\n", body)))).strip()


def test_pages_query(run, duck):
    pages = duck.execute("SELECT page_id, url, html FROM pages").fetchall()
    assert run("op1_html_extract", "page_id", "url", "text", "n_chars") == {p: (u, article(x), len(article(x))) for p, u, x in pages}


def test_alignment_infers_groups_options_and_slots():
    a = h.stream("<ul><li>x</li><li>y</li></ul><p>t</p>")
    b = h.stream("<ul><li><b>x</b></li></ul><h2>n</h2><p>t<br>u</p><dl><dt>1<dd>2<dt>3<dd>4</dl>")
    assert h.written(a) == "ul { li+ { # } } p { # }"
    joined = h.written(h.aligned(a, b))
    assert joined == "ul { li+ { #? b? { # } } } h2? { # } p { # br? #? } dl? { (+ { dt { # } dd { # } } }"
    assert h.written(h.read(joined)) == joined
    assert h.written(h.aligned(h.read(joined), a)) == joined


SITE = ("<html><body><header><h1>Site</h1></header><div class='wrap'><div class='tools'><a href=1>One</a></div><div class='text'>"
        "<h2>Title {0}</h2><p>{1}</p><p>Read &amp; learn {0}</p></div><div class='foot'>Made by us</div></div>"
        "<section id='comments'><p>Nice {1}</p></section></body></html>")


def site(n):
    rng = random.Random(n)
    words = [" ".join(rng.choice(("red", "green", "blue", "grey")) for _ in range(60)) for _ in range(n)]
    return [(i, f"https://One.example.org/{i}", SITE.format(i, w)) for i, w in enumerate(words)], words


def test_region_without_article(spark):
    pages, words = site(8)
    got = h.main_texts(spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "1 AS rule")).collect()
    assert {r.id: r.text for r in got} == {i: f"Title {i} {w} Read & learn {i}" for i, w in enumerate(words)}


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &lt;text&gt; only", "plain <text> only"), ("<p>a<p>b", "a b"), ("<article>a<b>b</b>c<br>d</article>", "abc d"),
    ("<article><nav>n</nav>x<aside>y</aside><div class='ad'>z</div><form>f</form><!-- c --><script>s('</p>')</script></article>", "x"),
    ("<article>&nbsp;a&#x41;&#" + "9" * 5000 + "; &bogus; &copy</article>", "aA� &bogus; ©"), ("<article>1 < 2 and 3 > 2</article>", "1 < 2 and 3 > 2"),
    ("<article><header><h1>T</h1><p>by me</p></header><p>x</article>", "T x"), ("<article>open <p>text <a href='", "open text"),
    ("<article>x</article><article class='comment'>y</article>", "x"), ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ("<body class='no-sidebar'><main>m</main><footer>f</footer>", "m"), ("<article hidden>x</article><p>y", "y"),
])
def test_odd_pages(spark, page, text):
    assert h.main_text(page or "", None) == text
    rows = spark.createDataFrame([(1, None, page), (1, None, page), (None, "no host", page)], "page_id long, url string, html string")
    assert [r.text for r in h.main_texts(rows).collect()] == [text] * 3


ARTICLE = ("<body><article><h1>Title {0}</h1><div class='x-a'>The same <b>line</b> everywhere</div><div class='x-b'>From the archive<p>{1}</p></div>"
           "<p>Written in <b>{1}</b></p><h2>Part <a href=1>{0}</a></h2><ul><li><a href=1>Read {1}</a></li><li><a href=2>More {0}</a></li></ul>{2}</article>")


def test_template_inside_an_article(spark):
    words = site(8)[1]
    pages = [(i, f"https://one.example.org/{i}", ARTICLE.format(i, w, "<p class='rare'>Kept</p>" * (i < 3))) for i, w in enumerate(words)]
    pages += [(10 + i, "https://copies.example.org/", ARTICLE.format(1, "same", "")) for i in range(4)]
    pages.append((20, "https://one.example.org/x", "<body><article><div class='x-a'>The same <b>line</b> everywhere</div></article>"))
    got = {r.id: r.text for r in h.main_texts(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    want = {i: f"Title {i} {w} Written in {w} Part {i}" + " Kept" * (i < 3) for i, w in enumerate(words)}
    want |= {10 + i: "Title 1 The same line everywhere From the archive same Written in same Part 1 Read same More 1" for i in range(4)}
    assert got == want | {20: "The same line everywhere"}


@pytest.mark.parametrize("more", ["", "<p>" + "word " * 220_000 + "</p>", "<p>5\" wide</p>", "<p>" + "l'homme don't " * 50 + "</p>", "<!-- \" -->"])
def test_quoted_end_of_tag(more):
    page = f"<article><p title=\"x -> y\">one <img alt='a > b'>two</p><div data-x=\"1>0\" class='advert'>buy</div>{more}<p>end</article>"
    middle = h.main_text(f"<article>{more}</article>", None)
    assert h.main_text(page, None) == " ".join(x for x in ("one two", middle, "end") if x)


@pytest.mark.parametrize("page, text", [
    ("<article>x<a href=\"never ends>y</a> z</article>", "xy z"), ("<article>x <a \"b>y</a></article>", "x y"), ("<article>x <img alt=\"a > b\"", "x"),
    ("<article>x<a href=a\"b>y</a> <b title='c>d'>z</b></article>", "xy z"), ("<article>x<!-- > ", "x"), ("<article>x</b title='1>0'>y</article>", "xy"),
])
def test_quotes_by_tag(page, text):
    assert h.main_text(page, None) == text


@pytest.mark.parametrize("part", ["<a b=\"", "<a b='>", "<a b=\"x", "<a b=", "<a b='c' \"", "<!-- >"])
def test_quotes_stay_linear(part):
    begin = time.perf_counter()
    for end in ("", ">", "\">", "'>\""):
        h.main_text(part * 30_000 + end, None)
    assert time.perf_counter() - begin < 8


def test_no_pages(spark):
    assert h.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("part", ["<a ", "<a \"", "<", "<div>", "<p><b>", "</a ", "&#1", "<a href='x", "<!--"])
def test_hostile_pages_stay_linear(part):
    begin = time.perf_counter()
    h.main_text(part * 30_000, None)
    assert time.perf_counter() - begin < 8


def test_pipeline_against_plain_stages(spark, sf_dir, duck):
    import corpus_pipeline as p

    got = {r.doc_id: (r.n_tokens, len(r.ids)) for r in p.run(spark, sf_dir).collect()}
    docs = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    docs = [(d, t) for d, t in docs if any(c.isalpha() for c in t or "")]
    docs = [(d, t) for (d, t), x in zip(docs, plain.exact(docs).values()) if x[2]]
    linked = plain.linked(docs, 5, 80)
    docs = [(d, t) for d, t in docs if linked[d][1] == d]
    leaks = plain.leaks(docs, duck.execute("SELECT item_id, text FROM benchmark").fetchall())
    assert set(got) == {d for d, _ in docs if not leaks[d][-1]}
    assert all(a == b > 0 for a, b in got.values())


def test_pipeline_stages_keep_columns(make):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "decontaminate", "bpe"]
    docs = make([])
    assert p.no_exact_copies(docs.sparkSession, docs, "").columns == p.no_near_copies(docs.sparkSession, docs, "").columns == docs.columns


def test_nothing_else_imports_the_subpackage():
    from pathlib import Path

    root = Path(h.__file__).resolve().parents[1]
    assert not [f for f in root.rglob("*.py") if root / "llm" not in f.parents and "cardloom.llm" in f.read_text()]


@pytest.mark.parametrize("kept", [
    '<h2 id="related-work">Related work</h2>', '<h2 id="discussion">Discussion</h2>', '<section class="discussion"><p>We discuss.</p></section>',
    '<h2 id="search-results">Search results</h2>', '<p class="notice-period">Two months.</p>', '<p id="share-of-votes">A third.</p>',
    '<p class="ad-hoc">Made for it.</p>', '<p class="sharing">Sharing is good.</p>', '<div class="alert-levels">Level one.</div>',
    '<table class="menu-of-the-day"><tr><td>Soup</td></tr></table>', '<h3 class="comments">Comments of the author</h3>'])
def test_names_inside_words_do_not_drop_text(spark, kept):
    body = "<article><h1>T {i}</h1><p>Text number {i} of this page.</p>" + kept.replace("</", " {i}</", 1) + "</article>"
    frame = spark.createDataFrame([(i, f"http://h.example/{i}", body.format(i=i)) for i in range(5)], "page_id long, url string, html string")
    wanted = re.sub("<[^>]+>", " ", kept).split()
    for r in h.main_texts(frame).collect():
        assert set(wanted) <= set(r.text.split())


@pytest.mark.parametrize("name", ["ad", "ads-container", "cookie-banner", "related-posts", "share-buttons", "comments-area", "site-footer", "navBar", "newsletter_box"])
def test_compound_names_still_drop_blocks(spark, name):
    body = f'<article><h1>T</h1><p>Text.</p><div class="{name}">away away</div><div id="{name}">away too</div></article>'
    frame = spark.createDataFrame([(1, "http://h.example/1", body)], "page_id long, url string, html string")
    assert "away" not in h.main_texts(frame).first().text


def test_headings_that_repeat_stay_with_their_text(spark):
    body = ("<article><h1>T {i}</h1><h2>Summary</h2><p>Sum of {i}.</p><p>More {i}.</p><h2>Details</h2><p>Detail {i}.</p><p>Same on all pages.</p>"
            "<h2>Follow us</h2><p>Same again.</p></article>")
    frame = spark.createDataFrame([(i, f"http://h.example/{i}", body.format(i=i)) for i in range(5)], "page_id long, url string, html string")
    for r in h.main_texts(frame).collect():
        assert "Summary" in r.text and "Details" in r.text
