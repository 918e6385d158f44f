"""Main text: markup, differencing, neighbours, awkward pages."""

import random
import re

import pytest

from tagloom.llm.html_extract import common_lines, deleted_lines, main_text, neighbours, page_lines


def text_of(html):
    return " ".join(t for t, _ in page_lines(html))


CASES = [
    ("<article><h1>A&amp;B</h1><p>x  y\n z<br>q<b>b</b>c</p></article>", "A&B x y z qbc"),
    ("<nav>n</nav><article><p>one<p>two</article><footer>f</footer>", "one two"),
    ("<script>var t='</p>';if(a<b){}</script><style>p{}</style><body><p>k</p>", "k"),
    ("<body><header>h</header><main><p>m</p><aside>s</aside></main></body>", "m"),
    ("<div class='ad'>a</div><div id=content><p>c</p><div class='comments'><p>no</p></div></div>", "c"),
    ("<article><p>a</p><form><p>f</p></form><div class='cookie-notice'>c</div><p>b</p></article>", "a b"),
    ("<article><p>cut &am", "cut &am"), ("<p>tail <b", "tail"), ("", ""), (None, ""), ("no markup < here", "no markup < here"),
    ("<!-- <p>x</p> --><p>y</p>", "y"), ("<article><header><h1>T</h1></header><p>b</p></article>", "T b"),
    ("<ul><li>a<li>b</ul>", "a b"), ("<p title='a>b'>z</p>", "z"), ("<article><p>&eacute;&#233;&nbsp;&#x41;</p></article>", "éé A"),
    ("<article>a</article><article class='comment'><p>r</p></article>", "a"), ("<body><p hidden>h</p><p>v</p>", "v"),
    ("<table><tr><td>1</td><td>2</td></tr></table>", "1 2"), ("<article><p><b>open<br><p>next</p></article>", "open next"),
]


@pytest.mark.parametrize("html, want", CASES)
def test_lines_of_a_page(html, want):
    assert text_of(html) == want


def test_common_lines_is_a_longest_common_subsequence():
    rnd = random.Random(3)
    for _ in range(300):
        a, b = ([rnd.randint(0, 6) for _ in range(rnd.randint(0, 12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        pairs = common_lines(a, b)
        assert len(pairs) == best[-1][-1]
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def page(host, path, body):
    return f"http://{host}/{path}", body


def test_shared_lines_of_a_template_go(spark):
    frame = "<body><div>Welcome to the site</div><div>{}</div><div>All rights reserved by us</div></body>"
    rows = [(k, *page("h", f"a/{k}", frame.format(f"own text number {k} of this page"))) for k in range(6)]
    rows += [(10, *page("other", "x", frame.format("alone on its host")))]
    out = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[k] == f"own text number {k} of this page" for k in range(6))
    assert out[10] == "Welcome to the site alone on its host All rights reserved by us"


def test_article_paragraphs_that_pages_share_stay(spark):
    shared = "a passage that both of the articles quote at length"
    frame = "<nav>menu</nav><article><h1>{0}</h1><p>{0} body</p><p>" + shared + "</p><div>Share this</div></article>"
    rows = [(k, *page("h", f"{k}.html", frame.format(f"title {k} with some more words"))) for k in range(4)]
    rows += [(7, *page("copies", "a", "<article><p>same</p></article>")), (8, *page("copies", "b", "<article><p>same</p></article>"))]
    out = {r.page_id: r for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(4):
        t = f"title {k} with some more words"
        assert out[k].text == f"{t} {t} body {shared}" and out[k].n_chars == len(out[k].text)
    assert out[7].text == out[8].text == "same"


def test_neighbours_do_not_depend_on_partitions(spark):
    rows = [(k, k * 7, "h" if k % 3 else f"h{k}", f"/p{k % 50:03d}") for k in range(300)]
    keys = spark.createDataFrame(rows, "k1 long, k2 long, host string, path string")
    got = {(r.k1, r.n1) for r in neighbours(keys).collect()}
    order = sorted(rows, key=lambda r: (r[2], r[3], r[0]))
    assert got == {(a[0], b[0]) for a, b in zip(order, order[1:]) if a[2] == b[2]}


def test_awkward_rows(spark):
    rows = [(1, None, None), (1, None, None), (2, "", ""), (None, "http://h/", "<p>x</p>"), (3, "nonsense", "<p>" + "y " * 40_000), (4, "http://h", "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as k1", "2 as lines", "3 as part")
    out = main_text(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((r.page_id or 0, r.n_chars) for r in out.collect())
    assert got == [(0, 1), (1, 0), (1, 0), (2, 0), (3, 79_999), (4, 1)]
    assert main_text(pages.limit(0)).count() == 0


def test_given_pages_by_their_article(spark):
    import html as h

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in main_text(pages).collect():
        article = source[r.page_id].split("<article>")[1].split("</article>")[0]
        want = re.sub(r"<(?:/?(?:p|h1)|br)>", " ", article)
        assert r.text == " ".join(h.unescape(re.sub(r"<[^>]+>", "", want)).split())


KEPT = [
    ("<h1 class='post-title'>T</h1><div class='body'><p>the body text</p></div>", "T the body text"),
    ("<main><p>the main text</p></main><section><article>teaser</article></section>", "the main text teaser"),
    ("<div id='top'><article><p>inside a wrapper</p></article></div>", "inside a wrapper"),
    ("<div class='has-sidebar'><main><p>m</p><div class='sidebar'>s</div></main></div>", "m"),
    ("<div class='has-sidebar'><p>" + "word " * 9 + "</p><div class='sidebar'><p>s</p></div></div><p>x</p>", "word " * 9 + "x"),
    ("<article><p>a</p></article><div class='sidebar'><article>teaser</article></div>", "a"),
    ("<article><p>a</p></article><div class='promo-box'><p>" + "word " * 9 + "</p></div>", "a"),
    ("<p>a</p><div class='post-comments'><p>" + "word " * 9 + "</p></div>", "a"),
    ("<p>a</p><div class='cookie-notice'><p>" + "word " * 9 + "</p></div>", "a"),
]


@pytest.mark.parametrize("html, want", KEPT)
def test_marks_that_do_not_hold_the_text_drop_nothing_else(html, want):
    assert text_of(html) == want


WORDS = "amber birch cedar delta ember fjord grove heath inlet jetty knoll ledge marsh north ocean prairie quarry ridge".split()


def prose(seed, n=20):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 99)) for _ in range(n))


def texts_of(spark, rows):
    return {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


@pytest.mark.parametrize("n", [2, 3, 9])
def test_short_articles_in_a_large_template(spark, n):
    frame = f"<body><div>{prose('menu', 80)}</div><div>{{}}</div><div>{prose('foot', 80)}</div></body>"
    out = texts_of(spark, [(k, *page("h", f"a/{k}", frame.format(prose(k)))) for k in range(n)])
    assert out == {k: prose(k) for k in range(n)}


def test_runs_of_copies_lose_their_template(spark):
    frame = f"<body><div>{prose('menu')}</div><div>{{}}</div></body>"
    bodies = [prose("first", 30), *[prose("copied", 30)] * 5, prose("last", 30)]
    out = texts_of(spark, [(k, *page("h", f"a/{k}", frame.format(x))) for k, x in enumerate(bodies)])
    assert out == dict(enumerate(bodies))


def test_edited_copies_keep_their_text(spark):
    lines = [prose(k) for k in range(8)]
    rows = [(k, *page("h", f"a/{k}", "".join(f"<p>{x} {k}</p>" if j == k else f"<p>{x}</p>" for j, x in enumerate(lines)))) for k in range(6)]
    rows += [(9, *page("h", "a/9", "".join(f"<p>{x}</p>" for x in lines)))]
    out = texts_of(spark, rows)
    assert all(set(" ".join(lines).split()) <= set(t.split()) for t in out.values())


def test_notices_inside_marked_articles_go_and_quotes_stay(spark):
    notice, advert, quote = prose("notice"), prose("advert"), prose("quote")
    frame = "<article><p>{}</p><p>" + notice + "</p>{}<p>{}</p><ul><li>Subscribe now</li></ul><div>" + advert + "</div></article>"
    quoted = (3, 7)
    rows = [(k, *page("h", f"a/{k}", frame.format(prose(k), f"<p>{quote}</p>" if k in quoted else "", prose(k + 100)))) for k in range(10)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r.text for r in main_text(pages).collect()}
    assert out == {k: " ".join([prose(k), *[quote] * (k in quoted), prose(k + 100)]) for k in range(10)}
    report = deleted_lines(pages).first().asDict()
    assert report == {"pages": 10, "lines": 52, "deleted": 30, "deleted_on_host_evidence": 30}


def test_edited_copies_of_a_marked_article_are_no_evidence(spark):
    lines = [prose(k) for k in range(8)]
    body = lambda k: "".join(f"<p>{x} {k}</p>" if j == k % 8 else f"<p>{x}</p>" for j, x in enumerate(lines))
    out = texts_of(spark, [(k, *page("h", f"a/{k}", f"<article>{body(k)}</article>")) for k in range(12)])
    assert all(set(" ".join(lines).split()) <= set(t.split()) for t in out.values())
