import random
import time
from collections import defaultdict

from foldlake.llm import html_text as h

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li>Home<li>More</ul></nav><header>Site</header><div class="ad">Buy &amp; go</div><main><article><header><h1>The&nbsp;title</h1>by me</header>
<p>One <b>bold
 word<p>Two&lt;3 <br>lines<div class="cookie-notice">We use cookies</div><form><p>Search</p></form><p hidden>no</p>
<section class="comments"><p>nice!</p></section><table><tr><td>a<td>b</table></article></main><aside>Side</aside><footer>&copy; x</footer><!-- <p>no</p> --></body></html>"""


def test_article_without_the_rest():
    assert h.extract(PAGE) == "The title\n\nOne bold word\n\nTwo<3 lines\n\na\n\nb"
    assert h.extract("") == "" and h.extract("plain") == "plain" and h.extract("<p") == "<p"
    assert h.extract("<div><p>a</p>b<ul><li>c<li>d</ul></div>") == "a\n\nb\n\nc\n\nd"
    assert len(h.extract("<p>" + "word " * 100_000)) == 499_999


def test_templates_are_deleted(spark):
    shared = "<div><p>Read our other sites</p></div>"
    rows = [(i, f"http://a.example/{i}", f"<body>{shared}<p>Text number {i}</p></body>") for i in range(12)]
    rows += [(100 + i, "http://b.example/x", "<body><p>Same story</p></body>") for i in range(12)]  # copies are no template
    rows += [(200, None, "<p>x</p>"), (201, "http://a.example/", None), (None, "", ""), (201, "http://a.example/", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "'x' AS template", "'x' AS text")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in h.extract_pages(df).collect()), key=str)
    want = [(i, f"Text number {i}", len(f"Text number {i}")) for i in range(12)] + [(100 + i, "Same story", 10) for i in range(12)]
    assert got == sorted([*want, (200, "x", 1), (201, "", 0), (201, "", 0), (None, "", 0)], key=str)
    assert h.extract_pages(df.limit(0)).count() == 0


def test_short_sentences_of_articles_stay(spark):
    rows = [(i, f"http://a.example/{i}", f"<article><h1>Title {i}</h1><p>Yes.</p><p>Body {i}</p></article>") for i in range(8)]
    out = h.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text == f"Title {r.page_id}\n\nYes.\n\nBody {r.page_id}" for r in out)


def site(host, pages, seed):
    """Pages without any telling element or name: boxes of the site, and an article of paragraphs of its own."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    top, side, end = (" ".join(word() for _ in range(n)) for n in (6, 9, 12))
    out = []
    for i in range(pages):
        own = [" ".join(word() for _ in range(rng.randint(3, 30))) for _ in range(rng.randint(1, 5))]
        body = "".join(f"<div class='t'>{x}</div>" for x in own)
        page = f"<body><div id='x1'><div>{top}</div></div><div class='c'>{body}</div><div><div>{side}</div></div><div>{end}</div></body>"
        out.append((f"http://{host}/{i}", page, "\n\n".join(own), "\n\n".join([top, *own, side, end])))
    return out


def test_hashes_alone_decide(spark):
    """Without templates the boxes of a site stay, with them only the articles do: on every page."""
    pages = site("one.example", 30, 1) + site("two.example", 5, 2) + site("few.example", 2, 3)
    df = spark.createDataFrame([(i, url, page) for i, (url, page, _, _) in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in h.extract_pages(df).collect()}
    for i, (url, page, article, everything) in enumerate(pages):
        assert h.extract(page, set()) == everything
        assert got[i] == (everything if "few" in url else article)


def test_template_counts_equal_brute_force(spark):
    pages = site("one.example", 25, 4) + site("two.example", 4, 5)
    df = spark.createDataFrame([(i, url, page) for i, (url, page, _, _) in enumerate(pages * 2)], "page_id long, url string, html string")
    on, articles = defaultdict(set), defaultdict(set)
    for url, page, _, _ in pages:
        root, where = h.parse(page), url.split("/")[2]
        main = h.container(root)
        text = "\n\n".join(h.blocks(main, set()))
        articles[where].add(text)
        for value, kind, node in h.hashes(root, main):
            assert kind == h.OUTSIDE
            if node is not main:
                on[where, value].add(text)
    want = {where: sorted(v for (w, v), texts in on.items() if w == where and len(texts) >= max(3, 0.1 * len(articles[where]))) for where in articles}
    assert {r.host: r.template for r in h.templates(df).collect()} == want


def test_doubtful_names_need_a_count(spark):
    def page(i, notice, n):
        return (i, f"http://{n}.example/{i}", f"<article><h1>Title {i}</h1><div class='notice'>{notice}</div><p>Body {i}</p></article>")

    rows = [page(i, "We moved." if i in (3, 4) else f"Mind the gap {i}.", "big") for i in range(6)] + [page(9, "Accept?", "small")]
    got = {r.page_id: r.text for r in h.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == "Title 0\n\nMind the gap 0.\n\nBody 0" and got[3] == "Title 3\n\nBody 3" and got[9] == "Title 9\n\nBody 9"


def test_versions_of_one_article_keep_their_text(spark):
    body = "".join(f"<p>Paragraph {i} of the story that all versions share.</p>" for i in range(8))
    rows = [(i, f"http://a.example/{i}", f"<article>{body}<p>Version {i}</p></article>") for i in range(14)]
    out = h.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text.count("\n\n") == 8 for r in out)


def test_article_text_is_not_lost():
    assert h.extract('<article><p class="share-price">Up 3</p><p id="ad-hoc">A group</p><p>x</p></article>') == "Up 3\n\nA group\n\nx"
    assert h.extract('<article class="related"><p>Text</p></article>') == "Text"
    assert h.extract("<main><header><h1>Title</h1><p>Lead</p></header><p>x</p></main>") == "Title\n\nLead\n\nx"
    assert h.extract('<article><div class="ad-container">Buy</div><ul id="post-comments"><li>c</ul><div class="share_buttons">S</div><p>x</p></article>') == "x"


def test_hostile_pages_take_time_in_proportion():
    def seconds(page):
        began = time.process_time()
        h.extract(page)
        return time.process_time() - began

    for make in (
        lambda n: "<article>x" * n,
        lambda n: "<b>" * n + "</i>" * n,
        lambda n: "<b>" * n + "<hr>" * n,
        lambda n: "<b>" * n + "<tr>" * n,
        lambda n: "<a " * n,
        lambda n: "<a 'x" * n,
        lambda n: "<p><!--" * n,
        lambda n: "<div><p>t" * n + "</div>" * n,
    ):
        seconds(make(2000))
        assert seconds(make(16_000)) < 25 * max(0.02, seconds(make(2000))), make(2)
