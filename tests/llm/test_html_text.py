import html
import re

from pyspark.sql import functions as F

from linea.llm import html_text, urls


def test_blocks_inline_and_references():
    page = """<html><head><title>T</title><script>var a="</p><p>no";</script><style>p{}</style></head><body>
    <nav><ul><li><a>Menu</a></ul></nav><header>Site</header><!-- <p>hidden</p> -->
    <article><header><h1>Head&amp;line</h1></header><p>One <b>bo</b>ld&nbsp;&#x41;&lt;b&gt;<p>Two<br>lines<ul><li>x<li>y</ul>
    <div class="comments"><p>Reader says</p></div><form>Name <input name="a>b"></form><aside>Side</aside>
    <blockquote>Quoted &unreal; &am</blockquote></article><div id="cookie-notice">We use</div><footer>&copy; me</footer>"""
    assert html_text.extract(page) == "Head&line One bold A<b> Two lines x y Quoted &unreal; &am"


def test_fallbacks_and_broken_pages():
    e = html_text.extract
    assert e(None) == e("") == e("<html><body></body></html>") == e("<!-- only") == e("<nav>x</nav>") == ""
    assert e("plain text") == "plain text" and e("<p>a<p>b<div cla") == "a b"
    assert e("<main><p>in</p></main><p>out</p>") == "in"
    assert e("<article></article><p>out</p>") == "out"
    assert e("<article class='comment'>no</article><article>yes</article>") == "yes"
    assert e("<div><header>top</header><p>a</p></div>") == "a"
    assert e("<p>1 < 2 & 3 > 2</p>") == "1 < 2 & 3 > 2"
    assert e("<p>x</i></b>y</p></div>z") == "xy z"
    assert e("<p>" * 20000 + "deep" + "<b>" * 20000) == "deep"
    assert len(e("<p>" + "word " * 200000)) == 5 * 200000 - 1


def test_names_are_whole_tokens_and_wrappers_keep_their_article():
    e = html_text.extract
    inner = "<article><header><h1>Head</h1></header><p>Body.</p></article>"
    for wrapper in ('<div class="layout has-sidebar">', '<div class="site menu-closed">', '<div class="widget">', '<div id="modal">'):
        assert e(f"<body>{wrapper}{inner}</div><footer>x</footer></body>") == "Head Body."
    assert e(f'<div class="site menu-closed"><main><p>In main.</p></main></div>') == "In main."
    assert e(f'<html><body class="comments-open">{inner}</body></html>') == "Head Body."
    assert e('<article><p>a</p><div class="share-price">12 EUR</div><div class="menu-of-the-day">Soup</div></article>') == "a 12 EUR Soup"
    for name in ("cookie-notice", "site-footer", "main-nav", "sidebar left", "related-posts", "reader-comments", "comment-42", "ad_slot", "social-links"):
        assert e(f'<article><p>a</p><div class="{name}">no</div></article>') == "a", name
    assert e('<ol class="comment-list"><article class="comment"><p>me</p></article></ol><p>text</p>') == "text"


def test_template_removal(spark):
    rows = []
    for i in range(30):
        body = "".join(f"<p>Story {i} part {j}.</p>" for j in range(4))
        rows.append((i, "http://a.org/x", f"<body><div><span>Subscribe to our letter</span></div><div>{body}</div><div>Seen on A</div></body>", "c"))
    for i in range(30, 42):  # equal articles of one host stay: they are content
        rows.append((i, "http://b.org/x", f"<article><p>Same text everywhere.</p><div>Copied box {i % 2}</div></article><footer>{i}</footer>", "c"))
    rows += [(99, None, None, "c"), (98, "http://a.org/y", "<body><div>Seen on A</div></body>", "c"), (98, "http://a.org/y", "", "c")]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, text string")
    got = html_text.main_text(pages, urls.host(F.col("url"))).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id < 30:
            assert r.text == " ".join(f"Story {r.page_id} part {j}." for j in range(4))
        elif r.page_id < 42:
            assert r.text in ("Same text everywhere.", f"Same text everywhere. Copied box {r.page_id % 2}")
    assert [r.text for r in got if r.page_id == 99] == [""]
    assert html_text.main_text(pages.limit(0), urls.host(F.col("url"))).count() == 0


def test_pages_hold_their_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: " ".join(r.text.split()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in html_text.main_text(spark.read.parquet(f"{sf}/pages.parquet"), urls.host(F.col("url"))).collect():
        shown = int(re.search(r"://[^/]+/\w+/(\d+)", r.url)[1])
        title = " ".join(html.unescape(re.search(r"<h1>(.*?)</h1>", r.html, re.S)[1]).split())
        assert r.text == f"{title} {docs[shown]}".strip()


def test_templates_of_a_part_of_a_large_host(spark):
    rows = [(i, "http://a.org/x", f"<body><div>Notice of one section</div><div>{'Story of this section. ' * 3}<p>Part {i}.</p></div></body>"
             if i < 20 else f"<body><div><p>Story {i}.</p></div></body>") for i in range(200)]
    rows += [(200, "http://a.org/x", "<body><div>Notice of one section</div></body>"),
             (201, "http://a.org/x", "<main><div>Notice of one section</div><p>Short.</p></main>"),
             (202, "http://b.org/x", "<body><div>Notice of one section</div></body>")]
    rows += [(300 + i, "http://c.org/x", f"<body><div>Seen on {i % 2}</div><p>Story {i}.</p></body>") for i in range(18)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_text(pages, urls.host(F.col("url"))).collect()}
    for i in range(20):  # a tenth of the host's pages
        assert got[i] == "Story of this section. " * 3 + f"Part {i}."
    assert got[200] == "" and got[201] == "Notice of one section Short." and got[202] == "Notice of one section"
    assert all(got[300 + i] == f"Seen on {i % 2} Story {i}." for i in range(18))  # 9 pages each: too few


def test_a_template_that_is_most_of_a_page_goes(spark):
    rows = [(i, "http://a.org/x", f"<body><div><p>Story {i}.</p></div><div>Seen on A</div></body>") for i in range(30)]
    rows.append((98, "http://a.org/y", "<body><div>Seen on A</div></body>"))
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_text(pages, urls.host(F.col("url"))).collect()}
    assert got == {**{i: f"Story {i}." for i in range(30)}, 98: ""}


def test_templates_equal_a_plain_count(spark):
    import random
    from collections import Counter

    rng = random.Random(3)
    boxes = [f"<div class='b{i}'><span>Box {i}</span></div>" for i in range(6)]
    pages = [(i, f"h{i % 2}", "<body>" + "".join(rng.sample(boxes, rng.randint(0, 4))) + f"<p>Own {i % 37}.</p></body>") for i in range(80)]
    df = spark.createDataFrame(pages, "id int, host string, html string")
    for least in (3, 10):
        counts = Counter()
        for host, page in {(h, p) for _, h, p in pages}:
            counts.update((host, d) for d in set(html_text.containers(html_text.parse(page))))
        key = {(r.host, r.html): r.key for r in df.select("host", "html", F.xxhash64("host", "html").alias("key")).collect()}
        want = {}
        for host, page in {(h, p) for _, h, p in pages}:
            if common := {d for d in html_text.containers(html_text.parse(page)) if counts[host, d] >= least}:
                want[key[host, page]] = common
        got = {r.key: set(r.templates) for r in html_text.templates(df, F.col("host"), "html", least).collect()}
        assert got == want and want
