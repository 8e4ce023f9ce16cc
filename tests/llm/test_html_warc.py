import base64
import hashlib
import io
import os
import tempfile

import pyarrow as pa
import pytest
import zstandard

from wardline.llm import htmltext, warc

PAGE = """<!doctype html><HTML><head><title>x < y</title><style>a{{}}</style></head><body class=home>
<header class="site-header"><h2>Site</h2></header><nav>menu</nav><div id="cookie-notice">We use cookies<p>ok</div>
<main><article class="post-{n}"><header><h1>Head&nbsp;line &amp;amp; co</h1></header><p>One <b>two<br>three</b>
 four<p>five<ul><li>six<li>seven</ul><aside>side</aside><table><tr><td>a<td>b</table><script>if (a<b) "</p>"</script>
<form>send <input name=q></form><div class="comments"><p>reader says</p></div><pre>x
  y</pre>tail</article></main><div class="sidebar"><a href="x>y">links</a></div><footer>f</footer></body></html>"""
MAIN = "Head line &amp; co\nOne two three four\nfive\nsix\nseven\na\nb\nx y\ntail"


def test_blocks_of_an_untidy_page():
    assert htmltext.extract(PAGE.format(n=12), []) == (MAIN, "body.home>main>article.post-#")


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain  text", "plain text"), ("<p>a", "a"), ("a<b", "a"), ("<div", ""), ("<p>x</p><!-- open", "x"),
    ("<p>ü &eacute; &#x41;&am", "ü é A&am"), ("<p>a<script>b", "a"), ("<p>a &lt;b&gt; c", "a <b> c"),
    ("<div><div><p>x</div></p></div>y", "x\ny"), ("<p>" * 3000 + "deep", "deep"), ("<b>" * 3000 + "x", "x"),
    ("<![CDATA[a<b]]>", "a<b"), ("<p>x" * 5, "\n".join("x" * 5))])
def test_awkward_pages(page, text):
    assert htmltext.extract(page, [])[0] == text


@pytest.mark.parametrize("name", [
    "content has-sidebar", "site-content no-sidebar", "layout--no-ads", "post-content print-content", "blog-post comments-open",
    "hasSidebar", "search social"])
def test_names_of_clutter_on_the_wrapper_lose_no_article(name):
    body = "<p>long enough text, with commas, and more.</p>" * 5
    want = "\n".join(["long enough text, with commas, and more."] * 5)
    rest = "<div class=sidebar><p>links and ads</p></div><div id=comments><p>reader says</p></div>"
    for inner in (f"<article>{body}</article>", f"<div class=text>{body}</div>"):
        assert htmltext.extract(f"<body><div class='{name}'>{inner}{rest}</div></body>", [])[0] == want


def test_marked_elements_weigh_less_and_an_empty_page_takes_them_back():
    text, more = "the story goes on, and on. " * 10, "a reader says this, and that. " * 14
    page = f"<body><div class=text><p>{text}</p></div><div class=comments><p>{more}</p></div></body>"
    assert htmltext.extract(page, [])[0] == text.strip()
    # a short article in a marked wrapper, beside longer text
    page = f"<body><div class=print><article><p>{text}</p></article></div><div class=x><p>{more}</p></div></body>"
    assert text.strip() in {b[1] for b in htmltext.blocks(page, htmltext._Names())}
    page = "<body>" + "".join(f"<div class=widget><p>part {i} of it</p></div>" for i in range(3)) + "</body>"
    assert [b[1] for b in htmltext.blocks(page, htmltext._Names())] == ["part 0 of it", "part 1 of it", "part 2 of it"]
    assert htmltext.blocks(page.replace("widget", "notice"), htmltext._Names()) == []    # notices are no article


def test_hosts_agree_on_the_container(spark):
    good = "<body><div class=wrap><div class='text-{0}'>" + "<p>long enough text, with commas, and more.</p>" * 5 \
        + "</div><div class=odd>{1}</div></div>"
    rows = [(i, f"http://www.h.org/{i}", good.format(i, "<p>short</p>")) for i in range(9)]
    # a page whose own best container is the wrong one follows its host
    rows.append((9, "http://h.org/9", good.format(9, "<p>x, y, z. " * 500)))
    rows += [(10, None, "<p>no host</p>"), (11, "http://other.org", None), (None, "bad url", "<p>t</p>"), rows[0]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "'x' AS paths")
    got = htmltext.main_text(pages).collect()
    by_id = {r.page_id: r for r in got}
    want = "\n".join(["long enough text, with commas, and more."] * 5)
    assert len(got) == 14 and all(by_id[i].text == want and by_id[i].path == "body>div.wrap>div.text-#" for i in range(10))
    assert (by_id[10].text, by_id[11].text, by_id[None].text) == ("no host", "", "t")
    assert all(r.n_chars == len(r.text) for r in got)
    alone, _ = htmltext.extract(rows[9][2], [])
    assert alone != want
    assert htmltext.main_text(pages.limit(0)).count() == 0


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS sha1", "'x' AS refers_to")


ROWS = [(3, "http://a", "same"), (1, "http://b\r\nX: y", "same"), (2, None, "same"), (4, "u", None), (5, "u", ""),
        (6, "u", "ünïcödé \r\n\r\n WARC/1.1 😀"), (7, "u", "big " * 100_000), (None, "u", "alone"), (None, "u", "same"),
        (8, "u", "twice"), (8, "u", "twice")]


def test_round_trip(spark):
    root = tempfile.mkdtemp(prefix="wardline-warc-")
    index = warc.write(pages(spark, ROWS), root, frame_bytes=2000, bundle_bytes=3000)
    got = warc.records(index, root).collect()
    first = {}
    for page_id, _, html in ROWS:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    assert len(got) == len(ROWS)
    seen = sorted((r.page_id is None, r.page_id or 0, r.payload_digest, r.record_type, r.refers_to or -1, r.payload_bytes) for r in got)
    want = []
    for page_id, _, html in ROWS:
        payload = (html or "").encode()
        home = first.get(html or "")
        revisit = home is not None and home != page_id
        want.append((page_id is None, page_id or 0, base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                     "revisit" if revisit else "response", home if revisit else -1, len(payload)))
    assert seen == sorted(want)
    text = {(r.page_id, r.record_type): r for r in got}
    assert bytes(text[6, "response"].payload).decode() == ROWS[5][2] and text[2, "revisit"].payload is None
    assert text[2, "revisit"].url is None and text[1, "response"].url == "http://b%0D%0AX: y"
    # one record by its index row alone
    for entry in index.collect():
        assert warc.fetch(root, entry)[0] == entry["page_id"]


def test_bundles_are_plain_zstandard_and_closed_by_a_seek_table(spark):
    root = tempfile.mkdtemp(prefix="wardline-warc-")
    index = warc.write(pages(spark, [(i, "u", f"page {i} " * 50) for i in range(40)]), root, frame_bytes=3000)
    folder, total = os.path.join(root, "bundles"), 0
    for name in os.listdir(folder):
        data = open(os.path.join(folder, name), "rb").read()
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        total += plain.count(b"WARC/1.1\r\n")
        table = warc.frame_table(pa.OSFile(os.path.join(folder, name)))
        assert len(table) > 1 and sum(size for _, _, size in table) == len(plain)
    assert total == 40 == index.count()


def test_small_payloads_may_all_be_responses_and_empty_table(spark):
    root = tempfile.mkdtemp(prefix="wardline-warc-")
    got = warc.records(warc.write(pages(spark, ROWS), root, least_bytes=5), root).collect()
    assert {r.record_type for r in got if r.payload_bytes < 5} == {"response"}
    root = tempfile.mkdtemp(prefix="wardline-warc-")
    assert warc.records(warc.write(pages(spark, ROWS).limit(0), root), root).count() == 0


ARTICLE = "<p>The first paragraph, of the article. It says something.</p><p>The second one, short.</p>"
SAID = "The first paragraph, of the article. It says something.\nThe second one, short."
THREAD = "".join(f"<div class='c'><p>Reader {k} says a lot, and more, and still more. And again.</p></div>" for k in range(40))


@pytest.mark.parametrize("page, want", [
    (f'<body><div class="post">{ARTICLE}<div class="comments">{THREAD}</div></div></body>', SAID),
    (f'<body><article>{ARTICLE}</article><section id="comments">{THREAD}</section></body>', SAID),
    (f'<body><article>{ARTICLE}<div class="post-comments">{THREAD}</div></article></body>', SAID),
    (f'<body><article>{ARTICLE}</article><div id="disqus"><article>{THREAD}</article></div></body>', SAID),
    (f'<body><form id="aspnetForm"><input name="x"><div>{ARTICLE}</div></form></body>', SAID),
    (f'<body><div>{ARTICLE}</div><form><p>Your name</p><select><option>a</option></select></form></body>', SAID),
    ('<body><div class="cookie-notice"><p>We use cookies, as all do. Accept them.</p></div></body>', ""),
    (f'<body><div class="content ads">{ARTICLE}</div></body>', SAID),
    (f'<body><div class="blog-post comments-open">{ARTICLE}<div class="ad">Buy now, buy more.</div></div></body>', SAID),
    (f'<body><div class="comment-page"><article>{ARTICLE}</article></div></body>', SAID),
    (f'<body><div class="post" title="a > b < c">{ARTICLE}</div></body>', SAID),
])
def test_comments_notices_and_forms(page, want):
    from wardline.llm import htmltext
    assert htmltext.extract(page, [])[0] == want


@pytest.mark.parametrize("page", ["<a " * 330_000, "<a 'x " * 160_000, '<a "x ' * 160_000, "<div>x" * 160_000, "<script " * 120_000,
                                  "<script>a</script " * 50_000, "<div>x</div>" * 80_000, "<div>" * 5_000 + "<p>x</p></b></i>" * 50_000])
def test_untidy_pages_take_linear_time(page):
    import time
    from wardline.llm import htmltext
    start = time.time()
    htmltext.extract(page, [])
    assert time.time() - start < 5
