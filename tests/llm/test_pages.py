import random

import numpy as np

from linebeam.llm.htmltext import lines_of, main_text, mates, page_text
from linebeam.llm.lcs import _align, shared

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p><article>";</script></head>
<body class="home"><header><a href="/">Site</a></header><nav><ul><li>Home<li>News</ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use <b>cookies</b></div><main><article class="post"><header><h1>Ti&amp;tle</h1></header>
<p>One <b>two</b>\n  three&nbsp;x<p>Four<br>five &lt;b&gt;<ul><li>a<li>b</ul><aside>rel</aside>
<div id="comments"><p>nice</p></div><form>mail<input></form></article></main><div class=sidebar>side</div><footer>foot"""


def test_roles():
    assert main_text(PAGE, None) == "Ti&tle\nOne two three x\nFour five <b>\na\nb"
    assert main_text(None, None) == main_text("", None) == main_text("<p></p><script>x", None) == ""
    assert main_text("plain &amp text", None) == "plain & text"
    assert main_text("<p>a<p>b</b> c<div>d", None) == "a\nb c\nd"
    texts, _ = lines_of(PAGE)
    assert "no" not in texts and "Site" in texts


def _hash(lines):
    from linebeam.llm.htmltext import line_hashes
    return line_hashes(lines)


def test_differencing_without_article():
    mine = "<div>Menu</div><p>own text</p><div>Imprint</div>"
    assert main_text(mine, _hash(["Menu", "other text", "Imprint"])) == "own text"
    assert main_text(mine, _hash(["Menu", "own text", "Imprint"])) == "Menu\nown text\nImprint"   # a copy shows nothing
    assert main_text(f"<article>{mine}</article>", _hash(["Menu", "own text", "Imprint"])) == "Menu\nown text\nImprint"


def test_lcs_equals_table(monkeypatch):
    def length(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]
    rnd = random.Random(2)
    for cells in (4_000_000, 9):
        monkeypatch.setattr("linebeam.llm.lcs.CELLS", cells)
        for _ in range(150):
            a, b = ([rnd.randrange(4) for _ in range(rnd.randrange(12))] for _ in "ab")
            a, b = np.array(a, np.int64), np.array(b, np.int64)
            mask = shared(a, b)
            assert mask.sum() == length(a, b) == len(_align(a, b))
            it = iter(b.tolist())
            assert all(x in it for x in a[mask].tolist())


def test_mates_are_nearest_in_path_order(spark):
    rows = [(1, "h", "/a/1"), (2, "h", "/a/2"), (3, "h", "/b/1"), (4, "i", "/a/1"), (5, "h", "/b/2/x"), (6, "j", "/"), (7, "j", "/z")]
    got = {r["key"]: r["mate"] for r in mates(spark.createDataFrame(rows, "key long, host string, path string")).collect()}
    assert got == {1: 2, 2: 1, 3: 5, 5: 3, 4: None, 6: 7, 7: 6}


def test_pages_edge_cases(spark):
    art = "<nav>n</nav><article><p>text {}</p></article><footer>f</footer>"
    rows = [(i, f"http://h.example/p/{i}", art.format(i), 0, "x") for i in range(40)]
    rows += [(50, None, art.format(50), 0, "x"), (51, "not a url", None, 0, "x"), (None, "http://h.example/p/1", "", 0, "x"),
             (0, "http://h.example/p/0", art.format(0), 0, "x"), (60, "http://h.example/q", "<p>" + "w " * 200000, 0, "x"),
             (61, "http://k.example/a", "<p>Menu<p>one", 0, "x"), (62, "http://k.example/b", "<p>Menu<p>two", 0, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, key long, lines string")
    got = {}
    for r in page_text(df).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
    assert got[0] == ["text 0"] * 2 and got[7] == ["text 7"] and got[50] == ["text 50"] and got[51] == [""] and got[None] == [""]
    assert len(got[60][0]) == 399999 and got[61] == ["one"] and got[62] == ["two"]
    assert page_text(df.limit(0)).collect() == []


def test_attributes_alone_do_not_hide_an_article():
    text = "<article{}><p>one</p><p>two</p></article>"
    for page in ('<div class="layout has-sidebar">' + text.format("") + "</div>", '<main id="main-search"><p>one</p><p>two</p></main>',
                 text.format(' class="post has-comments"'), '<div id="search">' + text.format("") + "</div>", text.format(" class=discussion")):
        assert main_text(page, None) == main_text(page, _hash(["other"])) == "one\ntwo", page
    inside = '<article><p>one</p><div class="notice"><p>mind this</p></div><div class="related"><p>More</p></div></article>'
    assert main_text(inside, _hash(["other", "More"])) == "one\nmind this"
    assert main_text(inside, None) == "one"
    assert main_text('<div class="sidebar"><p>side</p></div><p>own</p>', None) == "own"


def test_the_text_is_chosen_by_its_mass():
    teaser = "<div id=content><h1>Title</h1><p>The long article text.</p></div><section><article>Teaser</article></section>"
    assert main_text(teaser, None) == main_text(teaser, _hash(["other"])) == "Title\nThe long article text."
    assert main_text("<main><h1>Title</h1><p>Lead</p><article>body</article></main>", None) == "Title\nLead\nbody"
    assert main_text("<main><h1>Title</h1><p>Share</p><article>body</article></main>", _hash(["Share"])) == "Title\nbody"
    copy = "<main><h1>Title</h1><article>body</article></main>"
    assert main_text(copy, _hash(["Title", "body"])) == "Title\nbody"
    assert main_text("<article><p>one</p><article><p>Other story</p></article><p>two</p></article>", None) == "one\ntwo"
    related = "<article><p>own</p></article><div class=related><article><p>More</p></article></div>"
    assert main_text(related, None) == "own"
    assert main_text("<p>short</p><article><p>a longer text</p></article>", None) == "a longer text"


def test_names_with_parts():
    page = '<div class="site-footer">Imprint</div><ol class="comment-list"><li>nice</ol><div class="nav-menu">Home</div><div id="cookie-banner">Cookies</div>{}'
    assert main_text(page.format("<p>the text of the page itself, longer than all that</p>"), None) == "the text of the page itself, longer than all that"
    assert main_text('<div class="page-with-sidebar"><p>one</p></div>', None) == "one"
    assert main_text('<div class="sidebar-layout"><p>one</p><p>two</p></div><p>x</p>', None) == "one\ntwo\nx"   # more than the rest: it is the text
    assert main_text('<article class="post"><div class="image-comment">stays</div></article>', None) == "stays"


def brute_mates(keys):
    """{key: mate}: of the neighbours in path order on the host, the one that shares more leading segments."""
    order = sorted(keys, key=lambda k: (k[1], k[2], k[0]))

    def near(a, b):
        if not b or a[1] != b[1]:
            return -1
        x, y = a[2].split("/"), b[2].split("/")
        return next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)) if len(x) == len(y) else min(len(x), len(y)))
    out = {}
    for i, k in enumerate(order):
        prev, nxt = order[i - 1] if i else None, order[i + 1] if i + 1 < len(order) else None
        p, q = near(k, prev), near(k, nxt)
        out[k[0]] = prev[0] if p >= q and p >= 0 else nxt[0] if q >= 0 else None
    return out


def test_all_pages_of_a_table_equal_a_plain_version(spark):
    """Pairing and alignment over pages.parquet, and over the same pages without article and main
    elements, where differencing has to find the text: against a plain pairing and a table of the LCS."""
    import re

    from linebeam.llm.htmltext import line_hashes
    pages = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html").collect()]
    bare = [(i, u, re.sub("</?(?:article|main)[^>]*>", "", h or "")) for i, u, h in pages]

    def lcs_mask(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                t[i][j] = t[i + 1][j + 1] + 1 if a[i] == b[j] else max(t[i + 1][j], t[i][j + 1])
        return t[0][0]

    for table in (pages, bare):
        df = spark.createDataFrame(table, "page_id long, url string, html string")
        got = {r["page_id"]: r["text"] for r in page_text(df).collect()}
        address = lambda u: re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*))?([^?#]*)", u or "").groups()
        ids = {r["k"]: r["page_id"] for r in df.selectExpr("xxhash64(page_id, url, html) as k", "page_id").collect()}
        keys = [(k, (address(u)[0] or "").lower(), address(u)[1] or "") for k, i in ids.items() for j, u, _ in table if j == i]
        html = {k: h for k, i in ids.items() for j, _, h in table if j == i}
        for k, mate in brute_mates(keys).items():
            lines = None if mate is None else line_hashes(lines_of(html[mate])[0]).tolist()
            assert got[ids[k]] == main_text(html[k], lines)
            if mate is not None:
                mine = line_hashes(lines_of(html[k])[0])
                assert shared(mine, np.array(lines, np.int64)).sum() == lcs_mask(mine.tolist(), lines)
