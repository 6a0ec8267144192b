import html as H
import random
import re
import time
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from covtab.llm import page_diff, page_lines
from covtab.llm.common import read_table

SF = "/root/testdata/sf0.001"
COLUMNS = "page_id long, url string, html string"


def text_of(page):
    return " ".join(line for line, _ in page_lines.lines_of(page))


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<p>", ""), ("plain  text\n here", "plain text here"),
    ("<nav>menu</nav><article><h1>T</h1><p>a<b>b</b> c<p>d &amp; e&nbsp;f</article><footer>x</footer>", "T ab c d & e f"),
    ("<article><p><b>open <br>line<p>next</article>after", "open line next"),
    ("<article><p>a</p><script>var t='</p>';</script><style>p{}</style><!-- no --><p>b</p></article>", "a b"),
    ("<main><h1>T</h1><article><p>x</p></article><div class='share'>s</div></main><p>out</p>", "T x"),
    ("<body class='has-sidebar'><div class='sidebar'>s</div><article class='post'>x<aside>y</aside></article></body>", "x"),
    ("<article><p>x</p><section id='comments'><article class='comment'>c</article></section></article>", "x"),
    ("<form action='/'><article>" + "word " * 50 + "</article></form>", ("word " * 50).strip()),
    ("<div id='cookie-banner'>c</div><div class='post-content'><p>real</p></div><div>other</div>", "real"),
    ("<article><header><h1>T</h1></header><p>x</p><footer>tags</footer></article>", "T x"),
    ("<article>a<p class=ad>buy<p>b<ul><li class='promo'>no<li>yes</ul></article>", "a b yes"),
    ("<article>a<span hidden>h</span><span style='display: none'>n</span><span aria-hidden=\"true\">x</span>b</article>", "ab"),
    ("<article>1 < 2 and 3 > 2 &lt;b&gt; &#233; &am</article", "1 < 2 and 3 > 2 <b> é &am"),
    ("<p>a<p>b<script>never ends", "a b"), ("x<!-- never ends", "x"), ("<a title='it>s'>t</a>", "t"),
    ("<table><tr><td class='menu'>m<td>cell<tr><td>next</table>", "cell next"),
])
def test_lines(page, want):
    assert text_of(page) == want


def test_large_and_deep_pages():
    assert text_of("<article>" + "<div><p>x" * 20000) == " ".join("x" * 20000)
    assert text_of("<b>" * 20000 + "y") == "y"
    assert len(text_of("<article><p>" + "w " * 500000)) == 999999
    started = time.monotonic()
    for page in ("<title>" * 200000, "<i>" * 100000 + "<b>" * 100000 + "</i>" * 100000, "<" * 500000, "<a b=" * 200000, "<!-" * 300000,
                 "<ul>" * 50000 + "<li>" * 100000, "&" * 500000, "<p class='ad'>" * 100000, "<article>" * 50000 + "x" + "</article>" * 50000):
        text_of(page)
    assert time.monotonic() - started < 60


def test_given_pages_by_their_known_form(spark):
    """The given pages hold their article's blocks between its tags."""
    try:
        pages = read_table(spark, SF, "pages")
    except Exception:
        pytest.skip("test data not present")
    got = {r.page_id: r for r in page_diff.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want = " ".join(H.unescape(re.sub(r"</?(?:h1|p|br)>", " ", inner).replace("<b>", "")).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def plain_lcs(a, b):
    @lru_cache(None)
    def best(i, j):
        if i == len(a) or j == len(b):
            return 0
        return max(best(i + 1, j), best(i, j + 1), 1 + best(i + 1, j + 1) if a[i] == b[j] else 0)

    return best(0, 0)


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.randrange(rng.choice((2, 5, 20))) for _ in range(rng.randrange(25))] for _ in range(2))
        mask = page_diff.shared_lines(np.array(a, np.int64), np.array(b, np.int64))
        mine = [x for x, m in zip(a, mask) if m]
        rest = iter(b)
        assert all(x in rest for x in mine) and len(mine) == plain_lcs(tuple(a), tuple(b))


def test_alignment_of_long_pages():
    a = np.arange(60000) % 7
    b = np.concatenate([np.arange(30000) % 7, np.arange(30000) % 5 + 100])
    assert page_diff.shared_lines(a, b).sum() == 30000


def site(host, n, start=0):
    top = ["Welcome to " + host, "Home", "About us"]
    end = ["Read more", "Contact " + host]
    rows = []
    for k in range(n):
        body = [f"{host} story {k} part {p} " + "x" * (7 * k % 40) for p in range(4)]
        page = "".join(f"<div>{line}</div>" for line in top + body + end)
        rows.append((start + k, f"https://{host}/news/{k:05d}.html?ref=1", page, " ".join(" ".join(line.split()) for line in body)))
    return rows


def test_shared_lines_go_where_no_article_is_marked(spark):
    rows = site("a.example", 60) + site("b.example", 7, 100) + site("c.example", 1, 200)
    df = spark.createDataFrame([r[:3] for r in rows], COLUMNS).repartition(5)
    got = {r.page_id: r for r in page_diff.extract(df).collect()}
    for i, _, page, body in rows:
        if i == 200:  # the only page of its host has no neighbour
            assert got[i].n_shared == 0 and got[i].text == text_of(page)
        else:
            assert got[i].text == body and got[i].n_shared == 5


def plain_extract(rows):
    """Brute force: all pages of a host in order, one neighbour at a time."""
    parsed = {}
    for k, (_, url, page) in enumerate(rows):
        lines = page_lines.lines_of(page)
        host, path = page_diff.place_of(url)
        parsed[k] = (host, path, lines)
    classes = {}
    for k, (host, path, lines) in parsed.items():
        if host and lines:
            own = (host, tuple(line for line, _ in lines))
            classes[own] = min(classes.get(own, path), path)
    gone = {}
    for (host, lines), path in classes.items():
        others = sorted((p, x) for (h, x), p in classes.items() if h == host)
        at = others.index((path, lines))
        near = [others[j] for j in (at - 1, at + 1) if 0 <= j < len(others)]
        common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        near.sort(key=lambda o: -common(path, o[0]))
        for _, other in near:
            mask = page_diff.shared_lines(np.array([hash(x) for x in lines]), np.array([hash(x) for x in other]))
            size = max(sum(map(len, lines)), sum(map(len, other)))
            if sum(len(x) for x, m in zip(lines, mask) if m) < page_diff.COPY_SHARE * size:
                gone[host, lines] = mask
                break
    out = []
    for k, (i, url, _) in enumerate(rows):
        host, _, lines = parsed[k]
        mask = gone.get((host, tuple(line for line, _ in lines)), np.zeros(len(lines), bool))
        out.append((i, url, " ".join(x for (x, sure), m in zip(lines, mask) if sure or not m)))
    return sorted(out, key=str)


def test_hot_host_copies_and_odd_rows_against_brute_force(spark):
    rng = random.Random(4)
    rows = [r[:3] for r in site("hot.example", 150)]
    rows += [(1000 + k, f"http://hot.example/copy/{k % 30}", rows[3][2]) for k in range(120)]  # copies under many URLs
    rows += [(2000, rows[5][1], rows[5][2])] * 40 + [(None, None, None)] * 3 + [(3000, "", "<p>x"), (3001, "no url", "<p>x</p>")]
    rows += [(4000 + k, f"//m.example/{rng.randrange(9)}/{k}", "".join(f"<p>{rng.choice('abcdefgh') * 9}</p>" for _ in range(rng.randrange(12))))
             for k in range(60)]
    rows += [(5000 + k, f"//m.example/main/{k}", f"<main><p>same</p><article><p>own {k} {'z' * 50}</p><p>quoted by both</p></article></main>")
             for k in range(4)]
    for clash in (False, True):
        df = spark.createDataFrame(rows, COLUMNS).repartition(6)
        if clash:
            df = df.select("*", *[F.lit(1).alias(c) for c in ("host", "path", "lines", "row", "node", "digest", "lost", "text", "sizes")])
        got = page_diff.extract(df).collect()
        assert sorted(((r.page_id, r.url, r.text) for r in got), key=str) == plain_extract(rows)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[5000] == "own 0 " + "z" * 50 + " quoted by both"  # shared, but the article's
    assert by_id[1000] == by_id[3]


def test_empty_table(spark):
    assert page_diff.extract(spark.createDataFrame([], COLUMNS)).collect() == []
