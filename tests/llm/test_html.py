"""Main text of pages."""
import html
import random
import re

import pytest
from martcraft.llm.html_extract import BODY, CHROME, MAIN, common_lines, difference_only, extract_main_text, page_lines


def article(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", b))).split()) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n\n".join(b for b in blocks if b)


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    got = {r.page_id: r for r in extract_main_text(pages).collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


@pytest.mark.parametrize(("page", "text"), [
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>a<p>b<br>c</p>d", "a\n\nb c\n\nd"),
    ("<body><nav>menu</nav><div>one <b>two</b>\n three</div><footer>f</footer>", "one two three"),
    ("<article><header><h1>T</h1></header><p>x</p><aside>ad</aside><div class='comments'><p>c</p></div></article><p>out</p>", "T\n\nx"),
    ("<main><div class=\"ad-slot\">buy</div><form><p>mail</p></form><p>x &lt;tag&gt; &#8364;&nbsp;y</p></main>", "x <tag> € y"),
    ("<div role=navigation>m</div><div id='cookie-banner'>c</div><p hidden>h</p><p>x</p>", "x"),
    ("<script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes</p>", "yes"),
    ("<title>t</title><p>a</p><noscript><p>n</p></noscript><textarea><p>x</p>", "a"),
    ("<ul><li>one<li>two</ul><table><tr><td>a<td>b</table>", "one\n\ntwo\n\na\n\nb"),
    ("<p>a < b and 3 <4</p><p title=\"x > y\">q</p>", "a < b and 3 <4\n\nq"),
    ("<p>open <span>never closed", "open never closed"),
    ("</p></div><p>stray</p></b>", "stray"),
])
def test_markup(spark, page, text):
    lines = page_lines(page)
    zones = {z for z, _ in lines}
    assert zones <= {MAIN, BODY, CHROME}
    got = "\n\n".join([s for z, s in lines if z == MAIN] or [s for z, s in lines if z == BODY])
    assert got == text


def test_template_lines_go_where_no_zone_tells(spark):
    def page(i, *own):
        return (i, f"https://h.example/a/{i}", "<div>Home</div><div>Shop</div>" + "".join(f"<p>{x}</p>" for x in own) + "<div>Imprint</div>")

    rows = [page(1, "first", "same words"), page(2, "second"), page(3, "third", "more"), (4, "https://other.example/", "<p>Home</p>"), (5, None, "<p>n</p>"), (6, None, None),
            (None, "not a url", "<p>Home</p>"), (22, "https://h.example/z", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string").coalesce(1)
    got = [(r.page_id, r.text, r.n_chars) for r in extract_main_text(df).collect()]
    assert len(got) == len(rows)
    assert {(1, "first\n\nsame words", 17), (3, "third\n\nmore", 11), (4, "Home", 4), (6, "", 0), (22, "", 0)} <= set(got)
    assert extract_main_text(df.where("page_id = 77")).count() == 0


def test_zones_win_over_the_difference(spark):
    rows = [(i, f"https://h.example/{i}", f"<nav>m{i}</nav><article><p>same story</p></article><footer>f{i}</footer>") for i in (1, 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    assert [r.text for r in extract_main_text(df).collect()] == ["same story"] * 2
    assert {r.text for r in extract_main_text(df, pick=difference_only).collect()} == {"m1\n\nf1", "m2\n\nf2"}


def test_longest_common_subsequence():
    r = random.Random(6)
    for _ in range(300):
        a, b = ([r.choice("abcde") for _ in range(r.randrange(9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        used = common_lines(a, b)
        assert sum(used) == best[-1][-1]
        rest = iter(b)
        assert all(x in rest for x, u in zip(a, used) if u)


def test_long_page():
    page = "<article>" + "".join(f"<p>line {i} of many</p>" for i in range(20000)) + "</article>"
    assert len(page_lines(page)) == 20000
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert page_lines(deep) == [(BODY, "x")]
