"""Main text of pages: copies, attributes, wrappers."""
import pytest
from martcraft.llm.html_extract import BODY, MAIN, extract_main_text, page_lines

HOST = "https://h.example"


def texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    return {r.page_id: r.text for r in extract_main_text(df).collect()}


def page(*own):
    return "<div>Home</div><div>Shop</div><div class=content>" + "".join(f"<p>{x}</p>" for x in own) + "</div><div>Imprint</div>"


def test_copies_are_no_template(spark):
    story = [f"story line {i} of some words" for i in range(9)]
    other = [f"other text {i} of more words" for i in range(9)]
    rows = [(1, f"{HOST}/a/1", page(*story)), (2, f"{HOST}/a/1?print=1", page(*story)), (2, f"{HOST}/a/1?print=1", page(*story)),
            (3, f"{HOST}/a/2", page("on Monday", *story)), (4, f"{HOST}/a/3", page("on Tuesday", *story)), (5, f"{HOST}/a/4", page(*other))]
    want = {1: story, 2: story, 3: ["on Monday", *story], 4: ["on Tuesday", *story], 5: other}
    assert texts(spark, rows) == {i: "\n\n".join(x) for i, x in want.items()}


def test_copies_only(spark):
    """A host with nothing but copies: no line is known to be template, and no text is lost."""
    rows = [(i, f"{HOST}/a?x={i}", page("one story", "two lines")) for i in range(5)]
    assert set(texts(spark, rows).values()) == {"Home\n\nShop\n\none story\n\ntwo lines\n\nImprint"}


def test_copy_of_an_article(spark):
    story = [f"story line {i}" for i in range(9)]
    article = "<div>Home</div><article>" + "".join(f"<p>{x}</p>" for x in story) + "</article><div>Imprint</div>"
    rows = [(1, f"{HOST}/a/1", article), (2, f"{HOST}/a/1?a", article), (3, f"{HOST}/a/1?print", page("Print view", *story)), (4, f"{HOST}/a/2", page("other"))]
    assert texts(spark, rows) == {1: "\n\n".join(story), 2: "\n\n".join(story), 3: "\n\n".join(["Print view", *story]), 4: "other"}


def text_of(html):
    lines = page_lines(html)
    return "\n\n".join([s for z, s in lines if z == MAIN] or [s for z, s in lines if z == BODY])


STORY = "<p>" + " ".join(f"word{i}" for i in range(30)) + "</p>"
PLAIN = STORY[3:-4]


@pytest.mark.parametrize("attrs", ['style="overflow:hidden"', 'title="The hidden cost"', "title='the class = ad'", 'data-hidden="false"', 'data-class="ad"',
                                   'class="layout has-sidebar"', 'class="post no-comments"', 'alt=hidden', 'data-role="navigation"'])
def test_words_in_values_and_names(attrs):
    assert text_of(f"<nav>m</nav><div {attrs}>{STORY}</div><p>end</p>") == f"{PLAIN}\n\nend"
    assert text_of(f"<div {attrs}><nav>m</nav><article>{STORY}</article></div><p>end</p>") == PLAIN


@pytest.mark.parametrize("attrs", ["hidden", "a=1 hidden b", "HIDDEN=''", 'aria-hidden="true"', "class=ad", "id = 'x ad-slot'", "role=navigation", 'class="comments"'])
def test_hidden_and_chrome_stay(attrs):
    assert text_of(f"<div {attrs}><p>gone</p></div>{STORY}") == PLAIN


@pytest.mark.parametrize("wrapper", ["<form id=aspnetForm>{}</form>", "<div class=sidebar-layout>{}</div>", "<form><div id='page-widget'>{}</div></form>",
                                     "<div class=sidebar-layout>{}"])
def test_wrappers_around_the_page(wrapper):
    assert text_of("<p>skip</p>" + wrapper.format(f"<nav>m</nav><main>{STORY}</main><aside>a</aside>")) == PLAIN
    assert text_of("<p>skip</p>" + wrapper.format(f"<nav>m</nav>{STORY}<aside>a</aside>")) == f"skip\n\n{PLAIN}"


def test_comments_are_no_wrapper():
    comments = f"<div id=comments><article>{STORY}</article></div>"
    assert text_of(f"<p>short post</p>{comments}") == "short post"
    assert text_of(f"<article>short post</article><div class=related><article>{STORY}</article></div>") == "short post"


def test_neighbours_across_ranges(spark, monkeypatch):
    """The texts don't depend on the number of ranges."""
    from martcraft.llm import html_extract

    rows = [(i if i % 5 else None, f"{HOST}/a/{i // 2:03}?{i}" if i % 7 else None, "<p>Home</p><p>Shop</p>" + f"<p>own {i * 31} text {i}</p>" * 2) for i in range(120)]
    rows += [(1000 + i, f"https://two{i % 20}.example/{i}", f"<p>Home {i % 20} of two</p><p>own words {i}</p>") for i in range(40)]
    df = spark.createDataFrame(rows * 2, "page_id long, url string, html string").repartition(4)
    out = {}
    for n in (1, 30):
        monkeypatch.setattr(html_extract, "text_bytes", lambda *_, n=n: n << 24)
        out[n] = sorted(map(str, extract_main_text(df).collect()))
    assert len(out[1]) == 320
    assert out[1] == out[30]
    assert not any("Home" in x for x in out[30])
    monkeypatch.setattr(html_extract, "RANGES", 3)  # few large ranges
    assert sorted(map(str, extract_main_text(df).collect())) == out[1]
    monkeypatch.setattr(html_extract, "GROUP_BYTES", 1)  # groups wait for no page behind them
    got = sorted(map(str, extract_main_text(df).collect()))
    assert len(got) == 320 and [x.split("text='")[0] for x in got] == [x.split("text='")[0] for x in out[1]]


def test_groups_larger_than_a_task_holds(spark, monkeypatch):
    """A group's later pages still meet the page behind it; the earlier ones meet the page before it; nothing is lost."""
    from martcraft.llm import html_extract

    story = [f"story line {i} of some words" for i in range(9)]
    copies = [(i, f"{HOST}/b/1?n={i:03}", page(f"copy {i}", *story)) for i in range(40)]
    first, last = (0, f"{HOST}/a", page("something else", "at all")), (99, f"{HOST}/c", page("the last page", "of the host"))
    monkeypatch.setattr(html_extract, "GROUP_BYTES", 5000)
    want = {i: "\n\n".join([f"copy {i}", *story]) for i in range(1, 40)}
    got = texts(spark, [first, *copies[1:], last])
    assert got == {0: "something else\n\nat all", **want, 99: "the last page\n\nof the host"}
    got = texts(spark, [*copies[1:], last])  # nothing before the group: template is known to its last pages only
    assert all(want[i] in got[i] for i in want) and got[39] == want[39]
    articles = [(i, u, f"<article><p>{' '.join(story)}</p></article><p>{i}</p>") for i, u, _ in copies]
    assert set(texts(spark, articles).values()) == {" ".join(story)}


def test_groups_over_many_ranges(spark, monkeypatch):
    """Copies over several ranges, and over what a task holds, meet the pages before and behind their group."""
    from martcraft.llm import html_extract

    story = [f"story line {i} of some words" for i in range(9)]
    article = "<div>Home</div><article><p>" + " ".join(story) + "</p></article><p>{}</p>"
    rows = [(i, f"{HOST}/a/{i}", page(f"own {i} text", f"of page {i}")) for i in range(3)]
    rows += [(100 + i, f"{HOST}/b/1?n={i:03}", page(f"copy {i}", *story)) for i in range(60)]
    rows += [(200, f"{HOST}/b/2", page("between", "the groups"))]
    rows += [(300 + i, f"{HOST}/b/3?n={i:03}", article.format(i) if i % 4 else page(f"version {i}", *story)) for i in range(60)]
    rows += [(400, f"{HOST}/c", page("the last", "of the host"))]
    rows += [(500 + i, f"https://two.example/{i // 30}", page("only", "copies")) for i in range(90)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    out = {}
    for n in (1, 2, 7, 40):
        monkeypatch.setattr(html_extract, "text_bytes", lambda *_, n=n: n << 24)
        out[n] = {r.page_id: r.text for r in extract_main_text(df).collect()}
    monkeypatch.setattr(html_extract, "GROUP_BYTES", 2000)
    out["held"] = {r.page_id: r.text for r in extract_main_text(df).collect()}
    monkeypatch.setattr(html_extract, "text_bytes", lambda *_: 0)
    out["in a file"] = {r.page_id: r.text for r in extract_main_text(df).collect()}
    assert len(out[1]) == len(rows)
    assert all(out[1][100 + i] == "\n\n".join([f"copy {i}", *story]) for i in range(60))
    for got in out.values():
        assert got == out[1]


def test_pages_of_many_equal_lines(spark):
    """Tables with tens of thousands of equal cells: the comparison doesn't grow with the pairs of equal lines."""
    import time

    from martcraft.llm.html_extract import common_lines

    began = time.time()
    assert sum(common_lines(["x", *["cell"] * 40_000, "y"], ["z", *["cell"] * 39_999, "w"])) == 39_999
    assert sum(common_lines(["a", "b"] * 10_000, ["b", "c"] * 10_000)) == 10_000
    assert time.time() - began < 15
    cells = "<div>Home</div><table>" + "<tr><td>0</td><td>1</td></tr>" * 3000 + "</table>"
    own = {i: " ".join(f"w{i}x{j}" for j in range(3000)) for i in range(4)}
    assert texts(spark, [(i, f"{HOST}/a/{i}", f"{cells}<p>{own[i]}</p>") for i in range(4)]) == own


def test_common_lines_are_a_longest_common_subsequence():
    import random

    from martcraft.llm.html_extract import common_lines

    r = random.Random(2)
    for _ in range(300):
        a, b = ([r.choice("abcd") for _ in range(r.randrange(12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        used = [x for x, u in zip(a, common_lines(a, b), strict=True) if u]
        assert len(used) == best[-1][-1]
        rest = iter(b)
        assert all(x in rest for x in used)
