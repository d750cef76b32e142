import random

import pytest
from llm_helpers import rows

from seriesworks.llm import markup, urls, wrappers

RULES = [("org", "/", "allow"), ("Example.org", "/es/", "block"), ("example.org", "/es/", "allow"), ("example.org", "/en/1", "block"), (None, "/", "block")]


def test_rules_fit_hosts_and_subdomains(spark):
    pages = [
        (1, "https://a.example.org/es/x?y"), (2, "http://EXAMPLE.org/en/12#z"), (3, "http://notexample.org/es/"), (4, "http://example.org"),
        (5, "example.org/es/"), (6, None), (7, ""), (8, "x://org/"), (9, "http://a.org/b://c/d"), (9, "http://a.org/b://c/d"), (10, "http:///es/"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "'clash' AS host", "'clash' AS rule", "1 AS short", "2 AS digest")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    out = urls.judge(df, rules)
    assert len(set(out.columns)) == len(out.columns) == 8
    got = rows(out.select("page_id", "host", "path", "rule", "verdict"))
    assert got == sorted([
        (1, "a.example.org", "/es/x", "example.org/es/", "block"), (2, "example.org", "/en/12", "example.org/en/1", "block"),
        (3, "notexample.org", "/es/", "org/", "allow"), (4, "example.org", "", None, "allow"), (5, "", "", None, "allow"),
        (6, "", "", None, "allow"), (7, "", "", None, "allow"), (8, "org", "/", "org/", "allow"),
        (9, "a.org", "/b://c/d", "org/", "allow"), (9, "a.org", "/b://c/d", "org/", "allow"), (10, "", "/es/", None, "allow"),
    ], key=str)
    assert urls.judge(df, rules.limit(0)).filter("rule IS NOT NULL").count() == 0
    assert urls.judge(df.limit(0), rules).count() == 0


def test_token_streams():
    tokens, blocks = markup.parse('<ul><li>1<li><b>2</b> &amp;\n 3</ul><!-- x --><script>"</p>"</script><p>a<br>b<div class="Ad-box">c')
    assert [b[1] for b in blocks] == ["1", "2 & 3", "a", "b", "c"]
    signature, slots = markup.fold(tokens, blocks)
    assert signature == ["ul", "li", "#", "/li", "/ul", "p", "#", "/p", "div!", "#", "/div!"] and slots == [2, 2, 6, 6, 9]
    for odd in ["", "<", "<>", "a<b", "</p></p>", '<p class="x>y', "<script>", "&am", "<p/><p", "<" * 200]:
        markup.parse(odd)


@pytest.mark.parametrize("html,texts", [
    ("<p>one <svg/> two</p><p>three</p>", ["one two", "three"]),
    ("<p>one <svg viewBox='0 0 1 1' /> two <svg><text>x</text></svg></p><p>three</p>", ["one two", "three"]),
    ("<p>a <svg class='x'> b</p><p>c</p>", ["a b", "c"]), ("<p>a <button>b</p><p>c", ["a b", "c"]),
    ("<p>if <math><mi>x</mi></math> then</p>", ["if x then"]),
    ("<object><p>o</p></object><canvas>c</canvas><noscript><p>n</p></noscript>", ["o", "c", "n"]),
    ("<p>a<script>b</p><p>c", ["a"]), ("<p>a<style>b</style>c</p>", ["ac"]), ("<p>a<!-- b", ["a"]),
])
def test_only_markup_is_skipped(html, texts):
    assert [b[1] for b in markup.parse(html)[1]] == texts


def test_wrapper_alignment():
    a, b = "html nav # /nav article p # /p /article".split(), "html article p # /p h2 # /h2 /article".split()
    whole, placed = wrappers.infer([(a, 5, {}), (b, 1, {})])
    assert wrappers.expression(whole) == "html ( nav # /nav )? article p # /p ( h2 # /h2 )? /article"
    assert wrappers.judge(a, whole, placed[0]) == "000000100" and wrappers.judge(b, whole, placed[1]) == "000100100"


@pytest.mark.parametrize("html,text", [
    ("<body class='has-sidebar nav-open'><article><p>one</p></article></body>", "one"),
    ("<body class='search'><nav>n</nav><main><p>one</p></main></body>", "one"),
    ("<body><div class='sidebar'><nav>n</nav><article class='post has-sidebar'><p>one</p><div class='ad'>Buy</div></article></div></body>", "one"),
    ("<div class='widget'><article class='promo'><h1>one</h1><p>two</p><aside>x</aside></article></div>", "one\ntwo"),
    ("<body><div class='menu'><nav>n</nav><h1>one</h1><p>two</p></div></body>", "one\ntwo"),
    ("<article><p data-id='menu'>one</p><p class='comment'>two</p></article>", "one"),
    ("<article><p class='site-footer'>no</p><p>one</p></article><div class='related'><article>teaser</article></div>", "one"),
    ("<div class='main-nav'>n</div><div class='page-footer'>f</div><div class='left sidebar'>s</div><p>one</p>", "one"),
])
def test_layout_marks_lose_no_article(spark, html, text):
    df = spark.createDataFrame([(1, "http://a.org", html)], "page_id long, url string, html string")
    assert wrappers.extract(df).first()["text"] == text


def page(article, host_text="All rights", extra=""):
    return (
        f"<html><head><title>t</title><style>p{{}}</style></head><body><header>Site</header><nav><a href='/'>Home</a></nav>"
        f"<div class='cookie-notice'>We use cookies</div>{article}<aside>More</aside>{extra}<form>Your name</form><footer>{host_text}</footer></body></html>"
    )


def test_main_text(spark):
    pages = [
        (1, "http://a.org/1", page("<article><h1>One &amp; two</h1><p>x <i>y</i>z</p><p>last<div class='comments'><p>me too</p></div></article>")),
        (2, "http://a.org/2", page("<article><h1>Two</h1><p>p\n\t q</article>")),
        (3, "http://a.org/3", page("<article><h1>Two</h1><p>p q</p></article>", extra="<div class='ad'>Buy</div>")),
        (4, None, page("<main><p>no host</p></main>")), (5, "http://b.org", None), (6, "http://b.org", ""), (7, "http://b.org", "just text"),
        (7, "http://b.org", "just text"),
    ]
    plain = [(10 + i, "http://c.org", f"<body><div>Site of C</div><div><p>Text {i}</p></div><div><a>More {i}</a></div></body>") for i in range(4)]
    df = spark.createDataFrame(pages + plain, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS chosen", "3 AS _host")
    got = {r["page_id"]: r["text"] for r in wrappers.extract(df).collect()}
    assert got[1] == "One & two\nx yz\nlast" and got[2] == got[3] == "Two\np q" and got[4] == "no host"
    assert got[5] == got[6] == "" and got[7] == "just text"
    assert [got[10 + i] for i in range(4)] == [f"Text {i}" for i in range(4)]
    assert wrappers.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("streams", [1, 200])
def test_pages_beyond_the_wrapper_are_judged_alone(spark, streams):
    pages = [(i, "http://a.org", page(f"<article><p>{i}</p>{'<h2>x</h2>' * (i % 3)}</article>", extra="<div>z</div>" * (i % 2))) for i in range(12)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in wrappers.extract(df, streams=streams).collect()}
    for i in range(12):
        text = "\n".join([str(i), *["x"] * (i % 3)])
        assert got[i] == (text, len(text))


def test_template_texts_inside_articles(spark):
    def made(i):
        linked = f"<h1><a href='/{i}'>Title {i}</a></h1>"
        return page(f"<article>{linked}<div>Read this first</div><p>Text {i} with <a>one link</a></p><ul><li><a>See {i}</a><li><a>See {i + 1}</a></ul></article>")

    pages = [(i, "http://a.org", made(i)) for i in range(6)] + [(10 + i, "http://b.org", made(1)) for i in range(6)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in wrappers.extract(df).collect()}
    assert [got[i] for i in range(6)] == [f"Title {i}\nText {i} with one link" for i in range(6)]
    # copies of one page: nothing tells the notice from the article
    assert {got[10 + i] for i in range(6)} == {"Title 1\nRead this first\nText 1 with one link"}


def test_pages_judged_alone_use_their_links(spark):
    plain = "<body><div>{0}</div><div><ul><li><a>Home</a><li><a>Contact</a></ul></div>" + "<p>Text</p><h2>x</h2>"
    pages = [(i, "http://a.org", plain.format(i) + "<div>z</div>" * (i == 5) + "</body>") for i in range(6)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in wrappers.extract(df, streams=1).collect()}
    assert "Home" not in got[5] and got[5] == "5\nText\nx\nz"


@pytest.mark.parametrize("block", [
    "<h2>Ingredients</h2>", "<p>All prices include tax.</p>", "<div><a href='/x'>The full report {0}</a></div>", "<div class='search-results'>Found {0}</div>",
    "<section id='related-work'>Others did this {0}</section>", "<p class='shareholders'>Owners</p>",
])
def test_authors_texts_stay(spark, block):
    pages = [(i, "http://a.org", page(f"<article><h1>Title {i}</h1><p>Text {i}</p>{block.format(i)}<p>End {i}</p></article>")) for i in range(5)]
    got = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    text = "".join(b[1] for b in markup.parse(block)[1])
    assert got == {i: f"Title {i}\nText {i}\n{text.format(i)}\nEnd {i}" for i in range(5)}


@pytest.mark.parametrize("footer", ["All rights", "Become a member"])
def test_texts_shown_outside_of_articles_too(spark, footer):
    """Only the host's wrapper tells this block from an author's; paragraphs side by side are one slot."""
    pages = [(i, "http://a.org", page(f"<article><h1>Title {i}</h1><blockquote>Become a member</blockquote><p>Text {i}</p></article>", footer)) for i in range(5)]
    got = [r["text"] for r in wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()]
    kept = "" if footer == "Become a member" else "Become a member\n"
    assert sorted(got) == [f"Title {i}\n{kept}Text {i}" for i in range(5)]


def test_foreign_marks_are_whole_tokens():
    tags = {"ad": 1, "ad-box": 1, "cookie-notice": 1, "share-buttons": 1, "post-comments": 1, "Related_Posts": 1, "left sidebar": 1, "ad-slot-2": 1,
            "search-results": 0, "related-work": 0, "has-sidebar": 0, "comment-on-law": 0, "notice-period": 0}
    assert {c: int("!" in markup.label("div", f'class="{c}"')) for c in tags} == tags


def test_repeats_of_any_length_are_folded():
    def plain(tokens):
        out = []
        for token in tokens:
            out.append(token)
            n = len(out)
            size = next((k for k in range(1, n // 2 + 1) if out[n - k :] == out[n - 2 * k : n - k]), 0)
            del out[n - size :]
        return out

    deal = random.Random(3)
    for n in (60, 130, 400):
        item = [deal.choice("abcdefg") for _ in range(n)]
        tokens = [*"xy", *item, *item, *item[: n // 2], *item, *item, *item, "z"]
        assert markup.fold(tokens, [])[0] == plain(tokens)
        assert markup.fold(["x", *item, *item, *item, "z"], [])[0] == plain(["x", *item, "z"])
    # texts of every copy are in the slots of the first
    row = [t for i in range(30) for t in (f"h{i}", "#", f"/h{i}")]
    texts = [(i, str(i), 0) for i, t in enumerate(row * 3) if t == "#"]
    signature, slots = markup.fold(row * 3, texts)
    assert signature == row and slots == [i for i, t in enumerate(row) if t == "#"] * 3


def test_longest_common_subsequences(monkeypatch):
    def length(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    deal = random.Random(5)
    for cells in (wrappers.CELLS, 8):
        monkeypatch.setattr(wrappers, "CELLS", cells)
        for _ in range(150):
            a, b = ([deal.choice("abcd") for _ in range(deal.randint(0, 25))] for _ in range(2))
            found = wrappers.longest(a, b)
            assert len(found) == length(a, b) and all(a[i] == b[j] for i, j, _ in found)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:], strict=False))
    monkeypatch.undo()
    # runs stay together where as many single tokens match
    assert wrappers.longest("div p # /p /div div # /div".split(), "div # /div".split()) == [(5, 0, 1), (6, 1, 1), (7, 2, 1)]


KINDS = ["h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "section", "address"]


def shaped(i, bits):
    """For each number another choice of blocks, so another stream."""
    return "".join(f"<{kind}>{kind} of {i}</{kind}>" for k, kind in enumerate(KINDS[:bits]) if i >> k & 1)


def test_all_streams_of_a_host_count(spark):
    """More streams than one task aligns: the notice goes from all pages, and plain pages get their article's slots."""
    notice = "<div>Read this first</div>"
    pages = [(i, "http://a.org", page(f"<article><h1>Title {i}</h1>{notice}<p>Text {i}</p>{shaped(i, 9)}</article>")) for i in range(450)]
    pages += [(1000 + i, "http://b.org", page(f"<article><h1>Title {i}</h1>{notice}<p>Text {i}</p></article>")) for i in range(4)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in wrappers.extract(df).collect()}
    assert len(got) == 454 and [i for i, text in got.items() if "Read this first" in text] == []
    for i in (0, 7, 449):
        texts = [f"{kind} of {i}" for k, kind in enumerate(KINDS) if i >> k & 1]
        assert got[i] == "\n".join([f"Title {i}", f"Text {i}", *texts])
    assert got[1002] == "Title 2\nText 2"


@pytest.mark.parametrize("group", [3, 40])
def test_groups_of_streams_judge_like_one(spark, group):
    """Two rounds of wrappers and more, hosts that end in different rounds, pages without an article element, copies, no markup."""
    made = [page(f"<article><h1>Title {i}</h1><div>Read this first</div><p>Text {i}</p>{shaped(i, 7)}</article>") for i in range(128)]
    plain = [f"<body><div>Site</div><div>{shaped(i, 3)}<p>Text {i}</p></div><ul><li><a>More {i}</a></ul></body>" for i in range(8)]
    pages = [(i, "http://a.org", html) for i, html in enumerate([*made, *made[:5], None, ""])]
    pages += [(1000 + i, "http://b.org", html) for i, html in enumerate(plain)] + [(2000, None, plain[0])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    whole = rows(wrappers.extract(df, group=1000))
    assert rows(wrappers.extract(df, group=group)) == whole and len(whole) == len(pages)
    found = wrappers.wrappers(wrappers.parsed(df, "url", "html", []), group=group).collect()
    assert len(found) == 128 + 1 + 8 + 1 == len({(r["host"], r["key"]) for r in found})
    assert all(r["wrapper"] is not None and r["chosen"] is not None for r in found)
    assert len({r["wrapper"] for r in found if r["host"] == "a.org"}) == 1
