"""Main text of small pages, by paths of their hosts, and hostile pages."""

import time

import pytest

from tasteline.llm import maintext, markup

PROSE = ["First <b>para</b>graph with some words, enough of them to look like prose &amp; more.",
         "Second one, which says about as much as the one before it, and a little on top of that.",
         "Third &lt;and&gt; last: &eacute;t&eacute; &#233; &#x41;&nbsp;end."]
PLAIN = ["First paragraph with some words, enough of them to look like prose & more.",
         "Second one, which says about as much as the one before it, and a little on top of that.",
         "Third <and> last: été é A end."]


def paragraphs(texts):
    return "".join(f"<p>{t}</p>\n" for t in texts)


def own_text(source):
    page = maintext.parse(source)
    best = maintext.best_container(page)
    return "" if best is None else maintext.text_at(page, maintext.path_of(page, best))


AROUND = [
    '<nav><ul><li><a href="/">Home</a></li></ul></nav>',
    '<div class="main-menu"><a href="/x">A menu entry, with words, quite long, really long, as menus go</a></div>',
    "<header><h1>Name of the site</h1></header>",
    '<div id="siteHeader">Name of the site, again</div>',
    '<div class="cookie-notice">We use cookies, as everyone does, and we say so at length.</div>',
    '<div class="ad">Buy this, now, it is cheap, very cheap, cheaper than all of the others.</div>',
    '<aside>Beside it, some words.</aside>',
    '<div class="sidebar"><p>Beside it, some words, in a paragraph.</p></div>',
    '<form action="/s"><p>Search, please, for anything</p><input name=q></form>',
    '<section id="comments"><article class="comment"><p>Reader says: no, no, and no, at great length.</p></article></section>',
    "<script>if (a < b) document.write('<p>not text</p>')</script>",
    "<style>p > a {color: red}</style>",
    '<div role="navigation">Go on, somewhere</div>',
    '<div style="display: none">hidden words</div>',
    '<footer>&copy; somebody, all rights reserved.</footer>',
    "<!-- <p>a comment of the page</p> -->",
]


@pytest.mark.parametrize("wrap", [
    "<article><h1>Title</h1>{}</article>",
    '<main><article class="post-17"><header><h1>Title</h1><p>By me</p></header>{}<footer>Tags</footer></article></main>',
    '<div class="content"><h1>Title</h1><div class="body">{}</div></div>',
    '<div class="page has-sidebar"><div id="content-9"><h1>Title</h1>{}</div></div>',
    "<table><tr><td><h1>Title</h1>{}</td></tr></table>",
    '<div class="sidebar-left layout"><article><h1>Title</h1>{}</article></div>',
])
def test_what_stands_around_goes(wrap):
    body = "".join(AROUND[:8]) + wrap.format(paragraphs(PROSE)) + "".join(AROUND[8:])
    page = f"<!DOCTYPE html><html><head><title>Title</title></head><body class='no-nav'>{body}</body></html>"
    assert own_text(page) == "\n\n".join(["Title", *PLAIN])


def test_around_inside_the_article_goes_too():
    inside = "<article>" + "<p>One, two, three.</p>".join(AROUND[:2] + AROUND[3:]) + "<p>Last words.</p></article>"
    assert own_text(inside) == "\n\n".join(["One, two, three."] * (len(AROUND) - 2) + ["Last words."])


def test_blocks_and_white_space():
    page = """<article><h1> A\n title </h1><p><b>Open <i>tags<br>and a break<p>next&nbsp; \t one
      <ul><li>x <em>y</em>z<li>second</ul>loose text<pre>  kept   as
      one </pre><blockquote><p>quoted</p></blockquote><table><tr><td>cell</td><td>other</td></tr></table></article>"""
    want = ["A title", "Open tags and a break", "next one", "x yz", "second", "loose text", "kept as one", "quoted", "cell", "other"]
    assert own_text(page) == "\n\n".join(want)


def test_quotes_and_odd_tags():
    page = "<article><p title='a > b' data-x=\"</p>\">one</p><p don't>two</p><P>1 < 2 & 3 </p></article><p class=\"x>"
    assert own_text(page) == "one\n\ntwo\n\n1 < 2 & 3"
    assert list(markup.scan("a</>b<?x?>c<!x>d<")) == [
        (markup.TEXT, "", "a"), (markup.TEXT, "", "b"), (markup.TEXT, "", "c"), (markup.TEXT, "", "d"), (markup.TEXT, "", "<"),
    ]
    assert markup.attributes(" A=1 b='&amp;' b=2 c d = \"x y\" /") == {"a": "1", "b": "&", "c": "", "d": "x y"}


@pytest.mark.parametrize("piece", [
    "<p ", '<a x="', "<title>", "<div>", "<", "<!--", "<li>", "&", "<a href='x", "</p>", "<p>x<div class=ad>", "<div><p>a",
    "<div class=a></span>", "a b\n", "<i class=share>", "<p =\"'>", "<!", "<script>", "</script", "<b><p>&#x41",
])
def test_a_megabyte_of_anything_is_linear(piece):
    small, large = piece * (100_000 // len(piece)), piece * (1_000_000 // len(piece))
    took = []
    for page in (small, large):
        start = time.perf_counter()
        own_text(page)
        took.append(time.perf_counter() - start)
    assert took[1] < 25 * took[0] + 0.5


def host_pages():
    """Pages of one host whose article shares a path; on some an unnamed box beside it is the longer one."""
    box = "<div class='zone'>" + paragraphs(["Nothing that belongs to the article, but it goes on and on, " * 6]) + "</div>"
    long, short = paragraphs(PROSE * 4), paragraphs(PROSE[:1])
    rows = [(i, f"http://Host.example/{i}", f"<body>{box}<div class='text p{i}'>{long}</div></body>") for i in range(6)]
    rows += [(i, f"https://user@host.example:80/{i}?q", f"<body>{box}<div class='text p{i}'>{short}</div></body>") for i in range(6, 9)]
    return rows


def test_pages_follow_their_host(spark):
    rows = host_pages()
    rows += [(20, "http://other.example/", rows[-1][2]), (21, "http://host.example/x", "<body><article>No such path here, but words.</article></body>")]
    rows += [(22, None, rows[-3][2]), (23, "http://host.example/y", None), (24, "not an address", ""), (None, None, None), rows[0]]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, path string").repartition(3)
    got = {(r.page_id, r.url): r for r in maintext.main_text(pages).collect()}
    assert len(got) == len(rows) - 1
    for i, url, _ in rows[:9]:
        assert got[i, url].text == "\n\n".join(PLAIN * 4 if i < 6 else PLAIN[:1])
        assert got[i, url].path == "div.p#.text" and got[i, url].n_chars == len(got[i, url].text)
    # Alone the short page would have been read at the box.
    assert got[20, "http://other.example/"].path == got[22, None].path == "div.zone"
    assert got[21, "http://host.example/x"].text == "No such path here, but words."
    for row in (got[23, "http://host.example/y"], got[24, "not an address"], got[None, None]):
        assert (row.text, row.n_chars, row.path) == ("", 0, None)
    votes = {r.host: (r.path, r.votes, r.pages) for r in maintext.host_paths(pages).collect()}
    assert votes["host.example"] == ("div.p#.text", 7, 11)


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert maintext.main_text(pages).collect() == []
