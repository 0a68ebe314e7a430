import html
import re
import time

import pytest

from daytally.llm import html_text as ht

TREE = ht.Tree.grow(*ht.labelled_blocks())
LINE = "Some words of an article that goes on for quite a while and says things"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<article><p>One&nbsp; two\n three</p><p>b<b>o</b>ld<br>next</p></article>", "One two three\n\nbold next"),
        ("<article><p>a &lt;b&gt; &eacute; &#233; &copy</p></article>", "a <b> é é ©"),
        ("<article><p>x<script>var t='</p>';</script>y<!-- no <p> --></p><style>p{}</style></article>", "xy"),
        (f"<nav><ul><li><a>Home</a></li></ul></nav><main><p>{LINE}</p></main><footer>{LINE}</footer>", LINE),
        (f"<article><h1>T</h1><p>{LINE}</p><div class='reader comments'><p>{LINE}</p></div></article>", f"T\n\n{LINE}"),
        (f"<div class=ad>{LINE}</div><div id='side-bar sidebar'>{LINE}</div><article><p>Short</p></article>", "Short"),
        (f"<article><p>{LINE}</p><form>Name <input> <button>Send</button></form><p>End", f"{LINE}\n\nEnd"),
        (f"<article><header><h1>T</h1></header><p>{LINE}</p><aside>{LINE}</aside><footer>by x</footer></article>", f"T\n\n{LINE}"),
        (f"<div role=alert>{LINE}</div><div style='display: none'>{LINE}</div><article><p>{LINE}</p></article>", LINE),
        ("<title>t</title><p>", ""),
        ("<article><p>open <script>never closed </article>", "open"),
        ("<p title='a > b'>" + LINE + "</p>", LINE),
        ("</div></p><article></span><p>stray</p></article>", "stray"),
    ],
)
def test_pages(page, text):
    assert ht.main_text(page, TREE) == text


@pytest.mark.parametrize(
    "tags",
    [
        "<div style='overflow:hidden'>",
        "<div class=overflow-hidden>",
        "<div data-x=hidden data-id=ad>",
        "<div hidden=until-found>",
        "<body class='no-sidebar comments-open'>",
        "<html class=has-cookie-notice><body id=page class='single-post-share ad'>",
        "<main class=has-sidebar>",
        "<article class='post comments share'>",
        "<div class='no-sidebar'>",
        "<div title='display:none'>",
    ],
)
def test_attributes_that_say_nothing_of_the_text(tags):
    article = f"<article><h1>T</h1><p>{LINE}</p></article>"
    assert ht.main_text(f"{tags}{article}", TREE) == f"T\n\n{LINE}"


@pytest.mark.parametrize(
    "tag",
    [
        "div hidden",
        "div class=x hidden=''",
        "div HIDDEN=hidden",
        "section style=\"color:red; visibility : hidden\"",
        "div style=display:none",
        "div class='x Site_Footer'",
        "div id=reader-comments",
    ],
)
def test_hidden_and_named_elements_go(tag):
    assert ht.main_text(f"<article><p>{LINE}</p><{tag}><p>{LINE}</p></article>", TREE) == LINE


def test_pages_without_article_go_by_words_and_links():
    page = f"<div><a>Home</a> <a>News</a></div><h1>Title words</h1><p>{LINE} {LINE}</p><p>{LINE}</p><div><a>More of this</a></div>"
    assert LINE in ht.main_text(page, TREE) and "Home" not in ht.main_text(page, TREE) and "More" not in ht.main_text(page, TREE)


def test_the_tree_agrees_with_its_table():
    x, y = ht.labelled_blocks()
    assert ((TREE.predict(x) >= 0.5) == y).mean() > 0.98


@pytest.mark.parametrize("third", [0, 1, 2])
@pytest.mark.parametrize("of_a_layout", [1, len(ht.SIZES)])
def test_labelled_pages_that_are_held_out(third, of_a_layout):
    """A third of the pages, and of the layouts with all their sizes."""
    pages = ht.labelled_pages()
    held = [p for i, p in enumerate(pages) if i // of_a_layout % 3 == third]
    tree = ht.Tree.grow(*ht.labelled_blocks([p for p in pages if p not in held]))
    x, y = ht.labelled_blocks(held)
    assert ((tree.predict(x) >= 0.5) == y).mean() > 0.9


def columns_of(tree):
    return set() if tree.below is None else {tree.column} | columns_of(tree.below) | columns_of(tree.above)


def test_the_tree_uses_words_and_links_of_the_neighbours():
    words, density, before, links_before, after, links_after = range(6)
    used = columns_of(TREE)
    assert {words, density, links_before, links_after} <= used and used & {before, after}


NAMES = [
    "comments-section",
    "comment-body",
    "user-comments",
    "disqus_thread",
    "sidebar-left",
    "nav-links",
    "cookie-bar",
    "ad-wrapper",
    "footer-widgets",
    "post-related",
    "newsletter_signup",
    "social-icons",
]


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("where", ["class", "id"])
def test_named_elements_in_the_main_text_go(name, where):
    page = f"<main><h1>Title</h1><p>{LINE}</p><div {where}='{name}'><p>{LINE} not</p><div><p>{LINE} neither</p></div></div><p>End.</p></main>"
    assert ht.main_text(page, TREE) == f"Title\n\n{LINE}\n\nEnd."


@pytest.mark.parametrize(
    "wrapper",
    ["div class='content social'", "div class='widget'", "div id='modal'", "section class=sidebar-layout", "div class='no-ads comments-open'"],
)
@pytest.mark.parametrize("tag", ["article", "main", "div role=main"])
def test_an_article_in_a_named_wrapper_stays(wrapper, tag):
    end = tag.split()[0]
    page = f"<{wrapper}><div><{tag}><h1>Title</h1><p>{LINE}</p></{end}></div><p>{LINE} not</p></{wrapper.split()[0]}>"
    assert ht.main_text(page, TREE) == f"Title\n\n{LINE}"


@pytest.mark.parametrize("tag", ["nav", "aside", "footer", "div hidden", "div style='display:none'"])
def test_an_article_in_what_is_hidden_or_beside_goes(tag):
    page = f"<{tag}><article><p>{LINE} not</p></article></{tag.split()[0]}><article><p>{LINE}</p></article>"
    assert ht.main_text(page, TREE) == LINE


def test_comments_that_are_articles_go():
    page = f"<article><p>{LINE}</p><div class=comment-list><article><p>{LINE} not</p></article></div></article>"
    assert ht.main_text(page, TREE) == LINE


RUN = "".join(f"<li><a href='/{i}'>Word {i}</a></li>" for i in range(5))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<a name='top'><h1>Title words</h1><p>{LINE}</p><p>{LINE}</p>", f"Title words\n\n{LINE}\n\n{LINE}"),
        (f"<article><p>{LINE} <a href=x>more<p>{LINE}</p><p>{LINE}</p></article>", f"{LINE} more\n\n{LINE}\n\n{LINE}"),
        (f'<p title="x>{LINE}</p>', LINE),
        (f"<article><p title='x>{LINE}</p><p>{LINE}</p></article>", f"{LINE}\n\n{LINE}"),
        (f"<main><ul>{RUN}</ul><h1>Title words</h1><p>{LINE}</p><p>{LINE}</p><ul>{RUN}</ul></main>", f"Title words\n\n{LINE}\n\n{LINE}"),
        (f"<article><p>{LINE}</p><p><a href=x>one link</a></p><p>{LINE}</p></article>", f"{LINE}\n\none link\n\n{LINE}"),
        (f"<ul>{RUN}</ul><h1>Title words</h1><p>{LINE}</p><p>{LINE} <a href=x>and</a></p><ul>{RUN}</ul>", f"Title words\n\n{LINE}\n\n{LINE} and"),
        (f"<div>{RUN}</div><article><h1>T</h1><p>Short.</p></article><div><p>{LINE} not</p></div>", "T\n\nShort."),
        (f"<article><script src='a>b'>x<p>{LINE}</p></script><p>{LINE}</p></article>", LINE),
        (f"<article><p class=share-enabled>{LINE}</p><p class=is-related>{LINE}</p></article>", f"{LINE}\n\n{LINE}"),
    ],
)
def test_pages_of_other_kinds(page, text):
    assert ht.main_text(page, TREE) == text


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "text", "<p>text" + "</p>" * 100_000, "<div>" * 50_000 + "text" + "</p></div>" * 50_000, '<p title="' * 100_000, "<div><p>word" * 50_000])
def test_time_is_linear_in_a_hostile_page(page):
    begin = time.process_time()
    ht.main_text(page, TREE)
    assert time.process_time() - begin < 10


def article_of(page):
    """For the generated pages: the article's text by its tags."""
    body = re.sub(r"<br\s*/?>", " ", re.search(r"<article>(.*?)</article>", page, re.S)[1])
    parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in re.split(r"</?(?:p|h1)[^>]*>", body)]
    return "\n\n".join(p for p in parts if p)


def test_generated_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in ht.extract(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == article_of(r.html) and got[r.page_id].url == r.url
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_odd_rows(spark):
    long = "<article>" + f"<p>{LINE}</p>" * 20_000
    rows = [(1, None, None, "x"), (None, "u", "", "x"), (2, "u", long, "x"), (2, "u", long, "x"), (3, "u", "<" * 500, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.n_chars) for r in ht.extract(pages).collect())
    n = 20_000 * (len(LINE) + 2) - 2
    assert got[:4] == [(0, 0), (1, 0), (2, n), (2, n)]
    assert ht.extract(pages.limit(0)).collect() == []
