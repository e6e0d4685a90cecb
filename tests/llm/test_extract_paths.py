"""Main text: names are a prior only, and path scores decide which blocks stay."""

import pytest

from tripflow.llm import extract

PROSE = ["Some words, and more words, that make up a paragraph.", "Another one; it is as long, or nearly so, as the first."]
BODY = "".join(f"<p>{x}</p>" for x in PROSE)
LINKS = "".join(f"<li><a href=/{k}>Link number {k}</a></li>" for k in range(6))


@pytest.mark.parametrize("name", ["class='no-sidebar'", "id='content-search'", "class='sidebar'", "class='page related'"])
def test_no_name_drops_the_main_element(name):
    outer = f"<html><body><nav>Home</nav><div {name}>{{}}</div><footer>Imprint.</footer></body></html>"
    assert extract.main_text(outer.format(BODY)) == "\n".join(PROSE)
    assert extract.main_text(outer.format(f"<article>{BODY}</article>")) == "\n".join(PROSE)


def test_anchors_of_headings_stay():
    page = f"<article>{BODY}<h2 id='related-work'>Related work</h2>{BODY}<h2 id=side-effects>Side effects</h2>{BODY}</article>"
    assert extract.main_text(page).split("\n") == [*PROSE, "Related work", *PROSE, "Side effects", *PROSE]


def test_an_article_keeps_its_lists_of_links():
    page = f"<article><h1>Title</h1>{BODY}<div class='x'><ul>{LINKS}</ul></div><ul><li>short</li><li>item</li></ul>{BODY}</article>"
    links = [f"Link number {k}" for k in range(6)]
    assert extract.main_text(page).split("\n") == ["Title", *PROSE, *links, "short", "item", *PROSE]


def test_scores_decide_where_no_article_is_marked():
    inner = f"<h1>Title</h1>{BODY}<div class='x'><ul>{LINKS}</ul></div><ul><li>short</li><li>item</li></ul>{BODY}"
    assert extract.main_text(f"<body><div>{inner}</div></body>").split("\n") == ["Title", *PROSE, "short", "item", *PROSE]


LONG = "".join(f"<p>Sentence number {k}, which goes on for a while; it is long, and it says little.</p>" for k in range(12))
SHORT = "<article><h1>T</h1><p>One short paragraph, no more.</p></article>"
SHORT_TEXT = "T\nOne short paragraph, no more."
OUTSIDE = [
    "class='comments-area'", "class='comment-list'", "class='reader-comments'", "class='cookie-bar'", "class='newsletter-box'",
    "class='sidebar-left'", "class='site-header'", "id='disqus_thread'", "class='wp-comments'", "id='comments'", "class='x y-z'",
]


@pytest.mark.parametrize("name", OUTSIDE)
def test_what_follows_the_only_article_goes(name):
    for before, after in (("", f"<div {name}>{LONG}</div>"), (f"<div {name}>{LONG}</div>", "")):
        assert extract.main_text(f"<html><body>{before}{SHORT}{after}</body></html>") == SHORT_TEXT
        assert extract.main_text(f"<body><div class=wrap>{before}<main>{SHORT}{after}</main></div></body>") == SHORT_TEXT


@pytest.mark.parametrize("name", OUTSIDE[:-1])
def test_names_outside_articles_decide_by_their_head(name):
    page = f"<body><div id=post><h1>T</h1>{LONG}{LONG}{LONG}{LONG}</div><div {name}>{LONG}</div></body>"
    assert extract.main_text(page).split("\n")[0] == "T" and extract.main_text(page).count("number 3,") == 4


T4 = "\n".join(["T", *PROSE])
SHAPES = {
    "search section": (f"<article><h1>T</h1><section id='search'>{BODY}</section></article>", T4),
    "related section": (f"<article><h1>T</h1><section id='related'>{BODY}</section></article>", T4),
    "part names": (f"<article><h1>T</h1><div class='search-results'>{BODY}</div></article>", T4),
    "advert inside": (f"<article><h1>T</h1><div class='ad'>Buy, now!</div>{BODY}</article>", T4),
    "comments inside": (f"<article><h1>T</h1>{BODY}<div class='comments'>{LONG}</div></article>", T4),
    "thread inside": (f"<article><h1>T</h1>{BODY}<div id='disqus_thread'>{LONG}</div></article>", T4),
    "comments as articles": (f"<article><h1>T</h1>{BODY}<article class='comment'>{LONG}</article></article>", T4),
    "form inside": (f"<article><h1>T</h1><form>Name, please: <input></form>{BODY}</article>", T4),
    "nav inside": (f"<article><h1>T</h1><nav>{LINKS}</nav>{BODY}</article>", T4),
    "aside inside": (f"<article><h1>T</h1><aside>{LONG}</aside>{BODY}</article>", T4),
    "header inside": (f"<article><header><h1>T</h1></header>{BODY}</article>", T4),
    "header outside": (f"<header><h1>Site</h1>{LONG}</header><article><h1>T</h1>{BODY}</article>", T4),
    "footer inside": (f"<article><h1>T</h1>{BODY}<footer>By someone.</footer></article>", T4),
    "main without article": (f"<body><div>{LONG}</div><main><h1>T</h1>{BODY}</main></body>", T4),
    "main with sidebar": (f"<main><article><h1>T</h1>{BODY}</article><div class=x>{LONG}</div></main>", T4),
    "empty article": (f"<article></article><div><h1>T</h1>{BODY}</div>", T4),
    "whole page is a form": (f"<body><form id=aspnetForm><div>{LINKS}</div><article><h1>T</h1>{BODY}</article></form></body>", T4),
    "form page of divs": (f"<body><form><div><h1>T</h1>{BODY}</div></form></body>", T4),
    "role": (f"<div role=navigation>{LONG}</div><article><h1>T</h1>{BODY}</article>", T4),
    "unclosed article": (f"<body><nav>Home</nav><article><h1>T</h1>{BODY}", T4),
    "script and style": (f"<article><h1>T</h1><script>var a = '<p>';</script><style>p {{}}</style>{BODY}</article>", T4),
    "markup comments": (f"<article><h1>T</h1><!-- <p>no</p> -->{BODY}</article>", T4),
    "noscript": (f"<article><h1>T</h1><noscript>Enable it.</noscript>{BODY}</article>", T4),
    "table layout": (f"<table><tr><td>{LINKS}</td><td><h1>T</h1>{BODY}</td></tr></table>", T4),
    "table inside": ("<article><table><tr><td>a</td><td>b</td></tr></table></article>", "a\nb"),
    "line breaks": ("<article><p>one<br>two</p></article>", "one two"),
    "references": ("<article><p>a &amp; b &lt;c&gt; &#233; &eacute;</p></article>", "a & b <c> é é"),
    "white space": ("<article><p>  a \n\t b&nbsp;c  </p><p> </p><p>d</p></article>", "a b c\nd"),
    "inline markup": ("<article><p>a<b>b</b> <i>c</i><a href=x>d</a></p></article>", "ab cd"),
    "definition list": ("<article><dl><dt>a<dd>b<dt>c<dd>d</dl></article>", "a\nb\nc\nd"),
    "upper case": ("<ARTICLE><P>One.</P></ARTICLE><DIV>Two.</DIV>", "One."),
    "share links": (f"<article><h1>T</h1><ul class=share>{LINKS}</ul>{BODY}</article>", T4),
    "two articles": (f"<main><article><h1>T</h1>{BODY}</article><article class='related'>{LONG}</article></main>", T4),
    "no text": ("<article><img src=x></article>", ""),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_page_shapes(shape):
    page, text = SHAPES[shape]
    assert extract.main_text(page) == text


def test_a_very_large_element_and_equal_scores():
    page = "<article>" + "<p>" + "word, " * 300_000 + "</p></article>"
    assert len(extract.main_text(page)) == 300_000 * 6 - 1
    # Two equal columns without an article: both are content.
    both = f"<body><div class=a>{LONG}</div><div class=b>{LONG}</div></body>"
    assert extract.main_text(both).count("Sentence number 3,") == 2


def test_names_still_drop_what_is_no_content():
    page = (
        f"<body><div id=content><h1>T</h1>{BODY}<div class='site-menu'>{LINKS}</div><div class='comments'>{BODY}</div>"
        f"<div class='ad'>Buy now, it is cheap!</div>{BODY}{BODY}{BODY}</div></body>"
    )
    assert extract.main_text(page).split("\n") == ["T", *PROSE * 4]
    assert extract.main_text(f"<nav><a href=/>{PROSE[0]}</a></nav><a href=/>all linked</a>") == "all linked"
