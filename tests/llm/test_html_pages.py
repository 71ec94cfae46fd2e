"""Comments, compound names, links alone and tags that never close; and the parser against the standard library's on well-formed pages."""

import random
import time
from html.parser import HTMLParser

import pytest

from catalume.llm import html

TEXT = "<p>" + ", ".join(["words of an article"] * 12) + ".</p>"
SAID = TEXT[3:-4]


def remarks(n):
    return "".join(f"<div class='comment'><p>Remark {i}, which is long, and has commas, and says a lot, really.</p></div>" for i in range(n))


@pytest.mark.parametrize("n", [1, 10, 30, 300])
@pytest.mark.parametrize("name", ["id='comments'", "class='comments-area'", "id='disqus_thread'", "class='user-comments section'", "class='comment-list'"])
def test_comments_go_while_anything_else_is_left(name, n):
    assert html.main_text(f"<body><article><h1>Title</h1>{TEXT}</article><div {name}>{remarks(n)}</div></body>") == f"Title\n{SAID}"
    assert html.main_text(f"<body><article><p>One line.</p></article><section {name}>{remarks(n)}</section></body>") == "One line."
    assert html.main_text(f"<body><div><p>One line, and no more.</p></div><section {name}>{remarks(n)}</section></body>") == "One line, and no more."
    assert html.main_text(f"<body><article><h1>Title</h1>{TEXT}<div {name}>{remarks(n)}</div></article></body>") == f"Title\n{SAID}"


def test_comments_in_articles_of_their_own_and_pages_of_comments_alone():
    many = "".join(f"<article class='comment'><p>Remark {i}, which is long, and has commas, really.</p></article>" for i in range(20))
    assert html.main_text(f"<body><main><h1>T</h1>{TEXT}</main>{many}</body>") == f"T\n{SAID}"
    assert html.main_text(f"<body><div class='comments'>{remarks(3)}</div></body>").count("\n") == 2
    assert html.main_text(f"<body class='comments'><div class='no-comments'><article>{TEXT}</article></div></body>") == SAID


@pytest.mark.parametrize("name", ["related-work", "social-history", "share-of-market", "footer-note", "menu-of-the-day", "widget-design", "skip-list", "sponsor-history", "header-files", "banner-ads-in-history", "navigation-by-stars", "notice-period"])
def test_sections_are_not_lost_by_a_part_of_their_name(name):
    assert html.main_text(f"<article><h1>T</h1>{TEXT}{TEXT}<section class='{name}'><h2>Head</h2>{TEXT}</section></article>") == "\n".join(["T", SAID, SAID, "Head", SAID])


@pytest.mark.parametrize("name", ["ad", "ads", "advertisement", "related-posts", "share-buttons", "newsletter", "cookie-banner", "sidebar-left", "site-footer", "main-menu", "social", "ad-slot-3", "breadcrumb"])
def test_names_of_what_is_no_article(name):
    noise = "<p>Buy, <a href='x'>all of this and that</a>, now.</p>"
    assert html.main_text(f"<body><div id='content'><h1>T</h1>{TEXT}{TEXT}<div class='{name}'>{noise}</div></div><div class='{name}'>{noise}</div></body>") == "\n".join(["T", SAID, SAID])


def test_an_article_of_links_alone():
    assert html.main_text("<body><nav><a>Home</a></nav><article><p><a href='x'>One</a></p><p><a href='y'>Two</a></p></article></body>") == "One\nTwo"


@pytest.mark.parametrize("tail", ["<a ", "<!--", "<a href=\"", "</a ", "<![CDATA[", "<?", "<script>", "<a b='", "<a x=\"'", "&amp", "<p", "<", "<!-", "<title>"])
def test_time_is_linear_in_what_never_closes(tail):
    took = []
    for n in (10_000, 80_000):
        start = time.process_time()
        assert html.main_text(f"<article>{TEXT}</article>" + tail * n).startswith(SAID)
        took.append(time.process_time() - start)
    assert took[1] < 24 * took[0] + 0.5


def test_what_never_closes_ends_the_page():
    assert html.main_text(f"<article>{TEXT}<p>a < b <3 and</p><p>more <b class='x") == f"{SAID}\na < b <3 and\nmore"
    assert html.main_text("<article><p title='>' hidden=no>gone</p><p data-x=\"a>b\" class=x/y>1 &lt;2&gt; &copy;<br/>x</p><!-- > --><script>var a='<p>';</script ><p>end</p></article>") == "1 <2> © x\nend"


class Plain(HTMLParser):
    """The tree by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tree = html.Tree()

    def handle_starttag(self, tag, attrs):
        names = {}
        for k, v in attrs:
            names.setdefault(k, v or "")
        self.tree.handle_starttag(tag, names)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in html.VOID and self.tree.at.tag == tag:
            self.tree.close_to(self.tree.at)

    def handle_endtag(self, tag):
        self.tree.handle_endtag(tag)

    def handle_data(self, data):
        if self.tree.at.tag not in ("script", "style"):
            self.tree.handle_data(data)


def shape(node):
    out, text = [], ""
    for x in node.children:
        if isinstance(x, str):
            text += x
        else:
            out, text = [*out, *([text] if text else []), (x.tag, x.names, x.apart, shape(x))], ""
    return [*out, *([text] if text else [])]


def test_trees_are_those_of_the_standard_parser(spark):
    import os

    r = random.Random(5)
    parts = ["<p>", "</p>", "<div class=\"a b\" id='c'>", "</div>", "text, more ", "&amp; &eacute; &#233; &nope; &lt;p&gt; ", "<br>", "<br/>", "<li>", "<ul>", "</ul>", "<!-- c <p> -->", "<script>if (a<b) '</p>'</script>", "<style>p > a {}</style>", "<a href=x>", "</a>", "<b/>", "<!DOCTYPE html>", "< x", "<td>", "<P HIDDEN>", "<img alt='>'>", "\n"]
    pages = ["".join(r.choice(parts) for _ in range(r.randint(1, 60))) for _ in range(1500)]
    if os.path.isdir(sf := "/root/testdata/sf0.01"):
        pages += [x.html for x in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    for page in pages:
        plain, mine = Plain(), html.Tree()
        plain.feed(page or "")
        plain.close()
        mine.feed(page or "")
        assert shape(plain.tree.root) == shape(mine.root), page
