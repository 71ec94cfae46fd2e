"""Main text of HTML pages by tree scoring.

The page becomes a tree of blocks. Each paragraph-like block gives points for its length and commas to its parent and half of them to its
grandparent; points are discounted by the share of text in links. The container with most points is raised to the article or main that it lies in, or else to what
holds most of the page's points: points reach two levels only, so a long section beats the article around it. It and siblings of it that read
like text are the article. Menus, headers, footers, sidebars, notices, adverts, forms, comments and what is not
shown are left out by tag and role, and by name: a whole class or id, or one put together of such names and words of place, and only where the node does not hold most of the page. Inside an
article a name that is put together counts only if the node is links for the most part. Reader comments go as long as anything else is left. A page is worked on alone, by a small parser over its whole html.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from catalume.llm.common import prepare, tidy

# Elements by what HTML says about them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template head title iframe object svg canvas math audio video map".split())
APART = frozenset("nav footer aside form button select textarea dialog menu fieldset label option datalist".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
PARAGRAPH = frozenset("p pre blockquote td li dd h1 h2 h3 h4 h5 h6 figcaption dt th caption summary".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag closes open elements of these names that it cannot lie in, up to the nearest of SCOPE.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPE = frozenset("ul ol dl table select body html article section div main".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: What names say that a node is no part of the article, and words that may stand beside them: where it is, what it is made of.
BOILERPLATE = re.compile(r"ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|cookies?|consent|disqus|footer|header|masthead|menu|modal|nav\w*|newsletter|notice|pager|pagination|popup|promo\w*|related|replies|respond|share|sharing|sidebar|skip|skiplinks?|social|sponsor\w*|subscribe|toolbar|widgets?")
BESIDE = frozenset("site page main top bottom left right primary secondary global container wrapper wrap box bar area section block links link inner outer fixed sticky mobile desktop button buttons icons form thread slot unit overlay signup sign up policy trail posts articles stories news user reader view region column col row group area text content body title to it".split())
HEADS = frozenset("banner header masthead".split())
REMARKS = frozenset("comment comments commentlist disqus replies respond".split())
#: What stands before a name that says what a node has, or lacks, and not what it is.
HAVING = re.compile(r"(?<![a-z])(has|have|no|not|with|without|hide|show|is)[-_]\S*")
ARTICLE = re.compile(r"(?<![a-z])(article|body|content|entry|main|post|story|text)(?![a-z])")
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())


class Node:
    __slots__ = ("tag", "parent", "block", "scope", "held", "children", "apart", "names", "points", "gains", "size", "linked")

    def __init__(self, tag: str, parent: "Node | None", apart: bool = False, names: str = ""):
        self.tag, self.parent, self.apart, self.names = tag, parent, apart, names
        self.block = self if parent is None or tag in BLOCK else parent.block
        self.scope = self if parent is None or tag in SCOPE else parent.scope
        self.held = defaultdict(int) if self.block is self or self.scope is self else None  # open elements below, by tag
        self.children: list[Node | str] = []
        self.clear()

    def clear(self) -> None:
        self.points = self.gains = self.size = self.linked = 0.0


TAG, ATTRIBUTE, GAP = re.compile(r"[a-zA-Z][^\s/>]*+"), re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:([\"'])|([^\s>]*+)))?"), re.compile(r"[\s/]*+")
RAW_END = {x: re.compile(rf"</{x}(?=[\s/>])", re.I) for x in RAW}


class Tree:
    """The page as a tree, read from left to right: what never closes - a tag, a quote, a comment, a script - ends the page, as browsers have it, so nothing is looked for twice.

    What is open is counted by tag, so that no tag makes it look through all that is open: time is linear in the page.
    """

    def __init__(self) -> None:
        self.root = self.at = Node("html", None)
        self.open: dict[str, int] = defaultdict(int)

    def feed(self, html: str) -> None:
        at = 0
        while (start := html.find("<", at)) >= 0:
            if start > at:
                self.handle_data(unescape(html[at:start]))
            two = html[start + 1 : start + 3]
            if html.startswith("<!--", start):
                end = html.find("-->", start + 2)  # <!--> is one, too
                at = end + 3
            elif two[:1] in ("!", "?"):
                end = html.find(">", start)
                at = end + 1
            elif two[:1] == "/" and (found := TAG.match(html, start + 2)):
                end = html.find(">", found.end())
                at = end + 1
                if end >= 0:
                    self.handle_endtag(found[0].lower())
            elif found := TAG.match(html, start + 1):
                end = at = self.tag(found[0].lower(), html, found.end())
            else:
                self.handle_data("<")
                end, at = start, start + 1
            if end < 0:
                return
        self.handle_data(unescape(html[at:]))

    def tag(self, name: str, html: str, at: int) -> int:
        """Read a start tag from behind its name on; where it ends, or -1 if it never does. What lies in a script and its like is left out."""
        attrs: dict[str, str] = {}
        while True:
            gap = GAP.match(html, at)
            at, slash = gap.end(), gap[0].endswith("/")
            if at >= len(html):
                return -1
            if html[at] == ">":
                break
            found = ATTRIBUTE.match(html, at)
            at, value = found.end(), found[3] or ""
            if found[2]:
                end = html.find(found[2], at)
                if end < 0:
                    return -1
                value, at = html[at:end], end + 1
            attrs.setdefault(found[1].lower(), unescape(value))
        at += 1
        self.handle_starttag(name, attrs)
        if name in RAW and not slash:
            end = RAW_END[name].search(html, at)
            if end is None:
                return -1
            if name == "textarea" or name == "title":
                self.handle_data(unescape(html[at : end.start()]))
            return end.start()
        if slash and name not in VOID and self.at.tag == name:
            self.close_to(self.at)
        return at

    def count(self, node: Node, n: int) -> None:
        tag, block, scope = node.tag, node.parent.block, node.parent.scope
        self.open[tag] += n
        block.held[tag] += n
        if scope is not block:
            scope.held[tag] += n

    def close_to(self, node: Node) -> None:
        """Close node and all that is open in it."""
        while node is not self.root:
            at, self.at = self.at, self.at.parent
            self.count(at, -1)
            if at is node:
                return

    def handle_starttag(self, tag: str, a: dict[str, str]) -> None:
        if tag in ("html", "body") and self.at is not self.root:
            return
        if tag in BLOCK:
            at = self.at.block
            if at.tag == "p" or at.tag in HEADINGS and tag in HEADINGS:
                self.close_to(at)
        if tag in CLOSES:
            while any(self.at.scope.held[x] for x in CLOSES[tag]):
                last, self.at = self.at, self.at.parent
                self.count(last, -1)
        if tag in VOID:
            self.at.children.append(Node(tag, self.at))
            return
        names = f"{a.get('class', '')} {a.get('id', '')}".lower()
        hidden = "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "").lower()
        apart = tag in UNSEEN or tag in APART or hidden or a.get("role") in ROLES
        self.at.children.append(node := Node(tag, self.at, apart, names))
        self.at = node
        self.count(node, 1)

    def handle_endtag(self, tag: str) -> None:
        if not self.open[tag] or tag not in BLOCK and not (self.at.block.held[tag] or self.at.block.tag == tag):
            return  # an end tag of a phrase does not close blocks
        at = self.at
        while at.tag != tag:
            at = at.parent
        self.close_to(at)

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def walk(node: Node):
    """node and all below that are not set apart, parents first, without recursion."""
    stack = [node]
    while stack:
        at = stack.pop()
        yield at
        stack.extend(x for x in reversed(at.children) if isinstance(x, Node) and not x.apart)


def named(names: str) -> tuple[set[str], bool]:
    """What of BOILERPLATE the classes and ids of a node say, and whether one of them says it alone."""
    found, alone = set(), False
    for name in HAVING.sub(" ", names).split():
        parts = [x for x in re.split(r"[-_]+|(?<=\d)(?=\D)|(?<=\D)(?=\d)", name) if x]
        mine = {x for x in parts if BOILERPLATE.fullmatch(x)}
        if mine and all(x in mine or x in BESIDE or x.isdigit() for x in parts):
            found |= mine
            alone = alone or len(parts) == 1
    return found, alone


def set_apart(root: Node, remarks: bool = True) -> None:
    """Set apart the headers of the page, reader comments (if remarks), and nodes by their names: but for those that hold most of what the page has to say.

    Heads of an article are part of it. Comments may well be longer than the article, so how much they hold does not count; but what holds a main, or an article that is none itself, is no comment.
    """
    measure(root)
    told = {id(x): named(x.names) for x in walk(root)}
    whole: set[int] = set()
    for node in walk(root):
        if node.tag == "main" or node.tag == "article" and not told[id(node)][0] & REMARKS:
            while node is not None and id(node) not in whole:
                whole.add(id(node))
                node = node.parent
    total, stack = root.gains, [(root, False)]
    while stack:
        node, inside = stack.pop()
        found, alone = told[id(node)] if node.tag not in ("html", "body") else (set(), False)
        if found & REMARKS and id(node) not in whole:
            node.apart = node.apart or remarks
        elif node.tag not in ("main", "article"):
            found = found - REMARKS - (HEADS if inside else set())
            links = alone or node.linked > 0.3 * node.size or not inside
            node.apart = node.apart or node.tag == "header" and not inside or bool(found) and links and node.gains <= 0.5 * total
        inside = inside or node.tag in ("article", "main") or node.tag not in ("html", "body") and bool(ARTICLE.search(node.names))
        stack.extend((x, inside) for x in node.children if isinstance(x, Node) and not x.apart)


def measure(root: Node) -> list[Node]:
    """Fill in size, linked, points and gains (of all paragraphs in a node); the nodes that may hold an article."""
    order = list(walk(root))
    for node in order:
        node.clear()
    for node in reversed(order):
        node.size += sum(len(x.strip()) for x in node.children if isinstance(x, str))
        if node.tag == "a":
            node.linked = node.size
        if node.parent is not None:
            node.parent.size += node.size
            node.parent.linked += node.linked
    for node in order:
        own = "".join(x for x in node.children if isinstance(x, str))
        if node.tag in PARAGRAPH or node.tag in BLOCK and own.strip():
            gain = (1 + min(3.0, node.size / 100) + own.count(",")) * (1 - node.linked / node.size) if node.size else 0.0
            given, share = node if node.tag not in PARAGRAPH else node.parent, 1.0
            node.gains = gain
            for _ in range(2):
                if given is None:
                    break
                given.points += gain * share
                given, share = given.parent, share / 2
    for node in reversed(order):
        if node.parent is not None:
            node.parent.gains += node.gains
    return [x for x in order if x.points > 0]


def raised(best: Node) -> Node:
    """The whole that best is a part of: the outermost article or else main around it; else the nearest node named like an article that holds most of the page's gains, or the
    nearest that does, if best itself doesn't. Never the page."""
    around = [best]
    while around[-1].parent is not None:
        around.append(around[-1].parent)
    total = around[-1].gains
    around = [x for x in around if x.tag not in ("html", "body")]
    for tag in ("article", "main"):
        if any(x.tag == tag for x in around):
            return [x for x in around if x.tag == tag][-1]
    most = [x for x in around if 2 * x.gains > total]
    return next((x for x in most if ARTICLE.search(x.names)), next(iter(most), best))


def render(nodes: list[Node]) -> str:
    """Text of blocks in page order, one a line, white space in a block as one blank."""
    blocks: list[list[str]] = [[]]
    for top in nodes:
        blocks.append([])
        stack: list[Node | str | None] = [top]
        while stack:
            at = stack.pop()
            if at is None:
                blocks.append([])
            elif isinstance(at, str):
                blocks[-1].append(at)
            elif at is top or not at.apart:
                if at.tag == "br":
                    blocks[-1].append(" ")
                block = at.tag in BLOCK
                if block:
                    blocks.append([])
                    stack.append(None)
                stack.extend(reversed(at.children))
        blocks.append([])
    lines = (" ".join("".join(x).split()) for x in blocks)
    return "\n".join(x for x in lines if x)


def main_text(html: str | None) -> str:
    """The article of one page; empty if it has none."""
    if not html:
        return ""
    for remarks in (True, False):  # comments count only on a page that has nothing else
        tree = Tree()
        tree.feed(html)
        set_apart(tree.root, remarks)
        if found := measure(tree.root):
            break
        texts = [x for x in walk(tree.root) if x.tag in ("article", "main") and x.size]
        if texts:  # of links alone
            return render(texts[:1])
    if not found:
        return ""

    def value(node: Node) -> float:
        bonus = 25 if node.tag in ("article", "main") else 5 if ARTICLE.search(node.names) else 0
        return (node.points + bonus) * (1 - node.linked / node.size if node.size else 0)

    best = max(found, key=value)
    best_value = value(best)
    best = raised(best)
    if best.parent is None:
        return render([best])
    kept = []
    for node in best.parent.children:
        if isinstance(node, str) or node.apart:
            continue
        dense = node.linked / node.size if node.size else 1.0
        reads = node.tag in PARAGRAPH and node.tag not in ("li", "td", "th") and (node.size > 80 and dense < 0.25 or node.tag in HEADINGS and dense == 0)
        if node is best or value(node) >= max(10, 0.2 * best_value) or best.tag not in ("article", "main") and reads:
            kept.append(node)
    return render(kept)


def extracted(pages: DataFrame) -> DataFrame:
    """All columns of pages, text and n_chars (code points); columns of these names in pages are replaced.

    Null and empty html and pages without an article have an empty text. Rows are worked on one by one: repeated rows give
    equal results, no rows give none.
    """
    prepare(pages.sparkSession)
    kept = pages.drop("text", "n_chars")

    def texts(batches):
        for batch in batches:
            found = [main_text(x) for x in batch.column(batch.schema.get_field_index("html")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], [*batch.schema.names, "text", "n_chars"])

    return kept.mapInArrow(tidy(texts), T.StructType([*kept.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))
