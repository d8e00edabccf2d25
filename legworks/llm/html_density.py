"""Main text of web pages by composite text density."""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legworks.llm.common import map_rows

PAGE = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

# Elements by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("""address article aside blockquote body center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav
ol p pre section summary table tbody tfoot thead tr ul caption""".split())
SPACE = set("br td th".split())
NEVER = set("""head title script style noscript template iframe object svg canvas audio video map
nav footer aside form button select textarea input label fieldset dialog menu""".split())
WRAPPERS = {"form", "fieldset"}   # of NEVER; some pages are one form
NOT_MAIN_WORDS = set("""ad ads adv advert adverts advertisement advertising adsense banner
breadcrumb breadcrumbs comment comments commentlist cookie cookies consent copyright disqus
footer login menu menubar modal nav navbar navigation newsletter notice notices notification
pagination pager popup promo promotion related replies reply respond search share sharing
sidebar signup social sponsor sponsored subscribe subscription toolbar topbar tracking widget
masthead gdpr paywall discussion""".split())
# words that articles use for their own parts, too
ALSO_MAIN_WORDS = set("discussion related notice notices search widget footer banner".split())
COMMENT_WORDS = set("comment comments commentlist disqus replies reply respond".split())
NOT_MAIN_ROLES = set("""navigation banner contentinfo complementary search form alert alertdialog
dialog menu menubar toolbar""".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
FLOW = set("p ul ol dl pre blockquote table figure hr".split()) | HEADINGS
ITEMS = {"div", "li", "article", "section"}
BYLINES = set("b strong a cite span time img header h4 h5 h6 small".split())
SMALL_PRINT = re.compile(r"\s*(?:©|\(c\)|copyright\b)", re.I)
SMALL_PRINT_CHARS = 300
# Evidence from which a named part of an article is furniture (see ``is_furniture``).
FURNITURE = 2
# start tags that end an open element of the same kind
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = set("ul ol dl table body article section main div".split())
SPACES = re.compile(r"\s+")
# names that tell of a page what it has, rather than what an element is
STATE = re.compile(r"^(?:has|no|with|without|is|not)[-_]|[-_](?:open|closed|enabled|disabled)$", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Node:
    __slots__ = ("tag", "parent", "children", "dropped", "doubt", "names", "within", "chars", "tags",
                 "link_chars", "link_tags", "own", "density", "total", "core")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False, doubt: tuple = (),
                 names: tuple = ()):
        self.tag, self.parent, self.dropped, self.doubt = tag, parent, dropped, doubt
        self.names = names               # that tell of furniture, of a part of an article or main
        # the outermost article or main around
        self.within: Node | None = parent and (
            parent.within or (parent if parent.tag in ("article", "main") else None))
        self.children: list[Node | str] = []


class Tree(HTMLParser):
    """The DOM of a page; tolerant of missing and stray end tags."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.open: Counter[str] = Counter()      # elements by tag that are open

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            return
        if tag in BLOCK:
            self._close_within("p", SCOPE | BLOCK - {"p"})
        for other in SIBLINGS.get(tag, ()):
            self._close_within(other, SCOPE)
        attrs = dict(attrs)
        inside = self.at.within or (self.at.tag in ("article", "main") and self.at)
        dropped = not_main(tag, attrs, bool(inside))
        names = tuple(named(attrs)) if inside and not dropped else ()
        if inside and tag == "article" and self.open["article"]:
            names += ("comment",)                # an article in an article is a comment on it
        node = Node(tag, self.at, dropped, doubtful(tag, attrs) if dropped else (), names)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK and self.at.tag == tag:
            self._close(self.at)

    def _close(self, node):
        while self.at is not node.parent:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent

    def handle_endtag(self, tag):
        if not self.open[tag]:
            return
        node = self.at
        while node.parent is not None:
            if node.tag == tag:
                self._close(node)
                return
            if node.tag in BLOCK and tag not in BLOCK:
                return  # an inline end tag doesn't close a block
            node = node.parent

    def handle_data(self, data):
        self.at.children.append(data)

    def _close_within(self, tag, scope):
        if not self.open[tag]:
            return
        node = self.at
        while node.parent is not None and (node.tag not in scope or node.tag == tag):
            if node.tag == tag:
                self._close(node)
                return
            node = node.parent


def named(attrs: dict[str, str | None]) -> list[str]:
    """Names of furniture among an element's classes and id: a word by itself, or with others
    (then with a plus)."""
    out = []
    for n in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split():
        if n.lower() in NOT_MAIN_WORDS:
            out.append(n.lower())
        elif not STATE.search(n):
            out += [f"+{w.lower()}" for w in WORDS.findall(n) if w.lower() in NOT_MAIN_WORDS]
    return out


def not_main(tag: str, attrs: dict[str, str | None], inside: bool) -> bool:
    """Whether an element is page furniture by its tag or role or, outside of an article or
    main (``inside``), by its class or id."""
    if tag in NEVER or (tag == "header" and not inside):
        return True
    if (attrs.get("role") or "").lower() in NOT_MAIN_ROLES or "hidden" in attrs:
        return True
    if inside:
        return False
    names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()
    if tag in ("article", "main"):  # by a name of its own only: these hold the main text
        return any(n.lower() in NOT_MAIN_WORDS for n in names)
    return any(w.lower() in NOT_MAIN_WORDS for n in names if not STATE.search(n)
               for w in WORDS.findall(n))


def doubtful(tag: str, attrs: dict[str, str | None]) -> tuple:
    """What a dropped element was dropped for, if that may also wrap the main text: a form, or
    words that are only a part of its names; empty if it is furniture for certain."""
    names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()
    if (tag in NEVER - WRAPPERS or tag in ("header", "article", "main") or "hidden" in attrs
            or (attrs.get("role") or "").lower() in NOT_MAIN_ROLES - {"form"}
            or any(n.lower() in NOT_MAIN_WORDS for n in names)):
        return ()
    return (tag in WRAPPERS, *sorted({n for n in names if not STATE.search(n) and any(
        w.lower() in NOT_MAIN_WORDS for w in WORDS.findall(n))}))


def keep_wrappers(root: Node) -> None:
    """Take back the drop of doubtful elements that hold an article or main, or that hold (named
    ones with those of the same names) most of the page's text outside links."""
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack += [c for c in node.children
                  if isinstance(c, Node) and (not c.dropped or c.doubt)]
    if not any(n.doubt for n in nodes):
        return
    plain: dict[int, int] = {}
    holds: set[int] = set()
    alike: dict[tuple, int] = {}
    for node in reversed(nodes):
        n = plain.get(id(node), 0) + sum(len("".join(c.split())) for c in node.children
                                         if isinstance(c, str))
        plain[id(node)] = n = 0 if node.tag == "a" else n
        if node.parent is not None:
            plain[id(node.parent)] = plain.get(id(node.parent), 0) + n
            if node.tag in ("article", "main") or id(node) in holds:
                holds.add(id(node.parent))
        if node.doubt:
            if node.doubt[0]:                 # forms are judged one by one
                node.doubt = (True, id(node))
            alike[node.doubt] = alike.get(node.doubt, 0) + n
    for node in nodes:
        if node.doubt and (id(node) in holds or 2 * alike[node.doubt] > plain[id(root)]):
            node.dropped = False


def parse(html: str) -> Node:
    tree = Tree()
    tree.feed(html)
    tree.close()
    keep_wrappers(tree.root)
    return tree.root


def in_order(root: Node) -> list[Node]:
    """Nodes that are not dropped, parents first."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped]
    return out


def densities(nodes: list[Node]) -> None:
    """Composite text density of every node, and the sum over its children.

    Characters per tag, lowered by the share of link text against the whole page.
    A node's own text counts as a child without tags.
    """
    for node in reversed(nodes):
        node.own = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        kids = [c for c in node.children if isinstance(c, Node) and not c.dropped]
        node.chars = node.own + sum(c.chars for c in kids)
        node.tags = len(kids) + sum(c.tags for c in kids)
        # down to where a node's text parts, past wrappers of a single element
        node.core = kids[0].core if (len(kids) == 1 and not node.own
                                     and kids[0].tag not in FLOW) else node
        link = node.tag == "a"
        node.link_chars = node.chars if link else sum(c.link_chars for c in kids)
        node.link_tags = sum(c.link_tags + (c.tag == "a") for c in kids)
    body = nodes[0]
    page_links = body.link_chars / body.chars if body.chars else 0.0

    def density(chars, tags, link_chars, link_tags):
        if not chars:
            return 0.0
        plain = max(1, chars - link_chars)
        base = math.log(chars * link_chars / plain + page_links * chars + math.e)
        ratio = chars * max(1, tags) / (max(1, link_chars) * max(1, link_tags))
        return chars / max(1, tags) * max(0.0, math.log(max(ratio, 1.0))) / math.log(
            max(base, 1.1))

    for node in reversed(nodes):
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags)
        node.total = density(node.own, 0, node.own if node.tag == "a" else 0, 0) + sum(
            c.density for c in node.children if isinstance(c, Node) and not c.dropped)


def kids(node: Node) -> list[Node]:
    return [c for c in node.children if isinstance(c, Node) and not c.dropped]


def link_heavy(node: Node) -> bool:
    return 2 * node.link_chars > node.chars


def repeats(node: Node) -> bool:
    """Whether nearly all of a node's text is in items of the same make, a byline and what was said:
    the shape of reader comments."""
    inner = kids(node.core)
    if len(inner) == 1 and inner[0].tag in ("ul", "ol"):
        inner = kids(inner[0])
    items = [c for c in inner if c.tag in ITEMS]
    makes = Counter((c.tag, tuple(k.tag for k in kids(c))) for c in items)
    if not makes:
        return False
    (tag, make), n = makes.most_common(1)[0]
    said = sum(c.chars for c in items if (c.tag, tuple(k.tag for k in kids(c))) == (tag, make))
    return (n > 1 and len(make) > 1 and make[0] in BYLINES and make[-1] in FLOW | {"div"}
            and 5 * said >= 4 * node.chars)


def reads_on(node: Node) -> bool:
    """Whether a node is made like a part of an article: it has a heading or several
    paragraphs, isn't mostly links and doesn't repeat a pattern."""
    flow = [c for c in kids(node.core) if c.tag in FLOW and c.chars]
    return (not link_heavy(node) and not repeats(node)
            and (len(flow) > 1 or any(c.tag in HEADINGS for c in flow)))


def small_print(node: Node) -> bool:
    """Whether a short block begins like a copyright line."""
    if node.chars > SMALL_PRINT_CHARS:
        return False
    return bool(SMALL_PRINT.match(" ".join(blocks(node, [node]))))


def is_furniture(node: Node, alike: int) -> bool:
    """Whether a named part of an article is a menu, an advert, a comment list and the like.

    Names are only a part of the evidence, next to links, length, make and repetition: a section that
    reads like the article stays whatever its name, as do parts of one name that together (``alike``
    characters) hold most of the text.
    """
    own = [n for n in node.names if not n.startswith("+")]
    words = {n.lstrip("+") for n in node.names}
    whole = node.within.chars if node.within is not None else node.chars
    share = node.link_chars / node.chars if node.chars else 0.0
    evidence = 2 if own else 1
    evidence += 2 if words & COMMENT_WORDS else 1 if words - ALSO_MAIN_WORDS else 0
    evidence += 2 if share > 0.5 else 1 if share > 0.25 else 0
    evidence += repeats(node)
    evidence += 20 * alike < whole
    if share <= 0.25 and not repeats(node):
        evidence -= 2 * (reads_on(node) or node.tag == "section")
    return evidence - 4 * (2 * alike > whole) >= FURNITURE


def drop_furniture(nodes: list[Node]) -> bool:
    """Drop the named parts of articles that the evidence speaks against, outer ones first."""
    suspects = [n for n in nodes if n.names]
    alike: Counter[tuple] = Counter()
    for n in suspects:
        alike[n.names, n.tag] += n.chars
    if not suspects:
        return False
    gone: set[int] = set()
    for n in nodes:                            # parents first
        if n.parent is not None and id(n.parent) in gone:
            gone.add(id(n))
        elif n.names and is_furniture(n, alike[n.names, n.tag]):
            n.dropped = True
            gone.add(id(n))
    return bool(gone)


def main_nodes(nodes: list[Node]) -> list[Node]:
    """The subtree of the largest density sum (of equals the outermost, then the first), widened by
    what belongs to it.

    Inside an article or main, that is the outermost one around it and, for an article, its
    sibling articles.  Else it is what stands beside the subtree on its path to the body:
    headings and running text; siblings as dense as the least dense node of the path, right beside
    the subtree; farther off, parts that read like an article.  Parts that are mostly links,
    that repeat a byline and a remark, and copyright lines don't belong to it.
    """
    best = max(nodes, key=lambda n: n.total)  # the first of equals: parents before children
    around = best.within or (best if best.tag in ("article", "main") else None)
    if around is not None:
        if around.tag == "article" and around.parent is not None:
            return [c for c in kids(around.parent)
                    if c is around or (c.tag == "article" and not link_heavy(c))]
        return [around]
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    least = min(n.density for n in path)
    if len(path) == 1:                        # the body itself
        for other in kids(best):
            if other.tag in BLOCK and other.tag not in HEADINGS:
                other.dropped = link_heavy(other) or repeats(other) or small_print(other)
        return [best]
    for level, (child, parent) in enumerate(zip(path, path[1:], strict=False)):
        top = parent.parent is None
        for other in kids(parent):
            # links between words of their parent are part of a sentence
            if other is child or other.tag in HEADINGS or not (
                    other.tag in BLOCK or not parent.own):
                continue
            if link_heavy(other) or small_print(other):
                other.dropped = True
            elif other.tag not in FLOW and other.tag in BLOCK:
                near = level == 0 and not top and other.density >= least and not repeats(other)
                other.dropped = not (near or reads_on(other))
    return [path[-1]]


def blocks(root: Node, chosen: list[Node]) -> list[str]:
    """Blocks of the chosen subtrees in page order, white space folded."""
    wanted = set(map(id, chosen))
    out: list[str] = []
    held: list[str] = []

    def flush():
        block = SPACES.sub(" ", "".join(held)).strip()
        if block:
            out.append(block)
        held.clear()

    stack: list[tuple[Node | str, bool, bool]] = [(root, False, False)]
    while stack:
        node, inside, leaving = stack.pop()
        if isinstance(node, str):
            if inside:
                held.append(node)
            continue
        if node.tag in BLOCK or id(node) in wanted:
            flush()
        elif node.tag in SPACE:
            held.append(" ")
        if leaving or node.dropped:
            continue
        inside = inside or id(node) in wanted
        stack.append((node, inside, True))
        stack += [(c, inside, False) for c in reversed(node.children)]
    flush()
    return out


def extract(html: str | None) -> str:
    """Main text of a page: its blocks, joined by an empty line; empty if it has none."""
    root = parse(html or "")
    nodes = in_order(root)
    densities(nodes)
    if drop_furniture(nodes):
        nodes = in_order(root)
        densities(nodes)
    if not root.chars:
        return ""
    return "\n\n".join(blocks(root, main_nodes(nodes)))


def main_text(pages: DataFrame) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars (code points).

    Composite text density: characters per tag of every DOM node, lowered by its links; the
    subtree with the largest sum of its children's densities is the main text, widened by what belongs
    to it (``main_nodes``).  Of subtrees of equal sums the outermost, then the first one is taken.

    A page is handled by itself, so there is no shuffle.  Null and empty html,
    and pages without text outside menus and the like, give an empty text.  Very
    long and very deep pages are parsed whole, in time that grows with their length.  Repeated rows stay.  An empty table gives no
    rows.  Columns other than page_id, url and html are ignored.
    """
    def per_batch(cols):
        text = [extract(h) for h in cols["html"]]
        return {"page_id": cols["page_id"], "url": cols["url"], "text": text,
                "n_chars": [len(t) for t in text]}

    return map_rows(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                                 F.col("html").cast("string")), per_batch, PAGE)
