"""Main-text extraction by composite text density.

Every DOM node, runs of text included, gets a density: its characters per tag, scaled down by its share of link
characters (all tags beneath a node count, link tags count as link characters' carriers). A node's density sum is the sum
of its children's densities; on every page the container (no paragraph, heading, list or inline element) of the largest
sum is the article, and an article or main tag only breaks ties; where all that it holds is one container with at least half
of its sum beside blocks without tags and lists of links, that container is. The smallest density among the nodes above it, up to
body, is the threshold: blocks beside the path that reach it, and whose own density sum is that of a usual block of the
article at least (half the article's whole sum for a block without a tag in it, as a short text is dense by having no tags),
belong to the text. Those that don't are left out, but for headings among them and, where the path goes through an
<article>, sibling articles that aren't mostly links.
Elements that cannot be article text (scripts, styles, forms, navigation, headers, footers, asides) are taken out before
any density is taken, as are blocks with a whole token of class, id or role that names a menu, notice, advert, sidebar or
comments, and hidden ones, unless such a block holds an article or main tag or most of the body's text. Of a header within
an article or main tag its headings stay, as they are the article's own; the rest of it goes.

Pages are read in one pass whose steps don't go back, so time grows with the length of any markup, however odd: a quote
counts only after =, as in browsers; one that never closes ends that rule for the rest of the page.

Results: a null or empty page, or one without text, gives an empty string and 0 characters; an empty table gives an empty
result; long pages are read whole; of equal density sums the first in page order counts, after tags; unclosed and
misnested tags are closed by their parents; repeated rows give repeated results; extra columns, whatever their names, are
left out.
"""

from __future__ import annotations

import math
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])))*+)>", re.S)
#: For the rest of a page in which a quote never closes.
PLAIN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
START = re.compile(r"<(?:[!?]|/?[a-zA-Z])")
ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math noembed noframes xmp".split())
DROP = frozenset("script style noscript iframe template svg math form button select option input textarea label fieldset nav header footer aside menu dialog object embed canvas video audio title head noembed noframes".split())
BLOCK = frozenset("address article blockquote body br center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Whole tokens of class, id or role that name page furniture.
FURNITURE = re.compile(
    r"(?:^|\s)(?:ads?|advert\w*|adbox|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|side-?bar|aside|widget\w*|footer|header|masthead|notice|cookies?|consent|gdpr|popup|modal|overlay|newsletter|subscribe|signup|social|share|sharing|related|recommend\w*|comments?|disqus|replies|reply|respond|pagination|pager|skip|toolbar|navigation|contentinfo|complementary|search|alert|hidden)(?=$|\s)",
    re.I,
)
#: Start tags that end an open element of the named kinds, but not beyond the nearest of the bounds.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BOUNDS = frozenset("ul ol dl table tbody thead tfoot body article section div main".split())
ENDS_P = BLOCK - {"br", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
INNER = HEADING | frozenset("p blockquote pre li ul ol td tr tbody table br".split())
FORMATTING = frozenset("a b i em strong u s span small big font code tt sub sup mark q cite abbr".split())


#: Equal sums count as equal, whatever the order of additions.
NEARLY = 1 + 1e-9


class Node:
    __slots__ = ("chars", "dens", "kids", "links", "ltags", "marked", "parent", "tag", "tags", "total")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.kids = tag, parent, []  # kids: nodes and texts
        self.chars = self.tags = self.links = self.ltags = 0
        self.dens = self.total = 0.0
        self.marked = False  # by its attributes it looks like furniture


def furniture(tag: str, attrs: str) -> bool:
    if not attrs or tag in ("body", "html", "article", "main"):
        return False
    for name, a, b, c in ATTR.findall(attrs):
        if name.lower() in ("class", "id", "role") and FURNITURE.search(a or b or c):
            return True
    return bool(re.search(r"\shidden(?=[\s/=]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", attrs, re.I))


class Open:
    """The open elements, innermost last, with the places of each tag's, so that no step searches the stack."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.of: dict[str, list[int]] = {}
        self.bounds, self.plain = [0], [0]

    def push(self, x: Node) -> None:
        at = len(self.stack)
        self.stack.append(x)
        self.of.setdefault(x.tag, []).append(at)
        if x.tag in BOUNDS:
            self.bounds.append(at)
        if x.tag not in FORMATTING:
            self.plain.append(at)

    def last(self, tag: str) -> int:
        at = self.of.get(tag)
        return at[-1] if at else 0

    def close(self, at: int) -> None:
        """Ends the element at a place of the stack and all within it."""
        while len(self.stack) > at:
            x = self.stack.pop()
            self.of[x.tag].pop()
            if x.tag in BOUNDS:
                self.bounds.pop()
            if x.tag not in FORMATTING:
                self.plain.pop()


def tokens(page: str):
    """(text before, match) of every tag, comment and declaration in order, the last with no match."""
    at, n, token, last = 0, len(page), TOKEN, page.rfind(">")
    while True:
        seek = at
        while m := START.search(page, seek):
            if m.start() > last and not page.startswith("<!--", m.start()):
                m = None  # nothing after this ends
                break
            found = token.match(page, m.start())
            if not found and token is TOKEN:
                token = PLAIN
                found = token.match(page, m.start())
            if found:
                m = found
                break
            seek = m.end()
        if not m:
            yield page[at:], None
            return
        skip = yield page[at : m.start()], m
        at = skip or m.end()
        if skip:
            yield None
        if at >= n:
            return


def parse(page: str) -> Node:
    """The DOM, with furniture marked and elements of DROP in it; text nodes hold decoded text."""
    root = Node("#root", None)
    open_, missing, seen = Open(root), set(), set()  # missing: raw elements that have no end any more
    walk = tokens(page)
    for text, m in walk:
        if text:
            open_.stack[-1].kids.append(unescape(text))
        if m is None or not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            at = open_.last(tag)
            if at and not (tag in FORMATTING and open_.bounds[-1] > at):
                open_.close(at)
            elif tag == "p":
                open_.stack[-1].kids.append(Node("p", open_.stack[-1]))
            continue
        if tag in RAW:
            close = None if tag in missing else re.compile(rf"</{tag}\s*+>", re.I).search(page, m.end())
            if close:
                walk.send(close.end())
                continue
            missing.add(tag)
            if tag in ("script", "style"):
                break
        if tag in ENDS_P and (p := open_.last("p")) and open_.plain[-1] == p:
            open_.close(p)
        if tag in CLOSES and (at := max(open_.last(t) for t in CLOSES[tag])) > open_.bounds[-1]:
            open_.close(at)
        if tag in ("html", "body"):
            if tag in seen:
                continue
            seen.add(tag)
            if tag == "body" and (head := open_.last("head")):
                open_.close(head)
        here = open_.stack[-1]
        node = Node(tag, here)
        node.marked = furniture(tag, m[3])
        here.kids.append(node)
        if tag not in VOID and not (m[3].rstrip().endswith("/") and tag in DROP):
            open_.push(node)
    return root


def order(root: Node) -> list[Node]:
    """In page order, parents before children; without recursion, as pages may nest deeply."""
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        out.append(x)
        todo += [k for k in reversed(x.kids) if isinstance(k, Node)]
    return out


def length(text: str) -> int:
    return len("".join(text.split()))


def titles(header: Node) -> list[Node]:
    """The headings of a header, without those of menus and the like in it."""
    out, todo = [], [header]
    while todo:
        x = todo.pop()
        if x.tag in HEADING:
            out.append(x)
        else:
            todo += [k for k in reversed(x.kids) if isinstance(k, Node) and k.tag not in DROP and not k.marked]
    return out


def prune(root: Node) -> None:
    """Takes out elements of DROP, and what is marked, but for headings of an article's header and for elements that hold an
    article or main tag or most of the body's text.

    Most of the text doesn't count for a single block, such as an advert, beside an article tag that has text (a short one).
    """
    inside = set()  # an article or main tag, or beneath one
    for x in order(root):
        if x.tag in ("article", "main") or x.parent in inside:
            inside.add(x)
        own = x in inside
        kids = []
        for k in x.kids:
            if isinstance(k, str) or k.tag not in DROP:
                kids.append(k)
            elif own and k.tag == "header":
                for h in titles(k):
                    h.parent = x
                    kids.append(h)
        x.kids = kids
    nodes = order(root)
    if not any(x.marked for x in nodes):
        return
    body = next((x for x in nodes if x.tag == "body"), root)
    held, chars, blocks, named = set(), {}, {}, False
    for x in reversed(nodes):
        kids = [k for k in x.kids if isinstance(k, Node)]
        chars[x] = sum(chars[k] for k in kids) + sum(length(k) for k in x.kids if isinstance(k, str))
        blocks[x] = sum(blocks[k] + (k.tag in BLOCK and chars[k] > 0) for k in kids)
        if x.tag in ("article", "main"):
            named = named or chars[x] > 0
        if x.tag in ("article", "main") or any(k in held for k in kids):
            held.add(x)

    def stays(x: Node) -> bool:
        return not x.marked or x in held or 2 * chars[x] > chars[body] and (blocks[x] > 1 or not named)

    for x in nodes:
        x.kids = [k for k in x.kids if isinstance(k, str) or stays(k)]


def density(chars: int, tags: int, links: int, ltags: int, share: float) -> float:
    """Characters per tag, times a logarithm that falls with the share of link characters; share: that of the whole body."""
    if not chars:
        return 0.0
    tags = max(tags, 1)
    base = max(math.log(chars / max(chars - links, 1) * links + share * chars + math.e), 1.0001)
    arg = (chars / links) * (tags / max(ltags, 1)) if links else max(chars * tags, 2)
    return chars / tags * max(math.log(max(arg, 1.0), base), 0.0)


def weigh(root: Node) -> list[Node]:
    """Counts, densities and density sums of all nodes; a run of text is a child without tags."""
    nodes = order(root)
    for x in reversed(nodes):
        for k in x.kids:
            if isinstance(k, Node):
                x.chars += k.chars
                x.tags += k.tags + 1
                x.links += k.links
                x.ltags += k.ltags + (k.tag == "a")
            else:
                x.chars += length(k)
        if x.tag == "a":
            x.links = x.chars
    body = next((x for x in nodes if x.tag == "body"), root)
    share = body.links / max(body.chars, 1)
    for x in nodes:
        x.dens = density(x.chars, x.tags, x.links, x.ltags, share)
    for x in nodes:
        for k in x.kids:
            if isinstance(k, Node):
                x.total += k.dens
            else:
                c = length(k)
                x.total += density(c, 0, c if x.tag == "a" else 0, x.tag == "a", share)
    return nodes


def container(x: Node) -> bool:
    return x.tag not in FORMATTING and x.tag not in INNER


def main_nodes(root: Node) -> list[Node | str]:
    """The container of the largest density sum, and what belongs to it beside it and its parents, in page order."""
    prune(root)
    nodes = weigh(root)
    body = next((x for x in nodes if x.tag == "body"), root)
    best = max((x for x in order(body) if x is body or container(x)), key=lambda x: (x.total, x.tag in ("article", "main")))
    best = narrowed(best)
    threshold, x = math.inf, best
    while x is not body:
        x = x.parent
        threshold = min(threshold, x.dens)
    # A story may be dealt over several blocks: beside the winner, and beside each node that holds it.
    share = body.links / max(body.chars, 1)
    usual, half = usual_block(best, share), best.total / 2 if best.tags else 0.0
    parts = [best]
    while best is not body:
        beside = best.parent.kids
        at = beside.index(best)
        keep = [i == at or belongs(k, best, threshold, usual, half, share) for i, k in enumerate(beside)]
        last = max(i for i, yes in enumerate(keep) if yes)
        keep = [yes or i < last and isinstance(k, Node) and k.tag in HEADING for i, (k, yes) in enumerate(zip(beside, keep, strict=True))]
        parts = [k for k, yes in zip(beside[:at], keep, strict=False) if yes] + parts + [k for k, yes in zip(beside[at + 1 :], keep[at + 1 :], strict=True) if yes]
        best = best.parent
    return parts


def narrowed(best: Node) -> Node:
    """The container within the winner that has half of its sum at least, where what is beside it has no tags or is mostly links."""
    while True:
        kids = [k for k in best.kids if (length(k) if isinstance(k, str) else k.chars)]
        if not all(isinstance(k, Node) and container(k) for k in kids):
            return best
        built = [k for k in kids if k.tags and 2 * k.links <= k.chars]
        if len(built) != 1 or 2 * built[0].total < best.total:
            return best
        best = built[0]


def usual_block(best: Node, share: float) -> float:
    """The mean density of the children of a node that have text, headings left out."""
    dens = [density(length(k), 0, 0, 0, share) if isinstance(k, str) else k.dens for k in best.kids if isinstance(k, str) or k.tag not in HEADING]
    dens = [d for d in dens if d > 0]
    return sum(dens) / len(dens) if dens else 0.0


def belongs(x: Node | str, best: Node, threshold: float, usual: float, half: float, share: float) -> bool:
    """A block or run of text beside the text that is as dense and whose density sum is a usual block's at least (without
    tags: half the article's), or an article beside an article that isn't mostly links.
    """
    if isinstance(x, str):
        return (c := length(x)) > 0 and (d := density(c, 0, 0, 0, share)) >= threshold and d * NEARLY >= max(usual, half)
    if x.chars and x.tag == best.tag == "article" and 2 * x.links <= x.chars:
        return True
    if not x.chars or x.dens < threshold:
        return False
    return not container(x) or x.total * NEARLY >= (usual if x.tags else max(usual, half))


def text_of(node: Node | str) -> str:
    """The blocks of a subtree in page order: white space turned into one space, trimmed, joined by one space."""
    blocks, now = [], []
    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is None:
            blocks.append("".join(now))
            now = []
        elif isinstance(x, str):
            now.append(x)
        else:
            edge = x.tag in BLOCK
            if edge:
                todo.append(None)
            todo += reversed(x.kids)
            if edge:
                todo.append(None)
    blocks.append("".join(now))
    return " ".join(t for b in blocks if (t := " ".join(b.split())))


def main_text(page: str | None) -> str:
    return " ".join(t for x in main_nodes(parse(page)) if (t := text_of(x))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row."""

    def run(batches):
        for b in batches:
            text = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    p = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html"))
    return p.mapInArrow(run, "page_id long, url string, text string, n_chars long")
