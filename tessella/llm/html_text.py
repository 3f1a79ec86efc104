"""Main text of web pages by tree scoring.

Paragraphs give points for their length and commas to the containers above them, less with each level, and containers lose points in
proportion to their share of link text. The article around the best container is kept, or the container and its worthy siblings where
there is none, with the headings directly before them and without the parts that are never article text.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right

from pyspark.sql import DataFrame

from tessella.llm.common import add_columns, text_of

# Fixed values of HTML: elements without an end tag; elements whose content is no markup; elements that end a block of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noframes noembed".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hgroup hr html legend li main menu nav ol option optgroup p pre section select summary table tbody td tfoot th thead tr ul".split()
)
# Elements that are never article text, by name and by role.
DROPPED = frozenset("head nav footer aside form script style noscript template iframe textarea title button select option input dialog menu object embed svg canvas audio video map".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
# Class and id tokens that mark what is no article text; a compound does if any of its words is such, unless another word says
# that it is a state of something else: "comment-list" and "related-posts" do, "no-sidebar", "ad-free" and "comments-open" do not.
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar "
    "footer cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup login share sharing social related recommended "
    "comment comments disqus reply replies respond pagination pager toolbar widget masthead skip hidden".split()
)
STATES = frozenset("has have is no not non with without hide hides show shows free open closed enabled disabled allowed".split())
LIFTS = frozenset("article body content entry main page post story text blog".split())
# p ends before these; the others end before one of their own kind.
ENDS_P = BLOCK - frozenset("option optgroup".split())
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
MARKUP = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+|[^>]*+)>|<[!?/][^>]*+>")
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[A-Za-z]+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
COMMAS = re.compile("[,،、，]")


class Node:
    __slots__ = ("tag", "up", "parts", "marks", "gone", "doubt", "score", "chars", "linked", "commas", "headed")

    def __init__(self, tag: str, up: Node | None, marks: frozenset = frozenset(), gone: bool = False):
        self.tag, self.up, self.marks, self.gone = tag, up, marks, gone  # gone: dropped, or within a dropped element
        self.doubt = 0  # dropped for its class or id unless it holds most of the text; 2: all words of a token speak against it
        self.parts: list = []  # texts and nodes in page order
        self.score = 0.0
        self.chars = self.linked = self.commas = self.headed = 0  # of all text within; headed: characters in headings


def _named(token: list[str]) -> int:
    """1 if the words of a class or id token name what is no article text, 2 if all do."""
    if all(w in DROPPED_WORDS for w in token):
        return 2
    return int(any(w in DROPPED_WORDS for w in token) and not STATES.intersection(token))


def _marks(attributes: str) -> tuple[frozenset, bool, int]:
    """Words of class and id, whether the attributes hide the element, and how much a class or id speaks against it if none is for it."""
    words, gone, against, lifted = set(), False, 0, False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            for token in value.split():
                own = [w.lower() for w in WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", token))]
                words.update(own)
                against = max(against, _named(own) if own else 0)
                lifted |= len(own) == 1 and own[0] in LIFTS
        elif name == "role":
            gone |= value.strip().lower() in DROPPED_ROLES
        elif name == "hidden":
            gone = True
        elif name == "aria-hidden":
            gone |= value.strip().lower() == "true"
        elif name == "style":
            gone |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
    return frozenset(words), gone, 0 if lifted else against


class _Open:
    """The open elements, outermost first, with the depths of each tag, of block borders and of walls, so that nothing is walked."""

    def __init__(self, root: Node):
        self.path = [root]
        self.at: dict[str, list[int]] = {}
        self.borders: list[int] = []
        self.walls: list[int] = []  # an inline end tag does not reach past these

    def push(self, node: Node) -> None:
        depth = len(self.path)
        self.path.append(node)
        self.at.setdefault(node.tag, []).append(depth)
        if node.tag in BLOCK or node.tag in DROPPED:
            self.borders.append(depth)
        if node.tag in ("table", "td", "th") or (node.gone or node.doubt) and node.tag in BLOCK:
            self.walls.append(depth)

    def close(self, depth: int) -> None:
        """End the element at ``depth`` and all within."""
        while len(self.path) > depth:
            self.at[self.path.pop().tag].pop()
        for depths in (self.borders, self.walls):
            while depths and depths[-1] >= depth:
                depths.pop()

    def match(self, tag: str) -> int:
        """Depth of the element that an end tag ends; 0 if it ends none."""
        depth = (self.at.get(tag) or [0])[-1]
        return 0 if tag not in BLOCK and self.walls and self.walls[-1] > depth else depth

    def implied(self, closed: set, walls: set) -> int:
        """Depth of the outermost element of ``closed`` within the innermost of ``walls``; 0 if there is none."""
        wall = max((self.at[t][-1] for t in walls if self.at.get(t)), default=0)
        found = []
        for tag in closed:
            depths = self.at.get(tag, ())
            i = bisect_right(depths, wall)
            found += depths[i : i + 1]
        return min(found, default=0)


def parse(page: str) -> Node:
    """A forgiving tree of the page: unclosed and stray tags are mended. Dropped elements end by the same rules as others and leave
    at most an empty node where they break a block. Time is linear in the page, whatever is left open or closed too often."""
    root = Node("html", None)
    opened = _Open(root)
    path = opened.path
    at, head = 0, 0  # head: depth of the open head, which its own end or any start of content ends
    last = page.rfind(">") + 1  # no tag ends beyond
    for m in iter(lambda: MARKUP.search(page, at, last), None):
        if m.start() > at and not path[-1].gone:
            path[-1].parts.append(page[at : m.start()])
        at = m.end()
        if m[0] == "<!--":
            end = page.find("-->", at - 2 if page.startswith(("<!-->", "<!--->"), m.start()) else at)
            at = len(page) if end < 0 else end + 3
            continue
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in RAW and not closing:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if head and (tag == "body" or not closing and tag in BLOCK):
            opened.close(head)
            head = 0
        if closing:
            depth = opened.match(tag)
            if depth:
                opened.close(depth)
                if depth <= head:
                    head = 0
            elif tag == "p" and not path[-1].gone:
                path[-1].parts.append(Node("p", path[-1]))
            continue
        if tag in ("html", "body"):
            continue
        if tag in ENDS_P and opened.borders and path[opened.borders[-1]].tag == "p":
            opened.close(opened.borders[-1])
        if tag in ENDS:
            depth = opened.implied(*ENDS[tag])
            if depth:
                opened.close(depth)
        top = path[-1]
        if tag == "br":
            if not top.gone:
                top.parts.append(" ")
            continue
        marks, gone, against = _marks(m[3]) if m[3] and not m[3].isspace() else (frozenset(), False, 0)
        page_header = tag == "header" and not (opened.at.get("article") or opened.at.get("main"))
        gone = gone or tag in DROPPED or page_header
        node = Node(tag, top, marks, gone or top.gone)
        node.doubt = 0 if node.gone or tag in ("main", "h1") else against
        if not top.gone and (not gone or tag in BLOCK):
            top.parts.append(node)
        if tag not in VOID and not ((node.gone or node.doubt) and m[3].rstrip().endswith("/")):
            if tag == "head":
                head = len(path)
            opened.push(node)
    if at < len(page) and not path[-1].gone:
        path[-1].parts.append(page[at:].split("<!--", 1)[0])
    return root


def _chain(node: Node | None):
    while node is not None:
        yield node
        node = node.up


def _in_order(root: Node):
    """(node, leaving) in page order without recursion; texts as (text, None)."""
    stack: list = [(root, iter(root.parts))]
    yield root, False
    while stack:
        node, rest = stack[-1]
        for part in rest:
            if isinstance(part, str):
                yield part, None
            else:
                yield part, False
                stack.append((part, iter(part.parts)))
                break
        else:
            stack.pop()
            yield node, True


def blocks(root: Node) -> list[str]:
    """Texts between block borders, white space as one space, trimmed, empty ones left out."""
    out, held = [], []

    def close():
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            out.append(text)
        held.clear()

    for x, leaving in _in_order(root):
        if leaving is None:
            held.append(x)
        elif x.tag in BLOCK:
            close()
    close()
    return out


def _count(root: Node) -> None:
    """Characters and commas of text, and characters in links and headings, of all nodes."""
    links = headings = 0
    node = root
    for x, leaving in _in_order(root):
        if leaving is None:
            n = len(x) - x.count(" ")
            node.chars += n
            node.linked += n if links else 0
            node.headed += n if headings else 0
            node.commas += len(COMMAS.findall(x))
        elif not leaving:
            node = x
            links += x.tag == "a"
            headings += x.tag in HEADINGS
        else:
            links -= x.tag == "a"
            headings -= x.tag in HEADINGS
            if x.up is not None:
                x.up.chars += x.chars
                x.up.linked += x.linked
                x.up.headed += x.headed
                x.up.commas += x.commas
                node = x.up


def _settle(root: Node) -> None:
    """Empty the doubtful nodes. One that holds most of the unlinked text of the page stays, if no article or main lies outside it.
    One around it is no reason if the node has an article within, or its name is a compound and it holds nine tenths of that text."""
    doubtful, articles, seen = [], 0, {}
    around: list[Node] = []  # the open articles and mains
    for x, leaving in _in_order(root):
        if leaving is None:
            continue
        found = x.tag in ("article", "main") and x.chars > 0
        if leaving:
            if found:
                around.pop()
            if x.doubt:
                before, n, near = seen[id(x)]
                within = articles - before
                spared = within > 0 or x.doubt < 2 and (near is None or 10 * (x.chars - x.linked) >= 9 * (near.chars - near.linked))
                seen[id(x)] = within + (n if spared else 0)
        else:
            if x.doubt:
                doubtful.append(x)
                seen[id(x)] = (articles, len(around), around[-1] if around else None)
            if found:
                articles += 1
                around.append(x)
    for x in doubtful:
        if 2 * (x.chars - x.linked) <= root.chars - root.linked or seen[id(x)] < articles:
            x.parts = []
    if doubtful:
        for x, leaving in _in_order(root):
            if leaving is False:
                x.chars = x.linked = x.commas = x.headed = 0
        _count(root)


def main_text(page: str) -> str:
    root = parse(page)
    _count(root)
    _settle(root)
    candidates: dict[int, Node] = {}
    for x, leaving in _in_order(root):
        if leaving is False and x.chars and (x.tag in ("p", "pre", "blockquote", "td", "li", "dd") or _text_div(x)):
            points = 1 + x.commas + min(x.chars / 100, 3)
            points *= 1 - x.linked / x.chars
            level = 0
            for up in _chain(x.up if x.tag == "p" or x.up is not None else x):
                share = 1 if level == 0 else 1 / 2 if level == 1 else 1 / (3 * level)
                if id(up) not in candidates:
                    candidates[id(up)] = up
                    up.score += {"div": 5, "article": 30, "main": 25, "section": 3, "td": 3, "pre": 3, "blockquote": 3}.get(up.tag, 0)
                    up.score += 25 if up.marks & LIFTS else 0
                up.score += points * share
                level += 1
                if level > 4:
                    break
    if not candidates:
        best = next((x for t in ("article", "main") for x, k in _in_order(root) if k is False and x.tag == t and x.chars), root)
        return "\n".join(blocks(best))
    for x in candidates.values():
        x.score *= 1 - x.linked / max(x.chars, 1)
    best = max(candidates.values(), key=lambda x: x.score)  # of equals the first in page order
    whole = _whole(best)
    if whole.up is None:
        return "\n".join(blocks(whole))
    keep = Node("div", None)
    kept, before = [], False  # before: the siblings still to come stand before the text
    follows = False  # whether the next sibling with text is kept
    for s in reversed(whole.up.parts):
        if s is whole:
            kept.append(s)
            before = follows = True
        elif isinstance(s, Node) and s.chars:
            density = s.linked / s.chars
            title = density < 0.25 and (s.tag in ("header", "hgroup") or s.headed > 0.9 * s.chars)
            if title:
                follows = follows or before and s.tag in ("h1", "header", "hgroup")
            elif whole.tag in ("article", "main"):
                follows = False
            else:
                worthy = s.score >= max(10.0, 0.2 * best.score) and density < 0.5
                follows = worthy or s.tag == "p" and s.chars > 80 and density < 0.25
            if follows:
                kept.append(s)
        elif isinstance(s, str) and not s.isspace():
            follows = False
    keep.parts = kept[::-1]
    return "\n".join(blocks(keep))


def _whole(best: Node) -> Node:
    """The nearest article around the best container, or else the nearest main; without either the highest element, reached step by
    step, to which each level below the page adds text that is mostly no links. All blocks of it are kept."""
    for tag in ("article", "main"):
        found = next((x for x in _chain(best) if x.tag == tag), None)
        if found is not None:
            return found
    for up in _chain(best.up):
        chars, linked = up.chars - best.chars, up.linked - best.linked
        if up.up is None or chars and linked >= 0.25 * chars:
            break
        best = up
    return best


def _text_div(x: Node) -> bool:
    """A div or section with text of its own and no block inside it is a paragraph."""
    return x.tag in ("div", "section", "article", "main") and any(isinstance(p, str) and not p.isspace() for p in x.parts)


def extract(pages: DataFrame, markup: str = "html") -> DataFrame:
    """``pages`` with ``main_text``: the blocks of the article in page order, joined by newlines; empty if there are none.

    Each whole page is handled alone (no shuffle), in time linear in its length; null pages count as empty, text without markup is one
    block. Of equal containers the first in page order wins; repeated rows give repeated results. Other columns pass through; one
    that is called ``main_text`` is replaced.
    """
    return add_columns(pages, [text_of(pages, markup)], "main_text string", lambda ps: [[main_text(p) for p in ps]], batch_rows=1000)
