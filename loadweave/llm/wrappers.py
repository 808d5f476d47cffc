"""Main text of web pages by wrapper induction.

Pages of one host share a template. Per host, the page structure that occurs most gives a reference tree. Every page is
aligned with it by simple tree matching (nodes with equal labels match, children in order, so that most nodes
match). For each node of the reference, Spark counts on how many of the host's different pages (by their texts; exact
copies count once) each text stands there: a node with the same text on nearly all of them is template, the others
are slots. The host's content is the smallest node of the reference that holds ``CONTENT`` of the varying text of all its pages,
without leaving a text element, a varying title or an article beside it behind. A page's text is what varies in the
node aligned with that one; names and tags only settle what varies there and is no article: article or main elements
are taken alone, and elements that say what they are (menus, headers, footers, sidebars, notices, adverts, forms, comments) are
left out. For hosts with fewer than ``PAGES`` different pages, which show no template, nothing else is known. Elements say
it by their tag, a class or role name that is made of such words only, or outside articles an id. A menu, header, sidebar or
form that holds most of the page's varying text is taken for its frame and stays; comments, notices and adverts never do.

Blocks are runs of inline text between block elements; references are decoded, white space becomes one space.

The html is never shuffled unless the table of wrappers outgrows the planner's broadcast limit (the wrappers are written
first, so their size is known). Copies of a page combine before the first shuffle, which sends a page's slots as one row
under host and page, and counts before the second, so a host with a third of all pages sends each task's partial counts only.

Defined results: null and empty pages have an empty text; a page without body text too; pages without host form a group
of their own; repeated rows are extracted each. Empty tables give no rows. Only id, URL and html are read.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from itertools import chain
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import host_of, kept_at, scratch, whole

#: A node is template if this share of all different pages of the host, of which there are at least so many, has one text there.
CONSTANT, PAGES = 0.9, 8
#: Share of a host's varying text in the node that is its content.
CONTENT = 0.9
#: Share of a page's varying text that it must have at the host's content slot; else all of it is taken.
OWN = 0.25
#: Nodes below this depth are not aligned; they count as varying.
DEPTH = 100
#: Pairs of children that are compared one by one; more are compared on arrays, to the same end.
CELLS = 4_096

#: Fixed names of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript template iframe".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "head script style noscript template iframe object svg math canvas audio video nav footer aside form button select"
    " textarea input fieldset dialog menu title link meta".split()
)
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"),
    "tfoot": ("tbody", "tr", "td", "th"),
}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",)}

#: Words in class, id or role that say an element is not the article.
ROLE_NAMES = frozenset(
    "nav navbar navigation menu submenu header masthead banner topbar footer bottombar sidebar aside rail complementary"
    " contentinfo search notice notices cookie cookies consent gdpr alert warning popup modal overlay toast disclaimer ad ads"
    " adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion form login signup subscribe"
    " newsletter comment comments commentlist reply replies respond discussion disqus feedback share sharing social"
    " breadcrumb breadcrumbs related recommended recommendations widget pagination pager skip hidden".split()
)

#: Those of them that hold for an article element, too: a comment or a teaser marked up as an article.
ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement comment comments reply replies related recommended sponsored promo promoted"
    " widget".split()
)

#: Those of them that can stand for the frame of a page; all others never name what a page is about.
FRAME_NAMES = frozenset(
    "nav navbar navigation menu header masthead banner topbar sidebar aside rail search form popup modal overlay widget share"
    " sharing social hidden main".split()
)

#: Words that stand beside them in one name (``site-nav``, ``comment-list``) without changing what it says.
FILLERS = frozenset(
    "site page main top bottom left right upper lower inner outer global primary secondary container wrapper wrap box bar block"
    " area section list item items group panel slot unit button buttons link links icon icons posts articles stories fixed"
    " sticky x user users reader readers visitor visitors guest guests community thread threads feed count counter total new all"
    " recent latest wide full mobile desktop".split()
)
#: Words of the names of a main element.
MAIN_NAMES = frozenset("main content site page area column body container wrapper wrap text region".split())
#: Elements that can be frames of the whole page; ids of headings and sections are made of their titles.
FRAMES, TITLED = frozenset("form fieldset header".split()), frozenset("h1 h2 h3 h4 h5 h6 section".split())
#: Elements that an article's text consists of: what stands beside one of them belongs to the same text.
TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 p ul ol dl li dt dd pre blockquote figure figcaption table thead tbody tfoot tr td th".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^<>]*+>", re.S
)
_ATTRIBUTES = re.compile(r"([^\s\"'<>/=]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PARTS = re.compile(r"[a-z]+")


class Node:
    """A block element: its label, and its content in order (runs of inline text and block children).

    ``parts`` are the words of its class and role names that say what it is, ``id_parts`` those of its id.
    """

    __slots__ = ("tag", "label", "parts", "id_parts", "content", "_blocks")

    def __init__(
        self, tag: str, label: str = "", parts: frozenset[str] = frozenset(), id_parts: frozenset[str] = frozenset(),
    ):
        self.tag, self.label, self.parts, self.id_parts = tag, label or tag, parts, id_parts
        self.content: list[str | Node] = []
        self._blocks: list[str] | None = None

    def children(self) -> list[Node]:
        return [c for c in self.content if not isinstance(c, str)]

    def blocks(self) -> list[str]:
        """The texts of this element's own inline runs; to be asked for once the tree is complete."""
        if self._blocks is None:
            self._blocks = [t for t in (" ".join(unescape(c).split()) for c in self.content if isinstance(c, str)) if t]
        return self._blocks

    def add_text(self, text: str) -> None:
        if self.content and isinstance(self.content[-1], str):
            self.content[-1] += text
        else:
            self.content.append(text)


@lru_cache(100_000)
def _said(name: str) -> frozenset[str]:
    """What a whole name says: its words, if all of them are known and one tells the element's role; else nothing."""
    words = frozenset(_PARTS.findall(name))
    if "main" in words and words <= MAIN_NAMES:
        return frozenset(["main"])
    said = words & ROLE_NAMES
    return said if words <= ROLE_NAMES | FILLERS else frozenset()


def _element(tag: str, attributes: str) -> Node:
    label, parts, id_parts = [tag], set(), set()
    for name, *values in _ATTRIBUTES.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            parts.add("hidden")
        elif name in ("class", "id", "role"):
            for one in value.split():
                (id_parts if name == "id" else parts).update(_said(one))
            label.append(re.sub(r"\d+", "", value))
    return Node(tag, ".".join(label), frozenset(parts), frozenset(id_parts))


def parse(html: str) -> Node:
    """The tree of a page's block elements. Anything can be parsed; what is never closed ends with its parent."""
    root = Node("root")
    stack, at, lower = [root], 0, None  # open block elements
    while True:
        found = _TOKEN.search(html, at)
        text = html[at: found.start() if found else len(html)]
        if text:
            stack[-1].add_text(text)
        if not found:
            return root
        at = found.end()
        closing, tag, attributes = found[1], found[2], found[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW and not closing:
            if not attributes.endswith("/"):
                lower = html.lower() if lower is None else lower
                end = lower.find(f"</{tag}", at) if len(lower) == len(html) else _raw_end(html, tag, at)
                at = len(html) if end < 0 else (html.find(">", end) + 1 or len(html))
            stack[-1].add_text(" ")
            continue
        if tag in INLINE:
            if tag == "br":
                stack[-1].add_text(" ")
            continue
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        _close_implied(stack, tag)
        node = _element(tag, attributes)
        stack[-1].content.append(node)
        if tag not in VOID and not attributes.endswith("/"):
            stack.append(node)


def _raw_end(html: str, tag: str, at: int) -> int:
    found = re.compile(f"</{tag}", re.I).search(html, at)
    return found.start() if found else -1


def _close_implied(stack: list[Node], tag: str) -> None:
    """End the elements that the start of another one ends: an open paragraph, a list item, a cell."""
    if stack[-1].tag == "p":
        stack.pop()
    closes, scope = CLOSES.get(tag, ()), SCOPES.get(tag, ("table",))
    for k in range(len(stack) - 1, 0, -1) if closes else ():
        if stack[k].tag in closes:
            del stack[k:]
            return
        if stack[k].tag in scope:
            return


# --- alignment ---


def skeleton(node: Node, depth: int = 3) -> list:
    """Labels of the upper levels, equal neighbours once: pages of one template agree on it."""
    kids = []
    for child in node.children() if depth else ():
        one = skeleton(child, depth - 1)
        if not kids or kids[-1] != one:
            kids.append(one)
    return [node.label, kids]


def own_text(node: Node) -> int:
    """A hash of the element's own blocks; 0 without any."""
    text = "\n".join(node.blocks())
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) if text else 0


def numbered(node: Node) -> list:
    """The reference tree as plain lists: label, slot (its place in page order), children, own text."""
    out: list = [node.label, 0, [], own_text(node)]
    todo, slot = [(node, out)], 0
    while todo:
        one, made = todo.pop()
        made[1] = slot
        slot += 1
        pairs = [(c, [c.label, 0, [], own_text(c)]) for c in one.children()]
        made[2] = [m for _, m in pairs]
        todo.extend(reversed(pairs))
    return out


def _shapes(page: Node, reference: list) -> tuple[dict[int, tuple], dict[int, tuple]]:
    """For each node of both trees (by identity, and by slot): what the labels of all below and with it make (equal numbers
    for equal subtrees of labels), its height and the own texts of the subtree in page order (none where it is too high to be
    aligned whole)."""
    known: dict[tuple, int] = {}

    def told(label: str, text: int, below: list[tuple]) -> tuple:
        shape = known.setdefault((label, *(b[0] for b in below)), len(known))
        height = 1 + max((b[1] for b in below), default=0)
        return shape, height, [text, *chain.from_iterable(b[2] for b in below)] if height <= DEPTH else []

    order, mine = [page], {}
    for node in order:
        order.extend(node.children())
    for node in reversed(order):
        mine[id(node)] = told(node.label, own_text(node), [mine[id(c)] for c in node.children()])
    listed, theirs = [reference], {}
    for node in listed:
        listed.extend(node[2])
    for node in reversed(listed):
        theirs[node[1]] = told(node[0], node[3], [theirs[c[1]] for c in node[2]])
    return mine, theirs


def _anchors(xs: list[Node], ys: list) -> list[tuple[int, int]]:
    """Places of nodes whose label and text occur once on either side, as many as keep their order."""
    def once(keys: list) -> dict:
        places: dict = {}
        for k, key in enumerate(keys):
            places[key] = -1 if key in places else k
        return places

    mine, theirs = once([(x.label, own_text(x)) for x in xs]), once([(y[0], y[3]) for y in ys])
    pairs = [(i, theirs[key]) for key, i in mine.items() if i >= 0 and theirs.get(key, -1) >= 0]
    # The longest rising run of places: ends[k] is the smallest last place of a run of k + 1.
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(ends, j)
        before.append(last[k - 1] if k else -1)
        if k == len(ends):
            ends.append(j)
            last.append(n)
        else:
            ends[k], last[k] = j, n
    run, n = [], last[-1] if last else -1
    while n >= 0:
        run.append(pairs[n])
        n = before[n]
    return run[::-1]


def align(page: Node, reference: list, depth: int = DEPTH) -> dict[int, int]:
    """Slots of the page's nodes (by identity) under the matching with most nodes, and of those with most equal texts.

    Long lists of children are matched row by row on arrays, of which only every so manieth row is kept and the others are
    found again on the way back; what is below two of their elements is matched without being remembered, and again for
    those that belong together. So memory does not grow with the pairs, and all lists have the same, best matching.
    """
    found: dict[tuple[int, int], tuple[int, list]] = {}
    many = 1 << 32  # a node outweighs all equal texts
    shapes: list[tuple[dict, dict]] = []

    def match(a: Node, b: list, left: int) -> int:
        """Weight of the best matching of what is below two nodes with equal labels."""
        key = id(a), b[1]
        if key not in found:
            found[key] = _children(a.children(), b[2], left) if left else (0, [])
        return found[key][0]

    def _children(xs: list[Node], ys: list, left: int) -> tuple[int, list]:
        pairs = []
        low, high_x, high_y = 0, len(xs), len(ys)

        def alike(i: int, j: int) -> bool:
            return xs[i].label == ys[j][0] and own_text(xs[i]) == ys[j][3] and not ys[j][2] and not xs[i].children()

        # Childless nodes with equal labels and texts at either end belong together in some best matching.
        while low < min(high_x, high_y) and alike(low, low):
            pairs.append((xs[low], ys[low]))
            low += 1
        while low < min(high_x, high_y) and alike(high_x - 1, high_y - 1):
            high_x, high_y = high_x - 1, high_y - 1
            pairs.append((xs[high_x], ys[high_y]))
        total = len(pairs) * (many + 1)
        best = _best if (high_x - low) * (high_y - low) <= CELLS else _best_of_long
        weight, rest = best(xs[low:high_x], ys[low:high_y], left)
        return total + weight, pairs + rest

    def _best(xs: list[Node], ys: list, left: int) -> tuple[int, list]:
        pairs, texts = [], [own_text(x) for x in xs]
        best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        gain: dict[tuple[int, int], int] = {}
        for i, x in enumerate(xs):
            row, above, leaf = best[i + 1], best[i], not x.children()
            for j, y in enumerate(ys):
                value = max(above[j + 1], row[j])
                if x.label == y[0]:
                    gain[i, j] = own = many + (texts[i] == y[3]) + (0 if leaf or not y[2] else match(x, y, left - 1))
                    value = max(value, above[j] + own)
                row[j + 1] = value
        i, j = len(xs), len(ys)
        while i and j:
            if (i - 1, j - 1) in gain and best[i][j] == best[i - 1][j - 1] + gain[i - 1, j - 1]:
                i, j = i - 1, j - 1
                pairs.append((xs[i], ys[j]))
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
        return best[-1][-1], pairs

    def _best_of_long(xs: list[Node], ys: list, left: int) -> tuple[int, list]:
        """The same matching by the same rules."""
        if not shapes:
            shapes.append(_shapes(page, reference))
        mine, theirs = shapes[0]
        texts = np.array([y[3] for y in ys], np.int64)
        labelled = {label: np.array([y[0] == label for y in ys]) for label in {x.label for x in xs}}
        parents = np.array([bool(y[2]) for y in ys])
        of_shape: dict[int, list[int]] = {}
        for j, y in enumerate(ys):
            if y[2]:
                of_shape.setdefault(theirs[y[1]][0], []).append(j)
        subtrees = {shape: (np.array(js), np.array([theirs[ys[j][1]][2] for j in js], np.int64))
                    for shape, js in of_shape.items()}

        def gains(i: int) -> np.ndarray:
            """What matching a child with each of the others adds; 0 where labels differ."""
            x = xs[i]
            own = np.where(labelled[x.label], many + (texts == own_text(x)), 0)
            if not x.children():
                return own
            todo = labelled[x.label] & parents
            shape, height, all_texts = mine[id(x)]
            if shape in subtrees and height <= left:
                # Under equal labels all nodes match, each with the one in its place.
                js, theirs_all = subtrees[shape]
                own[js] = len(all_texts) * many + (theirs_all == np.array(all_texts, np.int64)).sum(axis=1)
                todo[js] = False
            for j in np.flatnonzero(todo):
                kept = len(found)
                own[j] += match(x, ys[j], left - 1)
                while len(found) > kept:
                    found.popitem()
            return own

        def after(above: np.ndarray, own: np.ndarray) -> np.ndarray:
            row = np.zeros(len(ys) + 1, np.int64)
            np.maximum.accumulate(np.maximum(above[1:], above[:-1] + own), out=row[1:])
            return row

        step = isqrt(len(xs)) + 1
        row, stored = np.zeros(len(ys) + 1, np.int64), []
        for i in range(len(xs)):
            if i % step == 0:
                stored.append(row)
            row = after(row, gains(i))
        weight, pairs, i, j = int(row[-1]), [], len(xs), len(ys)
        while i and j:
            first = (i - 1) // step * step
            own = [gains(k) for k in range(first, i)]
            rows = [stored[first // step]]
            for one in own:
                rows.append(after(rows[-1], one))
            while i > first and j:
                here, above, gain = rows[i - first], rows[i - first - 1], own[i - first - 1][j - 1]
                if gain and here[j] == above[j - 1] + gain:
                    i, j = i - 1, j - 1
                    pairs.append((xs[i], ys[j]))
                elif here[j] == above[j]:
                    i -= 1
                else:
                    j -= 1
        return weight, pairs

    slots: dict[int, int] = {}
    todo = [(page, reference, depth)]
    while todo:
        a, b, left = todo.pop()
        slots[id(a)] = b[1]
        match(a, b, left)
        todo.extend((x, y, left - 1) for x, y in found.pop((id(a), b[1]))[1])
    return slots


# --- extraction ---


def _is_template(node: Node, constant: dict[int, int], slots: dict[int, int]) -> bool:
    """Whether a node stands in a constant slot with that slot's text; another text there is the page's own."""
    slot = slots.get(id(node))
    return slot in constant and own_text(node) == constant[slot]


def _is_article(node: Node) -> bool:
    return node.tag == "main" or node.tag == "article" and ASIDE_NAMES.isdisjoint(node.parts | node.id_parts)


def holders(root: Node, constant: dict[int, int], slots: dict[int, int]) -> dict[int, bool]:
    """The elements (by identity) that hold most of the page's varying text, and whether all its articles are in them."""
    order, up = [root], {id(root): None}
    for node in order:
        for child in node.children():
            if child.tag not in DROPPED or child.tag in FRAMES:
                up[id(child)] = id(node)
                order.append(child)
    weight, articles = dict.fromkeys(up, 0), dict.fromkeys(up, 0)
    for node in reversed(order):
        own, above = id(node), up[id(node)]
        weight[own] += 0 if _is_template(node, constant, slots) else sum(map(len, node.blocks()))
        articles[own] += _is_article(node)
        if above is not None:
            weight[above] += weight[own]
            articles[above] += articles[own]
    total, every = weight[id(root)], articles[id(root)]
    return {own: articles[own] == every for own, w in weight.items() if 2 * w > total}


def dropped(node: Node, in_article: bool, most: dict[int, bool]) -> bool:
    """Whether an element says itself that it is no part of the article. ``most`` are the holders of the page's text."""
    if node.tag in DROPPED and node.tag not in FRAMES:
        return True
    parts = node.parts if in_article or node.tag in TITLED else node.parts | node.id_parts
    is_frame = node.tag in DROPPED or (node.tag == "header" and not in_article)
    if node.tag in ("root", "html", "body", "main") or not is_frame and ROLE_NAMES.isdisjoint(parts):
        return False
    if node.tag == "article":
        return not ASIDE_NAMES.isdisjoint(parts)
    # An element that holds most of a page's text can be the frame around it, unless the articles are elsewhere or it says
    # that it is something else: comments and notices stay out however long they are.
    said = parts & ROLE_NAMES
    if id(node) in most and (ASIDE_NAMES.isdisjoint(parts) if in_article else most[id(node)] and said <= FRAME_NAMES):
        return False
    if is_frame:
        return True
    # A frame around the article is named after what it has besides (``layout with sidebar``).
    todo = node.children()
    while todo:
        one = todo.pop()
        if _is_article(one):
            return False
        todo.extend(one.children())
    return True


def kept_blocks(
    node: Node, constant: dict[int, int], slots: dict[int, int], most: dict[int, bool], in_article: bool = False,
) -> list[str]:
    """Blocks below a node in page order, without what is dropped or template."""
    out: list[str] = []
    todo: list[tuple[Node | str, bool]] = [(node, in_article)]
    while todo:
        one, inside = todo.pop()
        if isinstance(one, str):
            text = " ".join(unescape(one).split())
            if text:
                out.append(text)
            continue
        if one is not node and dropped(one, inside, most):
            continue
        inside = inside or one.tag in ("article", "main")
        template = _is_template(one, constant, slots)
        todo.extend((c, inside) for c in reversed(one.content) if not (template and isinstance(c, str)))
    return out


def main_regions(root: Node, constant: dict[int, int], slots: dict[int, int], most: dict[int, bool]) -> list[Node]:
    """Article elements, else main elements, else the whole page, of which template and dropped elements are left out later."""
    for wanted in (("article",), ("main",)):
        found, todo = [], [root]
        while todo:
            one = todo.pop()
            if one is not root and dropped(one, False, most):
                continue
            is_main = one.tag in wanted or ("main" in wanted and "main" in one.parts | one.id_parts and one.tag != "body")
            if is_main and kept_blocks(one, constant, slots, most, True):
                found.append(one)
            else:
                todo.extend(reversed(one.children()))
        if found:
            return found
    # The smallest container with all that is kept has the same blocks as the root.
    return [root]


def content_slot(tree: list, weights: dict[int, int]) -> int:
    """The slot of a host's content, by the characters of varying text at each slot (or below it in nodes without a slot)."""
    order = [tree]
    for node in order:
        order.extend(node[2])
    total: dict[int, int] = {}
    titled: dict[int, bool] = {}  # with an article or a varying title at or below it
    for label, slot, children, _ in reversed(order):
        tag = label.split(".")[0]
        total[slot] = weights.get(slot, 0) + sum(total[c[1]] for c in children)
        titled[slot] = any(titled[c[1]] for c in children) or total[slot] > 0 and tag in ("h1", "article", "main")
    node, every = tree, total[tree[1]]
    while every and node[0].split(".")[0] not in ("article", "main"):
        most = max(node[2], key=lambda c: total[c[1]], default=None)
        if most is None or total[most[1]] < CONTENT * every or most[0].split(".")[0] in TEXTUAL:
            break
        beside = [c for c in node[2] if c is not most and total[c[1]]]
        if any(titled[c[1]] or c[0].split(".")[0] in TEXTUAL for c in beside):
            break
        node = most
    return node[1]


def _at_slot(root: Node, slot: int, slots: dict[int, int]) -> Node:
    """The page's node at a slot; the whole page if there is none."""
    todo = [root]
    while todo:
        one = todo.pop()
        if slots.get(id(one)) == slot:
            return one
        todo.extend(one.children())
    return root


def main_text(html: str, wrapper: dict | None) -> str:
    root = parse(html)
    slots = align(root, wrapper["tree"]) if wrapper and wrapper["constant"] else {}
    constant = wrapper["constant"] if wrapper else {}
    most = holders(root, constant, slots)
    def blocks_of(region: Node) -> list[str]:
        inside = region.tag in ("article", "main") or "main" in region.parts | region.id_parts
        return kept_blocks(region, constant, slots, most, inside)

    regions = main_regions(root, constant, slots, most)
    blocks = [b for r in regions for b in blocks_of(r)]
    if wrapper and wrapper["content"] and regions == [root]:
        # No element says that it is the article, so the host's content slot does, unless this page has its text elsewhere.
        own = blocks_of(_at_slot(root, wrapper["content"], slots or align(root, wrapper["tree"])))
        if sum(map(len, own)) >= OWN * sum(map(len, blocks)):
            blocks = own
    return "\n".join(blocks)


# --- jobs ---


def _packed(tree: list) -> bytes:
    return zlib.compress(json.dumps(tree, separators=(",", ":")).encode())


def _unpacked(tree: bytes) -> list:
    return json.loads(zlib.decompress(tree))


def wrapper_of(packed: bytes, constant: list[int], weights: list[dict]) -> dict:
    """A wrapper to extract by: the tree, the text of each constant slot, and the slot of the content (0: the whole page)."""
    tree = _unpacked(packed)
    return {
        "tree": tree, "constant": {c >> 32: c & 0xFFFFFFFF for c in constant},
        "content": content_slot(tree, {w["slot"]: w["chars"] for w in weights}),
    }


def skeletons(pages: DataFrame) -> DataFrame:
    """page_id, host, shape (a hash of the skeleton)."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = [zlib.crc32(json.dumps(skeleton(parse(h.as_py()))).encode()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shapes, pa.int64())], names=["page_id", "host", "shape"]
            )

    return pages.select("page_id", "host", "html").mapInArrow(look, "page_id long, host string, shape long")


def references(pages: DataFrame, path: str) -> DataFrame:
    """host and tree of the page with the smallest id among those with the host's most frequent shape."""
    shapes = kept_at(skeletons(pages), f"{path}/shapes")
    per_shape = shapes.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("page_id"))
    best = per_shape.groupBy("host").agg(F.max_by("page_id", F.struct("n", "shape")).alias("page_id"))
    best = kept_at(best.where("page_id IS NOT NULL"), f"{path}/chosen")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = [_packed(numbered(parse(h.as_py()))) for h in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees, pa.binary())], names=["host", "tree"])

    chosen = pages.select("page_id", "host", "html").join(best, ["page_id", "host"], "left_semi").select("host", "html")
    trees = chosen.mapInArrow(build, "host string, tree binary")
    return kept_at(trees.groupBy("host").agg(F.min("tree").alias("tree")), f"{path}/references")


def _page_texts(root: Node, found: dict[int, int]) -> tuple[int, list[tuple[int, int]]]:
    """A hash of all texts of a page, and (code, chars) of its nodes with text: slot * 2^32 + text (hash), and how long it is.

    Text in nodes without a slot counts at the slot of the node above, with 0 for its hash. Elements that say they are no
    article have no length, so that what is long there does not make them the content.
    """
    import xxhash

    name, codes = xxhash.xxh3_64(), []
    below: dict[int, int] = {}
    most = holders(root, {}, found)
    todo = [(root, found.get(id(root), 0), False, False)]
    while todo:
        node, above, in_article, out = todo.pop()
        out = out or node is not root and dropped(node, in_article, most)
        in_article = in_article or node.tag in ("article", "main")
        slot = found.get(id(node))
        text = own_text(node)
        if text:
            name.update(text.to_bytes(4, "little"))
            chars = 0 if out else sum(map(len, node.blocks()))
            if slot is None:
                below[above] = below.get(above, 0) + chars
            else:
                codes.append((slot << 32 | text, chars))
        above = above if slot is None else slot
        todo.extend((c, above, in_article, out) for c in reversed(node.children()))
    return name.intdigest() - (1 << 63), sorted([*codes, *((slot << 32, chars) for slot, chars in below.items() if chars)])


def slot_texts(pages: DataFrame, refs: DataFrame) -> DataFrame:
    """host, page (hash of all its texts), own: code and chars of its texts (``_page_texts``); a row a page."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, list] = {}
        for batch in batches:
            names, owns = [], []
            for host, html, tree in zip(*(batch.column(i) for i in range(3))):
                host = host.as_py()
                if host not in trees:
                    if len(trees) >= 1_000:
                        trees.clear()
                    trees[host] = _unpacked(tree.as_py())
                root = parse(html.as_py())
                name, own = _page_texts(root, align(root, trees[host]))
                names.append(name)
                owns.append([{"code": code, "chars": chars} for code, chars in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.int64()), pa.array(owns, pa.list_(coded))],
                names=["host", "page", "own"],
            )

    coded = pa.struct([("code", pa.int64()), ("chars", pa.int64())])
    joined = pages.join(refs, "host").select("host", "html", "tree")
    return joined.mapInArrow(look, "host string, page long, own array<struct<code: long, chars: long>>")


def induce(pages: DataFrame, path: str) -> DataFrame:
    """The wrappers: host, tree, constant (slot * 2^32 + text of the slots that are template), weights (varying chars by slot).

    Hosts with few different pages have neither constants nor weights.
    """
    refs = references(pages, path)
    # Pages with equal texts count once; where their marks differ, so that they align otherwise, one of them stands for all.
    once = kept_at(slot_texts(pages, refs).groupBy("host", "page").agg(F.min("own").alias("own")), f"{path}/texts")
    different = once.groupBy("host").agg(F.count(F.lit(1)).alias("different")).where(F.col("different") >= PAGES)
    counted = once.select("host", F.explode("own").alias("own")).groupBy("host", F.col("own.code").alias("code")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("own.chars").alias("chars")
    )
    # A slot's most frequent text is enough to judge it, and combines before the shuffle.
    often = F.when(F.col("code") % (1 << 32) != 0, F.struct("n", "code", "chars"))
    per_slot = counted.groupBy("host", F.shiftright("code", 32).alias("slot")).agg(
        F.max(often).alias("top"), F.sum("chars").alias("chars")
    )
    is_fixed = F.coalesce(F.col("top.n") >= CONSTANT * F.col("different"), F.lit(False))
    per_slot = per_slot.join(different, "host").select(
        "host", "slot", F.when(is_fixed, F.col("top.code")).alias("fixed"),
        (F.col("chars") - F.when(is_fixed, F.col("top.chars")).otherwise(0)).alias("chars"),
    )
    # At most one text of a slot is on nearly all pages, and a host has as many slots as its reference has nodes.
    slots = per_slot.groupBy("host").agg(
        F.sort_array(F.collect_list("fixed")).alias("constant"),
        F.sort_array(F.collect_list(F.when(F.col("chars") > 0, F.struct("slot", "chars")))).alias("weights"),
    )
    wrappers = refs.join(slots, "host", "left").select(
        "host", "tree", F.coalesce("constant", F.array().cast("array<long>")).alias("constant"),
        F.coalesce("weights", F.array().cast("array<struct<slot: long, chars: long>>")).alias("weights"),
    )
    return kept_at(wrappers, f"{path}/wrappers")


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict | None] = {}
        for batch in batches:
            texts = []
            for host, html, tree, constant, weights in zip(*(batch.column(i) for i in (2, 3, 4, 5, 6))):
                host = host.as_py()
                if host not in known:
                    if len(known) >= 1_000:
                        known.clear()
                    known[host] = wrapper_of(tree.as_py(), constant.as_py(), weights.as_py()) if tree.is_valid else None
                texts.append(main_text(html.as_py(), known[host]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        host_of(F.col(url_col)).alias("host"), whole(html_col).alias("html"),
    )
    wrappers = induce(rows, scratch(pages.sparkSession, "wrappers"))
    joined = rows.join(wrappers, "host", "left").select("page_id", "url", "host", "html", "tree", "constant", "weights")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
