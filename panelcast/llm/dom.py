"""Block trees of web pages, and simple tree matching between two of them.

A page becomes a tree of its block elements that hold text; inline elements
are part of their block's text. Neighbour siblings of one label and one shape
(the paragraphs of an article, the entries of a menu) are one node, so a tree
describes the layout and stays small on long pages. Its text form, the shape,
has one line per node in page order: depth and label. A label is the tag with
its class, id and role words (without digits), as ``div.ad.box@note``.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

#: Fixed values of HTML: elements inside a line of text, elements without an end,
#: elements whose content is no text of the page.
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q
    ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr br img""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = "script|style|title|noscript|textarea|iframe|template|svg|math|object|select|button|canvas|audio|video|xmp"
#: A start tag of the key ends an open element of the values.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
#: An open element that the search for one to end does not leave.
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
           "tbody": {"table"}}
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<skip>{_SKIPPED})(?=[\s/>])[^>]*>.*?(?:</(?P=skip)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "label", "children", "sid", "size", "index", "has_text")

    def __init__(self, tag: str, label: str):
        self.tag, self.label, self.children = tag, label, []
        self.sid, self.size, self.index, self.has_text = -1, 1, -1, False


def label_of(tag: str, attrs: str) -> str:
    words, roles = set(), set()
    for name, a, b, c in ATTRIBUTE.findall(attrs):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            words.update(_WORD.findall(_CAMEL.sub(" ", value).lower()))
        elif name == "role":
            roles.update(_WORD.findall(value.lower()))
        elif name == "hidden" or "display:none" in value.replace(" ", "").lower():
            roles.add("hidden")
    return "".join([tag, *(f".{w}" for w in sorted(words)), *(f"@{r}" for r in sorted(roles))])


class Page:
    """The block tree of one page: ``shape`` and ``items``, (node, text, characters in
    links) of every stretch of text in page order. White space is folded, ends trimmed."""

    def __init__(self, source: str):
        self._shapes: dict[tuple, int] = {}
        self._found: list[tuple[Node, str, int]] = []
        self._stack = [Node("", "")]
        self._text: list[str] = []
        self._link, self._linked = False, 0
        at = 0
        for m in TOKEN.finditer(source):
            if m.start() > at:
                self._words(source[at:m.start()])
            at = m.end()
            tag = m["tag"] or m["tag2"]
            if tag:
                self._tag(tag.lower(), bool(m["end"] or m["end2"]), m["attrs"] or m["attrs2"] or "")
        self._words(source[at:])
        self._flush()
        while len(self._stack) > 1:
            self._close()
        self._finish(self._stack[0])
        self.shape = self._number()
        self.items = [(node.index, text, linked) for node, text, linked in self._found]

    def _words(self, text: str) -> None:
        text = html.unescape(text) if "&" in text else text
        self._text.append(text)
        if self._link:
            self._linked += len("".join(text.split()))

    def _flush(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            self._stack[-1].has_text = True
            self._found.append((self._stack[-1], text, self._linked))
        self._text, self._linked = [], 0

    def _finish(self, node: Node) -> None:
        """Shape number of a closed node, from its label and its children's."""
        runs: list[int] = []
        size = 1
        for child in node.children:
            if not runs or runs[-1] != child.sid:
                runs.append(child.sid)
                size += child.size
        node.size = size
        node.sid = self._shapes.setdefault((node.label, *runs), len(self._shapes))

    def _close(self) -> None:
        node = self._stack.pop()
        if node.has_text:
            self._finish(node)
            self._stack[-1].children.append(node)
            self._stack[-1].has_text = True

    def _end(self, tags: set[str], scope: set[str]) -> None:
        """Close the innermost open element of ``tags``, and all inside it."""
        for k in range(len(self._stack) - 1, 0, -1):
            tag = self._stack[k].tag
            if tag in tags:
                self._flush()
                while len(self._stack) > k:
                    self._close()
                return
            if tag in scope:
                return

    def _tag(self, tag: str, end: bool, attrs: str) -> None:
        if tag in INLINE:
            if tag == "br":
                self._text.append(" ")
            elif tag == "a":
                self._link = not end
            return
        self._link = False
        if tag in VOID:
            self._flush()
        elif end:
            self._flush()
            self._end({tag}, set())
        else:
            self._flush()
            if self._stack[-1].tag == "p":
                self._close()
            while tag in _CLOSES and any(n.tag in _CLOSES[tag] for n in self._scope(_SCOPES.get(tag, set()))):
                self._end(_CLOSES[tag], _SCOPES.get(tag, set()))
            self._stack.append(Node(tag, label_of(tag, attrs) if attrs else tag))

    def _scope(self, scope: set[str]) -> Iterator[Node]:
        for node in reversed(self._stack):
            if node.tag in scope:
                return
            yield node

    def _number(self) -> str:
        """Give nodes their place in the shape, equal neighbours the same; the shape's text."""
        lines: dict[int, str] = {}
        todo = [(self._stack[0], 0, 0)]
        while todo:
            node, index, depth = todo.pop()
            node.index = index
            lines[index] = f"{depth} {node.label}"
            at, last = index + 1, None
            for child in node.children:
                if last is not None and child.sid != last.sid:
                    at += last.size
                todo.append((child, at, depth + 1))
                last = child
        return "\n".join(lines[k] for k in range(len(lines)))


class Shape:
    """Nodes of a shape's text: labels, words of the label, children, parents."""

    def __init__(self, text: str):
        rows = [line.split(" ", 1) for line in text.split("\n")]
        self.labels = [label for _, label in rows]
        self.tags = [re.split(r"[.@]", label, maxsplit=1)[0] for label in self.labels]
        self.parents, self.children = [], [[] for _ in rows]
        path: list[int] = []
        for k, (depth, _) in enumerate(rows):
            del path[int(depth):]
            self.parents.append(path[-1] if path else -1)
            if path:
                self.children[path[-1]].append(k)
            path.append(k)
        # One number per subtree, to align equal ones at once.
        self.prints = [0] * len(rows)
        for k in range(len(rows) - 1, -1, -1):
            self.prints[k] = hash((self.labels[k], *(self.prints[c] for c in self.children[k])))


def match(a: Shape, b: Shape) -> list[int]:
    """For every node of ``a`` the node of ``b`` it is aligned with, or -1, by simple tree
    matching: roots of one tag match, their children are aligned in order for the
    greatest number of matching nodes, of which equal labels count double. Equal subtrees
    at both ends of two child lists are aligned first; the rest costs the product of the lists."""
    memo: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def rows(x: int, y: int) -> tuple[int, list[tuple[int, int]]]:
        """(score, aligned children) of two nodes of one tag."""
        if (x, y) not in memo:
            memo[x, y] = align(x, y)
        return memo[x, y]

    def align(x: int, y: int) -> tuple[int, list[tuple[int, int]]]:
        left, right = a.children[x], b.children[y]
        own = 2 if a.labels[x] == b.labels[y] else 1
        head = 0
        while head < min(len(left), len(right)) and a.prints[left[head]] == b.prints[right[head]]:
            head += 1
        tail = 0
        while (tail < min(len(left), len(right)) - head
               and a.prints[left[-1 - tail]] == b.prints[right[-1 - tail]]):
            tail += 1
        sure = list(zip(left[:head], right[:head])) + list(zip(left[len(left) - tail:], right[len(right) - tail:]))
        left, right = left[head:len(left) - tail], right[head:len(right) - tail]
        best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for i, u in enumerate(left):
            for j, v in enumerate(right):
                pair = best[i][j] + rows(u, v)[0] if a.tags[u] == b.tags[v] else 0
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], pair)
        i, j, found = len(left), len(right), []
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append((left[i], right[j]))
        score = own + best[len(left)][len(right)] + sum(rows(u, v)[0] for u, v in sure)
        return score, sure + found

    out = [-1] * len(a.labels)
    todo = [(0, 0)]
    while todo:
        x, y = todo.pop()
        out[x] = y
        todo += rows(x, y)[1]
    return out
