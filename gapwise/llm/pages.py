"""Text of web pages as a reader sees it: a tree with implied tags, visibility rules, layout.

A page's tags are read into a tree first. Tags that HTML lets authors leave out are implied: a
block ends an open paragraph, an item ends the item before it, a cell or row ends the one
before it, and so on. Subtrees that no reader sees are left out: scripts, styles, the head,
templates, ``hidden`` and ``display:none``, ``visibility:hidden`` but for what is made visible
within, and what a closed ``<details>`` folds away. What remains is written with its layout: paragraphs and headings
stand apart by an empty line, other blocks begin a line, items are marked and indented,
preformatted text keeps its blanks, and the cells of a table are padded to columns.

Walking and writing use lists, not recursion, so nesting may be as deep as it likes. Work on a
page grows with its length; Spark spreads the pages. Defined results: null and empty pages give
an empty text; broken markup is read as far as it goes, and a ``<`` that begins no tag is text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*+"|'[^']*+'|[^>"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<[!?/][^>]*+>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
VISIBILITY = re.compile(r"(?:^|;)visibility:([a-z]+)")
BLANK = re.compile(r"[ \t\n\r\f]+")

#: Fixed names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = set(
    "script style head title template noscript datalist iframe noembed noframes object audio video canvas "
    "desc metadata defs symbol clippath mask marker pattern annotation annotation-xml".split()
)
#: What may stand in the head; anything else ends it.
IN_HEAD = set("base link meta noscript script style template title head html".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td text tfoot th thead tr ul caption".split()
)
APART = set("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure".split())
ENDS_PARAGRAPH = BLOCKS - {"html", "body", "option", "optgroup", "tbody", "thead", "tfoot", "tr", "td", "th", "caption", "text"}
#: A tag ends what is open of the first names, but does not look beyond the second.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "body": ({"head"}, {"html"}),
}
NEEDS_PARENT = {"td": "tr", "th": "tr"}
LISTS = {"ul", "ol", "menu", "dir"}


class Node:
    __slots__ = ("attributes", "children", "name")

    def __init__(self, name: str, attributes: str = ""):
        self.name = name
        self.attributes = attributes
        self.children: list[Node | str] = []

    def read(self) -> dict[str, str]:
        out: dict[str, str] = {}
        for m in ATTRIBUTE.finditer(self.attributes):
            value = m.group(2) or ""
            out.setdefault(m.group(1).lower(), unescape(value[1:-1] if value[:1] in ("'", '"') else value))
        return out

    def seen(self) -> bool:
        """Whether it is rendered at all, be it visible or not."""
        if self.name in UNSEEN:
            return False
        if not self.attributes:
            return True
        own = self.read()
        return not ("hidden" in own or "display:none" in "".join(own.get("style", "").lower().split()))

    def visible(self, inherited: bool) -> bool:
        if not self.attributes or "visibility" not in self.attributes.lower():
            return inherited
        own = VISIBILITY.findall("".join(self.read().get("style", "").lower().split()))
        return {"visible": True, "hidden": False}.get(own[-1], inherited) if own else inherited

    def shows_within(self) -> bool:
        """Whether anything below is visible although this is not."""
        below = [self]
        while below:
            for child in below.pop().children:
                if isinstance(child, Node) and child.seen():
                    if child.visible(False):
                        return True
                    below.append(child)
        return False


class Tree:
    """Builds the tree from tags and text in turn."""

    def __init__(self):
        self.root = Node("#root")
        self.open = [self.root]
        self.names = Counter({"#root": 1})

    def text(self, text: str) -> None:
        if text:
            if self.open[-1].name == "head" and text.strip():
                self._pop_to(len(self.open) - 1)
            self.open[-1].children.append(text)

    def _pop_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self.names[self.open.pop().name] -= 1

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.open.append(node)
        self.names[node.name] += 1

    def _end(self, names: set[str], beyond: set[str]) -> None:
        if not any(self.names[n] for n in names):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.open[depth].name
            if name in names:
                self._pop_to(depth)
                return
            if name in beyond:
                return

    def start(self, name: str, attributes: str) -> None:
        if self.open[-1].name == "head" and name not in IN_HEAD:
            self._pop_to(len(self.open) - 1)
        if name in IMPLIED_END:
            self._end(*IMPLIED_END[name])
        if name in ENDS_PARAGRAPH and self.names["p"]:
            self._end({"p"}, {"td", "th", "table", "li", "div", "button"} - {name})
        if name in NEEDS_PARENT and self.names["table"] and self.open[-1].name in ("table", "tbody", "thead", "tfoot"):
            self._push(Node(NEEDS_PARENT[name]))
        node = Node(name, attributes)
        if name in VOID:
            self.open[-1].children.append(node)
        else:
            self._push(node)

    def finish(self, name: str) -> None:
        if name == "br" or (name == "p" and not self.names["p"]):
            self.open[-1].children.append(Node(name))
        elif self.names[name]:
            self._end({name}, {"table"} if name not in ("table", "html", "body") else set())


def build(html: str) -> Node:
    tree, at, n = Tree(), 0, len(html)
    last = html.rfind(">")
    while at < n:
        m = TAG.search(html, at) if at <= last else None
        if m is None:
            tree.text(unescape(html[at:]))
            break
        if m.start() > at:
            tree.text(unescape(html[at : m.start()]))
        at = m.end()
        name = m.group(2) or m.group(5)
        if not name:
            continue
        name = name.lower()
        if m.group(1) or m.group(4):
            tree.finish(name)
            continue
        attributes = m.group(3) if m.group(2) else m.group(6)
        tree.start(name, attributes.strip())
        if name in RAW and not attributes.rstrip().endswith("/"):
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, at)
            tree.text(html[at : end.start()] if end else html[at:])
            at = end.end() if end else n
            tree.finish(name)
    return tree.root


class Page:
    """Lines under construction: text collapses blanks, blocks begin lines, gaps wait for text."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.indent: list[str] = []
        self.mark = ""
        self.blank = False

    def end_line(self) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        self.blank = False

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def _begin(self) -> None:
        if not self.line:
            if self.lines and self.gap > 1:
                self.lines.append("")
            self.gap = 0
            head = "".join(self.indent)
            if self.mark:
                head = head[: len(head) - len(self.mark)] + self.mark
                self.mark = ""
            self.line.append(head)

    def text(self, text: str) -> None:
        words = BLANK.sub(" ", text)
        if words == " ":
            self.blank = self.blank or bool(self.line)
            return
        if words[0] == " ":
            self.blank, words = True, words[1:]
        fresh = not self.line
        self._begin()
        if self.blank and not fresh:
            self.line.append(" ")
        self.blank = words[-1] == " "
        self.line.append(words.rstrip(" "))

    def kept(self, text: str) -> None:
        """Preformatted text: its own lines and blanks."""
        for k, part in enumerate(text.split("\n")):
            if k:
                if not self.line and self.lines:
                    self.lines.append("")
                self.end_line()
            if part:
                self._begin()
                self.line.append(part)

    def result(self) -> list[str]:
        self.end_line()
        return self.lines


def aligned(rows: list[list[list[str]]]) -> list[str]:
    """Rows of cells of lines, padded to columns."""
    widths: list[int] = []
    for row in rows:
        for k, cell in enumerate(row):
            if k == len(widths):
                widths.append(0)
            widths[k] = max(widths[k], *(len(line) for line in cell), 0)
    out = []
    for row in rows:
        for at in range(max((len(cell) for cell in row), default=0)):
            out.append(" | ".join((cell[at] if at < len(cell) else "").ljust(widths[k]) for k, cell in enumerate(row)).rstrip(" "))
    return out


def render(root: Node) -> str:
    """The visible text of a tree, with its layout."""
    pages = [Page()]
    tables: list[list[list[list[str]]]] = []
    lists: list[list[int]] = []
    kept = 0
    # (node, place of the next child, what leaving it must undo, whether its text is visible)
    walk: list[list] = [[root, 0, None, True]]
    while walk:
        top = walk[-1]
        node, k, undo, visible = top
        page = pages[-1]
        if k < len(node.children):
            top[1] += 1
            child = node.children[k]
            if isinstance(child, str):
                if visible and (node.name not in ("table", "tbody", "thead", "tfoot", "tr", "colgroup") or child.strip()):
                    (page.kept if kept else page.text)(child)
                continue
            name = child.name
            if not child.seen():
                continue
            shown = child.visible(visible)
            if not shown and (name in VOID or (visible and not child.shows_within())):
                continue
            if name == "br":
                page._begin()
                page.end_line()
                continue
            if name == "hr":
                page.block(2)
                continue
            if name == "img":
                continue
            if name == "details" and "open" not in child.read():
                child.children = [c for c in child.children if isinstance(c, Node) and c.name == "summary"][:1]
            action = None
            if name == "table":
                page.block(2)
                tables.append([])
                action = "table"
            elif name == "tr" and tables:
                tables[-1].append([])
                action = "tr"
            elif name in ("td", "th") and tables and tables[-1]:
                pages.append(Page())
                action = "cell"
            elif name in BLOCKS:
                page.block(2 if name in APART and not (name in LISTS and lists) else 1)
                if name in LISTS:
                    start = child.read().get("start", "1") if child.attributes else "1"
                    lists.append([int(start) if name == "ol" and start.lstrip("-").isdigit() and len(start) < 10 else 1, name == "ol"])
                    action = "list"
                elif name == "li":
                    mark = "- "
                    if lists:
                        number, ordered = lists[-1]
                        mark = f"{number}. " if ordered else mark
                        lists[-1][0] += 1
                    page.indent.append(" " * len(mark))
                    page.mark = mark
                    action = "item"
                elif name in ("blockquote", "dd"):
                    page.indent.append("  ")
                    action = "indent"
                elif name == "pre":
                    kept += 1
                    action = "pre"
                else:
                    action = "block"
            walk.append([child, 0, action, shown])
            continue
        walk.pop()
        if undo is None:
            continue
        if undo == "cell":
            tables[-1][-1].append(pages.pop().result() or [""])
        elif undo == "table":
            for line in aligned([row for row in tables.pop() if row]):
                page._begin()
                page.line.append(line)
                page.end_line()
            page.block(2)
        elif undo != "tr":
            page.block(2 if node.name in APART and not (undo == "list" and len(lists) > 1) else 1)
            if undo == "list":
                lists.pop()
            elif undo in ("item", "indent"):
                page.indent.pop()
                page.mark = ""
            elif undo == "pre":
                kept -= 1
    return "\n".join(pages[0].result()).strip("\n")


def page_text(html: str | None) -> str:
    return render(build(html)) if html else ""


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text, n_chars) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = [page_text(value.as_py()) for value in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["id", "text", "n_chars"])

    kind = dict(pages.dtypes)[id_col]
    found = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).mapInArrow(run, f"id {kind}, text string, n_chars long")
    return found.withColumnRenamed("id", id_col)
