"""Layout-aware text of HTML pages.

A tree builder reads tags with the usual implied ones: a block ends an open paragraph, list items, definition
terms, options, rows and cells end each other, rows and cells get the table parts they lack, and an inline end
tag does not close a block opened inside it. Visibility follows the tree: elements that are never shown, the
``hidden`` attribute, ``display: none``, ``visibility`` (inherited, and switched back on by ``visible``), closed
``details`` but their summary, and hidden inputs. Formulas, the text elements and embedded HTML of drawings, and
what an ``object`` falls back on are shown; definitions, descriptions and annotations in them are not. All other text is emitted: paragraphs and headings between
blank lines, other blocks on lines of their own, list items with markers and indents, preformatted text as it
is, and table cells aligned in columns. Columns are padded to at most ``PAD`` characters; a longer cell is kept
whole and sticks out.

Reading and rendering use explicit stacks, so nesting of any depth is fine, and every part of a page is
visited once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docketry.llm.common import annotate, col, struct_array

PAD = 60
GAP = "  "

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("head script style template noscript iframe audio video canvas datalist noembed noframes title".split())
# Drawings and formulas. Of a drawing only the text elements and embedded HTML show their text.
FOREIGN = frozenset("svg math".split())
SVG_SHOWN, SVG_NEVER = frozenset("text foreignobject".split()), frozenset("defs desc metadata symbol clippath mask pattern marker filter lineargradient radialgradient".split())
MATH_NEVER = frozenset("annotation annotation-xml mphantom".split())
# Formula parts that stand beside or above each other, not in one run.
MATH_APART = frozenset("mfrac mroot mtr mlabeledtr mtable".split())
RAW = frozenset("script style iframe noembed noframes".split())
ESCAPABLE = frozenset("title textarea".split())
# Blank lines around them.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure".split())
BLOCK = SPACED | frozenset(
    "html body address article aside center dd details dialog dir div dt fieldset figcaption footer form header hgroup hr legend li main menu nav optgroup option search section summary tr td th caption thead tbody tfoot colgroup".split()
)
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dd dt".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CELLS = frozenset("td th caption".split())
GROUPS = frozenset("thead tbody tfoot".split())
# Tags that a new tag ends, and the tags that stop the search for them.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th", "caption"}, {"tr", "table"}),
    "th": ({"td", "th", "caption"}, {"tr", "table"}),
    "tr": ({"tr", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
}

_TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))"""
    r"""|<[!?][^>]*(?:>|\Z)"""
    r"""|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"""
    r"""|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?>(?:"[^"]*"|'[^']*'|[^>"'])*)(?=>)|[^>]*(?=>))>"""
    r"""|</?[a-zA-Z][^>]*\Z"""
    r"""|(?P<text>[^<]+|<)""",
    re.S,
)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WANTED = re.compile(r"hidden|style|span|start|type|open|reversed|value", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


@dataclass(eq=False)
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if raw and _WANTED.search(raw):
        for m in _ATTR.finditer(raw):
            out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out


def tree(html: str) -> Node:
    """The tree of a page, below a node ``body``; children are nodes and texts."""
    root = Node("body")
    stack = [root]
    # How often each tag is open, to spare searches for tags that are not.
    count: dict[str, int] = {}

    def push(node: Node) -> None:
        stack[-1].children.append(node)
        stack.append(node)
        count[node.tag] = count.get(node.tag, 0) + 1

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            count[stack.pop().tag] -= 1

    def close(tags, stops, cells: bool = True) -> None:
        if not any(count.get(t) for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            tag = stack[i].tag
            if tag in tags:
                pop_to(i)
                return
            if tag in stops or tag == "table" or (cells and tag in CELLS):
                return

    def drawn() -> bool:
        """Whether tags belong to a drawing or formula, where a slash closes them and sections of text may stand."""
        return bool(count.get("svg") or count.get("math")) and not count.get("foreignobject")

    at = 0
    while at < len(html):
        if html.startswith("<![CDATA[", at) and drawn():
            end = html.find("]]>", at)
            stack[-1].children.append(html[at + 9 : end if end >= 0 else len(html)])
            at = end + 3 if end >= 0 else len(html)
            continue
        m = _TOKEN.match(html, at)
        if m is None:
            # A tag whose quotes do not close: its sign is text.
            stack[-1].children.append(html[at])
            at += 1
            continue
        at = m.end()
        if m["text"] is not None:
            if count.get("head") and m["text"].strip(" \t\n\r\f"):
                close({"head"}, ())
            stack[-1].children.append(unescape(m["text"]) if "&" in m["text"] else m["text"])
        elif m["start"]:
            tag = m["start"].lower()
            if tag == "html":
                continue
            if tag == "body":
                close({"head"}, ())
                continue
            if tag != "head" and count.get("head") and tag not in ("title", "meta", "link", "style", "script", "base", "noscript", "template"):
                close({"head"}, ())
            if tag in ENDS_P:
                close({"p"}, ("button",))
            if tag in HEADINGS and stack[-1].tag in HEADINGS:
                pop_to(len(stack) - 1)
            if tag in ENDED_BY:
                tags, stops = ENDED_BY[tag]
                close(tags, stops, cells=tag not in ("tr", "td", "th", *GROUPS))
                if tag in ("td", "th") and stack[-1].tag in ("table", *GROUPS):
                    push(Node("tr"))
            node = Node(tag, attributes(m["attrs"]))
            if tag in VOID or m["attrs"].endswith("/") and (tag in FOREIGN or drawn()):
                stack[-1].children.append(node)
            elif tag in RAW or tag in ESCAPABLE:
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
                inside = html[at : end.start() if end else len(html)]
                node.children.append(unescape(inside) if tag in ESCAPABLE else inside)
                stack[-1].children.append(node)
                at = (html.find(">", end.end()) + 1 or len(html)) if end else len(html)
            else:
                push(node)
        elif m["end"]:
            tag = m["end"].lower()
            if tag == "br":
                stack[-1].children.append(Node("br"))
            if not count.get(tag):
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    pop_to(i)
                    break
                # Cells hold their tags in, and blocks hold out against inline end tags.
                if (stack[i].tag in CELLS and tag not in ("table", "tr", *GROUPS)) or (stack[i].tag in BLOCK and tag not in BLOCK and tag not in NEVER and tag not in FOREIGN and tag != "object"):
                    break
    return root


class Page:
    """Lines of text under construction."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        # Line breaks owed before the next text, and a space owed inside a line.
        self.breaks = 0
        self.space = False
        self.indents: list[str] = []
        self.marker = ""

    def flush(self) -> None:
        if self.parts:
            self.lines.append("".join(self.parts).rstrip(" "))
            self.parts = []

    def need(self, breaks: int) -> None:
        """At least so many line breaks before what follows."""
        self.flush()
        self.breaks = max(self.breaks, breaks)
        self.space = False

    def begin(self) -> None:
        """Start a line, after the blank one if it is owed."""
        if self.lines and self.breaks > 1 and self.lines[-1] != "":
            self.lines.append("")
        self.breaks = 0
        lead = "".join(self.indents)
        if self.marker:
            lead = lead[: len(lead) - len(self.marker)] + self.marker
            self.marker = ""
        self.parts.append(lead)

    def flow(self, text: str) -> None:
        """Text with white space collapsed."""
        plain = _SPACE.sub(" ", text)
        if plain == " " or not plain:
            self.space = self.space or bool(plain)
            return
        if not self.parts:
            self.begin()
            plain = plain.lstrip(" ")
        elif self.space and plain[0] != " ":
            self.parts.append(" ")
        elif not self.space and plain[0] == " ":
            pass
        elif self.space:
            plain = plain.lstrip(" ")
            self.parts.append(" ")
        self.space = plain[-1] == " "
        self.parts.append(plain.rstrip(" "))

    def line_break(self) -> None:
        if self.parts:
            self.flush()
        elif self.lines and not self.breaks:
            self.lines.append("")
        self.space = False

    def kept(self, text: str) -> None:
        """Preformatted text."""
        for i, line in enumerate(text.split("\n")):
            if i:
                if self.parts:
                    self.lines.append("".join(self.parts))
                    self.parts = []
                elif self.lines:
                    self.lines.append("")
            if line:
                if not self.parts:
                    self.begin()
                self.parts.append(line.rstrip("\r"))

    def block(self, lines: list[str]) -> None:
        """Finished lines, under the indent."""
        for line in lines:
            if line:
                self.begin()
                self.parts.append(line)
                self.flush()
            elif self.lines:
                self.lines.append("")

    def done(self) -> list[str]:
        self.flush()
        lines = self.lines
        while lines and not lines[-1].strip(" "):
            lines.pop()
        return lines


@dataclass
class Table:
    captions: list[list[str]] = field(default_factory=list)
    rows: list[list[tuple[int, int, list[str]]]] = field(default_factory=list)

    def lines(self) -> list[str]:
        """The rows with cells in aligned columns; cells of several lines go on below."""
        grid: list[dict[int, tuple[int, list[str]]]] = []
        taken: dict[int, int] = {}
        for cells in self.rows:
            placed, at = {}, 0
            held, taken = taken, {c: n - 1 for c, n in taken.items() if n > 1}
            for across, down, lines in cells:
                while held.get(at):
                    at += 1
                placed[at] = (across, lines)
                if down > 1:
                    taken.update({c: down - 1 for c in range(at, at + across)})
                at += across
            grid.append(placed)
        width: dict[int, int] = {}
        for placed in grid:
            for c, (across, lines) in placed.items():
                if across == 1:
                    width[c] = max(width.get(c, 0), min(PAD, max(map(len, lines), default=0)))
        # A column that only spanning cells cover has no width; a row left of all text has no gap.
        start, edge = {}, 0
        for c in sorted({c for placed in grid for c in placed}):
            start[c] = edge
            edge += width.get(c, 0) + (len(GAP) if width.get(c, 0) else 0)
        out = [line for lines in self.captions for line in lines]
        for placed in grid:
            height = max((len(lines) for _, lines in placed.values()), default=0)
            for k in range(height):
                line = ""
                for c in sorted(placed):
                    text = placed[c][1][k] if k < len(placed[c][1]) else ""
                    if text:
                        line = line.ljust(start[c])
                        line += (GAP if line and len(line) > start[c] else "") + text
                out.append(line)
        return out


def _number(value: str | None, least: int, most: int) -> int:
    m = re.match(r"\s*([+-]?\d{1,9})", value or "")
    return min(most, max(least, int(m[1]))) if m else max(least, 1)


def _style(node: Node) -> tuple[bool, bool | None]:
    """Whether the element is shown at all, and whether it sets its visibility."""
    shown, visible = node.tag not in NEVER, None
    if node.attrs:
        if "hidden" in node.attrs or (node.tag == "input" and node.attrs.get("type", "").lower() == "hidden"):
            shown = False
        for rule in node.attrs.get("style", "").lower().split(";"):
            name, _, value = rule.partition(":")
            value = value.replace("!important", "").strip()
            if name.strip() == "display":
                shown = node.tag not in NEVER and value != "none"
            elif name.strip() == "visibility":
                visible = value not in ("hidden", "collapse")
    return shown, visible


def render(root: Node) -> str:
    pages, tables, lists = [Page()], [], []
    preformatted = 0
    # Open drawings and formulas, and what in a drawing shows text.
    foreign: list[str] = []
    # (node, entering, visible)
    todo: list[tuple[object, bool, bool]] = [(root, True, True)]
    while todo:
        node, entering, visible = todo.pop()
        page = pages[-1]
        if isinstance(node, str):
            if visible and not (foreign and foreign[-1] == "svg"):
                page.kept(node) if preformatted else page.flow(node)
            continue
        tag = node.tag
        if entering:
            shown, own = _style(node)
            if not shown or (foreign and tag in (MATH_NEVER if foreign[-1] == "math" else SVG_NEVER if foreign[-1] != "foreignobject" else ())):
                continue
            visible = visible if own is None else own
            if tag == "br":
                if visible:
                    page.line_break()
                continue
            if tag == "hr":
                page.need(1)
                if visible:
                    page.flow("---")
                page.need(1)
                continue
            if tag in VOID:
                if tag == "input" and visible and node.attrs.get("type", "text").lower() in ("text", "submit", "button", "reset", "search", "email", "url", "tel", "number"):
                    page.flow(node.attrs.get("value", ""))
                continue
            if tag in CELLS and tables:
                pages.append(Page())
            elif tag == "table":
                page.need(2 if not tables else 1)
                tables.append(Table())
            elif tag == "tr" and tables:
                tables[-1].rows.append([])
            elif tag in BLOCK:
                # A list inside a list stands close to its item.
                page.need(2 if tag in SPACED and not (tag in ("ul", "ol") and lists) else 1)
            if tag in ("ul", "ol", "menu", "dir"):
                lists.append(_number(node.attrs.get("start"), -(10**9), 10**9) if tag == "ol" else None)
            elif tag == "li":
                mark = "- "
                if lists and lists[-1] is not None:
                    if "value" in node.attrs:
                        lists[-1] = _number(node.attrs["value"], -(10**9), 10**9)
                    mark = f"{lists[-1]}. "
                    lists[-1] += 1
                page.indents.append(" " * len(mark))
                page.marker = mark
            elif tag in ("dd", "blockquote"):
                page.indents.append("    ")
            elif tag in ("pre", "textarea"):
                preformatted += 1
                if node.children and isinstance(node.children[0], str):
                    node.children[0] = re.sub(r"\A\r?\n", "", node.children[0])
            todo.append((node, False, visible))
            children = node.children
            if tag in FOREIGN or (tag in SVG_SHOWN and foreign and foreign[-1] in ("svg", tag)):
                if tag == "text" and visible:
                    # Labels of a drawing stand apart.
                    page.kept(" ") if preformatted else page.flow(" ")
                foreign.append(tag)
            elif tag in MATH_APART and foreign and foreign[-1] == "math":
                children = [c for child in children for c in (child, " ")]
            if tag == "details" and "open" not in node.attrs:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            todo.extend((child, True, visible) for child in reversed(children))
            continue
        # Leaving.
        if foreign and tag == foreign[-1]:
            foreign.pop()
            if tag == "text" and visible:
                page.kept(" ") if preformatted else page.flow(" ")
        if tag in CELLS and tables:
            lines = pages.pop().done()
            if tag == "caption":
                tables[-1].captions.append(lines)
            else:
                if not tables[-1].rows:
                    tables[-1].rows.append([])
                tables[-1].rows[-1].append((_number(node.attrs.get("colspan"), 1, 1000), _number(node.attrs.get("rowspan"), 1, 65534), lines))
            continue
        if tag == "table":
            page.need(1)
            page.breaks = 2 if len(tables) == 1 else 1
            page.block(tables.pop().lines())
        elif tag in ("ul", "ol", "menu", "dir"):
            lists.pop()
        elif tag == "li":
            page.flush()
            page.indents.pop()
            page.marker = ""
        elif tag in ("dd", "blockquote"):
            page.flush()
            page.indents.pop()
        elif tag in ("pre", "textarea"):
            preformatted -= 1
        if tag in BLOCK and not (tag == "tr" and tables):
            page.need(2 if tag in SPACED and not (tag in ("ul", "ol") and lists) else 1)
    return "\n".join(pages[0].done())


def title(root: Node) -> str | None:
    """The page's title: the first ``title`` outside drawings."""
    todo: list = [root]
    while todo:
        node = todo.pop()
        if isinstance(node, Node):
            if node.tag == "title":
                return _SPACE.sub(" ", "".join(c for c in node.children if isinstance(c, str))).strip(" ")
            if node.tag not in ("svg", "math"):
                todo.extend(reversed(node.children))
    return None


def extract(html: str | None) -> tuple[str | None, str]:
    """Title and visible text; a null or empty page has no title and an empty text."""
    if not html:
        return None, ""
    root = tree(html.replace("\x00", "�"))
    return title(root), render(root)


RESULT = T.StructType([T.StructField("title", T.StringType()), T.StructField("text", T.StringType())])


def visible_text(df: DataFrame, html_col: str, name: str = "page", carry: list[str] | None = None) -> DataFrame:
    """``df`` (or its ``carry`` columns) with a struct ``name``: ``title`` and ``text`` of the whole page.

    A null page has a null title and an empty text. Repeated rows stay; an empty table gives an empty result; a
    column called ``name`` gives way.
    """

    def start():
        def score(pages: list[str | None]) -> pa.StructArray:
            made = [extract(p) for p in pages]
            return struct_array(title=pa.array([m[0] for m in made], pa.string()), text=pa.array([m[1] for m in made], pa.string()))

        return score

    return annotate(df, [col(html_col).cast("string")], name, RESULT, start, carry)


