"""HTML extraction: the text that a reader sees, laid out as lines.

Markup is cut into tokens, a tree builder adds the end tags that HTML leaves out
(paragraphs before blocks, list items, table cells and rows, options, the head
before the first text or tag that it cannot hold) and ignores end tags that match nothing, and a renderer walks the tree:

* elements that are never shown (scripts, styles, templates, the head), closed dialogs,
  what a closed ``details`` holds besides its summary, and elements with ``hidden`` or
  ``display:none`` give nothing; ``visibility`` is inherited, and shown again where it says so;
* style rules count too: those of the page's ``style`` elements whose selectors name an
  element, classes and an id (no combinators; none inside of at-rules), by specificity and order,
  behind the element's own style;
* drawings give the text of their ``text`` elements, formulas all but annotations;
* runs of white space become one blank, except in preformatted text;
* blocks stand on lines of their own; paragraphs, headings, lists, tables and
  quotes are set off by an empty line;
* list items begin with ``- `` or their number and are indented by depth, up to
  ``DEEPEST`` blanks: deeper ones stand there too, so the text grows with the page only;
* table cells stand in columns, padded to the widest cell of the column that has
  at most ``WIDEST`` characters; a wider cell is not cut and not padded for, so
  one long cell does not blow up its column. A cell that spans rows stands in the first
  and keeps its columns free in the others.

Cases: null or empty html gives the empty text; broken markup never fails (an
unclosed comment or tag ends with the page); nesting of any depth is walked without
recursion; very long pages are rendered whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import common

WIDEST = 40
#: Blanks before a line of nested lists and quotes, at most.
DEEPEST = 40
#: Fixed values of HTML: columns and rows that a cell can span.
SPANS = {"colspan": 1000, "rowspan": 65534}

# Fixed values of HTML: element kinds.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
NEVER = set("head script style template noscript iframe noembed noframes object audio video canvas datalist title annotation annotation-xml".split())
#: Start tags that an open head keeps; any other, and text, ends it.
IN_HEAD = set("base basefont bgsound link meta title style script noscript noframes template head html".split())
#: In a drawing only these hold text that is shown, and these hold parts that are not drawn in place.
DRAWN = {"text", "foreignobject"}
UNDRAWN = set("defs desc metadata symbol clippath mask marker pattern".split())
#: HTML start tags that end an open svg or math, but not from within these elements, which hold HTML.
BREAKS_OUT = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small"
    " span strong strike sub sup table tt u ul var".split()
)
HOLDS_HTML = set("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr".split())
BLOCK = SPACED | set(
    "address article aside body center dd details dialog dir div dt fieldset figcaption footer form header hgroup html legend li"
    " main menu nav optgroup option search section summary tr caption thead tbody tfoot".split()
)
#: A start tag of the key ends an open element of the values, up to the given borders.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table", "thead", "tbody", "tfoot"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}
ENDS["tbody"] = ENDS["tfoot"] = ENDS["thead"]
CLOSES_P = BLOCK - {"html", "body", "li", "dd", "dt", "option", "optgroup", "tr", "thead", "tbody", "tfoot", "caption", "legend", "summary"}
#: End tags do not reach beyond these.
BORDERS = {"td": {"table"}, "th": {"table"}, "tr": {"table"}, "li": {"ul", "ol"}, "p": {"table", "td", "th", "button"}}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_DECLARATION = re.compile(r"(?:^|[;{\s])(display|visibility)\s*:\s*([a-z-]+)", re.I)
_RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
_SELECTOR = re.compile(r"([a-z][a-z0-9]*|\*)?((?:[.#][\w-]+)*)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


def _declared(style: str) -> dict[str, str]:
    """The last ``display`` and ``visibility`` of a style."""
    return {m[1].lower(): m[2].lower() for m in _DECLARATION.finditer(re.sub(r"/\*.*?(?:\*/|\Z)", " ", style, flags=re.S))}


class Styles:
    """Rules on ``display`` and ``visibility`` of a page's style elements."""

    def __init__(self) -> None:
        #: By an id, class or element that the selector names: (specificity, order, element, classes, id, declared).
        self.rules: dict[str, list[tuple]] = {}
        self.order = 0

    def add(self, text: str) -> None:
        text = re.sub(r"/\*.*?(?:\*/|\Z)|<!--|-->", " ", text, flags=re.S)
        plain, at = [], 0
        for m in re.finditer(r"@[^;{}]*", text):  # without at-rules and their blocks
            if m.start() < at:
                continue
            plain.append(text[at : m.start()])
            at, depth = m.end(), 0
            for brace in re.finditer(r"[{};]", text[m.end() :]):
                depth += {"{": 1, "}": -1, ";": 0}[brace[0]]
                at = m.end() + brace.end()
                if depth <= 0:
                    break
            else:
                at = len(text)
        for m in _RULE.finditer("".join([*plain, text[at:]])):
            declared = _declared(m[2])
            for selector in m[1].split(",") if declared else ():
                if found := _SELECTOR.fullmatch(selector.strip()):
                    element, names = (found[1] or "").lower().strip("*"), re.findall(r"[.#][\w-]+", found[2])
                    ids, classes = [x[1:] for x in names if x[0] == "#"], {x[1:] for x in names if x[0] == "."}
                    self.order += 1
                    rule = ((len(ids), len(classes), bool(element)), self.order, element, classes, set(ids), declared)
                    key = f"#{ids[0]}" if ids else f".{min(classes)}" if classes else element or "*"
                    self.rules.setdefault(key, []).append(rule)

    def of(self, node: Node) -> dict[str, str]:
        """What holds for an element: its rules, then its own style."""
        declared: dict[str, str] = {}
        low = node.attributes.lower() if node.attributes else ""
        if self.rules:
            classes = (node.get("class") or "").split() if "class" in low else []
            id_ = node.get("id") if "id" in low else None
            keys = ["*", node.tag, *(f".{c}" for c in classes), *([f"#{id_}"] if id_ else [])]
            rules = [r for k in dict.fromkeys(keys) for r in self.rules.get(k, ())]
            for rule in sorted(rules, key=lambda r: r[:2]):
                if (not rule[2] or rule[2] == node.tag) and rule[3] <= set(classes) and rule[4] <= {id_}:
                    declared |= rule[5]
        if "style" in low:
            declared |= _declared(node.get("style") or "")
        return declared


class Node:
    __slots__ = ("tag", "attributes", "children", "styles", "shown")

    def __init__(self, tag: str, attributes: str = "") -> None:
        self.tag, self.attributes, self.children = tag, attributes, []
        self.styles: Styles | None = None  # at the root: the page's
        self.shown: bool | None = None  # what the element says of its visibility, once rendered

    def get(self, name: str) -> str | None:
        for m in _ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                return unescape(next((g for g in m.groups()[1:] if g is not None), ""))
        return None

    def span(self, name: str) -> int:
        """Columns or rows spanned; rows 0: all that follow."""
        value = self.get(name) or "1"
        span = int(value) if re.fullmatch("[0-9]{1,9}", value) else 1
        return min(span or (SPANS[name] if name == "rowspan" else 1), SPANS[name])

    def hidden(self, styles: Styles) -> bool:
        """Is nothing of the element laid out? Notes its visibility."""
        if self.tag in NEVER:
            return True
        if self.tag == "dialog" and self.get("open") is None:
            return True
        if not styles.rules and (not self.attributes or self.attributes.isspace()):
            return False
        low = self.attributes.lower()
        declared = styles.of(self)
        if declared.get("visibility") in ("hidden", "collapse", "visible"):
            self.shown = declared["visibility"] == "visible"
        if declared.get("display") == "none":
            return True
        if "hidden" not in low:
            return False
        return self.get("hidden") is not None and "display" not in declared or self.tag == "input" and self.get("type") == "hidden"

    def laid_out(self) -> list[Node | str]:
        """The children, of closed details the first summary alone."""
        if self.tag == "details" and self.get("open") is None:
            return [c for c in self.children if isinstance(c, Node) and c.tag == "summary"][:1]
        return self.children


def parse(html: str) -> Node:
    """The tree of a page, under a root without a tag."""
    root = Node("")
    root.styles = Styles()
    stack = [root]
    counts: dict[str, int] = {}  # open elements by tag

    def close(depth: int) -> None:
        for node in stack[depth:]:
            counts[node.tag] -= 1
        del stack[depth:]

    def close_open(tags: set[str], borders: set[str]) -> None:
        """Ends the outermost open element of ``tags`` inside the innermost border."""
        if not any(counts.get(t) for t in tags):
            return
        found = 0
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in borders:
                break
            if stack[depth].tag in tags:
                found = depth
        if found:
            close(found)

    def add_text(text: str) -> None:
        if stack[-1].tag == "head" and text.strip(" \t\n\r\f"):
            close(len(stack) - 1)
        stack[-1].children.append(text)

    def break_out() -> None:
        """Ends the foreign elements around an HTML tag."""
        found = 0
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in HOLDS_HTML:
                break
            if stack[depth].tag in ("svg", "math"):
                found = depth
        if found:
            close(found)

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            add_text(unescape(html[at:]))
            break
        if m.start() > at:
            add_text(unescape(html[at : m.start()]))
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if stack[-1].tag == "head" and (tag in ("body", "html", "br") if m[1] else tag not in IN_HEAD):
            close(len(stack) - 1)
        foreign = counts.get("svg") or counts.get("math")
        if m[1]:
            if counts.get(tag):
                borders = BORDERS.get(tag, ())
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        close(depth)
                        break
                    if stack[depth].tag in borders:
                        break
            elif tag in ("br", "p"):
                stack[-1].children.append(Node(tag))
            continue
        if foreign and tag in BREAKS_OUT:
            break_out()
        if tag in CLOSES_P and counts.get("p"):
            close_open({"p"}, {"table", "td", "th", "button"})
        if tag in ENDS:
            close_open(*ENDS[tag])
        node = Node(tag, m[3] or "")
        stack[-1].children.append(node)
        if tag in RAW and not (foreign and (m[3] or "").endswith("/")):
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)", re.I).search(html, at)
            text = html[at : end.start()] if end else html[at:]
            node.children.append(unescape(text) if tag in ("title", "textarea") else text)
            if tag == "style" and not foreign and (node.get("media") or "all").strip().lower() in ("all", "screen"):
                root.styles.add(text)
            at = end.end() if end else n
        elif tag not in VOID and not (m[3] or "").endswith("/") or tag in BLOCK and tag not in VOID:
            stack.append(node)
            counts[tag] = counts.get(tag, 0) + 1
    return root


class Lines:
    """Text laid out as lines; collapses white space and empty lines."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.blank = False  # white space is due before the next text
        self.gap = 0  # empty lines due before the next line
        self.prefix = ""  # marker of the next line
        self.indent = ""

    def text(self, text: str) -> None:
        text = text.replace("\xa0", " ")
        if not text or text.isspace():
            self.blank = self.blank or bool(text)
            return
        body = _SPACE.sub(" ", text)
        if (self.blank or body[0] == " ") and self.parts:
            self.parts.append(" ")
        self.parts.append(body.strip(" "))
        self.blank = body[-1] == " "

    def line(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = 0
        self.lines.append((self.indent + self.prefix + line).rstrip())
        self.prefix = " " * len(self.prefix) if self.prefix else ""

    def end(self, gap: bool = False) -> None:
        """Ends the line; ``gap``: an empty line is due."""
        if self.parts:
            self.line("".join(self.parts))
            self.parts = []
        self.blank = False
        self.gap = self.gap or int(gap)

    def result(self) -> str:
        self.end()
        return "\n".join(self.lines).strip("\n")


def _placed(rows: list[list[tuple[str, int, int]]]) -> list[list[tuple[str, int, int]]]:
    """Rows of (text, columns spanned, rows spanned) as rows of (text, first column, end)."""
    out, taken = [], []  # (first column, end, rows left) of the cells that reach down from above
    for row in rows:
        above, at, k, cells = sorted(taken), 0, 0, []
        for text, wide, high in row:
            while k < len(above) and above[k][0] <= at:
                at = max(at, above[k][1])
                k += 1
            cells.append((text, at, at + wide))
            if high > 1:
                taken.append((at, at + wide, high))
            at += wide
        taken = [(a, b, left - 1) for a, b, left in taken if left > 1]
        out.append(cells)
    return out


def _cells(rows: list[list[tuple[str, int, int]]]) -> list[str]:
    """Rows of (text, columns spanned, rows spanned) as lines with aligned columns."""
    placed = _placed(rows)
    # only columns in which a cell begins count
    begun = sorted({a for row in placed for _, a, _ in row})
    widths = [0] * len(begun)
    spans = [[(text, bisect_left(begun, a), bisect_left(begun, b)) for text, a, b in row] for row in placed]
    for row in spans:
        for text, a, b in row:
            if b - a == 1 and len(text) <= WIDEST:
                widths[a] = max(widths[a], len(text))
    starts = list(accumulate((w + 2 for w in widths), initial=0))
    out = []
    for row in spans:
        line, due = [], 0  # what is written would end at ``due`` if no cell were too wide
        for text, a, b in row:
            line += [" " * max(starts[a] - due, 0), text.ljust(starts[b] - starts[a] - 2) + "  "]
            due = max(starts[b], due)
        out.append("".join(line).rstrip())
    return [x for x in out if x]


def render(root: Node) -> str:
    """The visible text of a tree."""
    # what is being laid out: the page, or a table with the cell at hand
    out = Lines()
    outer: list[tuple[Lines, list]] = []  # around each open cell
    tables: list[list] = []  # rows of each open table
    lists: list[list] = []  # [kind, number] of each open list
    quotes: list[str] = []  # indents around the open quotes
    pre = 0
    drawn: list[bool] = []  # is text shown in each open drawing, and in each of its texts?
    shown = [True]  # is it visible, in each open element that says so?
    todo: list[tuple[Node | str, bool]] = [(root, True)]
    while todo:
        node, enter = todo.pop()
        if isinstance(node, str):
            if drawn and not drawn[-1] or not shown[-1]:
                continue
            if pre:
                pieces = node.replace("\r\n", "\n").split("\n")
                for k, piece in enumerate(pieces):
                    if k:
                        out.line("".join(out.parts))
                        out.parts = []
                    if piece:
                        out.parts.append(piece)
            else:
                out.text(node)
            continue
        tag = node.tag
        if enter:
            if node.hidden(root.styles) or drawn and tag in UNDRAWN:
                continue
            if node.shown is not None and tag not in VOID:
                shown.append(node.shown)
            if tag == "br":
                if out.parts:
                    out.end()
                continue
            todo.append((node, False))
            todo += [(c, True) for c in reversed(node.laid_out())]
            if tag == "svg" or drawn and tag in DRAWN:
                drawn.append(tag != "svg")
                out.blank = True
            if tag in ("td", "th") and tables:
                outer.append((out, lists))
                out, lists = Lines(), []
                if not tables[-1]:
                    tables[-1].append([])
                continue
            if tag in BLOCK:
                out.end(tag in SPACED and not (tag in ("ul", "ol") and lists))
            if tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("ul", "ol", "menu", "dir"):
                start = node.get("start") if tag == "ol" else None
                lists.append([tag, int(start) - 1 if start and re.fullmatch(r"-?[0-9]{1,9}", start) else 0, out.indent])
                if len(lists) > 1 and len(out.indent) < DEEPEST:
                    out.indent += "  "
            elif tag == "li":
                if lists:
                    lists[-1][1] += 1
                out.prefix = f"{lists[-1][1]}. " if lists and lists[-1][0] == "ol" else "- "
            elif tag == "blockquote":
                quotes.append(out.indent)
                if len(out.indent) < DEEPEST:
                    out.indent += "  "
            elif tag == "pre":
                pre += 1
            elif tag == "hr" and shown[-1]:
                out.line("---")
            continue
        if node.shown is not None:
            shown.pop()
        if tag == "svg" or drawn and tag in DRAWN:
            drawn.pop()
            out.blank = True
        if tag in ("td", "th") and tables:
            text = _SPACE.sub(" ", out.result())
            out, lists = outer.pop()
            tables[-1][-1].append((text, node.span("colspan"), node.span("rowspan")))
        elif tag == "table":
            out.end()
            for line in _cells(tables.pop()):
                out.line(line)
            out.end(True)
        elif tag in BLOCK:
            if tag == "pre":
                pre -= 1
            out.end(tag in SPACED and not (tag in ("ul", "ol") and len(lists) > 1))
            if tag in ("ul", "ol", "menu", "dir") and lists:
                out.indent = lists.pop()[2]
            elif tag == "li":
                out.prefix = ""
            elif tag == "blockquote":
                out.indent = quotes.pop()
    return out.result()


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """Appends the visible text of each page."""

    def make():
        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            return [pa.array([render(parse(x)) if x else "" for x in common.texts_of(part, html_col)], pa.string())]

        return compute

    return common.with_arrow_columns(pages, html_col, [T.StructField(text_col, T.StringType())], make)
