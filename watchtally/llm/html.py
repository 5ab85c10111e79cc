"""Operator 3: layout-aware HTML text.

A small tree builder (implied and optional end tags, void and raw-text elements)
and a renderer that emits all visible text: blocks on lines of their own with
blank lines around paragraphs and headings, list items with markers and
indentation, table cells in aligned columns (a cell that spans rows keeps its columns free below), preformatted
text (also by an own ``white-space``) as it is.
Hidden are script, style, template, datalist, iframe, noembed and noframes, head parts
but the title, elements with ``hidden``, ``aria-hidden="true"``, ``display:none`` or
``visibility:hidden`` (their own, or by a rule of the page's style sheets with a simple selector of
tag, classes and id outside of ``@`` blocks), closed dialogs and hidden inputs; in svg and math the elements of
``FOREIGN_HIDDEN`` (descriptions, definitions, annotations); comments and declarations.
Nothing else is judged or dropped: formulas, labels of drawings and the fallback of
object and noscript are text. Parts of a formula that stand above, below or beside each
other get spaces between them; what ``use`` repeats of a drawing isn't looked up.

Defined cases: null or empty html gives the empty text; unclosed and stray tags
never fail; text outside a body counts; repeated rows are each rendered; elements
nested deeper than ``MAX_DEPTH`` keep their text, line ends and hidden parts, but get no
list markers, indentation or columns.
"""

from __future__ import annotations

import html as _entities
import re
import unicodedata
from itertools import accumulate

from pyspark.sql import DataFrame

from .common import map_arrow

MAX_DEPTH = 200
# Element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
HIDDEN = frozenset("script style template noembed noframes iframe datalist meta link base".split())
# In svg and math: never shown; where HTML goes on; HTML elements that end an unclosed one; parts that don't run on.
FOREIGN_HIDDEN = frozenset("title desc metadata defs symbol clippath mask pattern marker annotation annotation-xml mphantom".split())
INTEGRATION = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small "
    "span strong strike sub sup table tt u ul var".split())
SPACED = frozenset("mfrac msup msub msubsup munder mover munderover mmultiscripts mroot mtr mlabeledtr".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr".split())
BLOCK = PARAGRAPH | frozenset(
    "html head body title address article aside main nav section header footer div form fieldset details summary dialog li dt dd figcaption "
    "center dir menu legend caption option optgroup select tr hgroup search".split())
# Elements whose start closes an open one of these, looked for up to the given borders.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}), "body": ({"head"}, {"html"}),
}
P_CLOSERS = BLOCK - frozenset("html head body title li dt dd option optgroup select tr caption legend".split()) | {"li", "dt", "dd"}
P_BORDERS = frozenset("button table td th caption object li dd dt".split())
SCOPE = frozenset("table td th caption".split())

TOKEN = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|"
    r"<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<([a-zA-Z][^\s/>]*+)([^>]*+)>?", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
WHITE_SPACE = re.compile(r"white-space\s*:\s*([a-z-]+)", re.I)
# Style sheets: comments, rules outside of nested blocks, and the selectors that are understood.
CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
CSS_RULE = re.compile(r"([^{}]*+)\{([^{}]*+)\}|\{|\}")
SELECTOR = re.compile(r"([a-z][a-z0-9-]*)?((?:[.#][\w-]+)*)", re.I)
SHOWN = re.compile(r"(?:display|visibility)\s*:\s*([a-z-]+)", re.I)
SPACES = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "items", "foreign", "deep")

    def __init__(self, tag: str, attrs: dict[str, str], foreign: bool = False, deep: bool = False):
        self.tag, self.attrs, self.items, self.foreign, self.deep = tag, attrs, [], foreign, deep

    def hidden(self) -> bool:
        a = self.attrs
        if self.foreign and (self.tag in FOREIGN_HIDDEN or a and (a.get("display", "").strip() == "none" or a.get("visibility", "").strip() in ("hidden", "collapse"))):
            return True
        return self.tag in HIDDEN or bool(a) and ("hidden" in a or a.get("aria-hidden", "").lower() == "true" or bool(INVISIBLE.search(a.get("style", "")))
                                                  or self.tag == "input" and a.get("type", "").lower() == "hidden" or self.tag == "dialog" and "open" not in a)


def build(source: str) -> Node:
    """The element tree; end tags may be missing, stray or out of order."""
    root = Node("#root", {})
    stack, at, n = [root], 0, len(source)
    places: dict[str, list[int]] = {}  # of the open elements of each tag

    def place(tags) -> int:
        """Of the last open element with one of the tags; 0 is none."""
        return max([places[t][-1] for t in tags if places.get(t)], default=0)

    def push(node: Node) -> None:
        places.setdefault(node.tag, []).append(len(stack))
        stack.append(node)

    def cut_at(i: int) -> None:
        while len(stack) > i:
            places[stack.pop().tag].pop()

    def close(tags, borders) -> None:
        last = place(tags)
        if last and last >= place(borders):
            while last > 1 and stack[last - 1].tag in tags:
                last -= 1
            cut_at(last)

    while at < n:
        m = TOKEN.search(source, at)
        if m is None:
            stack[-1].items.append(source[at:])
            break
        if m.start() > at:
            stack[-1].items.append(source[at : m.start()])
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag == "br":
                stack[-1].items.append(Node("br", {}))
            elif tag == "p" and not places.get("p"):
                stack[-1].items.append(Node("p", {}))
            else:
                borders = SCOPE - {tag} if tag not in ("table", "tr", "tbody", "thead", "tfoot", "html", "body") else frozenset(["table"]) - {tag}
                i = place((tag,))
                if i and i > place(borders):
                    cut_at(i)
        elif m[2] or m[4]:  # the second form has an unclosed quote
            tag, raw = (m[2] or m[4]).lower(), m[3] or m[5] or ""
            if tag in BREAKOUT:
                while stack[-1].foreign and stack[-1].tag not in INTEGRATION:
                    cut_at(len(stack) - 1)
            foreign = tag in ("svg", "math") or stack[-1].foreign and stack[-1].tag not in INTEGRATION
            if tag in CLOSES and not foreign:
                close(*CLOSES[tag])
            if tag in P_CLOSERS:
                close({"p"}, P_BORDERS)
            attrs = {a[0].lower(): _entities.unescape(a[1] or a[2] or a[3] or "") for a in ATTRIBUTE.findall(raw)} if raw and not raw.isspace() else {}
            node = Node(tag, attrs, foreign, len(stack) > MAX_DEPTH)
            stack[-1].items.append(node)
            if foreign and raw.endswith("/"):
                continue
            if tag in RAW and (not foreign or tag in ("script", "style")):
                end = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)[^>]*>?", re.I).search(source, at)
                node.items.append(source[at : end.start() if end else n])
                at = end.end() if end else n
            elif foreign or tag not in VOID:
                push(node)
    return root


def sheet_rules(css: str) -> list[tuple[str, frozenset[str], bool]]:
    """(tag or empty, classes and ids with their mark, hidden) of the simple rules about visibility, in order.

    Rules in nested blocks (``@media``) and selectors with combinators or states are passed over."""
    out, depth = [], 0
    for m in CSS_RULE.finditer(CSS_COMMENT.sub("", css)):
        if m[2] is None:
            depth = max(0, depth + (1 if m[0] == "{" else -1))
        elif depth == 0 and (shown := SHOWN.findall(m[2])):
            for selector in m[1].split(";")[-1].split(","):
                if (part := selector.strip()) and (found := SELECTOR.fullmatch(part)):
                    out.append(((found[1] or "").lower(), frozenset(re.findall(r"[.#][\w-]+", found[2])), shown[-1].lower() in ("none", "hidden", "collapse")))
    return out


def apply_sheets(root: Node) -> None:
    """Hide what the page's own style sheets hide; the last rule that fits counts, an element's own style more."""
    css, todo, nodes = [], [root], []
    while todo:
        x = todo.pop()
        nodes.append(x)
        if x.tag == "style":
            css += [i for i in x.items if isinstance(i, str)]
        todo += [i for i in reversed(x.items) if isinstance(i, Node)]
    rules = sheet_rules("\n".join(css)) if css else []
    if not any(hidden for *_, hidden in rules):
        return
    for x in nodes:
        own = {f".{c}" for c in x.attrs.get("class", "").split()} | ({f"#{x.attrs['id']}"} if x.attrs.get("id") else set())
        fits = [hidden for tag, marks, hidden in rules if (not tag or tag == x.tag) and marks <= own]
        if fits and fits[-1] and not SHOWN.search(x.attrs.get("style", "")):
            x.attrs["hidden"] = ""


def width(text: str) -> int:
    """Columns that a text takes on a fixed-width page."""
    return len(text) if text.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Page:
    """Lines of text; blocks ask for line ends and blank lines, which merge."""

    def __init__(self):
        self.lines: list[str] = []
        self.line = ""
        self.gap = False  # a space is due before the next word
        self.blank = False

    def text(self, s: str) -> None:
        s = _entities.unescape(s) if "&" in s else s
        words = SPACES.sub(" ", s)
        if words == " " or not words:
            self.gap = self.gap or bool(words)
            return
        if self.line and (self.gap or words[0] == " "):
            self.line += " "
        self.line += words.strip(" ")
        self.gap = words[-1] == " "

    def verbatim(self, s: str) -> None:
        s = (_entities.unescape(s) if "&" in s else s).replace("\r\n", "\n").replace("\r", "\n").expandtabs(8)
        first, *rest = s.split("\n")
        self.line += first
        for x in rest:
            self.end(True)
            self.line = x

    def end(self, keep: bool = False) -> None:
        if self.line or keep:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.lines.append(self.line.rstrip(" "))
        self.line, self.gap = "", False

    def apart(self) -> None:
        self.end()
        self.blank = True

    def done(self) -> list[str]:
        self.end()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        while self.lines and not self.lines[0]:
            self.lines.pop(0)
        return self.lines


def indented(page: Page, lines: list[str], first: str, rest: str) -> None:
    page.end()
    for i, x in enumerate(lines):
        page.line = (first if i == 0 else rest) + x if x or i == 0 else ""
        page.end(True)


def rendered(node: Node, pre: bool = False) -> list[str]:
    page = Page()
    emit(node, page, pre)
    return page.done()


def table(node: Node, page: Page) -> None:
    """Rows of cells; a column is as wide as its widest line, spans widen no column.

    A cell that spans rows stands in its first one and keeps its columns free in the others."""
    rows: list[list[tuple[int, int, list[str]]]] = []
    loose: list[Node] = []

    def walk(x: Node) -> None:
        row: list[tuple[int, int, list[str]]] | None = None
        for item in x.items:
            if isinstance(item, str):
                if item.strip():
                    loose.append(Node("span", {}))
                    loose[-1].items.append(item)
            elif item.hidden():
                continue
            elif item.tag in ("thead", "tbody", "tfoot"):
                walk(item)
            elif item.tag == "tr":
                rows.append([])
                cells(item, rows[-1])
            elif item.tag in ("td", "th"):  # a row is implied
                if row is None:
                    rows.append(row := [])
                add(item, row)
            elif item.tag not in ("col", "colgroup"):
                loose.append(item)

    def cells(tr: Node, row: list) -> None:
        for item in tr.items:
            if isinstance(item, str):
                if item.strip():
                    loose.append(Node("span", {}))
                    loose[-1].items.append(item)
            elif not item.hidden():
                add(item, row) if item.tag in ("td", "th") else loose.append(item)

    def add(cell: Node, row: list) -> None:
        row.append((max(1, spanned(cell, "colspan")), spanned(cell, "rowspan") or 1000, rendered(cell)))

    def spanned(cell: Node, name: str) -> int:
        value = cell.attrs.get(name, "1").strip()
        return min(int(value), 1000) if value.isascii() and value.isdigit() else 1

    walk(node)
    for item in loose:  # captions, and what HTML moves out of a table
        emit(item, page, False) if item.tag == "span" else block(item, page, False)
    page.end()
    widths: list[int] = []
    placed: list[list[tuple[int, list[str]]]] = []
    taken: dict[int, int] = {}  # columns that cells of earlier rows still take, and for how many rows
    for row in rows:
        at, below = 0, {}
        placed.append([])
        for across, down, lines in row:
            while taken.get(at):
                at += 1
            placed[-1].append((at, lines))
            below |= dict.fromkeys(range(at, at + across), down - 1) if down > 1 else {}
            widths += [0] * (at + across - len(widths))
            if across == 1:
                widths[at] = max([widths[at], *map(width, lines)])
            at += across
        taken = {c: n - 1 for c, n in taken.items() if n > 1} | below
    start = [2 * c + x for c, x in enumerate(accumulate(widths, initial=0))]
    for row in placed:
        for k in range(max([len(lines) for _, lines in row], default=0)):
            out, least = "", 0
            for at, lines in row:
                if cell := lines[k] if k < len(lines) else "":
                    out += " " * (max(start[at], least) - width(out)) + cell
                    least = width(out) + 2
            page.line = out
            page.end()


def block(node: Node, page: Page, pre: bool) -> None:
    """One element, hidden or not."""
    if node.hidden():
        return
    tag = node.tag
    if (style := node.attrs.get("style")) and (kept := WHITE_SPACE.search(style)):
        pre = kept[1].lower() in ("pre", "pre-wrap", "break-spaces")
    if node.deep:
        flat(node, page, pre)
    elif node.foreign:
        drawn(node, page, pre)
    elif tag == "br":
        page.end(True)
    elif tag == "hr":
        page.apart()
    elif tag == "img":
        if alt := node.attrs.get("alt"):
            page.text(alt)
    elif tag == "input":
        if node.attrs.get("type", "").lower() in ("submit", "button", "reset") and node.attrs.get("value"):
            page.text(node.attrs["value"])
    elif tag in ("ul", "ol", "menu", "dir"):
        nested = page.line or pre
        page.end() if nested else page.apart()
        start = node.attrs.get("start", "1")
        n = int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1
        for item in node.items:
            if isinstance(item, Node) and item.tag == "li":
                if item.hidden():
                    continue
                value = item.attrs.get("value", "")
                n = int(value) if tag == "ol" and re.fullmatch(r"-?[0-9]{1,9}", value) else n
                mark = f"{n}. " if tag == "ol" else "- "
                lines = rendered(item)
                if lines:
                    indented(page, lines, mark, " " * len(mark))
                n += 1
            elif isinstance(item, str):
                page.text(item)
            else:
                block(item, page, pre)
        page.end() if nested else page.apart()
    elif tag == "table":
        page.apart()
        table(node, page)
        page.apart()
    elif tag in ("blockquote", "dd"):
        (page.apart if tag == "blockquote" else page.end)()
        indented(page, rendered(node), "    " if tag == "dd" else "> ", "    " if tag == "dd" else "> ")
        (page.apart if tag == "blockquote" else page.end)()
    elif tag == "pre":
        page.apart()
        emit(node, page, True)
        page.apart()
    elif tag == "textarea":
        page.end()
        emit(node, page, True)
        page.end()
    elif tag in ("td", "th"):  # outside a table
        page.text(" ")
        emit(node, page, pre)
        page.text(" ")
    elif tag in PARAGRAPH:
        page.apart()
        emit(node, page, pre)
        page.apart()
    elif tag in BLOCK:
        page.end()
        emit(node, page, pre)
        page.end()
    else:
        emit(node, page, pre)


def drawn(node: Node, page: Page, pre: bool) -> None:
    """An element of svg or math: a label or matrix row is a line, parts of a formula that don't run on get spaces."""
    if node.tag in ("text", "mtable", "mtr", "mlabeledtr", "foreignobject"):
        page.end()
    apart = node.tag in SPACED
    if node.tag == "tspan" and node.attrs.keys() & {"x", "y", "dx", "dy"}:
        page.text(" ")
    for item in node.items:
        if isinstance(item, Node):
            if apart and not item.hidden():
                page.text(" ")
            block(item, page, pre)
        else:
            page.verbatim(item) if pre else page.text(item)
    if apart:
        page.text(" ")
    if node.tag in ("text", "mtable", "mtr", "mlabeledtr", "foreignobject"):
        page.end()


def flat(node: Node, page: Page, pre: bool) -> None:
    """Text and line ends of a visible element at any depth, without recursion."""
    todo: list[tuple[Node | str | None, bool]] = [(node, pre)]
    while todo:
        x, pre = todo.pop()
        if x is None:
            page.end()
        elif isinstance(x, str):
            page.verbatim(x) if pre else page.text(x)
        elif x.hidden():
            continue
        elif x.tag in ("br", "img", "input") and not x.foreign:
            block(Node(x.tag, x.attrs), page, pre)
        else:
            if own_line := x.tag in (BLOCK if not x.foreign else ("text", "mtable", "mtr", "mlabeledtr", "foreignobject")):
                page.end()
                todo.append((None, pre))
            inner = pre or x.tag in ("pre", "textarea")
            spaced = not own_line and (x.tag in ("td", "th", "tspan") or x.foreign) or x.tag in SPACED
            for item in reversed(x.items):
                todo += [(" ", False), (item, inner), (" ", False)] if spaced and not isinstance(item, str) else [(item, inner)]
            if x.tag in ("td", "th"):
                todo.append((" ", False))


def emit(node: Node, page: Page, pre: bool) -> None:
    for item in node.items:
        if isinstance(item, Node):
            block(item, page, pre)
        elif pre:
            page.verbatim(item)
        else:
            page.text(item)


def to_text(source: str | None) -> str:
    """Visible text of a page, lines joined by \\n."""
    if not source:
        return ""
    root = build(source)
    if "<style" in source or "<STYLE" in source:
        apply_sheets(root)
    return "\n".join(rendered(root))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every page."""

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                yield {"page_id": part.column("page_id"), "url": part.column("url"), "text": [to_text(x) for x in part.column("html").to_pylist()]}

    return map_arrow(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string")
