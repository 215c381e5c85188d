"""HTML as a reader sees it: a tree with implied tags, visibility rules, and a text layout."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from html import unescape

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HEAD = frozenset("base link meta noscript script style template title".split())
UNSEEN = frozenset(
    "area audio base canvas col colgroup datalist embed head iframe link meta noembed noframes noscript object param script source style svg template title track video".split()
)
SPACED = frozenset("blockquote dl fieldset figure form h1 h2 h3 h4 h5 h6 hr ol p pre table ul xmp".split())
BLOCK = SPACED | frozenset(
    "address article aside body caption center dd details dialog dir div dt figcaption footer header hgroup html legend li main menu nav option optgroup search section select summary tbody td tfoot th thead tr".split()
)
#: A start tag closes these if they are open, up to the barrier.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
    "th": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
}
CLOSES["thead"] = CLOSES["tfoot"] = CLOSES["tbody"]
TABLE = frozenset("table tr tbody thead tfoot td th caption".split())
WALLS = frozenset("table td th caption button object template html body".split())
CLOSES_P = BLOCK - frozenset("td th tr tbody thead tfoot caption option optgroup body html legend summary select".split())
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
BEFORE = re.compile(r"[\s/]*")
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(\s*=\s*)?")
UNQUOTED = re.compile(r"[^\s>]*")
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
STRING = re.compile(r"""\"[^"\n]*\"|'[^'\n]*'""")
BRACE = re.compile(r"[{};]")
DISPLAY = re.compile(r"(?<![\w-])display\s*:\s*([a-z][a-z -]*[a-z])\s*(!\s*important)?\s*(?:;|\Z)", re.I)
#: Values of ``display``; others are no declaration.
VALUES = frozenset(
    "none block inline inline-block flex inline-flex grid inline-grid flow-root flow contents list-item table inline-table table-row table-cell table-caption table-column table-column-group table-row-group table-header-group table-footer-group ruby ruby-text ruby-base run-in initial inherit unset revert revert-layer math".split()
)
#: The screen that media queries are asked about: pixels, and words that hold on it.
SCREEN = {"width": 1280.0, "height": 800.0}
FEATURES = frozenset(
    "color hover:hover any-hover:hover pointer:fine any-pointer:fine hover any-hover pointer any-pointer orientation:landscape prefers-color-scheme:light prefers-reduced-motion:no-preference prefers-contrast:no-preference scripting:enabled update:fast update overflow-block:scroll display-mode:browser grid:0 width height".split()
)
LENGTH = re.compile(r"([\d.]+)\s*(px|r?em)?\Z")
UNITS = {"em": 16, "rem": 16}
VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
SIMPLE = re.compile(r"[.#]?[\w-]+\Z")
BLANKS = re.compile(r"[ \t\n\r\f]+")
#: Widest column that other rows are aligned with, largest span, and depth of tables within tables.
COLUMN, SPAN, DEPTH = 40, 1000, 20


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


class Open:
    """The open elements, and how many there are of each tag."""

    def __init__(self, root: Node):
        self.nodes, self.count = [root], Counter({root.tag: 1})

    def __getitem__(self, i: int) -> Node:
        return self.nodes[i]

    def push(self, node: Node) -> None:
        self.nodes.append(node)
        self.count[node.tag] += 1

    def cut(self, i: int) -> None:
        self.count.subtract(x.tag for x in self.nodes[i:])
        del self.nodes[i:]

    def shut(self, tags, walls, once: bool) -> None:
        """Closes the nearest open element of ``tags``, or all of them, below the nearest of ``walls``."""
        if not any(self.count[t] for t in tags):
            return
        for i in range(len(self.nodes) - 1, 0, -1):
            if self.nodes[i].tag in tags:
                self.cut(i)
                if once:
                    return
            elif self.nodes[i].tag in walls:
                return


def _attributes(html: str, at: int, unclosed: set[str]) -> tuple[int, dict[str, str]]:
    """Place of the tag's ``>`` and its attributes. A quote opens a value only where one begins, after ``=``;
    there, too, one that never closes is an ordinary character."""
    out: dict[str, str] = {}
    while True:
        at = BEFORE.match(html, at).end()
        m = ATTRIBUTE.match(html, at)
        if not m:
            return (at if at < len(html) else -1), out
        at, value = m.end(), ""
        if m.group(2):
            quote, close = html[at : at + 1], -1
            if quote in ('"', "'") and quote not in unclosed:
                close = html.find(quote, at + 1)
                if close < 0:
                    unclosed.add(quote)
            if close >= 0:
                value, at = html[at + 1 : close], close + 1
            else:
                value = UNQUOTED.match(html, at).group()
                at += len(value)
        out.setdefault(m.group(1).lower(), unescape(value) if "&" in value else value)


def parse(html: str) -> tuple[Node, str, list[str]]:
    """The tree, the title and the style sheets."""
    root = Node("html", {})
    stack, title, styles = Open(root), "", []
    at, n, unclosed = 0, len(html), set()
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            text = html[at:lt]
            if stack[-1].tag == "head" and not text.isspace():
                stack.cut(-1)
            stack[-1].children.append(unescape(text) if "&" in text else text)
            at = lt
            continue
        follow = html[at + 1 : at + 2]
        if follow in ("!", "?") or (follow == "/" and not html[at + 2 : at + 3].isalpha()):
            end = html.find("-->", at + 4) + 2 if html.startswith("<!--", at) else html.find(">", at)
            if end < 2:
                end = n
            at = end + 1
            continue
        if not (follow.isalpha() and follow.isascii()) and follow != "/":
            stack[-1].children.append("<")
            at += 1
            continue
        start = at + 1 + (follow == "/")
        name = NAME.match(html, start)
        if not name:
            stack[-1].children.append("<")
            at += 1
            continue
        end, attrs = _attributes(html, name.end(), unclosed)
        if end < 0:
            break  # a tag that never ends shows nothing
        tag = name.group().lower()
        at = end + 1
        if follow == "/":
            _close(stack, tag)
            continue
        node = Node(tag, attrs)
        _open(stack, tag)
        if tag == "html":
            continue
        if tag == "body" and stack.count["body"]:
            continue
        stack[-1].children.append(node)
        if tag in RAW:
            m = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            stop = m.start() if m else n
            body = html[at:stop]
            if tag == "title":
                title = title or BLANKS.sub(" ", unescape(body)).strip()
            elif tag == "style" and on_screen(attrs.get("media", "")):
                styles.append(body)
            node.children.append(unescape(body) if tag == "textarea" else body)
            at = n if not m else (html.find(">", stop) + 1 or n)
        elif tag not in VOID:
            stack.push(node)
    return root, title, styles


def _open(stack: Open, tag: str) -> None:
    """Closes what ``tag`` ends implicitly and opens what it needs."""
    if stack[-1].tag == "head" and tag not in HEAD:
        stack.cut(-1)
    if tag in CLOSES:
        shut, walls = CLOSES[tag]
        stack.shut(shut, walls, tag in ("li", "dt", "dd", "option"))
    if tag in CLOSES_P:
        stack.shut(("p",), WALLS, True)
    if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
        row = Node("tr", {})
        stack[-1].children.append(row)
        stack.push(row)


def _close(stack: Open, tag: str) -> None:
    if tag in ("html", "body"):
        return
    if not stack.count[tag]:
        if tag in ("p", "br"):
            stack[-1].children.append(Node(tag, {}))
        return
    for i in range(len(stack.nodes) - 1, 0, -1):
        if stack[i].tag == tag:
            stack.cut(i)
            return
        if stack[i].tag in ("td", "th", "table") and tag not in TABLE:
            return


def _pixels(text: str) -> float | None:
    m = LENGTH.match(text.strip())
    try:
        return float(m.group(1)) * UNITS.get(m.group(2), 1) if m else None
    except ValueError:
        return None


def _feature(text: str) -> bool:
    """Whether a media feature, without its brackets, holds on a normal screen; unknown ones do not."""
    text = text.strip()
    parts = re.split(r"(<=|>=|<|>|=)", text)
    if len(parts) > 1:
        values = [SCREEN.get(x.strip(), _pixels(x)) for x in parts[::2]]
        if None in values:
            return False
        compare = {"<": float.__lt__, "<=": float.__le__, ">": float.__gt__, ">=": float.__ge__, "=": float.__eq__}
        return all(compare[op](x, y) for x, op, y in zip(values, parts[1::2], values[1:]))
    name, _, value = (x.strip() for x in text.partition(":"))
    side, _, size = name.partition("-")
    if side in ("min", "max") and size in SCREEN:
        limit = _pixels(value)
        return limit is not None and (SCREEN[size] >= limit if side == "min" else SCREEN[size] <= limit)
    return (f"{name}:{value}" if value else name) in FEATURES


def _condition(text: str) -> bool:
    """A media condition: types and bracketed features joined by and, or, not."""
    text = text.strip()
    tokens, depth, start = [], 0, 0
    for i, c in enumerate(text):
        if c == "(":
            if not depth:
                tokens += text[start:i].split()
                start = i
            depth += 1
        elif c == ")" and depth:
            depth -= 1
            if not depth:
                tokens.append(text[start : i + 1])
                start = i + 1
    tokens += text[start:].split()
    if tokens[:1] == ["not"]:
        return not _condition(" ".join(tokens[1:]))
    for word, joined in (("or", any), ("and", all)):
        if word in tokens:
            parts: list[list[str]] = [[]]
            for t in tokens:
                parts.append([]) if t == word else parts[-1].append(t)
            return joined([_condition(" ".join(x)) for x in parts])
    if tokens[:1] == ["only"]:
        tokens = tokens[1:]
    if len(tokens) != 1:
        return False
    if tokens[0][0] != "(":
        return tokens[0] in ("all", "screen")
    inside = tokens[0][1:].removesuffix(")").strip()
    return _condition(inside) if "(" in inside or inside.startswith("not ") else _feature(inside)


def on_screen(media: str) -> bool:
    """Whether a list of media queries applies to a normal screen."""
    return not media.strip() or any(_condition(x) for x in media.lower().split(","))


def _rules(sheet: str, layered: bool = False) -> Iterator[tuple[str, str, bool]]:
    """(selectors, declarations, whether in a layer) of the rules that apply, in order."""
    # (what applies, selectors or None for a block of rules, layer, declarations) of the open blocks
    open_blocks: list[tuple[bool, str | None, bool, list[str]]] = [(True, None, layered, [])]
    at = 0
    for m in [*BRACE.finditer(sheet), None]:
        text = BLANKS.sub(" ", sheet[at : m.start() if m else len(sheet)]).strip()
        at = m.end() if m else len(sheet)
        applies, selectors, layer, body = open_blocks[-1]
        mark = m.group() if m else "}"
        if mark == "{":
            if selectors is not None:
                open_blocks.append((False, "", layer, []))  # a rule within a rule
            elif text.startswith("@"):
                name, _, rest = text[1:].partition(" ") if " " in text else (text[1:].partition("(")[0], "", text[text.find("(") :])
                name, bracket, more = name.partition("(")
                rest, name = bracket + more + " " + rest if bracket else rest, name.lower()
                fits = name == "layer" or (name == "media" and on_screen(rest)) or (name == "supports" and not rest.strip().lower().startswith("not"))
                open_blocks.append((applies and fits, None, layer or name == "layer", []))
            else:
                open_blocks.append((applies, text, layer, []))
            continue
        if selectors is not None:
            body.append(text)
        if mark == "}" and len(open_blocks) > 1:
            open_blocks.pop()
            if applies and selectors:
                yield selectors, ";".join(body), layer
    for applies, selectors, layer, body in open_blocks:
        if applies and selectors:  # the sheet ends within a rule
            yield selectors, ";".join(body), layer


def _display(declarations: str) -> tuple[bool, bool] | None:
    """(important, shown) by the declaration of ``display`` that holds."""
    found = [(bool(m.group(2)), m.group(1).lower() != "none") for m in DISPLAY.finditer(declarations) if set(m.group(1).lower().split()) <= VALUES]
    return max(enumerate(found), key=lambda x: (x[1][0], x[0]))[1] if found else None


def hidden_selectors(styles: list[str]) -> dict[str, tuple[tuple, bool]]:
    """Tags, classes and ids whose display a simple rule sets: the rule's rank and whether it shows them."""
    out: dict[str, tuple[tuple, bool]] = {}
    order = 0
    for sheet in styles:
        for selectors, body, layer in _rules(STRING.sub('""', COMMENT.sub(" ", sheet))):
            found = _display(body) if "isplay" in body or "ISPLAY" in body else None
            if not found:
                continue
            order += 1
            important, shown = found
            for s in selectors.split(","):
                name = s.strip().lower()
                if SIMPLE.match(name):
                    # Among important rules, those in layers come first; among others, last.
                    rank = (important, layer == important, {"#": 2, ".": 1}.get(name[0], 0), order)
                    out[name] = max(out.get(name, (rank, shown)), (rank, shown))
    return out


def _shown(node: Node, hidden: dict[str, tuple[tuple, bool]]) -> bool:
    a = node.attrs
    if node.tag in UNSEEN:
        return False
    found = [hidden[node.tag]] if node.tag in hidden else []
    if a:
        if node.tag == "input" and a.get("type", "").lower() == "hidden":
            return False
        if hidden:
            found += [hidden[k] for c in a.get("class", "").split() if (k := "." + c.lower()) in hidden]
            if "id" in a and (k := "#" + a["id"].lower()) in hidden:
                found.append(hidden[k])
        if "style" in a and (own := _display(COMMENT.sub(" ", a["style"]))):
            # An inline value ranks above every rule of its importance.
            found.append(((own[0], True, 3, 0), own[1]))
    if found:
        return max(found)[1]
    return "hidden" not in a and (node.tag != "dialog" or "open" in a)


class Layout:
    """Lines of text; breaks between blocks collapse to the largest asked for."""

    def __init__(self):
        self.out: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.breaks = 0
        self.mark = ""

    def text(self, value: str) -> None:
        first = value[0] in " \t\n\r\f"
        words = BLANKS.sub(" ", value).strip(" ")
        if not words:
            self.space = self.space or first
            return
        if (first or self.space) and self.line:
            self.line.append(" ")
        self._start()
        self.line.append(words)
        self.space = value[-1] in " \t\n\r\f"

    def verbatim(self, value: str) -> None:
        rows = value.expandtabs(8).replace("\r\n", "\n").split("\n")
        for i, row in enumerate(rows):
            if i:
                self.newline()
            if row:
                self._start()
                self.line.append(row)

    def _start(self) -> None:
        if not self.line:
            if self.out and self.breaks > 1:
                self.out.append("")
            self.breaks = 0
            if self.mark:
                self.line.append(self.mark)
                self.mark = ""

    def end_line(self) -> None:
        if self.line:
            self.out.append("".join(self.line).rstrip())
            self.line = []
        self.space = False

    def newline(self) -> None:
        if self.line:
            self.end_line()
        elif self.out:
            self.breaks = 0
            self.out.append("")

    def block(self, size: int) -> None:
        self.end_line()
        self.breaks = max(self.breaks, size)

    def lines(self, rows: list[str]) -> None:
        for row in rows:
            self._start()
            self.line.append(row)
            self.end_line()

    def result(self) -> list[str]:
        self.end_line()
        while self.out and not self.out[-1].strip():
            self.out.pop()
        return self.out


def _width(text: str) -> int:
    return len(text) if text.isascii() else sum(0 if unicodedata.combining(c) else 1 + (unicodedata.east_asian_width(c) in "WF") for c in text)


def lay_out(top: Node, hidden: dict[str, tuple[tuple, bool]], depth: int = 0) -> list[str]:
    out = Layout()
    # (node or text or closing action, inherited state: visible, pre, list depth)
    stack: list[tuple] = [(child, True, False, 0) for child in reversed(top.children)]
    counters: list[int | None] = []
    while stack:
        item, seen, pre, nested = stack.pop()
        if isinstance(item, str):
            if seen and item:
                out.verbatim(item) if pre else out.text(item)
            continue
        if isinstance(item, tuple):  # the end of an element
            tag, size, was_list = item
            if was_list:
                counters.pop()
            if tag == "li":
                out.mark = ""
            if size:
                out.block(size)
            continue
        tag = item.tag
        if not _shown(item, hidden):
            continue
        if "style" in item.attrs and (v := VISIBILITY.search(item.attrs["style"])):
            seen = v.group(1).lower() == "visible"
        if tag == "br":
            out.newline()
            continue
        if tag == "hr":
            out.block(2)
            continue
        if tag == "img":
            continue
        if tag == "table" and depth < DEPTH:
            out.block(2)
            if seen:
                out.lines(_table(item, hidden, depth))
            out.block(2)
            continue
        size = 2 if tag in SPACED else 1 if tag in BLOCK else 0
        listing = tag in ("ul", "ol", "menu", "dir")
        if listing and nested:
            size = 1
        if size:
            out.block(size)
        if tag == "li":
            number = counters[-1] if counters else None
            if number is not None:
                value = item.attrs.get("value", "")
                number = int(value) if re.fullmatch(r"-?\d{1,9}", value) else number
                counters[-1] = number + 1
            out.mark = "  " * max(0, nested - 1) + ("- " if number is None else f"{number}. ")
        elif tag == "dd":
            out.mark = out.mark or "  "
        elif tag == "q" and seen:
            out.text('"')
        stack.append(((tag, size, listing), seen, pre, nested))
        if listing:
            start = item.attrs.get("start", "")
            counters.append((int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1) if tag == "ol" else None)
        children = item.children
        if tag == "details" and "open" not in item.attrs:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        pre_here = pre or tag in ("pre", "textarea", "xmp")
        if pre_here and not pre and children and isinstance(children[0], str):
            children = [re.sub(r"\A\r?\n", "", children[0]), *children[1:]]
        stack += [(child, seen, pre_here, nested + listing) for child in reversed(children)]
    return out.result()


def _rows(table: Node, hidden: dict[str, tuple[tuple, bool]]):
    """(captions, rows of cells, what else stands in the table) in the order of the page."""
    captions, rows, other = [], [], []
    stack = list(reversed(table.children))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            if x.strip():
                other.append(x)
        elif not _shown(x, hidden):
            continue
        elif x.tag == "caption":
            captions.append(x)
        elif x.tag == "tr":
            rows.append([c for c in x.children if isinstance(c, Node) and c.tag in ("td", "th") and _shown(c, hidden)])
            other += [c for c in x.children if not (isinstance(c, Node) and c.tag in ("td", "th")) and not (isinstance(c, str) and not c.strip())]
        elif x.tag in ("tbody", "thead", "tfoot"):
            stack += reversed(x.children)
        else:
            other.append(x)
    return captions, rows, other


def _span(cell: Node, name: str) -> int:
    value = cell.attrs.get(name, "")
    return max(1, min(SPAN, int(value))) if re.fullmatch(r"\d{1,9}", value) else 1


def _table(table: Node, hidden: dict[str, tuple[tuple, bool]], depth: int) -> list[str]:
    """The table's lines: what browsers put before it, captions, then rows with aligned columns."""
    captions, rows, other = _rows(table, hidden)
    before = Node("div", {})
    before.children = [*other, *captions]
    lines = lay_out(before, hidden, depth + 1)
    taken: dict[int, int] = {}  # column -> rows that a cell from above still reaches
    laid = []
    for row in rows:
        column, cells, reaching = 0, [], {}
        for cell in row:
            while taken.get(column, 0) > 0:
                column += 1
            wide, tall = _span(cell, "colspan"), _span(cell, "rowspan")
            text = lay_out(cell, hidden, depth + 1)
            cells.append((column, wide, text))
            if tall > 1:
                reaching.update(dict.fromkeys(range(column, column + wide), tall - 1))
            column += wide
        taken = {c: k - 1 for c, k in taken.items() if k > 1} | reaching
        laid.append(cells)
    widths: dict[int, int] = {}
    for cells in laid:
        for column, wide, text in cells:
            if wide == 1 and text:
                widths[column] = max(widths.get(column, 0), min(COLUMN, max(map(_width, text))))
    starts, at = {}, 0
    for column in range(max(widths, default=-1) + 2):
        starts[column] = at
        at += widths[column] + 2 if column in widths else 0
    for cells in laid:
        for i in range(max((len(text) for _, _, text in cells), default=0)):
            line, used = [], 0
            for column, _, text in cells:
                if i < len(text) and text[i]:
                    gap = max(starts.get(column, used), used + 2 if used else 0) - used
                    line.append(" " * gap + text[i])
                    used += gap + _width(text[i])
            lines.append("".join(line))
    return lines


def visible_text(html: str) -> tuple[str, str]:
    """(title, text as laid out)."""
    root, title, styles = parse(html)
    return title, "\n".join(lay_out(root, hidden_selectors(styles)))
