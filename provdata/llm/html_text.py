"""HTML extraction by layout-aware rendering.

A page's tags build a tree: void elements take no children, an element whose end tag may be left out is
closed by what cannot stand inside it, and an end tag closes the nearest open element of its name
within the same table cell or table. Visibility follows: elements that are never drawn, ``hidden``, closed
``details`` and ``dialog``, and ``display`` and ``visibility`` of inline styles and of the page's own style rules, by
importance, specificity and order, those for other media than a ``VIEWPORT`` wide screen left out. What is left is all
drawn: blocks on lines of their own with blank lines where the layout has margins, list items behind
their markers and indented by depth, table cells on a grid of rows and columns (spans of both kinds) padded to
common columns, lists and paragraphs in a cell on lines of its row, form controls apart, ``pre`` as it stands.

Style rules are read whose selectors name one element by tag, classes and id; those with combinators or
pseudo-classes are not applied. Labels of buttons are text, what is typed into fields is not.

Pages are independent, so this is a map without a shuffle, 256 pages in memory at a time. The tree is
walked with an explicit stack, so depth is no limit. Padding stays in proportion to the page: a cell wider than
``most_width`` does not widen its column, a table wider than eight such columns is not padded, and a row of more
than ``MOST_LINES`` lines (a page laid out by a table) is drawn cell after cell.

Defined results: a null page gives a null text, an empty one or one without visible text an empty text;
broken markup is read as far as it goes; a very long page is drawn whole; equal rows give equal texts; a null id
stays null; other columns, whatever their names, are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names and their roles in HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NEVER_DRAWN = frozenset("head title script style template noscript meta link base datalist iframe object audio video "
                         "canvas defs symbol desc metadata clippath annotation annotation-xml map colgroup col area param source track rp noframes".split())
_SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr fieldset".split())
_BLOCKS = _SPACED | frozenset("html body div section article aside nav header footer main address form li dt dd tr caption "
                              "thead tbody tfoot details summary dialog figcaption hgroup legend center menu dir "
                              "search optgroup option".split())
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                      "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul li dd dt "
                      "summary".split())
#: What a start tag closes, and the elements beyond which it closes nothing.
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, {"body"}), "rt": ({"rt", "rp"}, {"ruby"}), "rp": ({"rt", "rp"}, {"ruby"}),
}
_LABELLED = frozenset("submit button reset".split())
_CONTROLS = frozenset("button textarea select input".split())
_SCOPES = frozenset("table td th caption template html object button".split())
_SPACE = re.compile(r"[ \t\n\r\f]+")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)|<!--|-->", re.S)
_QUOTED = re.compile(r"\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'", re.S)
_PIECE = re.compile(r"([^{};]*)([{};])")
_SIMPLE = re.compile(r"([a-z][\w-]*|\*)?((?:[.#][\w-]+)*)", re.I)
_WIDTH = re.compile(r"\(\s*(min|max)-width\s*:\s*([0-9.]+)(px|r?em)\s*\)")
#: Width in pixels of the screen that pages are drawn for, and lines of a table row that are still aligned.
VIEWPORT = 1280
MOST_LINES = 30


@dataclass
class Node:
    tag: str
    attrs: dict[str, str | None] = field(default_factory=dict)
    children: list = field(default_factory=list)


class TreeBuilder(HTMLParser):
    """Builds the tree; children are nodes and strings."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]
        self.paragraph = [0]  # of each open element, the depth of the open p that a block in it would close
        self.count: Counter[str] = Counter()
        self.styles: list[str] = []

    def _close_to(self, depth: int) -> None:
        self.count.subtract(n.tag for n in self.open[depth:])
        del self.open[depth:], self.paragraph[depth:]

    def _push(self, node: Node) -> None:
        self.open.append(node)
        self.count[node.tag] += 1
        self.paragraph.append(len(self.open) - 1 if node.tag == "p" else 0 if node.tag in _SCOPES else self.paragraph[-1])

    def _close_implied(self, tag: str) -> None:
        if tag in _CLOSES_P and self.paragraph[-1]:
            self._close_to(self.paragraph[-1])
        closed, fence = _IMPLIED.get(tag, ((), ()))
        if any(self.count[name] for name in closed):
            cut = None
            for depth in range(len(self.open) - 1, 0, -1):
                name = self.open[depth].tag
                if name in fence or (name in _SCOPES and name not in closed):
                    break
                if name in closed:
                    cut = depth
            if cut is not None:
                self._close_to(cut)

    def handle_starttag(self, tag, attrs):
        if tag == "html" or tag == "body" and self.count["body"]:
            return
        if self.open[-1].tag == "head" and tag not in _NEVER_DRAWN:
            self._close_to(len(self.open) - 1)
        self._close_implied(tag)
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self._push(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag):
        if tag == "br":
            self.open[-1].children.append(Node("br"))
        if not self.count[tag]:
            return
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.open[depth].tag
            if name == tag:
                self._close_to(depth)
                return
            if name in _SCOPES and tag not in ("table", "tr", "thead", "tbody", "tfoot", "body", "html"):
                return
            if name == "table" and tag != "table":
                return

    def handle_data(self, data):
        if self.open[-1].tag == "style":
            media = self.open[-1].attrs.get("media")
            self.styles.append(f"@media {media}{{{data}}}" if media else data)
        if self.open[-1].tag == "head" and data.strip():
            self._close_to(len(self.open) - 1)
        self.open[-1].children.append(data)

    def parse_html_declaration(self, i):
        """``<![`` begins no section in HTML, but a comment up to the next ``>``."""
        return self.parse_bogus_comment(i) if self.rawdata.startswith("<![", i) else super().parse_html_declaration(i)


def on_screen(media: str) -> bool:
    """Whether a media query list holds for the screen; features other than its width count as not held."""
    def holds(query: str) -> bool:
        query = query.strip().lower()
        turned = query.startswith("not ")
        widths = _WIDTH.findall(query)
        words_ = re.sub(r"^(not|only)\s+", "", _WIDTH.sub(" ", query)).split()
        fits = all(w in ("screen", "all", "and") for w in words_) and all(
            (VIEWPORT >= float(n) * (1 if unit == "px" else 16)) if end == "min" else
            (VIEWPORT <= float(n) * (1 if unit == "px" else 16)) for end, n, unit in widths)
        return fits != turned
    return not media.strip() or any(holds(q) for q in media.split(","))


def declared(text: str) -> dict[str, tuple[bool, str]]:
    """``display`` and ``visibility`` of declarations, each with whether it is important."""
    found: dict[str, tuple[bool, str]] = {}
    for declaration in text.split(";"):
        name, _, value = declaration.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        if name in ("display", "visibility") and value:
            plain = value.removesuffix("important").rstrip().removesuffix("!").rstrip() if value.endswith("important") else value
            own = (plain != value, plain)
            if not found.get(name, own)[0] or own[0]:
                found[name] = own
    return found


_NOTHING: dict[str, str] = {}


class Visibility:
    """``display`` and ``visibility`` of elements by their names, attributes and the page's style rules."""

    def __init__(self, styles: list[str]):
        self.rules: dict[str, list] = {}  # under the last part of the selector that an element must have
        self.known: dict[tuple, dict[str, str]] = {}
        self.order = 0
        css = _QUOTED.sub("", _COMMENT.sub(" ", " ".join(styles)))
        blocks: list[tuple[str, str, bool]] = []  # kind, selectors, whether rules in it apply
        body = ""
        for text, mark in _PIECE.findall(css + "}}}"):
            kind, selectors, applies = blocks[-1] if blocks else ("group", "", True)
            if mark == "{":
                blocks.append(self._block(text.strip(), kind, applies))
                body = ""
            elif kind == "style":
                body += text + ";"
            if mark == "}" and blocks:
                blocks.pop()
                if kind == "style" and applies:
                    self._add(selectors, declared(body))
                body = ""

    @staticmethod
    def _block(prelude: str, outer: str, applies: bool) -> tuple[str, str, bool]:
        if outer != "group":
            return "other", "", False
        if not prelude.startswith("@"):
            return "style", prelude, applies
        name, _, rest = prelude[1:].partition(" ")
        if name.lower().partition("(")[0] == "media":
            return "group", "", applies and on_screen(name[5:] + " " + rest)
        return ("group" if name.lower() in ("supports", "layer") else "other"), "", applies

    def _add(self, selectors: str, found: dict[str, tuple[bool, str]]) -> None:
        self.order += 1
        for selector in selectors.split(",") if found else ():
            simple = _SIMPLE.fullmatch(selector.strip())
            if simple and simple[0]:
                tag, marks = (simple[1] or "*").lower(), re.findall(r"[.#][\w-]+", simple[2])
                rank = (sum(m[0] == "#" for m in marks), sum(m[0] == "." for m in marks), int(tag != "*"), self.order)
                self.rules.setdefault(marks[-1] if marks else tag, []).append((tag, frozenset(marks), rank, found))

    def styles(self, node: Node) -> dict[str, str]:
        """The values that hold for a node, by importance, inline before rules, specificity and order."""
        attrs = node.attrs
        if not self.rules and "style" not in attrs:
            return _NOTHING
        key = (node.tag, attrs.get("id"), attrs.get("class"), attrs.get("style"))
        if key not in self.known:
            marks = {"." + c for c in (key[2] or "").split()} | ({"#" + key[1]} if key[1] else set())
            best: dict[str, tuple] = {}
            asked = [(((1,) + rank), found) for at in ("*", node.tag, *marks) for tag, need, rank, found in self.rules.get(at, ())
                     if tag in ("*", node.tag) and need <= marks]
            if key[3]:
                asked.append(((2,), declared(key[3])))
            for rank, found in asked:
                for name, (important, value) in found.items():
                    best[name] = max(best.get(name, ((False, (0,)), "")), ((important, rank), value), key=lambda x: x[0])
            self.known[key] = {name: value for name, (_, value) in best.items()}
        return self.known[key]

    def laid_out(self, node: Node) -> bool:
        """Whether the element has a place at all."""
        if node.tag in _NEVER_DRAWN or node.tag == "input" and (node.attrs.get("type") or "").lower() not in _LABELLED:
            return False
        display = self.styles(node).get("display")
        if display is None:
            return not ("hidden" in node.attrs or node.tag == "dialog" and "open" not in node.attrs)
        return display != "none"

    def shown(self, node: Node, inherited: bool) -> bool:
        """Whether text right in it is seen; unlike ``display``, what a child says counts."""
        value = self.styles(node).get("visibility", "inherit")
        return value in ("visible", "initial") or inherited and value not in ("hidden", "collapse")


class _Lines:
    """Text under way: words join into a line, breaks collapse to the largest one asked for."""

    def __init__(self):
        self.out: list[str] = []
        self.breaks = 0
        self.space = False
        self.prefixes: list[str] = []
        self.marker = ""

    def break_(self, n: int) -> None:
        self.breaks, self.space = max(self.breaks, n), False

    def _begin(self) -> None:
        if self.breaks or not self.out:
            if self.out:
                self.out.append("\n" * self.breaks)
            lead = "".join(self.prefixes)
            if self.marker:
                lead = lead[:max(0, len(lead) - len(self.marker))] + self.marker
            self.out.append(lead)
            self.breaks, self.marker, self.space = 0, "", False

    def text(self, data: str) -> None:
        plain = _SPACE.sub(" ", data)
        if plain == " " or not plain:
            self.space |= bool(plain) and not self.breaks
            return
        fresh = bool(self.breaks) or not self.out
        self._begin()
        if (self.space or plain[0] == " ") and not fresh:
            self.out.append(" ")
        self.out.append(plain.strip(" "))
        self.space = plain[-1] == " "

    def gap(self) -> None:
        self.space |= bool(self.out) and not self.breaks

    def raw(self, data: str) -> None:
        for k, line in enumerate(data.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
            if k:
                self._begin()
                self.breaks += 1
            if line:
                apart = self.space and not self.breaks and bool(self.out)
                self._begin()
                self.out.append(" " + line if apart else line)
                self.space = False

    def done(self) -> str:
        return re.sub(r"[ \t]+$", "", "".join(self.out), flags=re.M)


def _number(value, default: int) -> int:
    try:
        return int(str(value).strip())
    except ValueError:
        return default


class Renderer:
    """Draws a tree; an explicit stack of things to do takes the place of recursion."""

    def __init__(self, visible: Visibility, most_width: int):
        self.visible, self.most_width = visible, most_width

    def _children(self, node: Node) -> list:
        if node.tag == "details" and "open" not in node.attrs:
            return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
        return node.children

    def render(self, root: Node) -> str:
        """A cell's text is drawn to lines of its own, inner tables first; they meet in its table."""
        lines = _Lines()
        todo: list[tuple] = [("visit", root, lines, False, True)]
        while todo:
            step, *rest = todo.pop()
            if step == "visit":
                self._visit(todo, *rest)
            elif step == "break":
                rest[0].break_(rest[1])
            elif step == "gap":
                rest[0].gap()
            elif step == "indent":
                rest[0].prefixes.append(rest[1])
                rest[0].marker = rest[2] or rest[0].marker
            elif step == "outdent":
                rest[0].prefixes.pop()
                rest[0].marker = ""
            elif step == "table":
                self._draw(*rest)
        return lines.done()

    def _visit(self, todo: list, node, lines: _Lines, pre: bool, shown: bool) -> None:
        if isinstance(node, str):
            if shown:
                (lines.raw if pre else lines.text)(node)
            return
        if not self.visible.laid_out(node):
            return
        shown = self.visible.shown(node, shown)
        tag = node.tag
        if tag == "br":
            if lines.breaks:
                lines.breaks += lines.breaks < 2
            else:
                lines.break_(1)
            return
        if tag == "table":
            self._table(todo, node, lines, pre, shown)
            return
        gap = 2 if tag in _SPACED else 1 if tag in _BLOCKS else 0
        if tag in ("ul", "ol", "menu", "dir") and any(lines.prefixes):
            gap = 1  # an inner list has no margins
        after: list[tuple] = [("break", lines, gap)] if gap else []
        before = list(after)
        if tag in _CONTROLS:
            before, after = [*before, ("gap", lines)], [("gap", lines), *after]
        if tag in ("ul", "ol", "menu", "dir"):
            position = _number(node.attrs.get("start"), 1)
            for child in node.children:
                if isinstance(child, Node) and child.tag == "li":
                    position = _number(child.attrs.get("value"), position)
                    child.attrs["#marker"] = f"{position}. " if tag == "ol" else "- "
                    position += 1
        if tag == "li" or tag in ("dd", "blockquote"):
            marker = (node.attrs.get("#marker") or "- ") if tag == "li" else ""
            before.append(("indent", lines, " " * (len(marker) or 4), marker))
            after.insert(0, ("outdent", lines))
        if tag == "hr":
            todo.extend([("break", lines, 2), ("visit", "----", lines, False, shown), ("break", lines, 2)])
            return
        pre = pre or tag in ("pre", "textarea", "listing", "xmp")
        todo.extend(reversed(after))
        drawn = [node.attrs.get("value") or ""] if tag == "input" else self._children(node)
        todo.extend(("visit", c, lines, pre, shown) for c in reversed(drawn))
        todo.extend(reversed(before))

    def _table(self, todo: list, table: Node, lines: _Lines, pre: bool, shown: bool) -> None:
        rows: list[tuple[int, list[tuple[_Lines, int, int]]]] = []  # group and cells: lines, colspan, rowspan
        captions, steps, walk, group = [], [], [(iter(table.children), shown)], 0
        while walk:  # rows may stand in groups, cells and text in the wrong places
            children, seen = walk[-1]
            for child in children:
                if isinstance(child, str):
                    if child.strip():
                        captions.append((child, seen))
                elif not self.visible.laid_out(child):
                    continue
                elif child.tag in ("thead", "tbody", "tfoot", "tr"):
                    if child.tag == "tr":
                        rows.append((group, []))
                    else:
                        group += 1
                    walk.append((iter(child.children), self.visible.shown(child, seen)))
                    break
                elif child.tag in ("td", "th"):
                    if not rows:
                        rows.append((group, []))
                    cell, own = _Lines(), self.visible.shown(child, seen)
                    down = _number(child.attrs.get("rowspan"), 1)
                    rows[-1][1].append((cell, max(1, min(1000, _number(child.attrs.get("colspan"), 1))),
                                        65_534 if down == 0 else max(1, min(65_534, down))))  # 0: to the group's end
                    steps.extend(("visit", c, cell, pre, own) for c in child.children)
                else:
                    captions.append((child, seen))
            else:
                walk.pop()
        todo.append(("break", lines, 2))
        todo.append(("table", rows, lines))
        todo.extend(reversed(steps))
        todo.append(("break", lines, 1))
        todo.extend(("visit", c, lines, pre, seen) for c, seen in reversed(captions))
        todo.append(("break", lines, 2))

    def _draw(self, rows: list[tuple[int, list[tuple[_Lines, int, int]]]], lines: _Lines) -> None:
        grid: list[list[tuple[int, int, list[str]]]] = []
        taken: dict[int, int] = {}  # of a column, the last row that a cell from above reaches
        last_group = -1
        for nr, (group, row) in enumerate(rows):
            if group != last_group:
                taken, last_group = {}, group
            column, cells = 0, []
            for cell, across, down in row:
                while taken.get(column, -1) >= nr:
                    column += 1
                cells.append((column, across, cell.done().strip("\n").split("\n")))
                if down > 1:
                    taken |= dict.fromkeys(range(column, column + across), nr + down - 1)
                column += across
            grid.append(cells)
        starts = sorted({column for cells in grid for column, _, _ in cells})  # other columns have no width
        widths = dict.fromkeys(starts, 0)
        for cells in grid:
            for column, across, text in cells:
                length = max(map(len, text))
                if across == 1 and length <= self.most_width:
                    widths[column] = max(widths[column], length)
        padded = sum(widths.values()) + 3 * len(starts) <= 8 * self.most_width
        for cells in grid:
            height = max((len(text) for _, _, text in cells), default=0)
            if not any(any(text) for _, _, text in cells):
                continue
            if height > MOST_LINES:
                self._stack(lines, [text for _, _, text in cells])
                continue
            for k in range(height):
                parts, at = [], 0
                if k and not any(text[k] for _, _, text in cells if k < len(text)):
                    lines.break_(2)
                    continue
                upto = max(n for n, (_, _, text) in enumerate(cells) if k < len(text) and text[k]) if k else len(cells)
                for column, across, text in cells[:upto + 1]:
                    first, end = bisect_left(starts, column), bisect_left(starts, column + across)
                    if padded:
                        parts.extend(" " * widths[c] for c in starts[at:first])
                        width = sum(widths[c] for c in starts[first:end]) + 3 * (end - first - 1)
                    else:
                        width = 0
                    parts.append((text[k] if k < len(text) else "").ljust(width))
                    at = end
                lines.break_(1)
                lines.raw(" | ".join(parts).rstrip(" "))
                lines.break_(1)

    @staticmethod
    def _stack(lines: _Lines, texts: list[list[str]]) -> None:
        for text in texts:
            lines.break_(2)
            for line in text:
                if line:
                    lines.raw(line)
                    lines.break_(1)
                else:
                    lines.break_(2)


def render_page(html: str, most_width: int = 40) -> str:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return Renderer(Visibility(builder.styles), most_width).render(builder.root)


def _render(most_width: int):
    schema = pa.schema([("page_id", pa.int64()), ("text", pa.string())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                texts = [None if h is None else render_page(h, most_width) for h in some["html"].to_pylist()]
                yield pa.RecordBatch.from_arrays([some["page_id"], pa.array(texts, pa.string())], schema=schema)
    return run


def extract_text(df: DataFrame, most_width: int = 40, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, text (all that is visible), n_chars, n_lines."""
    return (df.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html"))
            .mapInArrow(_render(most_width), "page_id long, text string")
            .withColumns({"n_chars": F.length("text").cast("long"),
                          "n_lines": F.when(F.col("text") == "", F.lit(0)).otherwise(
                              F.size(F.split("text", "\n"))).cast("long")}))
