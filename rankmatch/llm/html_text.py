"""Text of web pages as a reader would see it laid out.

A tree is built from the page's tags with the usual implied ones: missing ``html``, ``head``,
``body``, ``tbody`` and ``tr``, and the ends of paragraphs, list items, cells and options that a
following tag implies.  All text that is visible is then written in order: blocks on lines of
their own, paragraphs, headings, lists and tables apart by an empty line, list items with bullets
or numbers and indented by depth, preformatted text as it is, and table cells in columns padded
to one width.  What is hidden is left out: by its element, by the ``hidden`` attribute, by its
style, by the page's own style sheets as :mod:`page_style` reads them, or in a closed ``details``.
What ``visibility`` hides can hold elements that are visible again.  Formulas, the labels of drawings,
the contents of image maps and the values of inputs are text like any other.

Defined results: a null or empty page has an empty text; broken tags and stray ends never fail;
nesting of any depth is walked without recursion, and tables within :data:`TABLES` tables are
laid out as plain blocks; every cell is whole, counts for the width of its column and has two blanks
after it, rows reach as far as their section and columns to HTML's own 1000, and only where that would pad a table to over :data:`ROOM` characters are lines wider
than :data:`PAD` not padded for; rows with a null or repeated id, and equal rows, are each rendered
alone; an empty table gives an empty result.  Columns other than the id and the page are not read.
"""

from __future__ import annotations

import re
from html import unescape
from unicodedata import east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmatch.llm.common import by_texts, column
from rankmatch.llm.page_style import Said, Sheets, on_screen, own_style

# Widest column that shorter cells are always padded for, characters up to which a table is padded for wider
# ones too, and deepest nesting of laid-out tables.
PAD, ROOM, TABLES = 60, 1_000_000, 8


def names(text: str) -> frozenset[str]:
    return frozenset(text.split())


# Elements by what they mean for the layout.
VOID = names("area base br col embed hr img input link meta param source track wbr")
RAW = names("script style textarea title xmp iframe noembed noframes")
HEAD = names("base link meta script style template title")
HIDDEN = names(
    "head script style template title noscript iframe noembed noframes object audio video canvas "
    "datalist area param source track meta link base col colgroup annotation annotation-xml"
)
# In drawings only text elements, which are told from HTML by name, and these are shown, and nothing of those.
LABEL, DRAWN = "svg:text", names("foreignobject")
UNDRAWN = names(
    "title desc defs metadata symbol clippath mask marker pattern lineargradient radialgradient filter script style"
)
# Formulas whose parts stand over, under or beside one another.
APART = names("mfrac msub msup msubsup munder mover munderover mmultiscripts mroot mtable mtr mlabeledtr")
# HTML tags that end a drawing or a formula, and elements inside these that hold HTML.
LEAVES = names(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var"
)
HOLDS = names("svg math")
MARKS = HOLDS | names("foreignobject desc mi mo mn ms mtext annotation-xml")
# Inputs that show no text: marks, pickers, pictures, and what is to be unseen.
UNREAD = names("hidden password checkbox radio file image color range")
MARGIN = names("p h1 h2 h3 h4 h5 h6 ul ol dl menu table blockquote pre figure hr fieldset")
BLOCK = MARGIN | names(
    "html body address article aside center details dialog dd div dir dt fieldset figcaption footer form header "
    "hgroup legend li main nav optgroup option search section summary tr caption thead tbody tfoot td th"
)
ENDS_P = MARGIN | names(
    "address article aside center details dialog dir div figcaption footer form header hgroup main menu nav search "
    "section summary"
)
CELL = names("td th caption")
GROUPS = names("thead tbody tfoot")
# A start tag ends open elements of these names, as far as an element that bounds the search.
IMPLIED = {
    "li": (names("li"), names("ul ol menu table td th")),
    "dt": (names("dt dd"), names("dl table td th")),
    "dd": (names("dt dd"), names("dl table td th")),
    "option": (names("option"), names("select datalist table")),
    "optgroup": (names("option optgroup"), names("select table")),
    "td": (CELL, names("table tr")),
    "th": (CELL, names("table tr")),
    "tr": (CELL | names("tr colgroup"), names("table") | GROUPS),
    "thead": (CELL | GROUPS | names("tr colgroup"), names("table")),
    "tbody": (CELL | GROUPS | names("tr colgroup"), names("table")),
    "tfoot": (CELL | GROUPS | names("tr colgroup"), names("table")),
}
BOUNDS_P = names("button table td th caption html body")

_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)"
    r"|<[!?/][^>]*+>?",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
_UNQUOTED = re.compile(r"=\s*+[^\s\"'][^\s]*+\Z")
_SPACE = re.compile(r"[ \t\n\r\f\v]+")
# Whether an element is shown: not at all, without its own text, or with it.
NONE, MUTE, SHOWN = range(3)


class Element:
    __slots__ = ("tag", "attributes", "children", "state")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None):
        self.tag, self.attributes, self.children, self.state = tag, attributes or {}, [], SHOWN


def _attributes(text: str) -> dict[str, str]:
    if not text or text == "/":
        return {}
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        value = a or b or c
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


class Tree:
    """The tree of a page, built tag by tag."""

    def __init__(self, page: str):
        self.root, self.head, self.body = Element("html"), Element("head"), Element("body")
        self.root.children = [self.head, self.body]
        self.stack = [self.root, self.body]
        self.open: dict[str, int] = {"html": 1, "body": 1}
        self.begun = False
        # Where drawings and formulas, and elements in them that hold HTML, are in the stack.
        self.marks: list[int] = []
        self.sheet: list[str] = []
        at = 0
        while True:
            match = _TAG.search(page, at)
            if match is None:
                break
            if match.start() > at:
                self.text(page[at : match.start()])
            at = match.end()
            tag = (match[2] or "").lower()
            if not tag:
                continue
            if match[1]:
                self.end(tag)
                continue
            attributes = _attributes(match[3])
            if self.foreign(tag, match[3]):
                self.push(Element(tag, attributes))
                self.pop(len(self.stack) - 1)
                continue
            self.begin(tag, attributes)
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                content = page[at : stop.start() if stop else len(page)]
                at = stop.end() if stop else len(page)
                if tag == "style":
                    if not self.open.get("noscript") and on_screen(attributes.get("media", "")):
                        self.sheet.append(content)
                elif tag in ("textarea", "xmp") and content:
                    self.stack[-1].children.append(unescape(content) if tag == "textarea" else content)
                self.pop(len(self.stack) - 1)
        if at < len(page):
            self.text(page[at:])

    def text(self, text: str) -> None:
        if not self.begun and text.strip():
            self.begun = True
        self.stack[-1].children.append(unescape(text) if "&" in text else text)

    def push(self, element: Element, parent: Element | None = None) -> None:
        (parent or self.stack[-1]).children.append(element)
        if element.tag in MARKS:
            self.marks.append(len(self.stack))
        self.stack.append(element)
        self.open[element.tag] = self.open.get(element.tag, 0) + 1

    def pop(self, depth: int) -> None:
        """Close all open elements from ``depth`` on; html and body stay."""
        for element in self.stack[max(depth, 2) :]:
            self.open[element.tag] -= 1
        del self.stack[max(depth, 2) :]
        while self.marks and self.marks[-1] >= len(self.stack):
            self.marks.pop()

    def close(self, wanted: frozenset[str], bounds: frozenset[str]) -> bool:
        """Close the outermost open element of these names above the first bound."""
        if not any(self.open.get(t) for t in wanted):
            return False
        found = None
        for depth in range(len(self.stack) - 1, 1, -1):
            tag = self.stack[depth].tag
            if tag in bounds:
                break
            if tag in wanted:
                found = depth
        if found is None:
            return False
        self.pop(found)
        return True

    def foreign(self, tag: str, attributes: str) -> bool:
        """Whether this is an element without content of a drawing or formula; HTML tags end these."""
        closed = attributes.endswith("/") and not _UNQUOTED.search(attributes)
        if tag in HOLDS:
            return closed
        inside = self.stack[self.marks[-1]].tag in HOLDS if self.marks else False
        if inside and tag in LEAVES:
            self.pop(self.marks[-1])
            return False
        return inside and closed

    def begin(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in ("html", "head", "body"):
            if tag == "body":
                self.body.attributes = {**attributes, **self.body.attributes}
            return
        if tag in HEAD and not self.begun and len(self.stack) == 2:
            self.push(Element(tag, attributes), self.head)
            if tag in VOID:
                self.pop(len(self.stack) - 1)
            return
        self.begun = True
        if tag in ENDS_P and self.open.get("p"):
            self.close(names("p"), BOUNDS_P)
        if tag in IMPLIED:
            self.close(*IMPLIED[tag])
        if self.open.get("table"):
            if tag in ("td", "th", "tr") and self.stack[-1].tag == "table":
                self.push(Element("tbody"))
            if tag in ("td", "th") and self.stack[-1].tag in GROUPS:
                self.push(Element("tr"))
        self.push(Element(tag, attributes))
        if tag in VOID:
            self.pop(len(self.stack) - 1)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.begin("br", {})
        elif tag == "p" and not self.open.get("p"):
            self.stack[-1].children.append(Element("p"))
        elif tag not in ("html", "head", "body") and self.open.get(tag):
            # An end tag inside a cell does not reach out of it.
            bounds = frozenset() if tag in ("table", "tr") or tag in GROUPS else CELL - {tag}
            bounds |= names("table") if tag != "table" else frozenset()
            for depth in range(len(self.stack) - 1, 1, -1):
                if self.stack[depth].tag == tag:
                    self.pop(depth)
                    break
                if self.stack[depth].tag in bounds:
                    break


def _width(text: str) -> int:
    return len(text) if text.isascii() else sum(2 if east_asian_width(c) in "WF" else 1 for c in text)


class Writer:
    """Lines of text with pending breaks, indents and bullets."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap, self.space, self.bullet = 0, False, ""
        self.indents: list[str] = []

    def flush(self) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []

    def broken(self, size: int) -> None:
        """At least this many line breaks before what comes next: 1 for a new line, 2 for an empty one."""
        self.flush()
        self.space = False
        self.gap = max(self.gap, size)

    def started(self) -> None:
        if not self.line:
            if self.gap > 1 and self.lines:
                self.lines.append("")
            self.gap = 0
            indent = "".join(self.indents)
            if self.bullet:
                indent = indent[: len(indent) - len(self.bullet)] + self.bullet
                self.bullet = ""
            self.line.append(indent)

    def inline(self, text: str) -> None:
        words = _SPACE.sub(" ", text)
        if words[:1] == " ":
            self.space = bool(self.line)
        words = words.strip(" ")
        if not words:
            return
        self.started()
        if self.space:
            self.line.append(" ")
        self.line.append(words)
        self.space = text[-1] in " \t\n\r\f\v"

    def literal(self, text: str) -> None:
        for i, line in enumerate(text.split("\n")):
            if i:
                if not self.line:
                    self.started()
                self.flush()
            if line:
                self.started()
                self.line.append(line)

    def text(self) -> str:
        self.flush()
        return "\n".join(self.lines)


class Renderer:
    def __init__(self, tree: Tree):
        self.sheets, self.styles, self.tables = Sheets(tree.sheet), {}, 0
        stack = [(tree.root, True, False)]
        while stack:
            e, visible, drawing = stack.pop()
            display, visibility = self.styled(e)
            if drawing and e.tag in UNDRAWN:
                display = "none"
            if display == "none" or visibility == "collapse" and (e.tag == "tr" or e.tag in GROUPS):
                e.state = NONE
                continue
            if visibility != "inherit":
                visible = visibility == "visible"
            visible &= e.tag != "mphantom"
            if drawing and e.tag == "text":
                e.tag = LABEL
                drawing = False
            drawing = e.tag == "svg" or drawing and e.tag not in DRAWN
            e.state = SHOWN if visible and not drawing else MUTE
            children = [c for c in e.children if isinstance(c, Element)]
            if drawing and e.tag == "switch":
                for child in children:
                    child.state = NONE
                children = [c for c in children if "requiredextensions" not in c.attributes][:1]
            stack.extend((c, visible, drawing) for c in children)

    def styled(self, e: Element) -> tuple[str, str]:
        """Whether an element's ``display`` is "none", and its ``visibility``."""
        a = e.attributes
        if e.tag in HIDDEN or (
            e.tag == "input" and a.get("type", "").strip().lower() in UNREAD
        ):
            return "none", "inherit"
        said: Said = self.sheets.of(e.tag, a) if self.sheets.rules else {}
        if "style" in a:
            if (text := a["style"]) not in self.styles:
                self.styles[text] = own_style(text)
            own = self.styles[text]
            said = said | {x: max(ranked, said.get(x, ranked)) for x, ranked in own.items()}
        display = said["display"][1] if "display" in said else "default"
        if display == "default" and ("hidden" in a or e.tag == "dialog" and "open" not in a):
            display = "none"
        return display, said["visibility"][1] if "visibility" in said else "inherit"

    def hidden(self, e: Element) -> bool:
        return e.state == NONE

    def render(self, top: Element) -> str:
        """The visible text of an element, walked with a stack of its own."""
        out = Writer()
        numbers: list[int | None] = []
        stack: list[tuple[object, bool]] = [(c, True) for c in reversed(self.shown(top, top.children))]
        literal = 1 if top.tag == "pre" else 0
        while stack:
            node, enter = stack.pop()
            if isinstance(node, str):
                (out.literal if literal else out.inline)(node)
                continue
            tag = node.tag
            size = 2 if tag in MARGIN and not (tag in ("ul", "ol", "menu") and numbers) else 1
            if not enter:
                if tag in ("ul", "ol", "menu"):
                    numbers.pop()
                if tag in ("li", "blockquote", "dd") and out.indents:
                    out.indents.pop()
                    out.bullet = ""
                literal -= tag in ("pre", "textarea", "xmp")
                if tag in BLOCK:
                    out.broken(size)
                elif tag == LABEL:
                    out.inline(" ")
                continue
            if self.hidden(node):
                continue
            if tag == "br":
                if not out.line:
                    out.gap = 2 if out.gap else 1
                out.broken(1)
                continue
            if tag == "input":
                if node.state == SHOWN:
                    out.inline(f" {node.attributes.get('value', '')} ")
                continue
            if tag in BLOCK:
                out.broken(size)
            elif tag == LABEL:
                out.inline(" ")
            children = node.children
            if tag in APART:
                children = [part for child in children for part in (child, " ")]
            if tag == "table" and self.tables < TABLES:
                self.tables += 1
                text = self.table(node)
                self.tables -= 1
                if text:
                    out.literal(text)
                out.broken(2)
                continue
            if tag == "details" and "open" not in node.attributes:
                children = [c for c in children if isinstance(c, Element) and c.tag == "summary"][:1]
            if tag == "select":
                children = self.shown_options(node)
            if tag in ("ul", "ol", "menu"):
                start = node.attributes.get("start", "")
                numbers.append((int(start) if re.fullmatch(r"[0-9]{1,9}", start) else 1) if tag == "ol" else None)
            elif tag == "li":
                out.bullet = "- "
                if numbers and numbers[-1] is not None:
                    out.bullet = f"{numbers[-1]}. "
                    numbers[-1] += 1
                out.indents.append(" " * len(out.bullet))
                if node.state == MUTE:
                    out.bullet = ""
            elif tag in ("blockquote", "dd"):
                out.indents.append("  ")
            if tag in ("pre", "textarea", "xmp"):
                literal += 1
                if children and isinstance(children[0], str) and children[0].startswith("\n"):
                    children = [children[0][1:], *children[1:]]
            stack.append((node, False))
            stack.extend((c, True) for c in reversed(self.shown(node, children)))
        return out.text()

    @staticmethod
    def shown(e: Element, children: list) -> list:
        return children if e.state == SHOWN else [c for c in children if isinstance(c, Element)]

    def shown_options(self, select: Element) -> list[Element]:
        found, stack = [], list(reversed(select.children))
        while stack:
            node = stack.pop()
            if isinstance(node, Element):
                if node.tag == "option":
                    found.append(node)
                else:
                    stack.extend(reversed(node.children))
        if "multiple" in select.attributes:
            return found
        return [o for o in found if "selected" in o.attributes][-1:] or found[:1]

    def table(self, table: Element) -> str:
        """Rows on lines, cells in columns of one width; what is no cell comes before."""
        before, rows = Element("div"), []
        # Nodes with the section of the table that they are in.
        stack: list[tuple[object, Element]] = [(c, table) for c in reversed(self.shown(table, table.children))]
        while stack:
            node, section = stack.pop()
            if isinstance(node, str):
                before.children.append(node)
            elif self.hidden(node):
                continue
            elif node.tag in GROUPS:
                stack.extend((c, node) for c in reversed(self.shown(node, node.children)))
            elif node.tag == "tr":
                rows.append((node, section))
            else:
                before.children.append(node)
        ends = list(range(1, len(rows) + 1))
        for r in range(len(rows) - 2, -1, -1):
            if rows[r][1] is rows[r + 1][1]:
                ends[r] = ends[r + 1]
        # The cells of each row by their first column.
        grid: list[dict[int, list[str]]] = []
        # Columns, from and to, that cells of earlier rows reach into, and the row before which they end.
        below: list[tuple[int, int, int]] = []
        for r, (row, _) in enumerate(rows):
            cells: dict[int, list[str]] = {}
            below = [b for b in below if b[2] > r]
            reaching: list[tuple[int, int, int]] = []
            at = met = 0
            for cell in self.shown(row, row.children):
                if isinstance(cell, str):
                    if not cell.strip(" \t\n\r\f\v"):
                        continue
                    cell_element, span, down = Element("td"), 1, 1
                    cell_element.children.append(cell)
                elif self.hidden(cell):
                    continue
                else:
                    cell_element = cell
                    if cell.tag not in ("td", "th"):
                        cell_element = Element("td")
                        cell_element.children.append(cell)
                    span, down = min(max(_span(cell, "colspan"), 1), 1000), _span(cell, "rowspan")
                while met < len(below) and below[met][0] <= at:
                    at = max(at, below[met][1])
                    met += 1
                cells[at] = self.render(cell_element).split("\n")
                until = min(r + down, ends[r]) if down else ends[r]
                if until > r + 1:
                    reaching.append((at, at + span, until))
                at += span
            grid.append(cells)
            if reaching:
                joined: list[tuple[int, int, int]] = []
                for b in sorted(below + reaching):
                    if joined and joined[-1][1] >= b[0] and joined[-1][2] == b[2]:
                        b = (joined[-1][0], max(joined.pop()[1], b[1]), b[2])
                    joined.append(b)
                below = joined
        wide: dict[int, int] = dict.fromkeys(sorted({i for cells in grid for i in cells}), 0)
        height = sum(max([0, *map(len, cells.values())]) for cells in grid)
        most = max(PAD, ROOM // max(height * len(wide), 1))
        for cells in grid:
            for i, lines in cells.items():
                wide[i] = max([wide[i], *(w for line in lines if (w := _width(line)) <= most)])
        # Columns in which no cell begins take no room.
        starts, upto = {}, 0
        for i, width in wide.items():
            starts[i] = upto
            upto += width + 2
        out = []
        for cells in grid:
            for k in range(max([0, *map(len, cells.values())])):
                line, width = [], 0
                for i, lines in cells.items():
                    if k < len(lines) and lines[k]:
                        gap = max(starts[i] - width, 2 if line else 0)
                        line += (" " * gap, lines[k])
                        width += gap + _width(lines[k])
                out.append("".join(line).rstrip(" "))
        head = self.render(before)
        return "\n".join(([head] if head else []) + out)


def _span(cell: Element, name: str) -> int:
    """A number of columns or rows; 0 rows are all that the section still has."""
    digits = re.match(r"\s*\+?([0-9]{1,9})", cell.attributes.get(name, "1"))
    return int(digits[1]) if digits else 1


def page_text(page: str | None) -> str:
    """The visible text of one whole page."""
    if not page:
        return ""
    tree = Tree(page)
    return Renderer(tree).render(tree.root)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, ``text`` and its number of code points, ``n_chars``, for every row of ``pages``."""
    rows = pages.select(
        column(id_col).alias("page_id"), F.coalesce(column(html_col).cast("string"), F.lit("")).alias("html")
    )

    def run(batches):
        for batch in batches:
            texts = [page_text(p) for p in batch.column(1).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), sizes], names=["page_id", "text", "n_chars"]
            )

    return by_texts(rows, run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, text string, n_chars bigint")
