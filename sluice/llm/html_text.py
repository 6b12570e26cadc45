"""Layout-aware text of HTML pages.

A page is read into a tree with implied tags, hidden parts are left out by tag,
attribute, inline style and the rules of its own style sheets that apply to a
screen, and the rest is laid out as text: inline white space collapses, blocks stand
on lines of their own with blank lines where a browser has margins, list items carry
their markers and table cells stand on a grid, aligned in columns.
"""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import in_slices, on_plain_names

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style title template noscript iframe noembed noframes object audio video canvas datalist param source track area base link meta".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset menu".split())
BLOCK = SPACED | frozenset(
    "html body div article section nav header footer main aside address form li dt dd figcaption details summary center legend option optgroup search hgroup tr dialog".split()
)
#: Start tags that end an open element of the same kind, and the elements at which the search for it stops.
CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist", "optgroup"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
    "tr": (frozenset({"tr", "td", "th", "caption", "colgroup"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "th": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "thead": (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}), frozenset({"table"})),
    "tbody": (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}), frozenset({"table"})),
    "tfoot": (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}), frozenset({"table"})),
    "body": (frozenset({"head"}), frozenset({"body"})),
}
#: An end tag does not reach through these.
FENCES = frozenset({"table", "td", "th", "caption"})
ROWS = frozenset({"thead", "tbody", "tfoot"})
#: Start tags that end a drawing or formula, and the elements in which it holds HTML again.
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
HTML_AGAIN = frozenset("foreignobject desc mi mo mn ms mtext annotation-xml".split())
#: Parts of drawings and formulas that are not shown, and those that stand apart from what is before them.
UNDRAWN = {
    "svg": frozenset("defs symbol clippath mask pattern marker metadata desc title".split()),
    "math": frozenset("annotation annotation-xml mphantom".split()),
}
APART = frozenset("text mtr mtd mfrac".split())
ROMAN = ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i"))
#: Columns are aligned up to this width; a longer cell pushes the rest of its row.
MAX_COLUMN = 40
MAX_SPAN = 100

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>""", re.DOTALL
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SELECTOR = re.compile(r"""([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+|\[[\w-]+(?:=(?:"[^"]*"|'[^']*'|[\w-]+))?\])*)""")
COMBINATOR = re.compile(r"\s*(>)\s*|\s+")
NAME = re.compile(r"""([.#\[])([\w-]+)(?:=["']?([^"'\]]*))?""")
CSS_TOKEN = re.compile(r"""/\*.*?(?:\*/|\Z)|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|<!--|-->|[{};]""", re.DOTALL)
DECLARED = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)[^;]*?(!\s*important)?\s*(?=;|$)", re.IGNORECASE)
#: The screen that media queries are asked about, in pixels, and what else holds for it. Rules under other features are left out.
SCREEN = {"width": 1280, "height": 800}
LENGTH = r"(\d+\.?\d*|\.\d+)(px|r?em)?"
BOUND = re.compile(rf"\((min|max)-(width|height):{LENGTH}\)|\((width|height)(<|>)=?{LENGTH}\)")
FEATURES = {"(orientation:landscape)": True, "(orientation:portrait)": False, "(prefers-color-scheme:light)": True, "(prefers-color-scheme:dark)": False}
FEATURES |= {"(hover)": True, "(hover:hover)": True, "(hover:none)": False, "(pointer:fine)": True, "(pointer:coarse)": False, "(color)": True}
SPACE = re.compile(r"[ \t\n\r\f]+")


class Element:
    """``foreign`` is ``svg`` or ``math`` for the parts of a drawing or formula."""

    __slots__ = ("attributes", "children", "foreign", "tag")

    def __init__(self, tag: str, attributes: dict[str, str], foreign: str = ""):
        self.tag, self.attributes, self.children, self.foreign = tag, attributes, [], foreign


def attributes_of(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(next((v for v in values if v), "")))
    return found


class Opened:
    """The open elements, outermost first, and where those of a kind stand."""

    def __init__(self, root: Element):
        self.stack, self.at, self.blocks, self.deepest = [root], {}, [0], 1

    def push(self, element: Element) -> None:
        self.at.setdefault(element.tag, []).append(len(self.stack))
        if element.tag in BLOCK or element.tag in FENCES:
            self.blocks.append(len(self.stack))
        self.stack.append(element)
        self.deepest = max(self.deepest, len(self.stack))

    def last(self, tags) -> int:
        """The place of the innermost element of these kinds; 0 if there is none."""
        return max((self.at[x][-1] for x in tags if self.at.get(x)), default=0)

    def cut(self, place: int) -> None:
        """Ends the element at a place and all inside of it."""
        while len(self.stack) > place:
            self.at[self.stack.pop().tag].pop()
        while self.blocks[-1] >= place:
            self.blocks.pop()

    def foreign(self) -> int:
        """The place of the drawing or formula whose parts are read now; 0 outside of them."""
        place = self.last(("svg", "math"))
        return place if place > self.last(HTML_AGAIN) else 0


def imply(opened: Opened, tag: str) -> None:
    element = Element(tag, {})
    opened.stack[-1].children.append(element)
    opened.push(element)


def build_tree(page: str) -> tuple[Element, list[str], int]:
    """The page's tree, the texts of its style elements, and how deep the tree is."""
    root = Element("#root", {})
    opened, styles, at, last = Opened(root), [], 0, page.rfind(">")
    stack = opened.stack

    while at < len(page):
        start = page.find("<", at)
        token = TOKEN.match(page, start) if 0 <= start < last or page.startswith("<!--", start) else None
        if start < 0 or not token:
            end = start + 1 if 0 <= start < last else len(page)
            stack[-1].children.append(html.unescape(page[at:end]))
            at = end
            continue
        if start > at:
            stack[-1].children.append(html.unescape(page[at:start]))
        at = token.end()
        if ended := token[1]:
            ended = ended.lower()
            place = opened.last((ended,))
            fence = 0 if ended in ("table", "tr", "body", "html", *ROWS) else opened.last(FENCES)
            if place and place >= fence:
                opened.cut(place)
            elif ended == "p" and not fence:
                stack[-1].children.append(Element("p", {}))
            continue
        tag = (token[2] or token[4] or "").lower()
        if not tag:
            continue
        attributes = token[3] or token[5] or ""
        while tag in BREAKOUT and (place := opened.foreign()):
            opened.cut(place)
        foreign = tag if tag in ("svg", "math") else stack[place].tag if (place := opened.foreign()) else ""
        if foreign and re.search(r"(^|[\s\"'])/$", attributes):
            stack[-1].children.append(Element(tag, attributes_of(attributes), foreign))
            continue
        if tag in CLOSES and not foreign:
            kinds, fences = CLOSES[tag]
            # a row ends with its cells: look on for the outer ones
            while (place := opened.last(kinds)) > opened.last(fences):
                opened.cut(place)
        if tag in BLOCK and not foreign and stack[opened.blocks[-1]].tag == "p":
            opened.cut(opened.blocks[-1])
        if tag in ("tr", "td", "th") and stack[-1].tag == "table":
            imply(opened, "tbody")
        if tag in ("td", "th") and stack[-1].tag in ROWS:
            imply(opened, "tr")
        element = Element(tag, attributes_of(attributes), foreign)
        stack[-1].children.append(element)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>|\Z", re.IGNORECASE).search(page, at)
            raw = page[at : end.start()]
            if tag == "style" and on_screen(element.attributes.get("media", "")) and not any(x.tag in ("noscript", "template") for x in stack):
                styles.append(raw)
            element.children.append(html.unescape(raw) if tag in ("textarea", "title") else raw)
            at = end.end()
        elif tag not in VOID:
            opened.push(element)
    return root, styles, opened.deepest


def holds(part: str) -> bool | None:
    """Whether a part of a media query holds for the screen; None if it is not known."""
    part = re.sub(r"\s+", "", part)
    if part in ("", "all", "screen"):
        return True
    if re.fullmatch(r"[a-z-]+", part):
        return False
    if bound := BOUND.fullmatch(part):
        end, side, size, unit, side_2, sign, size_2, unit_2 = bound.groups()
        pixels = float(size or size_2) * (16 if (unit or unit_2 or "px") != "px" else 1)
        return SCREEN[side or side_2] >= pixels if "min" == end or sign == ">" else SCREEN[side or side_2] <= pixels
    return FEATURES.get(part)


def on_screen(queries: str) -> bool:
    """Whether one of the media queries is known to hold for the screen."""
    for query in queries.lower().split(","):
        only, rest = re.fullmatch(r"\s*(not\s|only\s)?(.*)", query, re.DOTALL).groups()
        parts = [holds(x) for x in re.split(r"\band\b", rest)]
        whole = False if False in parts else None if None in parts else True
        if whole is not None and whole != (only or "").startswith("not"):
            return True
    return False


def group_applies(prelude: str) -> bool:
    name, rest = re.fullmatch(r"@([\w-]*)\s*(.*)", prelude, re.DOTALL).groups()
    name, rest = name.lower(), rest.lower()
    return (name == "media" and on_screen(rest)) or (name == "supports" and not rest.startswith("not")) or name == "layer"


def style_rules(sheet: str) -> Iterator[tuple[str, str]]:
    """``(selectors, declarations)`` of the rules that apply to a screen, in order.

    Blocks of at-rules are entered or left out as a whole, and so are blocks inside
    of rules. What the sheet leaves open ends with it.
    """
    blocks: list[tuple[str, str, list[str]]] = []
    text, at = "", 0
    for token in [*CSS_TOKEN.finditer(sheet), None]:
        text += sheet[at : token.start()] if token else sheet[at:]
        at = token.end() if token else len(sheet)
        mark = token[0] if token else "}"
        kind = blocks[-1][0] if blocks else "group"
        if mark.startswith(("/*", "<!--", "-->")):
            text += " "
            continue
        if mark[0] in "\"'":
            text += mark
            continue
        if kind == "rule" and mark != "{":
            blocks[-1][2].append(text)
        if mark == "{":
            prelude = text.strip()
            inner = "skip" if kind != "group" else "rule" if not prelude.startswith("@") else "group" if group_applies(prelude) else "skip"
            blocks.append((inner, prelude, []))
        elif mark == "}" and blocks:
            kind, selectors, parts = blocks.pop()
            if kind == "rule":
                yield selectors, ";".join(parts)
        text = ""


def declarations(body: str) -> dict[str, tuple[str, bool]]:
    """The display and visibility that a body declares, and whether as important."""
    found: dict[str, tuple[str, bool]] = {}
    for name, value, important in DECLARED.findall(body):
        if important or not found.get(name.lower(), ("", False))[1]:
            found[name.lower()] = (value.lower(), bool(important))
    return found


def compounds(selector: str) -> list[tuple[bool, re.Match]] | None:
    """The simple selectors of one with combinators, outermost first, each with whether
    it asks for a child of the one before; None if other combinators or pseudo-classes are in it."""
    found, at, child = [], 0, False
    while True:
        one = SELECTOR.match(selector, at)
        if not one[0]:
            return None
        found.append((child, one))
        if one.end() == len(selector):
            return found
        if not (link := COMBINATOR.match(selector, one.end())):
            return None
        at, child = link.end(), bool(link[1])


class Rule(NamedTuple):
    """One simple selector of a rule on display and visibility.

    It holds only below (``child``: directly below) an element at which the rule
    ``outer`` held; the last of a selector declares something, the others nothing.
    """

    rank: tuple
    tag: str
    ids: set[str]
    classes: set[str]
    wanted: list[tuple[str, str | None]]
    declared: dict[str, tuple[str, bool]]
    number: int
    outer: int | None
    child: bool

    def fits(self, element: Element, names: set[str], inside: frozenset[int], directly: frozenset[int]) -> bool:
        own = element.attributes
        if self.outer is not None and self.outer not in (directly if self.child else inside):
            return False
        if self.tag not in ("*", element.tag) or not self.ids <= {own.get("id")} or not self.classes <= names:
            return False
        return all(x in own and value in (None, own[x]) for x, value in self.wanted)


def visibility_rules(styles: list[str]) -> dict[str, list[Rule]]:
    """Rules on display and visibility, by id, class or tag of the element that they hold at."""
    rules: dict[str, list[Rule]] = {}
    number = 0
    for order, (selectors, body) in enumerate(x for sheet in styles for x in style_rules(sheet)):
        if not (declared := declarations(body)):
            continue
        for selector in filter(None, map(str.strip, selectors.split(","))):
            weight, outer = (0, 0, 0), None
            parts = compounds(selector) or []
            for place, (child, whole) in enumerate(parts, 1):
                tag, names = (whole[1] or "*").lower(), NAME.findall(whole[2])
                ids, classes = ({x for k, x, _ in names if k == kind} for kind in "#.")
                wanted = [(x.lower(), value if f"[{x}=" in whole[2] else None) for k, x, value in names if k == "["]
                key = f"#{min(ids)}" if ids else f".{min(classes)}" if classes else tag
                own = (sum(k == "#" for k, *_ in names), sum(k != "#" for k, *_ in names), int(tag != "*"))
                weight = tuple(map(sum, zip(weight, own)))
                says = declared if place == len(parts) else {}
                rules.setdefault(key, []).append(Rule((False, weight, order), tag, ids, classes, wanted, says, number, outer, child))
                outer, number = number, number + 1
    return rules


NONE: frozenset[int] = frozenset()


def decided(element: Element, rules: dict[str, list[Rule]], inside: frozenset[int] = NONE, directly: frozenset[int] = NONE) -> tuple[dict[str, str], frozenset[int]]:
    """Display and visibility as the strongest of the matching rules and the inline style
    say, and the numbers of the rules that hold here.

    ``inside`` and ``directly`` number those that hold at an ancestor and at the parent,
    so that the work does not depend on the depth.
    """
    own, best, held = element.attributes, {}, NONE
    offers = [((True, (0, 0, 0), 0), declarations(own["style"]))] if "style" in own else []
    if rules:
        names = set(own.get("class", "").split())
        keys = (f"#{own.get('id')}", *(f".{x}" for x in names), element.tag, "*")
        holding = [rule for key in keys for rule in rules.get(key, ()) if rule.fits(element, names, inside, directly)]
        offers += [(rule.rank, rule.declared) for rule in holding]
        held = frozenset(rule.number for rule in holding)
    for rank, declared in offers:
        for name, (value, important) in declared.items():
            best[name] = max(best.get(name, ((False,), "")), ((important, *rank), value))
    return {name: value for name, (_, value) in best.items()}, held


def is_left_out(element: Element, folded: bool) -> bool:
    """Whether an element is not shown whatever the style says."""
    if element.tag in HIDDEN or element.tag in UNDRAWN.get(element.foreign, ()):
        return True
    return folded or (element.tag == "input" and element.attributes.get("type", "").lower() == "hidden")


def leave_out_hidden(
    element: Element, rules: dict[str, list[Rule]], visible: bool = True, inside: frozenset[int] = NONE, directly: frozenset[int] = NONE, drawn: bool = True
) -> None:
    """Removes elements that are not displayed, and text where it is invisible.

    A visible element inside of an invisible one stays. Of closed details only the
    first summary stays, and of a drawing the text in its text elements (``drawn``).
    """
    kept = []
    closed = element.tag == "details" and "open" not in element.attributes
    summary = next((x for x in element.children if not isinstance(x, str) and x.tag == "summary"), None) if closed else None
    for child in element.children:
        if isinstance(child, str):
            if visible and drawn and not closed:
                kept.append(child)
            continue
        own = child.attributes
        if is_left_out(child, closed and child is not summary):
            continue
        style, held = decided(child, rules, inside, directly) if rules or "style" in own else ({}, NONE)
        shown = style.get("display", "revert")
        if shown == "none" or (shown.startswith("revert") and ("hidden" in own or (child.tag == "dialog" and "open" not in own))):
            continue
        seen = style.get("visibility", "inherit")
        seen = visible if seen in ("inherit", "unset", "revert", "revert-layer") else seen not in ("hidden", "collapse")
        within = inside if held <= inside else inside | held
        if child.foreign == "svg":
            draws = child.tag in ("text", "foreignobject") or (drawn and child.tag != "svg")
        else:
            draws = drawn
        leave_out_hidden(child, rules, seen, within, held, draws)
        if seen or child.children:
            kept.append(child)
    element.children = kept


class Lines:
    """Text being laid out: finished lines, the open one, and the blank lines owed."""

    def __init__(self):
        self.done, self.open, self.owed = [], [], 0

    def words(self, text: str) -> None:
        text = SPACE.sub(" ", text)
        if text[:1] == " " and (not self.open or self.open[-1].endswith(" ")):
            text = text[1:]
        if text:
            self.open.append(text)

    def end_line(self) -> None:
        line = "".join(self.open).rstrip(" ")
        self.open = []
        if line:
            self.add([line])

    def add(self, lines: list[str]) -> None:
        if self.done and self.owed:
            self.done.extend([""] * self.owed)
        self.owed = 0
        self.done.extend(lines)

    def space(self) -> None:
        if self.done:
            self.owed = 1


def render_children(element: Element, lines: Lines) -> None:
    for child in element.children:
        if isinstance(child, str):
            lines.words(child)
        else:
            render(child, lines)


def lines_of(element: Element) -> list[str]:
    inner = Lines()
    render_children(element, inner)
    inner.end_line()
    return inner.done


def plain_text(element: Element) -> str:
    parts = []
    for child in element.children:
        if isinstance(child, str):
            parts.append(child)
        elif child.tag == "br":
            parts.append("\n")
        else:
            parts.append(plain_text(child))
    return "".join(parts)


def render(element: Element, lines: Lines) -> None:
    tag = element.tag
    if tag == "br":
        if "".join(lines.open).strip(" "):
            lines.end_line()
        elif lines.done:
            lines.open, lines.owed = [], min(lines.owed + 1, 1)
        return
    if tag == "input":
        if element.attributes.get("type", "text").lower() in ("text", "submit", "button", "reset", "search", "email", "url", "tel", "number"):
            lines.words(element.attributes.get("value", ""))
        return
    if tag == "textarea":
        written = "".join(x for x in element.children if isinstance(x, str)).replace("\r\n", "\n").removeprefix("\n").rstrip("\n")
        if "\n" not in written:
            lines.words(written)
            return
        lines.end_line()
        lines.add([x.rstrip() for x in written.split("\n")])
        return
    if tag not in BLOCK or element.foreign:
        if tag in ("td", "th", *ROWS, "caption") or (element.foreign and tag in APART):  # cells outside a table
            lines.words(" ")
        for place, child in enumerate(element.children):
            if place and tag == "mfrac":
                lines.words(" ")
            if isinstance(child, str):
                lines.words(child)
            else:
                render(child, lines)
        if element.foreign and tag in APART:
            lines.words(" ")
        return
    lines.end_line()
    if tag in SPACED:
        lines.space()
    if tag == "table":
        lines.add(table_lines(element))
    elif tag in ("ul", "ol", "menu"):
        lines.add(list_lines(element))
    elif tag == "pre":
        text = plain_text(element).expandtabs(8)
        lines.add([x.rstrip() for x in text.removeprefix("\n").rstrip("\n").split("\n")])
    elif tag in ("blockquote", "dd"):
        lines.add([f"  {x}" if x else "" for x in lines_of(element)])
    else:
        render_children(element, lines)
        lines.end_line()
    if tag in SPACED:
        lines.space()


def number_of(element: Element, name: str, default: int) -> int:
    text = element.attributes.get(name, "").strip()
    return int(text) if re.fullmatch(r"[+-]?\d{1,9}", text) else default


def ordinal(number: int, kind: str) -> str:
    """A number as a list of this type shows it: plain where the type cannot."""
    if kind in ("a", "A") and number > 0:
        letters = ""
        while number:
            number, rest = divmod(number - 1, 26)
            letters = chr(ord("a") + rest) + letters
        return letters.upper() if kind == "A" else letters
    if kind in ("i", "I") and 0 < number < 4000:
        letters = ""
        for value, letter in ROMAN:
            times, number = divmod(number, value)
            letters += letter * times
        return letters.upper() if kind == "I" else letters
    return str(number)


def list_lines(element: Element) -> list[str]:
    """Items with their markers, further lines indented below the first."""
    out, ordered = [], element.tag == "ol"
    falling = ordered and "reversed" in element.attributes
    items = sum(not isinstance(x, str) and x.tag == "li" for x in element.children) if falling else 1
    number, kind = number_of(element, "start", items), element.attributes.get("type", "1")
    for child in element.children:
        if isinstance(child, str):
            if child.strip():
                out.append(SPACE.sub(" ", child).strip(" "))
            continue
        if child.tag != "li":
            out += render_alone(child)
            continue
        number = number_of(child, "value", number)
        mark = f"{ordinal(number, child.attributes.get('type', kind))}. " if ordered else "- "
        number += -1 if falling else 1
        out += [(mark if i == 0 else " " * len(mark)) + x if x else "" for i, x in enumerate(lines_of(child))]
    return out


def render_alone(element: Element) -> list[str]:
    inner = Lines()
    render(element, inner)
    inner.end_line()
    return inner.done


class Cell(NamedTuple):
    lines: list[str]
    row: int
    column: int
    high: int
    wide: int


def rows_of(table: Element) -> tuple[list[str], list[tuple[int, list[Element | str]]]]:
    """What stands in a table outside of rows, and the rows: the number of their group and their cells."""
    before, rows, group = [], [], 0
    todo = table.children[::-1]
    while todo:
        child = todo.pop()
        if child is None:
            group += 1
        elif isinstance(child, str):
            if child.strip():
                before.append(SPACE.sub(" ", child).strip(" "))
        elif child.tag in ROWS:
            group += 1
            todo += [None, *reversed(child.children)]
        elif child.tag == "tr":
            rows.append((group, [x for x in child.children if not isinstance(x, str) or x.strip()]))
        elif child.tag in ("td", "th"):
            rows.append((group, [child]))
        else:
            before += render_alone(child)
    return before, rows


def cells_of(rows: list[tuple[int, list[Element | str]]]) -> list[list[Cell]]:
    """The cells on their grid, by the row in which they start.

    A cell takes the first columns that no cell from above still holds, all of them
    free, so that no text covers another; it reaches down as far as its ``rowspan`` and its group of rows go, 0 meaning all of them.
    """
    ends: dict[int, int] = {}
    for place, (group, _) in enumerate(rows):
        ends[group] = place + 1
    grid, held = [], {}
    for place, (group, children) in enumerate(rows):
        held = {column: end for column, end in held.items() if end > place}
        column, cells = 0, []
        for child in children:
            high = wide = 1
            if isinstance(child, str):
                lines = [SPACE.sub(" ", child).strip(" ")]
            elif child.tag in ("td", "th"):
                lines = lines_of(child)
                wide = min(MAX_SPAN, max(1, number_of(child, "colspan", 1)))
                high = number_of(child, "rowspan", 1)
                high = ends[group] - place if high == 0 else max(1, min(high, ends[group] - place))
            else:
                lines = render_alone(child)
            while blocked := [c for c in range(column, column + wide) if c in held]:
                column = blocked[-1] + 1
            cells.append(Cell(lines, place, column, high, wide))
            if high > 1:
                held.update(dict.fromkeys(range(column, column + wide), place + high))
            column += wide
        grid.append(cells)
    return grid


def column_widths(grid: list[list[Cell]]) -> dict[int, int]:
    """The widest text of each column; a cell over several widens the last of them."""
    widths: dict[int, int] = {}
    for cell in sorted((x for cells in grid for x in cells), key=lambda x: x.wide):
        needed = max(map(len, cell.lines), default=0) - 2 * (cell.wide - 1)
        needed -= sum(widths.get(c, 0) for c in range(cell.column, cell.column + cell.wide - 1))
        last = cell.column + cell.wide - 1
        widths[last] = max(widths.get(last, 0), min(MAX_COLUMN, needed))
    return widths


def table_lines(element: Element) -> list[str]:
    """Rows of cells, two spaces apart and aligned in columns.

    A row is as high as its cells of one row; the last row under a cell of several is
    made higher where the cell needs it.
    """
    out, rows = rows_of(element)
    grid = cells_of(rows)
    widths = column_widths(grid)
    heights = [max((len(x.lines) for x in cells if x.high == 1), default=0) for cells in grid]
    for cell in sorted((x for cells in grid for x in cells if x.high > 1), key=lambda x: x.row + x.high):
        last = cell.row + cell.high - 1
        heights[last] += max(0, len(cell.lines) - sum(heights[cell.row : last + 1]))
    tops = [0, *accumulate(heights)]
    reaching: list[Cell] = []
    for place, cells in enumerate(grid):
        across = sorted([x for x in reaching if x.row + x.high > place] + cells, key=lambda x: x.column)
        reaching = [x for x in across if x.high > 1]
        for line in range(tops[place], tops[place + 1]):
            parts, at = [], 0
            for cell in across:
                parts += ["".ljust(widths.get(c, 0)) for c in range(at, cell.column)]
                width = sum(widths.get(c, 0) for c in range(cell.column, cell.column + cell.wide)) + 2 * (cell.wide - 1)
                here = line - tops[cell.row]
                parts.append((cell.lines[here] if here < len(cell.lines) else "").ljust(width))
                at = cell.column + cell.wide
            out.append("  ".join(parts).rstrip(" "))
    return out


def page_text(page: str | None) -> str:
    """The visible text of a page, laid out in lines; empty for NULL."""
    root, styles, depth = build_tree(page or "")
    usual = sys.getrecursionlimit()
    # Calls between Python functions take no C stack; the deepest way has four a level.
    sys.setrecursionlimit(usual + 4 * depth)
    try:
        rules = visibility_rules(styles)
        # The elements that every page is in, whether it says so or not.
        _, html_held = decided(Element("html", {}), rules)
        _, body_held = decided(Element("body", {}), rules, html_held, html_held)
        leave_out_hidden(root, rules, True, html_held | body_held, body_held)
        return "\n".join(lines_of(root)).strip("\n")
    finally:
        sys.setrecursionlimit(usual)


@on_plain_names("html")
def extract_text(pages: DataFrame, column: str = "html") -> DataFrame:
    """The pages with ``__text`` added: their visible text.

    Whole pages are read; NULL and empty pages give an empty text, and text
    without tags stays with its white space collapsed. Unclosed and misplaced tags
    are taken as browsers take them in the common cases. Style rules with descendant
    and child selectors are applied; those with sibling combinators or pseudo-classes, and
    rules under media features that are not known, are not, whether they hide or show. Other columns pass through, and repeated rows are rendered each.
    """
    pages = pages.withColumn(column, F.make_valid_utf8(F.col(column).cast("string")))
    fields = [*pages.schema.fields, T.StructField("__text", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts = pa.array([page_text(x) for x in batch.column(column).to_pylist()], pa.string())
            yield pa.RecordBatch.from_pydict({x: batch.column(x) for x in batch.schema.names} | {"__text": texts})

    return pages.mapInArrow(run, T.StructType(fields))


def with_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_lines, n_chars)``."""
    found = extract_text(pages.select("page_id", "url", "html")).withColumnRenamed("__text", "text")
    lines = F.when(F.length("text") > 0, F.size(F.split("text", "\n", -1))).otherwise(0)
    return found.select("page_id", "url", "text", lines.cast("long").alias("n_lines"), F.length("text").cast("long").alias("n_chars"))
