"""Layout-aware text of HTML pages.

A small tree builder (open elements with implied end tags) decides which text
is visible and a renderer lays it out: blocks on lines of their own, paragraphs
set off by an empty line, list items with their markers and indents, and tables
with cells padded into columns. All visible text is kept; there is no guess at
a "main" part.

Text of an invisible element goes, that of a visible one inside it stays. Lists
count from ``start`` and ``value``; cells over several rows keep their columns.

Cases: null or empty html gives empty text; null ids stay null; an empty table of
pages gives an empty result; broken markup (stray or missing end
tags, unclosed comments and scripts) is closed as browsers do; markup without
any tag is text; repeated rows give repeated results; extra columns are ignored.
Very long pages and tables are laid out whole, within one page's memory.
Nesting is held in lists, so very deep pages need no recursion.
"""

from __future__ import annotations

import html as entities
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slim

# HTML's elements by what they mean for layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head title script style template noscript noembed noframes rp iframe object datalist audio video canvas annotation annotation-xml".split())
#: Start tags that leave an open head open.
HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
#: Parts of a drawing that are not drawn where they stand, elements that show text in it, and HTML that ends a drawing or formula left open.
UNDRAWN = frozenset("defs desc metadata symbol clippath mask pattern marker".split())
DRAWN = frozenset("text foreignobject".split())
LEAVES = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
HOSTS = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset hr".split())
BLOCK = PARAGRAPH | frozenset("html body address article aside details dialog dd div dt figcaption footer form header hgroup legend li main menu nav section summary center caption thead tbody tfoot tr optgroup option".split())
#: Start tag -> the open elements that it ends, up to the bound named beside them.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}), "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}), "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select", "datalist"}), "body": ({"head"}, set()),
}
#: A start tag of these ends an open paragraph.
ENDS_P = frozenset("address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: An end tag looks no further than these.
SCOPE = frozenset("table td th caption html".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SLASHED = re.compile(r"=\s*[^\s\"'>=]*/\Z")
_SPACE = re.compile(r"[ \t\n\r\f\v]+")
_STYLE = re.compile(r"<style(?:\s[^>]*)?>(.*?)(?:</style|\Z)", re.I | re.S)
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
#: Kinds of input that show their value.
SHOWN_INPUTS = frozenset("button email number reset search submit tel text url".split())


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) in document order; kinds: text, start, end."""
    at, n, drawings = 0, len(html), 0
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            yield "text", html[at:], ""
            return
        if lt > at:
            yield "text", html[at:lt], ""
        m = _TOKEN.match(html, lt) or _LOOSE.match(html, lt)
        if m is None:
            yield "text", "<", ""
            at = lt + 1
            continue
        at = m.end()
        name = m[2].lower() if m.re.groups and m[2] else ""
        if not name:
            continue
        yield ("end" if m[1] else "start"), name, m[3]
        if name in ("svg", "math") and (m[1] or not closed(m[3])):
            drawings = max(0, drawings - 1) if m[1] else drawings + 1
        if not m[1] and name in RAW and not (drawings and closed(m[3])):
            close = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(html, at)
            stop = close.start() if close else n
            yield "text", html[at:stop], ""
            at = stop


def closed(attrs: str) -> bool:
    """Whether a start tag ends in a slash that isn't part of an unquoted value."""
    return attrs.endswith("/") and not _SLASHED.search(attrs)


def attributes(attrs: str) -> dict[str, str]:
    """Attributes by lower-case name; the first of a name counts."""
    out: dict[str, str] = {}
    for m in _ATTR.finditer(attrs):
        out.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    return out


#: Media that a page's own rules may name and that hold for a reader on a screen.
SCREENS = re.compile(r"@media\s+(?:only\s+)?(?:all|screen)\s*\Z|@(?:layer|supports)\b", re.I)
_SELECTOR = re.compile(r"(\*|[A-Za-z][\w-]*)?(?:([.#])(-?[A-Za-z_][\w-]*))?\Z")
_DISPLAY = re.compile(r"(?:^|[;\s])display\s*:\s*([A-Za-z-]+)", re.I)
_PRELUDE = re.compile(r"[^{}]*")


class Rules:
    """What a page's own style sheets say of ``display``, for selectors of one tag, class or id, or a tag with one of these.

    An id outweighs a class and a class a tag; of equal ones the last counts. Other
    selectors, linked sheets and media other than the screen are left out.
    """

    def __init__(self, html: str = ""):
        self.none: dict[tuple[str, str, str], tuple[int, bool]] = {}
        self.count = 0
        if "<style" in html or "<STYLE" in html or "<Style" in html:
            for m in _STYLE.finditer(html):
                self._read(m[1])

    def _read(self, css: str) -> None:
        css, at, open_ = _COMMENT.sub(" ", css).replace("<!--", " ").replace("-->", " "), 0, []
        while at < len(css):
            m = _PRELUDE.match(css, at)
            text, at = m[0], m.end() + 1
            if css[m.end() : at] == "{":
                open_.append(text.rpartition(";")[2].strip())
            elif open_:
                heads, last = open_[:-1], open_.pop()
                if all(SCREENS.match(x) for x in heads) and not last.startswith("@") and (said := _DISPLAY.findall(text)):
                    for selector in last.split(","):
                        if (own := _SELECTOR.match(selector.strip())) and selector.strip():
                            self.count += 1
                            tag = (own[1] or "*").lower()
                            self.none[(tag, own[2] or "", own[3] or "")] = (self.count, said[-1].lower() == "none")

    def hide(self, name: str, found: dict[str, str]) -> bool:
        """Whether the rules take an element with these attributes out of the layout."""
        for kind, values in (("#", [found["id"]] if found.get("id") else []), (".", found.get("class", "").split()), ("", [""])):
            said = [x for v in values for tag in (name, "*") if (x := self.none.get((tag, kind, v)))]
            if said:
                return max(said)[1]
        return False


def hidden(name: str, attrs: str, rules: Rules | None = None) -> bool:
    """Whether an element and all below it take no part in the layout."""
    if name in HIDDEN:
        return True
    ruled = rules is not None and bool(rules.none)
    if name == "dialog":
        return "open" not in attributes(attrs)
    if not ruled and (not attrs or "hid" not in attrs.lower() and "none" not in attrs.lower()):
        return False
    if not attrs:
        return rules.hide(name, {})
    found = attributes(attrs)
    if "hidden" in found or name == "input" and found.get("type", "").lower() == "hidden":
        return True
    own = _DISPLAY.findall(found.get("style", ""))
    return own[-1].lower() == "none" if own else ruled and rules.hide(name, found)


def veil(attrs: str, before: bool) -> bool:
    """Whether an element's own text is invisible: it inherits that unless its style says otherwise."""
    if "visib" not in attrs.lower():
        return before
    said = _VISIBILITY.findall(attributes(attrs).get("style", ""))
    return said[-1].lower() != "visible" if said else before


def whole(text: str, default: int) -> int:
    """The whole number that an attribute starts with."""
    m = re.match(r"\s*([+-]?\d{1,9})", text)
    return int(m[1]) if m else default


class Flow:
    """Lines of one block container: the page or a table cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space = False
        self.gap = 0
        self.marker = ""
        self.indent = 0

    def text(self, data: str, pre: bool) -> None:
        if not data:
            return
        if pre:
            first, *rest = data.split("\n")
            if first:
                self.now.append(first)
            for line in rest:
                self.close(True)
                if line:
                    self.now.append(line)
            return
        if data.isspace():
            self.space = self.space or bool(self.now)
            return
        core = " ".join(w for w in _SPACE.split(data) if w) if "  " in data or "\n" in data or "\t" in data or "\r" in data or "\f" in data or "\v" in data else data.strip(" ")
        if self.now and (self.space or data[0] in " \t\n\r\f\v"):
            self.now.append(" ")
        self.now.append(core)
        self.space = data[-1] in " \t\n\r\f\v"

    def close(self, keep_empty: bool = False) -> None:
        """End the line; an empty one counts only where markup asks for it."""
        if self.now or keep_empty:
            if self.gap and self.lines:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            line = "".join(self.now).rstrip()
            pad = "  " * self.indent
            self.lines.append((pad[: max(0, len(pad) - len(self.marker))] + self.marker if self.marker else pad) + line if line else "")
            self.now, self.marker = [], ""
        self.space = False

    def block(self, gap: int) -> None:
        self.close()
        if self.lines:
            self.gap = max(self.gap, gap)

    def result(self) -> list[str]:
        self.close()
        return self.lines


def width_of(text: str) -> int:
    return len(text) if text.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def table_lines(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Rows of (cell lines, columns, rows) as lines with aligned columns.

    A cell stands in the first of its rows; in the others its columns stay empty. Where
    a cell over several columns is wider than they are, the last of them grows.
    """
    held: dict[int, int] = {}  # column -> rows that a cell from above still covers
    placed: list[list[tuple[list[str], int, int]]] = []
    for row in rows:
        at, out, new = 0, [], {}
        for lines, span, down in row:
            while at in held:
                out.append(([], at, 1))
                at += 1
            out.append((lines, at, span))
            if down > 1:
                new.update((c, down) for c in range(at, at + span))
            at += span
        out.extend(([], c, 1) for c in range(at, max(held, default=-1) + 1))
        placed.append(out)
        held = {c: n - 1 for c, n in (held | new).items() if n > 1}
    widths = [0] * max((at + span for row in placed for _, at, span in row), default=0)
    for row in placed:
        for lines, at, span in row:
            if span == 1 and lines:
                widths[at] = max(widths[at], max(map(width_of, lines)))
    for row in placed:
        for lines, at, span in row:
            if span > 1 and lines:
                widths[at + span - 1] += max(0, max(map(width_of, lines)) - sum(widths[at : at + span]) - 3 * (span - 1))
    out = []
    for row in placed:
        for k in range(max((len(lines) for lines, _, _ in row), default=0)):
            parts = []
            for lines, at, span in row:
                cell = lines[k] if k < len(lines) else ""
                wide = sum(widths[at : at + span]) + 3 * (span - 1)
                parts.append(cell + " " * max(0, wide - width_of(cell)))
            out.append(" | ".join(parts).rstrip())
    return out


def _spans(attrs: str) -> tuple[int, int]:
    """Columns and rows of a cell, within HTML's limits; 0 rows reach to the end."""
    if "span" not in attrs.lower():
        return 1, 1
    found = attributes(attrs)
    down = whole(found.get("rowspan", ""), 1)
    return min(1000, max(1, whole(found.get("colspan", ""), 1))), 65534 if down == 0 else min(65534, max(1, down))


def render(html: str | None) -> str:
    """All visible text of a page with its layout."""
    return layout(tokens(html or ""), Rules(html or ""))


def layout(found: Iterable[tuple[str, str, str]], rules: Rules | None = None) -> str:
    """The laid-out text of a page's tokens, under its style sheets' rules.

    Each tag costs a few look-ups however deep the page is: ``where`` has the places in the
    stack of the open elements of each name.
    """
    flow = Flow()
    stack: list[tuple[str, bool, bool]] = []  # name, hidden, whether text was invisible before
    where: dict[str, list[int]] = {}
    scopes = [-1]  # places of open elements that bound an end tag's search
    folded: dict[int, bool] = {}  # places of closed details -> whether their summary has come
    open_names: dict[str, int] = {}
    lists: list[list] = []  # kind, counter
    tables: list[dict] = []
    unseen = pre = 0
    veiled = False

    def leave() -> None:
        nonlocal flow, unseen, pre, veiled
        name, is_hidden, veiled = stack.pop()
        open_names[name] -= 1
        place = where[name].pop()
        if name in SCOPE:
            scopes.pop()
        if folded:
            folded.pop(place, None)
        if is_hidden:
            unseen -= 1
            return
        if unseen:
            return
        if name in ("td", "th") and tables and tables[-1]["cell"] is not None:
            outer, span, down = tables[-1]["cell"]
            tables[-1]["cell"] = None
            if not tables[-1]["rows"]:
                tables[-1]["rows"].append([])
            tables[-1]["rows"][-1].append((flow.result(), span, down))
            flow = outer
        elif name == "table" and tables:
            done = tables.pop()
            for line in table_lines(done["rows"]):
                flow.now = [line] if line else []
                flow.close(True)
            flow.block(1)
        elif name in ("ul", "ol", "menu") and lists:
            lists.pop()
            flow.block(0 if lists else 1)
            flow.indent = len(lists)
        elif name == "pre":
            pre -= 1
            flow.block(1)
        elif name == "li":
            flow.block(0)
            flow.marker = ""
        elif name == "button" or name == "text" and open_names.get("svg"):
            flow.text(" ", False)
        elif name in BLOCK:
            flow.block(1 if name in PARAGRAPH else 0)

    def end_until(names: set[str], bound: set[str] | frozenset) -> None:
        """End the open elements of these names that lie above the bound."""
        lowest = floor = None
        for x in names:
            if places := where.get(x):
                if floor is None:
                    floor = scopes[-1] if bound is SCOPE else max((p[-1] for y in bound if (p := where.get(y))), default=-1)
                k = bisect_right(places, floor)
                if k < len(places) and (lowest is None or places[k] < lowest):
                    lowest = places[k]
        if lowest is not None:
            while len(stack) > lowest:
                leave()

    for kind, name, attrs in found:
        if stack and stack[-1][0] == "head" and (name not in HEAD if kind == "start" else kind == "text" and name.strip(" \t\n\r\f")):
            while stack and stack[-1][0] == "head":
                leave()
        inside = bool(folded) and len(stack) - 1 in folded
        if kind == "text":
            if not unseen and not veiled and not inside:
                if open_names.get("svg") and not any(open_names.get(x) for x in DRAWN):
                    continue
                if tables and tables[-1]["cell"] is None and not name.strip():
                    continue
                flow.text(entities.unescape(name) if "&" in name else name, bool(pre))
            continue
        if kind == "start":
            if name in IMPLIED:
                end_until(*IMPLIED[name])
            if name in ENDS_P:
                end_until({"p"}, SCOPE)
            foreign = open_names.get("svg") or open_names.get("math")
            if foreign and name in LEAVES and not any(open_names.get(x) for x in HOSTS):
                while open_names.get("svg") or open_names.get("math"):
                    leave()
                foreign = 0
            if (foreign or name in ("svg", "math")) and closed(attrs) and not (name not in ("svg", "math") and open_names.get("foreignobject")):
                continue
            gone = hidden(name, attrs, rules) or bool(foreign) and name in UNDRAWN
            if folded and len(stack) - 1 in folded:  # of closed details only the first summary is shown
                gone = gone or name != "summary" or folded[len(stack) - 1]
                folded[len(stack) - 1] |= name == "summary"
            if name in VOID:
                if unseen or gone or veil(attrs, veiled):
                    continue
                if name == "br":
                    flow.close(True)
                elif name == "hr":
                    flow.block(1)
                elif name == "img" and "alt" in attrs.lower():
                    alt = attributes(attrs).get("alt", "")
                    if alt.strip():
                        flow.text(alt, False)
                elif name == "input" and "value" in attrs.lower():
                    own = attributes(attrs)
                    if own.get("type", "text").lower() in SHOWN_INPUTS:
                        flow.text(f" {own.get('value', '')} ", False)
                continue
            if name in where:
                where[name].append(len(stack))
            else:
                where[name] = [len(stack)]
            if name in SCOPE:
                scopes.append(len(stack))
            if name == "details" and "open" not in attributes(attrs):
                folded[len(stack)] = False
            stack.append((name, gone, veiled))
            veiled = veil(attrs, veiled)
            open_names[name] = open_names.get(name, 0) + 1
            if gone:
                unseen += 1
            if unseen:
                continue
            if name == "table":
                flow.block(1)
                tables.append({"rows": [], "cell": None})
            elif name == "tr" and tables and tables[-1]["cell"] is None:
                tables[-1]["rows"].append([])
            elif name in ("td", "th") and tables and tables[-1]["cell"] is None:
                tables[-1]["cell"] = (flow, *_spans(attrs))
                flow = Flow()
            elif name in ("ul", "ol", "menu"):
                flow.block(0 if lists else 1)
                lists.append([name, whole(attributes(attrs).get("start", ""), 1) - 1 if attrs else 0])
                flow.indent = len(lists)
            elif name == "li":
                flow.block(0)
                if lists:
                    lists[-1][1] = whole(attributes(attrs).get("value", "") if attrs else "", lists[-1][1] + 1)
                    flow.marker = "" if veiled else f"{lists[-1][1]}. " if lists[-1][0] == "ol" else "* "
                else:
                    flow.marker = "" if veiled else "* "
            elif name == "button" or name == "text" and foreign:
                flow.text(" ", False)
            elif name == "pre":
                flow.block(1)
                pre += 1
            elif name == "dd":
                flow.block(0)
                flow.marker = "  "
            elif name in BLOCK:
                flow.block(1 if name in PARAGRAPH else 0)
        elif open_names.get(name):
            nearest = where[name][-1]
            if nearest > scopes[-1] or name in SCOPE or name in ("tr", "thead", "tbody", "tfoot"):
                while len(stack) > nearest:
                    leave()
        elif name == "p" and not unseen:
            flow.block(1)
    while stack:
        leave()
    return "\n".join(flow.result()).strip("\n")


def extract_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text, n_chars, n_lines) for each page; the whole visible text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                id_col: batch.column(0), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64()),
                "n_lines": pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64()),
            })

    rows = slim(pages, id_col, html_col)
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, text string, n_chars long, n_lines long")
