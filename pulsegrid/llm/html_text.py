"""Visible text of HTML pages, laid out: a small tree builder and a renderer.

The builder supplies tags that pages leave out (a new paragraph ends the open one, a list item the
item before, a cell the cell, rows and sections of tables follow suit) and the renderer leaves out
what a browser without scripts does not show. Blocks stand on lines of their own, paragraphs,
headings, lists and tables between blank lines; list items carry their mark and are indented; table
cells are padded to the width of their column. All text that is visible is kept.

Style sheets of the page are read for ``display`` and ``visibility`` as on a screen of 1280 by 800:
importance, layers, specificity and order decide. Selectors of tags, classes and ids with descendant
and child combinators count, others are not read; where a condition cannot be decided (``@supports``,
``@container``, unknown media features), a rule in it may show text but not hide any.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import bound_batches

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head title script style template iframe noembed noframes datalist object video "
                   "audio canvas area base col colgroup link meta param source track".split())
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr menu dir xmp".split())
BLOCK = MARGIN | frozenset("html body div section article aside header footer main nav address form "
                           "fieldset legend li dt dd tr td th thead tbody tfoot caption center details "
                           "summary dialog figcaption hgroup search option optgroup".split())
ENDS_P = BLOCK - frozenset("html body tr td th thead tbody tfoot caption option optgroup legend".split())
HEAD_ONLY = frozenset("base link meta title style script template noscript".split())
# an element of the key ends open elements of the values, up to the nearest of its bounds
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th", "caption"}, {"table"}), "th": ({"td", "th", "caption"}, {"table"}),
    "tr": ({"td", "th", "tr", "caption"}, {"table"}),
    **{x: ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}) for x in ("thead", "tbody", "tfoot")},
}
SCOPE = frozenset("table td th caption template html".split())
TABLE_PARTS = frozenset("table thead tbody tfoot tr td th caption".split())
ONLY_IN_TABLE = frozenset("thead tbody tfoot tr td th caption col colgroup".split())
# start tags that end svg and math around them, and elements in which HTML goes on
BREAKS_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img "
                       "li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul "
                       "var".split())
HTML_AGAIN = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
UNSEEN_IN_SVG = frozenset("title desc metadata defs symbol clippath mask marker pattern filter lineargradient "
                          "radialgradient".split())
UNSEEN_IN_MATH = frozenset("annotation annotation-xml mphantom".split())
DEEPEST, DEEPEST_TABLE = 150, 190
WIDE, HIGH = 1280, 800

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
BLANK = re.compile(r"[ \t\n\f\r]+")
CLOSED = re.compile(r"=\s*[^\s\"'>]*/\Z")
CSS_COMMENT = re.compile(r"(\"(?:[^\"\\\n]|\\.)*+\"|'(?:[^'\\\n]|\\.)*+')|/\*.*?(?:\*/|\Z)", re.S)
CSS_PART = re.compile(r"\"(?:[^\"\\\n]|\\.)*+\"?|'(?:[^'\\\n]|\\.)*+'?|\\.|[{};]", re.S)
IMPORTANT = re.compile(r"\s*!\s*important\Z", re.I)
NAME = r"(?:[\w-]|[^\x00-\x7f]|\\.)+"
COMPOUND = re.compile(rf"(\*|[a-z][\w-]*)?((?:[.#]{NAME})*)\Z", re.I)
PARTS = re.compile(rf"([.#])({NAME})")
FEATURE = re.compile(r"\(\s*(?:(min|max)-)?(?:device-)?(width|height|orientation|prefers-color-scheme)\s*"
                     r"(:|[<>]=?)\s*([\d.]+|[a-z]+)\s*(px|r?em)?\s*\)\Z")
SHOWS = frozenset("block inline inline-block flex inline-flex grid inline-grid flow flow-root contents list-item "
                  "table inline-table table-row table-cell table-caption table-column table-column-group "
                  "table-row-group table-header-group table-footer-group ruby ruby-text math initial inherit unset "
                  "revert revert-layer -webkit-box -webkit-inline-box -webkit-flex -webkit-inline-flex".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs or {}, [], parent


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), unescape(next((v for v in values if v), "")))
    return out


class Builder:
    """Builds a tree below ``body``; what belongs in the head hangs below ``head``."""

    def __init__(self):
        self.root = Node("html")
        self.head, self.body = Node("head", None, self.root), Node("body", None, self.root)
        self.open = [self.body]
        self.foreign = False  # whether svg or math was seen
        self.started = False  # whether content of the body was seen

    def text(self, data: str) -> None:
        top = self.open[-1]
        if top.tag in ("table", "tbody", "thead", "tfoot", "tr"):
            if not data.strip():
                return
            # text between the parts of a table stands before the table
            at = max((i for i, n in enumerate(self.open) if n.tag == "table"), default=0)
            if at:
                siblings = self.open[at - 1].children
                siblings.insert(siblings.index(self.open[at]), data)
            else:
                top.children.append(data)
        else:
            top.children.append(data)
        self.started = self.started or bool(data.strip())

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag == "html":
            for name, value in attrs.items():
                self.root.attrs.setdefault(name, value)
        if tag in ("html", "head", "body"):
            if tag != "head":
                for name, value in attrs.items():
                    self.body.attrs.setdefault(name, value)
            return
        if not self.started and tag in HEAD_ONLY and tag not in ("noscript", "template"):
            self.head.children.append(Node(tag, attrs, self.head))
            return
        if tag in ONLY_IN_TABLE and not any(n.tag == "table" for n in self.open):
            return
        self.started = True
        if self.foreign and tag in BREAKS_OUT:
            at = self.foreign_at()
            if at:
                del self.open[at:]
        self.foreign = self.foreign or tag in ("svg", "math")
        if tag in ENDS_P:
            self.close({"p"}, SCOPE)
        if tag in IMPLIED_END:
            self.close(*IMPLIED_END[tag])
        if re.fullmatch("h[1-6]", tag) and re.fullmatch("h[1-6]", self.open[-1].tag):
            self.open.pop()
        if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self.push(Node("tr"))
        self.push(Node(tag, attrs))
        if tag in VOID:
            self.open.pop()

    def push(self, node: Node) -> None:
        # deeper elements hang beside each other, as in browsers: nothing is lost; tables and what
        # their cells hold keep together for a little longer
        deep = len(self.open)
        if deep > DEEPEST and node.tag not in VOID and (
                deep > DEEPEST_TABLE or not (node.tag in ONLY_IN_TABLE or self.open[-1].tag in TABLE_PARTS)):
            self.open.pop()
        node.parent = self.open[-1]
        node.parent.children.append(node)
        self.open.append(node)

    def foreign_at(self) -> int:
        """Where the outermost of the svg and math elements is open that the text in work is part of, or 0."""
        found = 0
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in HTML_AGAIN:
                break
            if self.open[at].tag in ("svg", "math"):
                found = at
        return found

    def close(self, tags: set[str], bounds: set[str] | frozenset[str]) -> None:
        """End the outermost open element of these tags that lies within the nearest bound."""
        found = None
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in tags:
                found = at
            elif self.open[at].tag in bounds:
                break
        if found:
            del self.open[found:]

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {})
        elif tag == "p" and not any(n.tag == "p" for n in self.open):
            self.start("p", {})
            self.open.pop()
        elif tag not in ("html", "body", "head"):
            bound = {"table"} if tag in IMPLIED_END or tag == "caption" else SCOPE - {tag}
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at].tag == tag or (tag[0] == "h" and re.fullmatch("h[1-6]h[1-6]", tag + self.open[at].tag)):
                    del self.open[at:]
                    return
                if self.open[at].tag in bound and tag != "table":
                    return


def parse(html: str) -> Builder:
    builder, at, n = Builder(), 0, len(html)
    lower = None
    while at < n:
        found = TOKEN.search(html, at)
        if found is None:
            builder.text(unescape(html[at:]))
            break
        if found.start() > at:
            builder.text(unescape(html[at:found.start()]))
        at = found.end()
        if not found["name"]:
            continue
        tag = found["name"].lower()
        if found["end"]:
            builder.end(tag)
            continue
        source = found["attrs"]
        closed = source.endswith("/") and not CLOSED.search(source) and (
            tag in ("svg", "math") or builder.foreign and builder.foreign_at() > 0)
        builder.start(tag, attributes(source) if source else {})
        if closed and builder.open[-1].tag == tag:
            builder.open.pop()
            continue
        if tag in RAW:
            lower = lower if lower is not None else html.lower()
            if len(lower) != n:  # lower case of a few letters is longer
                close = re.compile(f"</{tag}", re.I).search(html, at)
                stop = close.start() if close else n
            else:
                stop = lower.find(f"</{tag}", at)
                stop = n if stop < 0 else stop
            data = html[at:stop]
            top = builder.open[-1]
            if top.tag == tag:
                top.children.append(unescape(data) if tag in ("textarea", "title") else data)
            elif builder.head.children:
                builder.head.children[-1].children.append(data)
            at = stop
    return builder


# --- style sheets -----------------------------------------------------------------------
def css_blocks(css: str, nested: bool) -> Iterator[tuple[str, str | None]]:
    """Rules as (prelude, body); what ends without a block, such as a declaration, has no body."""
    depth = start = 0
    prelude = ""
    for part in CSS_PART.finditer(css):
        if part[0] == "{":
            if not depth:
                prelude, start = css[start:part.start()].strip(), part.end()
            depth += 1
        elif part[0] == "}" and depth:
            depth -= 1
            if not depth:
                yield prelude, css[start:part.start()]
                start = part.end()
        elif part[0] == ";" and not depth and (nested or css[start:part.start()].lstrip().startswith("@")):
            yield css[start:part.start()].strip(), None
            start = part.end()
    if depth:
        yield prelude, css[start:]
    elif css[start:].strip():
        yield css[start:].strip(), None


def _every(values: list[bool | None]) -> bool | None:
    return False if False in values else None if None in values else True


def media_applies(media: str) -> bool | None:
    """Whether a list of media queries holds on the screen; None if that cannot be decided."""
    found = []
    for query in media.lower().split(","):
        query = query.strip()
        negated = bool(re.match(r"not\s+[a-z]", query))
        query = re.sub(r"\A(?:not|only)\s+(?=[a-z])", "", query)
        values = [_feature(x) if "(" in x else x in ("all", "screen", "") for x in re.split(r"\s*\band\b\s*", query)]
        value = _every(values)
        found.append(value if value is None or not negated else not value)
    return True if True in found else None if None in found else False


def _feature(text: str) -> bool | None:
    m = FEATURE.match(text.strip())
    if not m:
        return None
    bound, name, sign, value, unit = m.groups()
    if name == "orientation" or name == "prefers-color-scheme":
        return value in ("landscape", "light") if value in ("landscape", "portrait", "light", "dark") else None
    if not re.fullmatch(r"\d*\.?\d+|\d+\.", value):
        return None
    size, limit = (WIDE if name == "width" else HIGH), float(value) * (16 if unit and unit != "px" else 1)
    if sign == ":":
        return size >= limit if bound == "min" else size <= limit if bound == "max" else size == limit
    if bound:
        return None
    return {"<": size < limit, "<=": size <= limit, ">": size > limit, ">=": size >= limit}[sign]


def declared(name: str, value: str) -> tuple[str, str, bool] | None:
    """(display or visibility, its value, whether important), if the declaration is valid."""
    name, value = name.strip().lower(), value.strip().lower()
    important = bool(IMPORTANT.search(value))
    value = IMPORTANT.sub("", value)
    if name == "display" and (value == "none" or "(" in value or all(x in SHOWS for x in value.split())) or (
            name == "visibility" and value in ("hidden", "collapse", "visible", "initial", "inherit", "unset")):
        return (name, value, important) if value else None
    return None


def selector_parts(selector: str) -> tuple | None:
    """(specificity, [(combinator before it, tag, ids, classes)]) or None if it is not one that is read."""
    out, ids, classes, tags, combinator = [], 0, 0, 0, " "
    for text in re.findall(r"(?:\\.|[^\s>\\])+|>", selector):
        if text == ">":
            combinator = ">"
            continue
        compound = COMPOUND.match(text)
        if not compound:
            return None
        names = [(k, re.sub(r"\\(.)", r"\1", x)) for k, x in PARTS.findall(compound[2])]
        tag = "" if compound[1] in (None, "*") else compound[1].lower()
        own = ([x for k, x in names if k == "#"], [x for k, x in names if k == "."])
        ids, classes, tags = ids + len(own[0]), classes + len(own[1]), tags + bool(tag)
        out.append((combinator, tag, *own))
        combinator = " "
    return ((0, ids, classes, tags), out) if out else None


class Styles:
    """Rules of the page's style sheets on display and visibility, by the last name of their selector."""

    def __init__(self, builder: Builder):
        self.rules: dict[str, list[tuple]] = {}
        self.count = 0
        stack = [builder.body, builder.head]
        while stack:
            node = stack.pop()
            if node.tag == "style":
                applies = media_applies(node.attrs.get("media", ""))
                if applies is not False and node.attrs.get("type", "text/css").strip().lower() in ("", "text/css"):
                    css = "".join(x for x in node.children if isinstance(x, str))
                    css = CSS_COMMENT.sub(lambda m: m[1] or "", css).replace("<!--", "").replace("-->", "")
                    self.read(css, applies, False, None, 0)
            elif node.tag != "template":
                stack.extend(x for x in reversed(node.children) if isinstance(x, Node))

    def read(self, css: str, applies: bool | None, layered: bool, selectors: list[str] | None, depth: int) -> None:
        for prelude, body in css_blocks(css, selectors is not None):
            if body is None:
                name, _, value = prelude.partition(":")
                found = declared(name, value)
                # a rule whose condition is not decided does not hide
                if found and selectors and (applies or found[1] not in ("none", "hidden", "collapse")):
                    self.add(selectors, found, layered)
            elif depth > 30:
                continue
            elif prelude.startswith("@"):
                kind = re.match(r"@[-\w]*", prelude)[0].lower()
                if kind in ("@media", "@supports", "@container", "@scope", "@layer"):
                    holds = {"@media": media_applies(prelude[6:]), "@layer": True}.get(kind)
                    if holds is not False:
                        self.read(body, _every([applies, holds]), layered or kind == "@layer", selectors, depth + 1)
            else:
                own = [x.strip() for x in prelude.split(",")]
                if selectors is not None:
                    own = [x.replace("&", p) if "&" in x else f"{p} {x}" for p in selectors for x in own]
                # rules nested in lists of rules can stand for more selectors than can be read
                if selectors is None or len(own) <= 10_000:
                    self.read(body, applies, layered, own, depth + 1)

    def add(self, selectors: list[str], found: tuple[str, str, bool], layered: bool) -> None:
        name, value, important = found
        self.count += 1
        for selector in selectors:
            parts = selector_parts(selector)
            if parts:
                _, tag, ids, classes = parts[1][-1]
                key = f"#{ids[0]}" if ids else f".{classes[0]}" if classes else tag
                weight = (important, layered == important, parts[0], self.count)
                self.rules.setdefault(key, []).append((weight, parts[1], name, value))

    def of(self, node: Node) -> dict[str, str]:
        """The values of display and visibility that are declared for an element."""
        a, best = node.attrs, {}
        if self.rules:
            keys = ["", node.tag, *(f".{x}" for x in set(a.get("class", "").split())), *([f"#{a['id']}"] if "id" in a else [])]
            for key in keys:
                for weight, parts, name, value in self.rules.get(key, ()):
                    if (name not in best or weight > best[name][0]) and _matches(node, parts):
                        best[name] = (weight, value)
        if "style" in a:
            for at, part in enumerate(CSS_COMMENT.sub(lambda m: m[1] or "", a["style"]).split(";")):
                found = declared(*part.partition(":")[::2])
                if found:
                    weight = (found[2], True, (1, 0, 0, 0), at)
                    if found[0] not in best or weight > best[found[0]][0]:
                        best[found[0]] = (weight, found[1])
        return {name: value for name, (_, value) in best.items()}


def _matches(node: Node, parts: list[tuple]) -> bool:
    combinator, *names = parts[-1]
    if not _named(node, *names):
        return False
    if len(parts) == 1:
        return True
    above, up = [], node.parent
    while up is not None:
        above.append(up)
        up = up.parent
    found = [-1]  # where in the chain of ancestors the part before may stand
    for before, *names in reversed(parts[:-1]):
        at = [i + 1 for i in found if i + 1 < len(above)] if combinator == ">" else range(found[0] + 1, len(above))
        found = [i for i in at if _named(above[i], *names)]
        if not found:
            return False
        combinator = before
    return True


def _named(node: Node, tag: str, ids: list[str], classes: list[str]) -> bool:
    if tag and tag != node.tag or any(x != node.attrs.get("id") for x in ids):
        return False
    return not classes or set(classes) <= set(node.attrs.get("class", "").split())


class Lines:
    """Output of one box: finished lines, the line in work and the blank lines still owed."""

    def __init__(self):
        self.done: list[str] = []
        self.line = ""
        self.owed = 0

    def text(self, data: str, kept: bool) -> None:
        if kept:
            first, *rest = data.replace("\r\n", "\n").split("\n")
            self.add(first)
            for part in rest:
                self.newline(True)
                self.add(part)
            return
        data = BLANK.sub(" ", data)
        if not self.line or self.line[-1] == " ":
            data = data.lstrip(" ")
        self.add(data)

    def add(self, data: str) -> None:
        if data:
            if not self.line and self.owed and self.done:
                self.done.extend([""] * (self.owed - 1))
            if not self.line:
                self.owed = 0
            self.line += data

    def newline(self, forced: bool = False) -> None:
        if self.line or forced:
            self.done.append(self.line.rstrip(" "))
            self.line = ""

    def block(self, margin: bool) -> None:
        """End the line; ask for a blank line if the block has a margin."""
        self.newline()
        self.owed = max(self.owed, 2 if margin else 1)

    def box(self, lines: list[str]) -> None:
        if lines:
            if self.owed and self.done:
                self.done.extend([""] * (self.owed - 1))
            self.owed = 0
            self.done.extend(lines)

    def finish(self) -> list[str]:
        self.newline()
        while self.done and not self.done[-1]:
            self.done.pop()
        return self.done


class Renderer:
    def __init__(self, builder: Builder):
        self.styles = Styles(builder)

    def unseen(self, node: Node) -> bool:
        a = node.attrs
        if node.tag in UNSEEN:
            return True
        if node.tag == "input" and a.get("type", "").lower() in ("hidden", "password", "checkbox", "radio", "file"):
            return True
        own = self.styles.of(node) if self.styles.rules or "style" in a else {}
        display = own.get("display")
        if display == "none" or not display and ("hidden" in a or (node.tag == "dialog" and "open" not in a)):
            return True
        if own.get("visibility") in ("hidden", "collapse"):
            node.children = self.visible_parts(node)
            return not node.children
        return False

    def visible_parts(self, node: Node) -> list[Node]:
        """Children of an invisible element that are, or hold, elements made visible again."""
        out = []
        for child in node.children:
            if isinstance(child, Node) and not self.unseen(child):
                if (self.styles.of(child).get("visibility") or child.attrs.get("visibility")) not in (
                        "visible", "initial", "hidden", "collapse"):
                    child.children = self.visible_parts(child)
                    if not child.children:
                        continue
                out.append(child)
        return out

    def children(self, node: Node, out: Lines, kept: bool) -> None:
        for child in node.children:
            if isinstance(child, str):
                out.text(child, kept)
            elif not self.unseen(child):
                self.element(child, out, kept)

    def element(self, node: Node, out: Lines, kept: bool) -> None:
        tag = node.tag
        if tag == "br":
            out.newline(True)
        elif tag == "input":
            out.text(node.attrs.get("value", ""), False)
        elif tag in ("ul", "ol", "menu", "dir"):
            out.block(True)
            out.box(self.list_lines(node, kept))
            out.block(True)
        elif tag == "table":
            out.block(True)
            out.box(self.table_lines(node, kept))
            out.block(True)
        elif tag in ("blockquote", "dd"):
            out.block(tag in MARGIN)
            out.box([f"  {x}" if x else x for x in self.lines(node, kept)])
            out.block(tag in MARGIN)
        elif tag == "svg":
            self.drawing(node, out, kept, False)
        elif tag in UNSEEN_IN_MATH and _within(node, "math"):
            return
        elif tag in ("mtr", "mlabeledtr"):
            out.block(False)
            self.children(node, out, kept)
            out.block(False)
        elif tag == "mtd":
            self.children(node, out, kept)
            out.text(" ", False)
        elif tag == "details" and "open" not in node.attrs:
            out.block(False)
            for child in node.children:
                if isinstance(child, Node) and child.tag == "summary" and not self.unseen(child):
                    self.element(child, out, kept)
                    break
            out.block(False)
        elif tag in BLOCK:
            out.block(tag in MARGIN)
            self.children(node, out, kept or tag in ("pre", "xmp"))
            out.block(tag in MARGIN)
        else:
            self.children(node, out, kept or tag == "textarea")

    def drawing(self, node: Node, out: Lines, kept: bool, written: bool) -> None:
        """Text elements of an svg, each on a line of its own; other characters are not drawn."""
        for child in node.children:
            if isinstance(child, str):
                if written:
                    out.text(child, kept)
                continue
            a = child.attrs
            own = {"display": a.get("display", ""), "visibility": a.get("visibility", ""), **self.styles.of(child)}
            if child.tag in UNSEEN_IN_SVG or own["display"] == "none" or self.unseen(child):
                continue
            if own["visibility"] in ("hidden", "collapse"):
                child.children = self.visible_parts(child)
            if child.tag in ("text", "foreignobject"):
                out.block(False)
                if child.tag == "text":
                    self.drawing(child, out, kept, True)
                else:
                    self.children(child, out, kept)
                out.block(False)
            else:
                if child.tag == "tspan" and "x" in a and ("y" in a or "dy" in a):
                    out.newline()
                self.drawing(child, out, kept, written)

    def lines(self, node: Node, kept: bool) -> list[str]:
        out = Lines()
        self.children(node, out, kept)
        return out.finish()

    def list_lines(self, node: Node, kept: bool) -> list[str]:
        items = [c for c in node.children if isinstance(c, Node) and c.tag == "li" and not self.unseen(c)]
        step = -1 if "reversed" in node.attrs else 1
        number = _whole(node.attrs.get("start"), len(items) if step < 0 else 1)
        own = {id(item) for item in items}
        out: list[str] = []
        for child in node.children:
            if id(child) in own:
                number = _whole(child.attrs.get("value"), number)
                mark = f"{number}. " if node.tag == "ol" else "- "
                number += step
                first, *rest = self.lines(child, kept) or [""]
                out.append(f"{mark}{first}".rstrip())
                out.extend(" " * len(mark) + x if x else x for x in rest)
            else:
                # anything but an item, such as a list directly in a list, is indented like one
                box = Node("div")
                box.children = [child]
                out.extend(f"  {x}" if x else x for x in self.lines(box, kept))
        return out

    def table_lines(self, node: Node, kept: bool) -> list[str]:
        rows: list[Node] = []
        out: list[str] = []
        for child in node.children:
            parts = child.children if isinstance(child, Node) and child.tag in ("thead", "tbody", "tfoot") else [child]
            if isinstance(child, Node) and self.unseen(child):
                continue
            for part in parts:
                if isinstance(part, Node) and part.tag == "tr" and not self.unseen(part):
                    rows.append(part)
                else:
                    box = Node("div")
                    box.children = [part]
                    out.extend(self.lines(box, kept))
        grid: list[dict[int, list[str]]] = []
        spans: dict[int, int] = {}  # rows that a cell from above still takes, by column
        single: list[tuple[int, int, list[str]]] = []
        for row in rows:
            column, cells = 0, {}
            below = {c: n - 1 for c, n in spans.items() if n > 1}
            for cell in row.children:
                if isinstance(cell, str):
                    continue
                if self.unseen(cell):
                    continue
                while column in spans:
                    column += 1
                lines = self.lines(cell, kept)
                wide = min(max(_whole(cell.attrs.get("colspan"), 1), 1), 1000)
                high = min(max(_whole(cell.attrs.get("rowspan"), 1), 1), 65534)
                cells[column] = lines
                if wide == 1:
                    single.append((len(grid), column, lines))
                if high > 1:
                    below.update({c: high - 1 for c in range(column, column + wide)})
                column += wide
            spans = below
            grid.append(cells)
        width: dict[int, int] = {}
        for _, column, lines in single:
            width[column] = max([width.get(column, 0), *map(len, lines)])
        for cells in grid:
            for k in range(max([0, *map(len, cells.values())])):
                line = ""
                for column in sorted(cells):
                    at = sum(width.get(c, 0) + 2 for c in range(column))
                    part = cells[column][k] if k < len(cells[column]) else ""
                    if part:
                        line = line.ljust(at) if len(line) < at or not line else f"{line}  "
                        line += part
                out.append(line.rstrip(" "))
        return out


def _within(node: Node, tag: str) -> bool:
    while node.parent is not None:
        node = node.parent
        if node.tag == tag:
            return True
    return False


def _whole(value: str | None, default: int) -> int:
    return int(value) if value and re.fullmatch(r"-?\d{1,9}", value.strip()) else default


def render(html: str | None) -> str:
    """The visible text of a page; null and empty pages have none."""
    if not html:
        return ""
    builder = parse(html)
    renderer = Renderer(builder)
    return "" if renderer.unseen(builder.body) else "\n".join(renderer.lines(builder.body, False)).strip("\n")


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` instead of the page source.

    Null and empty pages give an empty text; pages of any length are rendered whole; repeated rows
    and other columns pass through; a column ``text`` of the input is replaced; an empty table gives
    no rows.
    """
    bound_batches(pages.sparkSession)
    kept = [c for c in pages.columns if c not in (html, "text")]
    rows = pages.select(*kept, F.col(html).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([render(x) for x in batch.column(len(kept)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)
