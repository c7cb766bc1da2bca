"""Layout-aware text of HTML pages.

A tokenizer cuts the page into tags and text; a tree builder adds the tags that HTML implies
(closing p, li, td, tr and others); hidden parts (script, style, head apart from nothing, hidden or
display:none elements, comments) are left out; a renderer writes all visible text: blocks on lines
of their own, one blank line between paragraphs and headings, list items with markers and indents,
table rows as lines whose cells are padded to the widest cell of their column, preformatted text as
it stands.  Cells that span columns or rows keep the cells beside and below them in their columns.

Defined cases: null html gives null text, empty html the empty text; unclosed or stray tags, cut
entities and a tag cut at the end of the page are tolerated; a quote opens a value only behind ``=``
and only if the page closes it, else it is an ordinary character; numbers in attributes that are no
numbers or longer than nine digits count as absent, spans are bounded as HTML bounds them (1,000
columns, the rows of their group); rows with one id are separate rows; other columns are ignored.
Nesting beyond ``MAX_DEPTH`` is flattened, its text is kept.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from faultline.llm.common import in_pandas

MAX_DEPTH = 200
# Fixed value: the widest column span of HTML.
MAX_COLSPAN = 1000

# Element names and their roles in HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"script", "style", "head", "title", "template", "noscript", "iframe", "object", "svg", "math", "select", "datalist",
          "audio", "video", "canvas"}
RAW = {"script", "style", "title", "textarea", "noscript", "iframe"}
SPACED = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "table", "blockquote", "pre", "figure", "hr"}
BLOCK = SPACED | {"address", "article", "aside", "body", "caption", "dd", "details", "dialog", "div", "dt", "fieldset",
                  "figcaption", "footer", "form", "header", "hgroup", "html", "legend", "li", "main", "nav", "section",
                  "summary", "tbody", "td", "tfoot", "th", "thead", "tr", "option"}
# An opening tag closes these open elements, up to the nearest boundary.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, set()),
}
P_ENDS = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "legend"}

_TOKEN = re.compile(
    r"<!--(?:-?>|(?P<comment>.*?)(?:--!?>|\Z))|<(?P<other>[!?][^>]*)(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<start>[a-zA-Z][^\s/>]*)"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
# One attribute: blanks and slashes, a name (a first = belongs to it), perhaps a value.
_ATTRIBUTE = re.compile(
    r"[\s/]*(?P<name>[^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"(?P<two>[^\"]*)\"|'(?P<one>[^']*)'|(?P<bare>[^\s>]+)|(?=>|\Z)))?", re.S
)
_TAG_END = re.compile(r"[\s/]*(?:>|\Z)")
_NUMBER = re.compile(r"\s*([+-]?[0-9]{1,9})(?![0-9])")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I) for tag in RAW}
_BLANK = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "parts")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.parts = tag, attrs, []


def _number(attrs: dict[str, str], name: str) -> int | None:
    found = _NUMBER.match(attrs.get(name, ""))
    return int(found[1]) if found else None


def _start_tag(page: str, at: int) -> tuple[dict[str, str], bool, int]:
    """The attributes behind a tag name (the first of equal names counts), whether the tag closes
    itself, and where it ends."""
    attrs: dict[str, str] = {}
    while True:
        end = _TAG_END.match(page, at)
        if end:
            return attrs, end[0].endswith("/>"), end.end()
        found = _ATTRIBUTE.match(page, at)
        value = next((v for v in (found["two"], found["one"], found["bare"]) if v is not None), "")
        attrs.setdefault(found["name"].lower(), html.unescape(value))
        at = found.end()


def tokens(page: str) -> Iterator[tuple]:
    """("text", text), ("start", tag, attributes, closes itself, raw content or None) and ("end", tag)."""
    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.match(page, at)
        at = token.end()
        if token["text"] is not None:
            yield "text", html.unescape(token["text"])
        elif token["end"] is not None:
            yield "end", token["end"].lower()
        elif token["start"] is not None:
            tag = token["start"].lower()
            attrs, closed, at = _start_tag(page, at)
            raw = None
            if tag in RAW:
                end = _RAW_END[tag].search(page, at)
                raw = page[at : end.start() if end else size]
                at = end.end() if end else size
            yield "start", tag, attrs, closed, raw


def tree(page: str) -> Node:
    """The element tree of a page; text nodes are strings with entities resolved."""
    root = Node("#root", {})
    open_ = [root]

    def close(names: set[str], until: set[str]) -> None:
        for place in range(len(open_) - 1, 0, -1):
            if open_[place].tag in until:
                return
            if open_[place].tag in names:
                rest = [n for n in open_[1:place] if n.tag in names and not any(
                    o.tag in until for o in open_[open_.index(n) + 1 : place])]
                del open_[open_.index(rest[0]) if rest else place :]
                return

    for kind, tag, *rest in tokens(page):
        if kind == "text":
            open_[-1].parts.append(tag)
        elif kind == "start":
            attrs, closed, raw = rest
            if tag in P_ENDS:
                close({"p"}, {"table", "td", "th", "caption", "button", "object"})
            if tag in CLOSES:
                close(*CLOSES[tag])
            node = Node(tag, attrs)
            open_[-1].parts.append(node)
            if raw is not None:
                node.parts.append(html.unescape(raw) if tag in ("title", "textarea") else raw)
            elif tag not in VOID and not closed and len(open_) < MAX_DEPTH:
                open_.append(node)
        else:
            if tag == "br":
                open_[-1].parts.append(Node("br", {}))
                continue
            for place in range(len(open_) - 1, 0, -1):
                if open_[place].tag == tag:
                    del open_[place:]
                    break
                if open_[place].tag in ("table", "td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                    break
    return root


def hidden(node: Node) -> bool:
    attrs = node.attrs
    return (
        node.tag in HIDDEN
        or "hidden" in attrs
        or (node.tag == "input" and attrs.get("type", "").lower() == "hidden")
        or (node.tag == "dialog" and "open" not in attrs)
        or ("style" in attrs and bool(_NO_DISPLAY.search(attrs["style"])))
    )


class _Lines:
    """Lines under way: inline text is joined with collapsed blanks, blocks break lines."""

    def __init__(self):
        self.done: list[str] = []
        self.line: list[str] = []
        self.gap = False

    def text(self, text: str) -> None:
        parts = _BLANK.sub(" ", text)
        if parts.startswith(" ") and (not self.line or self.line[-1].endswith(" ")):
            parts = parts[1:]
        if parts:
            self.line.append(parts)

    def end(self, spaced: bool = False) -> None:
        line = "".join(self.line).strip(" ")
        self.line = []
        if line:
            self.put([line])
        self.gap = self.gap or spaced

    def put(self, lines: list[str]) -> None:
        if self.gap and self.done:
            self.done.append("")
        self.gap = False
        self.done += lines


def _indented(lines: list[str], first: str) -> list[str]:
    rest = " " * len(first)
    return [(first if i == 0 else rest if line else "") + line for i, line in enumerate(lines)]


def _table_rows(node: Node) -> tuple[list[list[tuple[int, int, list[str]]]], list[int], list[str]]:
    """Rows of (columns, rows, lines) per cell, the end of each row's group, and loose texts."""
    rows: list[list[tuple[int, int, list[str]]]] = []
    group_ends: list[int] = []
    captions: list[str] = []

    def end_group() -> None:
        group_ends.extend([len(rows)] * (len(rows) - len(group_ends)))

    def walk(part: Node) -> None:
        loose = False
        for child in part.parts:
            if isinstance(child, str):
                if child.strip():
                    captions.append(_BLANK.sub(" ", child).strip())
            elif hidden(child):
                continue
            elif child.tag == "tr":
                rows.append([])
                walk(child)
                loose = False
            elif child.tag in ("td", "th"):
                if part.tag != "tr" and not loose:
                    rows.append([])
                    loose = True
                across, down = _number(child.attrs, "colspan"), _number(child.attrs, "rowspan")
                across = min(across, MAX_COLSPAN) if across and across > 0 else 1
                down = 1 if down is None or down < 0 else down
                rows[-1].append((across, down, _block(child)))
            elif child.tag in ("tbody", "thead", "tfoot", "colgroup"):
                end_group()
                walk(child)
                end_group()
                loose = False
            else:
                captions.extend(_block(child))

    walk(node)
    end_group()
    return rows, group_ends, captions


def _placed(rows: list[list[tuple[int, int, list[str]]]], group_ends: list[int]) -> list[list[tuple[int, list[str]]]]:
    """Rows of (column, lines).  Columns that cells of earlier rows still cover are skipped; they are
    kept as spans (from, to, last row), neighbours with one last row as one span."""
    covered: list[tuple[int, int, int]] = []
    placed = []
    for number, row in enumerate(rows):
        covered = [span for span in covered if span[2] > number]
        found, spans, column, at = [], [], 0, 0
        for across, down, lines in row:
            while at < len(covered) and covered[at][0] < column + 1:
                column = max(column, covered[at][1])
                at += 1
            found.append((column, lines))
            end = min(number + down, group_ends[number]) if down else group_ends[number]
            if end > number + 1:
                spans.append((column, column + across, end))
            column += across
        placed.append(found)
        merged: list[tuple[int, int, int]] = []
        for span in sorted(covered + spans) if spans else covered:
            if merged and merged[-1][2] == span[2] and merged[-1][1] >= span[0]:
                merged[-1] = (merged[-1][0], max(merged[-1][1], span[1]), span[2])
            else:
                merged.append(span)
        covered = merged
    return placed


def _table(node: Node) -> list[str]:
    rows, group_ends, captions = _table_rows(node)
    placed = _placed(rows, group_ends)
    widths: dict[int, int] = {}
    for row in placed:
        for column, cell in row:
            widths[column] = max(widths.get(column, 0), max(map(len, cell), default=0))
    # Only columns in which some cell begins take room.
    left, room = 0, {}
    for column in sorted(widths):
        room[column] = left
        left += widths[column] + 2
    lines = list(captions)
    for row in placed:
        for k in range(max((len(cell) for _, cell in row), default=0)):
            line = ""
            for column, cell in row:
                if k < len(cell):
                    line = line.ljust(room[column]) + cell[k]
            lines.append(line.rstrip())
    return lines


def _block(node: Node) -> list[str]:
    lines = _Lines()
    _write(node, lines)
    lines.end()
    return lines.done


def _write(node: Node, lines: _Lines) -> None:
    number, step = _number(node.attrs, "start"), 1
    if node.tag == "ol" and "reversed" in node.attrs:
        step = -1
        if number is None:
            number = sum(isinstance(part, Node) and part.tag == "li" and not hidden(part) for part in node.parts)
    number = 1 if number is None else number
    for part in node.parts:
        if isinstance(part, str):
            lines.text(part)
            continue
        tag = part.tag
        if hidden(part):
            continue
        if tag == "br":
            line = "".join(lines.line).strip(" ")
            lines.line = []
            lines.put([line])
        elif tag == "img":
            lines.text(part.attrs.get("alt", ""))
        elif tag == "hr":
            lines.end(True)
        elif tag == "pre":
            lines.end(True)
            content = _plain(part).removeprefix("\n").rstrip("\n")
            if content.strip():
                lines.put(content.split("\n"))
            lines.gap = True
        elif tag == "table":
            lines.end(True)
            content = _table(part)
            if content:
                lines.put(content)
            lines.gap = True
        elif tag == "li":
            lines.end()
            content = _block(part)
            own = _number(part.attrs, "value")
            number = number if own is None else own
            marker = f"{number}. " if node.tag == "ol" else "- "
            number += step
            if content:
                lines.put(_indented(content, marker))
        elif tag in ("dd", "blockquote"):
            lines.end(tag == "blockquote")
            content = _block(part)
            if content:
                lines.put(_indented(content, "  "))
            lines.gap = tag == "blockquote"
        elif tag in ("ul", "ol", "menu") and node.tag in ("li", "ul", "ol", "menu"):
            lines.end()
            content = _block(part)
            if content:
                lines.put(content if node.tag == "li" else _indented(content, "  "))
        elif tag in BLOCK:
            lines.end(tag in SPACED)
            _write(part, lines)
            lines.end(tag in SPACED)
        else:
            _write(part, lines)


def _plain(node: Node) -> str:
    return "".join(
        part if isinstance(part, str) else "" if hidden(part) else "\n" if part.tag == "br" else _plain(part)
        for part in node.parts
    )


def page_text(page: str | None) -> str | None:
    if page is None:
        return None
    return "\n".join(_block(tree(page)))


def extracted(pages: DataFrame) -> DataFrame:
    """Per page: page_id, text, n_chars and n_lines of the text."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [page_text(page) for page in frame["html"]]
            yield pd.DataFrame(
                {
                    "page_id": frame["page_id"].astype("Int64"),
                    "text": texts,
                    "n_chars": [len(t or "") for t in texts],
                    "n_lines": [len(t.split("\n")) if t else 0 for t in texts],
                }
            )

    narrow = pages.selectExpr("CAST(page_id AS BIGINT) AS page_id", "html")
    return in_pandas(narrow, rows, "page_id long, text string, n_chars long, n_lines long")
