"""Markup that only a parser can read: HTML bodies and Editor.js documents, a batch of documents at a time.

HTML goes through a tolerant tree builder: elements that may be left open are closed by what cannot stand in
them, script and style content is never read as markup, comments stay as text of their own. Results are typed
blocks without order-dependent columns; paths, offsets and Markdown come from window and array functions.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Tags that make blocks, inline marks that are reported, elements without content, hidden elements.
BLOCK_TAGS = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "table", "blockquote"}
MARK_TAGS = {"strong", "b", "em", "i", "u", "sup", "sub"}
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
HIDDEN_TAGS = {"script", "style", "noscript"}
#: Keys of Editor.js data that hold no human text.
TECHNICAL_KEYS = {
    "api", "element", "styles", "toolbar", "version", "time", "id", "type", "readOnly", "sanitizer", "saver", "selection",
    "caret", "events", "i18n", "inlineToolbar", "listeners", "notifier", "tools", "tooltip", "ui", "nodes", "redactor",
    "wrapper", "block", "button", "inlineToolButton", "inlineToolButtonActive", "input", "loader", "settingsButton",
    "settingsButtonActive", "style", "level", "withHeadings", "withBorder", "withBackground", "stretched", "file", "url",
    "tunes", "inlineToolData", "inlineStyles", "markups", "alignment", "inlines",
}

_HEADINGS = {f"h{k}" for k in range(1, 7)}
_ENDS_PARAGRAPH = _HEADINGS | {"p", "div", "ul", "ol", "li", "table", "blockquote", "section", "article", "header", "footer", "nav", "aside", "form", "pre", "hr", "dl", "main"}
#: An opening tag closes these, up to the given container.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
}
_HTML = re.compile(r"<\s*/?\s*[a-zA-Z][^>]*>")
_META = {
    "source_format": None, "editorjs_type": None, "editorjs_block_id": None, "rows": None, "row_count": None, "column_count": None,
    "has_header": None, "has_header_tag": None, "markdown": None, "list_type": None, "list_level": None, "quote_caption": None,
    "source": None, "container": None, "inline_marks": None, "links": None,
}
META_DDL = (
    "struct<source_format: string, editorjs_type: string, editorjs_block_id: string, `rows`: array<array<string>>, row_count: int, column_count: int, "
    "has_header: boolean, has_header_tag: boolean, markdown: string, list_type: string, list_level: int, quote_caption: string, source: string, "
    "container: string, inline_marks: array<string>, links: array<struct<text: string, href: string>>>"
)
PARSED_DDL = f"plain_text string, error string, blocks array<struct<type: string, text: string, html: string, level: int, dom_path: string, metadata: {META_DDL}>>"


def tidy(value: str) -> str:
    """Lines trimmed, blanks collapsed, at most one empty line in a row."""
    joined = "\n".join(" ".join(re.split(r"[ \t]+", line)).strip() for line in value.splitlines())
    return re.sub(r"\n{3,}", "\n\n", joined).strip()


class Element:
    __slots__ = ("attrs", "children", "parent", "place", "tag")

    def __init__(self, tag: str, attrs: list, parent: Element | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []
        self.place = 1

    def add(self, child) -> None:
        if isinstance(child, Element):
            child.place = 1 + sum(isinstance(x, Element) and x.tag == child.tag for x in self.children)
        self.children.append(child)

    def elements(self) -> Iterator[Element]:
        for child in self.children:
            if isinstance(child, Element):
                yield child
                yield from child.elements()

    def ancestors(self) -> Iterator[Element]:
        at = self.parent
        while at is not None:
            yield at
            at = at.parent

    def strings(self) -> Iterator[str]:
        for child in self.children:
            if isinstance(child, Element):
                yield from child.strings()
            elif not isinstance(child, Comment):
                yield str(child)

    def text(self, separator: str = " ") -> str:
        return tidy(separator.join(s for x in self.strings() if (s := x.strip())))

    def path(self) -> str:
        line = [self, *self.ancestors()]
        return "/".join(f"{e.tag}[{e.place}]" for e in reversed(line) if e.tag)

    def source(self) -> str:
        inner = "".join(c.source() if isinstance(c, Element) else f"<!--{c}-->" if isinstance(c, Comment) else html.escape(str(c), quote=False) for c in self.children)
        attrs = "".join(f' {k}="{html.escape(v or "")}"' for k, v in self.attrs)
        return f"<{self.tag}{attrs}/>" if self.tag in VOID_TAGS else f"<{self.tag}{attrs}>{inner}</{self.tag}>"


class Comment(str):
    """Text of a comment: a string of its container that is not part of its text."""


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("", [], None)
        self.page = self._open(self.root, "html", [])
        self.head: Element | None = None
        self.body: Element | None = None
        self.at = self.page

    @staticmethod
    def _open(parent: Element, tag: str, attrs: list) -> Element:
        made = Element(tag, attrs, parent)
        parent.add(made)
        return made

    def _in_body(self) -> None:
        if self.at is self.page:
            self.body = self.body or self._open(self.page, "body", [])
            self.at = self.body

    def _close(self, tags: set[str], container: set[str]) -> None:
        open_now = [self.at, *self.at.ancestors()]
        for e in open_now:
            if e.tag in container or e in (self.page, self.body):
                return
            if e.tag in tags:
                self.at = e.parent
                if not any(x.tag in tags for x in self._until(container)):
                    return

    def _until(self, container: set[str]) -> Iterator[Element]:
        for e in [self.at, *self.at.ancestors()]:
            if e.tag in container or e in (self.page, self.body):
                return
            yield e

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html":
            self.page.attrs = self.page.attrs or attrs
            return
        if tag == "head" and self.body is None:
            self.head = self.head or self._open(self.page, "head", attrs)
            self.at = self.head
            return
        if tag == "body":
            if self.body is None:
                self.body = self._open(self.page, "body", attrs)
            self.at = self.body if self.at in (self.page, self.head) else self.at
            return
        if self.at is self.head and tag not in {"title", "meta", "link", "base", "script", "style", "noscript"}:
            self.at = self.page
        if self.at is self.page and self.body is None and tag in {"title", "meta", "link", "base", "script", "style"}:
            self.head = self.head or self._open(self.page, "head", [])
            self.at = self.head
        self._in_body()
        if tag in _ENDS_PARAGRAPH:
            self._close({"p"}, {"table", "td", "th", "blockquote", "li", "div", "section", "article"} if tag not in {"p"} else {"table", "td", "th", "blockquote", "li"})
        if tag in _HEADINGS:
            self._close(_HEADINGS, {"table", "td", "th", "blockquote", "li", "div", "section", "article"})
        if tag in _CLOSES:
            self._close(*_CLOSES[tag])
        made = self._open(self.at, tag, attrs)
        if tag not in VOID_TAGS:
            self.at = made

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and self.at.tag == tag:
            self.at = self.at.parent

    def handle_endtag(self, tag: str) -> None:
        if tag in {"html", "body"}:
            return
        for e in [self.at, *self.at.ancestors()]:
            if e.tag == tag:
                self.at = e.parent
                return
            if e in (self.page, self.body):
                return

    def handle_data(self, data: str) -> None:
        if self.at is self.page or (self.at is self.head and data.strip()):
            if not data.strip():
                return
            self.at = self.page
            self._in_body()
        self.at.add(data)

    def handle_comment(self, data: str) -> None:
        if self.at is not self.page:
            self.at.add(Comment(data))


def parse_tree(value: str) -> tuple[Element, Element]:
    """(whole document, body), without hidden elements."""
    builder = _Builder()
    builder.feed(value)
    builder.close()
    for e in [builder.root, *builder.root.elements()]:
        if any(isinstance(c, Element) and c.tag in HIDDEN_TAGS for c in e.children):
            e.children = [c for c in e.children if not (isinstance(c, Element) and c.tag in HIDDEN_TAGS)]
    return builder.root, builder.body or builder.page


def _meta(**known) -> dict:
    return _META | known


def _block(kind: str, text: str, *, source: str | None = None, level: int | None = None, path: str | None = None, **known) -> dict:
    return {"type": kind, "text": text, "html": source, "level": level, "dom_path": path, "metadata": _meta(**known)}


def table_meta(rows: list[list[str]], has_tag: bool, headed: bool = False) -> dict:
    wide = max(map(len, rows), default=0)
    inferred = bool(rows) and (len(rows) == 1 or bool(rows[0]) and all(c.strip() for c in rows[0]))
    escape = lambda c: c.replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join([*map(escape, r), *[""] * (wide - len(r))]) + " |" for r in rows]
    if wide:
        lines.insert(1, "| " + " | ".join(["---"] * wide) + " |")
    return {"rows": rows, "row_count": len(rows), "column_count": wide, "has_header": has_tag or headed or inferred, "has_header_tag": has_tag, "markdown": "\n".join(lines) if wide else ""}


def _inline(e: Element) -> dict:
    marks = sorted({x.tag for x in e.elements() if x.tag in MARK_TAGS})
    links = [{"text": x.text(), "href": dict(x.attrs).get("href")} for x in e.elements() if x.tag == "a"]
    links = [x for x in links if x["href"] or x["text"]]
    return {"inline_marks": marks or None, "links": links or None}


def _of_element(e: Element) -> dict:
    """The block that a block element makes."""
    shown = {"source": e.source(), "path": e.path()}
    if e.tag in _HEADINGS:
        return _block("heading", e.text(), level=int(e.tag[1]), **shown) | {"metadata": _meta(**_inline(e))}
    if e.tag == "table":
        found = [r for r in e.elements() if r.tag == "tr"]
        rows = [[c.text() for c in r.children if isinstance(c, Element) and c.tag in {"td", "th"}] for r in found]
        rows = [r for r in rows if any(r)]
        tagged = bool(found) and any(x.tag == "th" for x in found[0].elements())
        return _block("table", "\n".join(" | ".join(r) for r in rows) or e.text(), **shown) | {"metadata": _meta(**table_meta(rows, tagged))}
    if e.tag == "li":
        lists = [x.tag for x in e.ancestors() if x.tag in {"ol", "ul"}]
        own = [x.text() if isinstance(x, Element) else tidy(x) for x in e.children if not (isinstance(x, Element) and x.tag in {"ul", "ol", "table"})]
        kind = {"ol": "ordered", "ul": "unordered"}.get(lists[0] if lists else "", "unknown")
        return _block("list_item", tidy(" ".join(x for x in own if x)) or e.text(), **shown) | {"metadata": _meta(list_type=kind, list_level=len(lists), **_inline(e))}
    return _block("blockquote" if e.tag == "blockquote" else "paragraph", e.text(), **shown) | {"metadata": _meta(**_inline(e))}


def _walk(e: Element) -> Iterator[dict]:
    for child in e.children:
        if not isinstance(child, Element):
            yield _block("paragraph", tidy(child), path=e.path() or None) | {"metadata": _meta(source="text_node", container=e.tag or None)}
        elif child.tag in BLOCK_TAGS:
            yield _of_element(child)
            if child.tag == "li":
                yield from (_of_element(x) for x in child.elements() if x.tag in BLOCK_TAGS)
        elif any(x.tag in BLOCK_TAGS for x in child.elements()):
            yield from _walk(child)
        else:
            yield _block("paragraph", child.text(), source=child.source(), path=child.path()) | {"metadata": _meta(source="inline_or_container", container=child.tag, **_inline(child))}


def html_document(value: str) -> dict:
    whole, body = parse_tree(value)
    return {"plain_text": whole.text("\n"), "error": None, "blocks": [b for b in _walk(body) if b["text"]]}


def fragment_text(value) -> str:
    """Text of a string that may hold markup; a line break element is a line end."""
    text = "" if value is None else str(value)
    if not _HTML.search(text):
        return tidy(text)
    root, _ = parse_tree(re.sub(r"<br\s*/?>", "\n", text, flags=re.I))
    return tidy(" ".join(root.strings()))


def human_text(value, key: str | None = None) -> Iterator[str]:
    """Every string of nested data that a reader sees."""
    if key in TECHNICAL_KEYS:
        return
    if isinstance(value, dict):
        for k, v in value.items():
            yield from human_text(v, str(k))
    elif isinstance(value, list):
        for v in value:
            yield from human_text(v)
    elif isinstance(value, str) and (text := fragment_text(value)):
        yield text


def _scalar(value) -> str:
    return "" if value is None else tidy(str(value))


def _items(items, level: int = 1) -> Iterator[tuple[str, int]]:
    for item in items if isinstance(items, list) else ():
        if isinstance(item, str):
            text = fragment_text(item)
        elif isinstance(item, dict):
            text = next((t for k in ("content", "text") if (t := fragment_text(item.get(k)))), "") or tidy("\n".join(human_text(item)))
        else:
            text = ""
        if text:
            yield text, level
        if isinstance(item, dict) and isinstance(item.get("items"), list):
            yield from _items(item["items"], level + 1)


def _editor_blocks(block: dict) -> Iterator[dict]:
    kind = _scalar(block.get("type")) or "unknown"
    data = block.get("data") if isinstance(block.get("data"), dict) else {}
    base = {"source_format": "editorjs", "editorjs_type": kind, "editorjs_block_id": _scalar(block.get("id")) or None}
    plain = lambda t, text, level=None, **more: {"type": t, "text": text, "html": None, "level": level, "dom_path": None, "metadata": _meta(**base, **more)}
    if kind == "delimiter":
        return
    if kind == "header":
        try:
            level = min(max(int(data.get("level")), 1), 6)
        except (TypeError, ValueError):
            level = 2
        yield plain("heading", fragment_text(data.get("text")), level)
    elif kind == "paragraph":
        yield plain("paragraph", fragment_text(data.get("text")))
    elif kind == "list":
        style = _scalar(data.get("style")).lower()
        for text, level in _items(data.get("items")):
            yield plain("list_item", text, list_type=style if style in {"ordered", "unordered"} else "unknown", list_level=level)
    elif kind == "table":
        rows = []
        held = data.get("content") or data.get("rows")
        for row in held if isinstance(held, list) else ():
            cells = (row.get("cells") or row.get("content")) if isinstance(row, dict) else row
            rows.append([fragment_text(c) for c in cells] if isinstance(cells, list) else [])
        rows = [r for r in rows if any(r)]
        yield plain("table", "\n".join(" | ".join(r) for r in rows), **table_meta(rows, False, bool(data.get("withHeadings"))))
    elif kind == "quote":
        caption = fragment_text(data.get("caption"))
        yield plain("blockquote", tidy("\n".join(x for x in (fragment_text(data.get("text")), caption) if x)), quote_caption=caption or None)
    else:
        yield plain("unknown", tidy("\n".join(human_text(data))))


def editor_document(value: str) -> dict:
    """`plain_text` is here the broad human text, against which preservation is measured."""
    try:
        held = json.loads(value)
    except json.JSONDecodeError as e:
        return {"plain_text": "", "error": f"Invalid Editor.js JSON: {e}", "blocks": []}
    if not isinstance(held, dict) or not isinstance(held.get("blocks"), list):
        return {"plain_text": "", "error": "Editor.js JSON must contain top-level blocks list", "blocks": []}
    real = [b for b in held["blocks"] if isinstance(b, dict)]
    useful = [t for b in real if _scalar(b.get("type")) != "delimiter" for t in human_text(b.get("data") if isinstance(b.get("data"), dict) else {})]
    return {"plain_text": tidy("\n".join(useful)), "error": None, "blocks": [x for b in real for x in _editor_blocks(b) if x["text"]]}


def _batch(parse, values: pd.Series) -> pd.DataFrame:
    rows = []
    for value in values:
        try:
            rows.append(parse(value or ""))
        except RecursionError as e:
            rows.append({"plain_text": "", "error": f"nested too deeply: {e}", "blocks": []})
    return pd.DataFrame(rows, columns=["plain_text", "error", "blocks"])


def _parser(parse):
    def run(values: pd.Series) -> pd.DataFrame:
        return _batch(parse, values)

    return F.pandas_udf(run, PARSED_DDL)


def parse_html(value: Column) -> Column:
    return _parser(html_document)(value)


def parse_editorjs(value: Column) -> Column:
    return _parser(editor_document)(value)
