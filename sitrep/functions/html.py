"""What pages say about themselves, read with the standard HTML parser.

These helpers see one page at a time inside Arrow batches; Spark does the rest.
"""

from __future__ import annotations

import codecs
import re
from html.parser import HTMLParser

# Elements that never hold content.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input "
    "isindex keygen link menuitem meta nextid param source spacer track wbr".split()
)
# Elements whose text is not part of the surrounding text.
HIDDEN = frozenset(("script", "style", "template", "rt", "rp"))
KEEP_SPACE = frozenset(("pre", "textarea"))

_META_CHARSET = re.compile(rb"<meta\b[^>]*\bcharset\s*=\s*[\"']?\s*([\w.:+-]+)", re.I)


class _AllFound(Exception):
    """Nothing later on the page can change the answer."""


class _Meta(HTMLParser):
    """First ``content`` of each wanted ``meta property``; a tag without content counts as empty."""

    def __init__(self, wanted: tuple[str, ...]):
        super().__init__(convert_charrefs=True)
        self.wanted = wanted
        self.found: dict[str, str] = {}

    def handle_starttag(self, tag, attrs):
        if tag != "meta":
            return
        values = {k: ("" if v is None else v) for k, v in attrs}
        name = values.get("property")
        if name in self.wanted and name not in self.found:
            self.found[name] = values.get("content", "")
            if len(self.found) == len(self.wanted):
                raise _AllFound

    handle_startendtag = handle_starttag


def open_graph(html: str) -> tuple[str, str, str] | None:
    """``(image, description, title)`` if the page names an image and a description."""
    parser = _Meta(("og:image", "og:description", "og:title"))
    try:
        parser.feed(html)
        parser.close()
    except _AllFound:
        pass
    if "og:image" not in parser.found or "og:description" not in parser.found:
        return None
    return parser.found["og:image"], parser.found["og:description"], parser.found.get("og:title", "")


class _Rows(HTMLParser):
    """Text of every wanted element, nested ones included, in document order.

    An end tag closes everything opened after its start tag; one without a start
    tag is ignored; what is still open at the end of the page closes there.
    """

    def __init__(self, wanted: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.wanted = wanted
        self.open: list[tuple[str, int | None]] = []
        self.hidden = 0
        self.verbatim = 0
        self.pieces: list[str] = []
        self.rows: list[list[int]] = []
        self.run: list[str] = []

    def handle_data(self, data):
        self.run.append(data)

    def _end_run(self):
        """One text node: a run of pure white space counts as one space or line break."""
        if not self.run:
            return
        text = "".join(self.run)
        self.run = []
        if self.hidden:
            return
        if not self.verbatim and not text.strip("\t\n\f\r "):
            text = "\n" if "\n" in text else " "
        self.pieces.append(text)

    def handle_starttag(self, tag, attrs):
        self._end_run()
        if tag in VOID:
            return
        row = None
        if tag in self.wanted:
            row = len(self.rows)
            # Wanted elements inside a hidden one have no visible text.
            self.rows.append([len(self.pieces), -1])
        self.open.append((tag, row))
        self.hidden += tag in HIDDEN
        self.verbatim += tag in KEEP_SPACE

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_run()
        if any(name == tag for name, _ in self.open):
            while self._close_last() != tag:
                pass

    def handle_comment(self, data):
        self._end_run()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def _close_last(self) -> str:
        name, row = self.open.pop()
        self.hidden -= name in HIDDEN
        self.verbatim -= name in KEEP_SPACE
        if row is not None:
            self.rows[row][1] = len(self.pieces)
        return name

    def texts(self):
        self._end_run()
        while self.open:
            self._close_last()
        for start, end in self.rows:
            yield "".join(self.pieces[start:end])


def element_texts(html: str, wanted=("tr", "div", "li")):
    """Text of every wanted element, in document order."""
    parser = _Rows(frozenset(wanted))
    parser.feed(html)
    parser.close()
    return parser.texts()


def decode_page(payload: bytes) -> str:
    """Page text: byte order mark, declared charset, UTF-8, then Windows-1252.

    As in the reference's parser (Beautiful Soup's ``EncodingDetector``), a declaration counts
    only in the first 2048 bytes, or the first 5 % of a page if that is more.
    """
    for mark, name in (
        (codecs.BOM_UTF8, "utf-8"),
        (codecs.BOM_UTF16_LE, "utf-16-le"),
        (codecs.BOM_UTF16_BE, "utf-16-be"),
    ):
        if payload.startswith(mark):
            return payload[len(mark):].decode(name, errors="replace")
    declared = _META_CHARSET.search(payload[: max(2048, len(payload) // 20)])
    names = [declared.group(1).decode("ascii", errors="ignore")] if declared else []
    for name in names + ["utf-8", "windows-1252"]:
        try:
            return payload.decode(name)
        except (LookupError, UnicodeDecodeError, ValueError):
            continue
    return payload.decode("utf-8", errors="replace")
