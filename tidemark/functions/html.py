"""HTML clean-up: regular expressions for flat elements, a parser for nested ones."""

from __future__ import annotations

from collections.abc import Iterable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'
VOID_ELEMENTS = frozenset("area base br col embed hr img input link meta param source track wbr".split())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def html_remove(html: Column | str, element: str) -> Column:
    """Drop an element and its content. Exact for elements that do not nest in
    themselves (script, style, svg); use :func:`html_remove_nested` otherwise."""
    return F.regexp_replace(_col(html), rf"(?is)<{element}\b[^>]*>.*?</{element}\s*>", "")


def html_strip_attrs(html: Column | str, keep: Iterable[str] = ()) -> Column:
    """Drop the attributes of all start tags except those of the elements in ``keep``."""
    kept = "|".join(keep)
    guard = rf"(?!(?:{kept})\b)" if kept else ""
    quoted = r"""(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+"""
    tag = rf"""(?i)<{guard}([a-z][a-z0-9:-]*)\s[^>"']*+{quoted}(?:(?<=(/))|)>"""
    return F.regexp_replace(_col(html), tag, "<$1$2>")


def html_element(html: Column | str, name: str) -> Column:
    """Inner HTML of the first element of that name wrapped in html tags; NULL without one."""
    pattern = rf"(?is)<{name}\b[^>]*>(.*?)</{name}\s*>"
    h = _col(html)
    return F.when(h.rlike(pattern), F.concat(F.lit("<html>"), F.regexp_extract(h, pattern, 1), F.lit("</html>")))


class _Rewriter(HTMLParser):
    """Writes the document back without some elements and, if asked, without attributes.

    An element that is dropped ends with its end tag, or with that of an element around
    it. One that never ends is kept, so no text is lost behind it.
    """

    def __init__(self, drop: frozenset[str], strip: bool, keep: frozenset[str]):
        super().__init__(convert_charrefs=False)
        self.drop, self.strip, self.keep = drop, strip, keep
        self.depth, self.out = 0, []
        self.held, self.inside = [], []  # what a dropped element holds, and its open elements

    def _start(self, tag, attrs, close):
        if self.strip and tag not in self.keep:
            attrs = ()
        text = "".join(f" {k}" if v is None else f' {k}="{v.replace(QUOTE, "&quot;")}"' for k, v in attrs)
        self.out.append(f"<{tag}{text}{close}>")

    def handle_starttag(self, tag, attrs):
        if tag in self.drop and tag not in VOID_ELEMENTS:
            self.depth += 1
        if self.depth:
            self.held.append(self.get_starttag_text())
            if tag not in VOID_ELEMENTS:
                self.inside.append(tag)
        elif tag not in self.drop:
            self._start(tag, attrs, "")

    def handle_startendtag(self, tag, attrs):
        if self.depth:
            self.held.append(self.get_starttag_text())
        elif tag not in self.drop:
            self._start(tag, attrs, "/")

    def handle_endtag(self, tag):
        if self.depth and tag in self.inside:
            while self.inside:
                last = self.inside.pop()
                self.depth -= last in self.drop
                if last == tag:
                    break
            self.held.append(f"</{tag}>")
            if not self.depth:
                self.held, self.inside = [], []
            return
        if self.depth and tag not in self.drop:  # of an element around the dropped one
            self.depth, self.held, self.inside = 0, [], []
        if not self.depth and tag not in self.drop:
            self.out.append(f"</{tag}>")

    def close(self):
        super().close()
        self._text(self.rawdata)  # of a script that never ends
        self.rawdata = ""
        self.out += self.held
        self.depth, self.held, self.inside = 0, [], []

    def _text(self, text):
        (self.held if self.depth else self.out).append(text)

    def handle_data(self, data):
        self._text(data)

    def handle_comment(self, data):
        self._text(f"<!--{data}-->")

    def handle_decl(self, decl):
        self._text(f"<!{decl}>")

    def handle_pi(self, data):
        self._text(f"<?{data}>")

    def unknown_decl(self, data):
        self._text(f"<![{data}]]>" if data.startswith("CDATA[") else f"<![{data}]>")


class _Inner(HTMLParser):
    """Collects the inner HTML of the first element of a name, nested ones included."""

    def __init__(self, name: str):
        super().__init__(convert_charrefs=False)
        self.name, self.depth, self.done, self.out = name, 0, False, []

    def handle_starttag(self, tag, attrs):
        if self.depth and not self.done:
            self.out.append(self.get_starttag_text())
        if tag == self.name and not self.done:
            self.depth += 1

    def handle_startendtag(self, tag, attrs):
        self._text(self.get_starttag_text())

    def handle_endtag(self, tag):
        if tag == self.name and self.depth:
            self.depth -= 1
            if self.depth == 0:
                self.done = True
        self._text(f"</{tag}>")

    def _text(self, text):
        if self.depth and not self.done:
            self.out.append(text)

    def handle_data(self, data):
        self._text(data)

    def handle_comment(self, data):
        self._text(f"<!--{data}-->")

    def handle_pi(self, data):
        self._text(f"<?{data}>")

    def unknown_decl(self, data):
        self._text(f"<![{data}]]>" if data.startswith("CDATA[") else f"<![{data}]>")


def _run(parser: HTMLParser, html: str) -> str:
    """Output of a parser. Character references stay as they are written: the ampersand
    is a private character, one the page does not hold, while the parser runs."""
    mark = next(c for c in map(chr, range(0xE000, 0xF900)) if c not in html)
    parser.feed(html.replace("&", mark))
    parser.close()
    return "".join(parser.out).replace(mark, "&")


def _rewrite(html: str | None, drop: frozenset[str], strip: bool, keep: frozenset[str]) -> str | None:
    if html is None:
        return None
    return _run(_Rewriter(drop, strip, keep), html)


def _inner(html: str | None, name: str) -> str | None:
    if html is None:
        return None
    parser = _Inner(name)
    inner = _run(parser, html)
    return f"<html>{inner}</html>" if parser.depth or parser.done else None


def html_clean(html: Column | str, remove: Iterable[str] = (), strip_attrs: bool = True,
               keep: Iterable[str] = ()) -> Column:
    """Drop elements with their content, nested ones included, and the attributes of
    all others but ``keep``, in one pass of a parser over each page."""
    gone, kept = frozenset(remove), frozenset(keep)

    @F.pandas_udf(T.StringType())
    def clean(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: _rewrite(h, gone, strip_attrs, kept))
    return clean(_col(html))


def html_remove_nested(html: Column | str, element: str) -> Column:
    """:func:`html_remove` for elements that nest, by a parser."""
    return html_clean(html, [element], strip_attrs=False)


def html_strip_attrs_parsed(html: Column | str, keep: Iterable[str] = ()) -> Column:
    """:func:`html_strip_attrs` by a parser."""
    return html_clean(html, (), True, keep)


def html_element_nested(html: Column | str, name: str) -> Column:
    """:func:`html_element` for elements that nest, by a parser."""
    @F.pandas_udf(T.StringType())
    def inner(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: _inner(h, name))
    return inner(_col(html))
