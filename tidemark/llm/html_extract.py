"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks of text, each with the path of open elements above it. A bidirectional
LSTM reads the blocks of the whole page (hashed path and word vectors, lengths, link share) and labels
each as main text or not; the main blocks in page order are the text. The model is trained once in a
driver process, on pages built by rule (``training_pages``), and is a few kilobytes.

Scripts, styles, templates, the head and markup never become text. Character references are decoded,
white space inside a block becomes one space, blocks are joined by an empty line; nothing is cut.

Defined results: null html is an empty page with empty text; a page without blocks gives empty text;
elements that are never closed end with their parent, a head with the first text or element that may not
stand in it; formulas are text of their block, without their annotations; repeated rows give a row each; extra columns are
ignored.
"""

from __future__ import annotations

import html
import random
import re
import string
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import lstm
from tidemark.llm.bpe import small
from tidemark.llm.registry import query

# How HTML elements behave.
SILENT = frozenset("script style template noscript head title textarea select option svg annotation annotation-xml iframe object canvas".split())
RAW = frozenset("script style title textarea iframe noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
                    "sub sup time tt u var button "
                    "math semantics annotation annotation-xml maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded "
                    "mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover").split())
#: What may stand in the head; any other start tag, and text, ends a head that was not closed.
IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
_MARKUP = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
#: A tag ends at the first > outside a quoted value; quotes mean something after an equals sign only. It may run to the end of the page.
_TOKEN = re.compile(_MARKUP + r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+)(?:(>)|\Z)""", re.S)
#: The same, where a tag ends at the first >.
_PLAIN = re.compile(_MARKUP + r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(>)", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"[\s ]+")
BUCKETS = 192
NUMBERS = 8
PATH_DEPTH = 12
_UPPER = string.ascii_uppercase.encode()
_ASCII = re.compile(r"[\x00-\x7f]+")


class _Open:
    """The open elements, with what is asked of all of them kept as counts."""

    def __init__(self) -> None:
        self.items: list[tuple[str, tuple[str, ...]]] = []
        self.count: dict[str, int] = {}
        self.silent = 0

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        self.items.append((tag, names))
        self.count[tag] = self.count.get(tag, 0) + 1
        self.silent += tag in SILENT

    def pop(self) -> str:
        tag, _ = self.items.pop()
        self.count[tag] -= 1
        self.silent -= tag in SILENT
        return tag

    def top(self) -> str:
        return self.items[-1][0] if self.items else ""

    def close(self, tag: str) -> None:
        """Ends the innermost element of that name, and all inside it; an end tag without one says nothing."""
        if self.count.get(tag):
            while self.pop() != tag:
                pass

    def path(self) -> tuple[str, ...]:
        """Names of the outermost and innermost elements, as far as ``vectors`` looks at them."""
        def names(items) -> list[str]:
            return [n for t, own in items for n in (t, *own)]
        if len(self.items) <= 2 * PATH_DEPTH:
            return tuple(names(self.items))
        return (*names(self.items[:PATH_DEPTH])[:PATH_DEPTH], *names(self.items[-PATH_DEPTH:])[-PATH_DEPTH:])


def blocks(page: str) -> list[tuple[str, tuple[str, ...], float]]:
    """Text, path and link share of every leaf block, in page order; linear in the length of the page.

    A tag that quotes keep open to the end of the page ends at its first >, and so do all after it; without any >
    it is text.
    """
    out: list[tuple[str, tuple[str, ...], float]] = []
    stack = _Open()
    parts: list[str] = []
    linked = total = 0
    path: tuple[str, ...] = ()
    head = False  # a head may be open

    def close() -> None:
        nonlocal parts, linked, total
        text = _SPACE.sub(" ", "".join(parts)).strip()
        if text:
            out.append((text, path, linked / max(total, 1)))
        parts, linked, total = [], 0, 0

    def say(raw: str, decoded: bool = False) -> None:
        nonlocal linked, total, path
        if head and stack.top() == "head" and raw.strip():
            stack.pop()
        if not raw or stack.silent:
            return
        if not total and not raw.isspace():
            path = stack.path()
        parts.append(raw if decoded else html.unescape(raw))
        size = len(raw.strip())
        total += size
        linked += size * bool(stack.count.get("a"))

    at, end, token = 0, len(page), _TOKEN
    last = page.rfind(">") + 1  # no tag ends behind it
    while at < end:
        m = token.search(page, at)
        if m and m[3] and not m[5]:  # open at the end
            if m.start() >= last:
                say(page[at:])
                break
            token = _PLAIN
            continue
        say(page[at:m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        if m[3] is None:
            if m[1]:
                say(m[1], True)
            continue
        tag = m[3].lower()
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE:
            close()
        if m[2]:
            stack.close(tag)
        elif tag not in VOID and not m[4].endswith("/"):
            if tag == "head":
                head = True
            elif head and tag not in IN_HEAD:
                head = False
                while stack.count.get("head"):
                    stack.pop()
            if tag not in INLINE:
                while stack.top() in INLINE or stack.top() == "p":
                    stack.pop()
                if tag in ("li", "tr", "td", "th", "dt", "dd") and stack.top() == tag:
                    stack.pop()
            names = _NAMES.findall(m[4]) if m[4] else ()
            stack.push(tag, tuple(n for found in names for n in re.findall("[a-z]+", "".join(found).lower())))
            if tag in RAW:
                stop = _find_end(page, tag, at)
                at = end if stop < 0 else stop
    close()
    return out


def _find_end(page: str, tag: str, at: int) -> int:
    m = re.compile(f"</{tag}", re.I).search(page, at)
    return m.start() if m else -1


def _capitals(text: str) -> int:
    if not text.isascii():
        return _capitals(text.encode("ascii", "ignore").decode()) + sum(map(str.isupper, _ASCII.sub("", text)))
    raw = text.encode()
    return len(raw) - len(raw.translate(None, _UPPER))


def vectors(found: list[tuple[str, tuple[str, ...], float]], step: int = 1024) -> np.ndarray:
    """Features of the blocks of a page: numbers, hashed path, hashed words; made for ``step`` blocks at once."""
    x = np.zeros((len(found), NUMBERS + 2 * BUCKETS), np.float32)
    for low in range(0, len(found), step):
        _fill(x[low:low + step], found[low:low + step], low, len(found))
    return x


def _fill(x: np.ndarray, some: list[tuple[str, tuple[str, ...], float]], low: int, total: int) -> None:
    seen, names, said, n_names, n_said = [], [], [], [], []
    for text, path, links in some:
        words = text.lower().split()
        letters = max(len(text), 1)
        seen.append((len(words), letters, links, sum(map(text.count, ".,;:!?")) / letters * 10, _capitals(text) / letters * 4,
                     text[-1] in ".!?\""))
        near = path[-PATH_DEPTH:]
        own = (*path[:PATH_DEPTH], *near, f"leaf {near[-1] if near else ''}")
        names += [crc32(n.encode(), 1) for n in own]
        n_names.append(len(own))
        distinct = set(words)
        said += [crc32(w.strip(".,:;!?()\"'").encode(), 2) for w in distinct]
        n_said.append(len(distinct))
    n_words, letters, links, signs, capitals, closed = map(np.array, zip(*seen))
    rows = np.arange(len(some))
    x[:, :NUMBERS] = np.column_stack((np.log1p(n_words) / 4, np.log1p(letters) / 6, links, signs, capitals, (low + rows) / total,
                                      np.full(len(some), np.log1p(total) / 4), closed))
    x[np.repeat(rows, n_names), NUMBERS + np.array(names, np.int64) % BUCKETS] = 1
    # a word adds one over the root of the length to its bucket; one after the other, since each sum is rounded
    left = np.bincount(np.repeat(rows, n_said) * BUCKETS + np.array(said, np.int64) % BUCKETS, minlength=len(some) * BUCKETS)
    cell = np.flatnonzero(left)
    row, column, left = cell // BUCKETS, NUMBERS + BUCKETS + cell % BUCKETS, left[cell]
    while row.size:
        x[row, column] += 1 / np.sqrt(n_words[row])
        left = left - 1
        row, column, left = (a[left > 0] for a in (row, column, left))


# Names and words that pages use for what is not the article.
_ROLES = {
    "nav": (("nav", "menu", "navbar", "navigation", "breadcrumb", "topbar"), ("home", "about", "contact", "news", "products", "login", "search")),
    "header": (("header", "masthead", "branding", "banner", "logo"), ("welcome", "daily", "official", "site", "your", "source")),
    "footer": (("footer", "colophon", "copyright", "legal"), ("© 2024", "all rights reserved", "privacy policy", "terms of use", "imprint")),
    "aside": (("sidebar", "aside", "widget", "related", "recommended", "popular", "trending"), ("related", "popular", "read more", "more from", "trending")),
    "ad": (("ad", "ads", "advert", "sponsor", "promo", "sponsored", "banner"), ("buy now", "sale", "offer", "free shipping", "sponsored", "deal")),
    "notice": (("cookie", "notice", "consent", "gdpr", "alert", "newsletter", "subscribe", "popup"),
               ("we use cookies", "accept", "subscribe to our newsletter", "sign up", "by continuing you agree")),
    "comments": (("comments", "comment", "replies", "discussion", "respond", "disqus"), ("reply", "said", "posted", "likes", "great article", "i agree", "thanks")),
    "social": (("share", "social", "tags", "meta", "byline"), ("share", "tweet", "facebook", "tags", "email", "print")),
}
_TAGS = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "comments": "section"}
_MAIN = ("content", "post", "entry", "story", "article", "main", "body", "text", "page")


def training_pages(n: int = 500, seed: int = 5) -> list[tuple[str, list[tuple[str, int]]]]:
    """Pages built by rule, each with its blocks' texts and labels in order."""
    rng = random.Random(seed)
    syllables = "an en er in on re st th ti ou ar es al it is ent ion ing der sch un ge los que mi do ra ci".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))

    def sentence(low: int = 2, high: int = 24) -> str:
        return " ".join(word() for _ in range(rng.randint(low, high))).capitalize() + rng.choice("....!?")

    def paragraph() -> str:
        return styled(" ".join(sentence() for _ in range(rng.choice((1, 1, 2, 4, 8, 16)))))

    def styled(text: str) -> str:
        """Text in the manner of the page: plain, shouted, full of signs, or a table row."""
        if manner == 1:
            return text.upper().replace(" ", "!! ")
        if manner == 2:
            return "".join(w + rng.choice(("###", "$$$", "%%%", "***")) + " " for w in text.split())[:-1]
        return text.replace(" ", " | ") if manner == 3 else text

    out = []
    for _ in range(n):
        page: list[str] = []
        truth: list[tuple[str, int]] = []
        manner = rng.choice((0, 0, 0, 0, 0, 0, 0, 1, 2, 3))

        def put(tag: str, text: str, label: int, attrs: str = "", link: bool = False) -> None:
            end = "" if tag in ("p", "li") and rng.random() < 0.25 else f"</{tag}>"
            inner = f'<a href="/{word()}">{text}</a>' if link else text
            if label and rng.random() < 0.25:
                inner = f"<b>{inner}" + rng.choice(("</b>", "", "<br>"))
            page.append(f"<{tag}{attrs}>{inner}{end}")
            truth.append((text, label))

        def aside(kind: str) -> None:
            names, words = _ROLES[kind]
            tag = _TAGS.get(kind, "div") if rng.random() < 0.7 else "div"
            mark = f' {rng.choice(("class", "id"))}="{rng.choice(names)}{rng.choice(("", "-" + word()))}"'
            plain = tag != "div" and rng.random() < 0.6
            page.append(f"<{tag}{'' if plain else mark}>")
            said = lambda: rng.choice(words).capitalize() if rng.random() < 0.4 else sentence(1, 4).rstrip(".!?")
            if kind in ("nav", "aside") or kind == "social":
                if rng.random() < 0.4:
                    put(rng.choice(("h3", "h4", "div")), said(), 0)
                page.append("<ul>")
                for _ in range(rng.randint(1, 7)):
                    put("li", said(), 0, link=rng.random() < 0.85)
                page.append("</ul>")
            elif kind == "notice" and rng.random() < 0.6:
                page.append("<form>")
                put("p", said() + " " + sentence(2, 8), 0)
                page.append('<input type="text">')
                put("div", rng.choice(words).capitalize(), 0)
                page.append("</form>")
            elif kind == "comments":
                put(rng.choice(("h2", "h3", "div")), rng.choice(("Comments", "Replies", "Discussion", sentence(1, 3))), 0)
                for _ in range(rng.randint(1, 4)):
                    put(rng.choice(("p", "li", "div")), rng.choice((sentence(), paragraph(), said() + " " + sentence())), 0)
            elif rng.random() < 0.5:
                page.append(f"{(text := rng.choice((said() + ' &middot; ' + sentence(1, 9), sentence(1, 12))))}")
                truth.append((html.unescape(text), 0))
            else:
                put(rng.choice(("p", "div")), said() + " " + sentence(1, 10), 0)
            page.append(f"</{tag}>")

        cells = rng.random() < 0.08  # the page is laid out as a table
        if cells:
            page.append("<table><tr><td>")
        for kind in ("header", "nav", "notice", "ad", "social"):
            if rng.random() < (0.85 if kind == "nav" else 0.45):
                aside(kind)
        if cells:
            page.append(rng.choice(("</td><td>", "</td></tr><tr><td>")))
        style = rng.random()
        tag = "article" if style < 0.5 else "main" if style < 0.6 else "div"
        attrs = f' {rng.choice(("class", "id"))}="{rng.choice(_MAIN)}"' if tag == "div" and rng.random() < 0.8 else ""
        page.append(f"<{tag}{attrs}>")
        if rng.random() < 0.8:
            put(rng.choice(("h1", "h1", "h2")), styled(sentence(2, 9)), 1)
        for _ in range(rng.choice((1, 1, 2, 3, 5, 8, 14, 24))):
            kind = rng.random()
            if kind < 0.6:
                put("p", paragraph(), 1)
            elif kind < 0.8:
                put("p", styled(rng.choice((sentence(1, 3), sentence(1, 12), " ".join([word()] * rng.randint(2, 30))))), 1)
            elif kind < 0.87:
                put(rng.choice(("h2", "h3")), sentence(1, 7).rstrip("."), 1)
            elif kind < 0.93:
                page.append("<ul>")
                for _ in range(rng.randint(2, 5)):
                    put("li", sentence(2, 14), 1)
                page.append("</ul>")
            elif kind < 0.94:
                put("blockquote", paragraph(), 1)
            elif kind < 0.95:
                put("pre", sentence(2, 12), 1)
            elif kind < 0.96:
                page.append('<figure><img src="x.png">')
                put("figcaption", sentence(2, 9), 1)
                page.append("</figure>")
            elif kind < 0.975:
                page.append("<table>")
                for row in range(rng.randint(2, 4)):
                    page.append("<tr>")
                    for _ in range(rng.randint(2, 3)):
                        put("td" if row else rng.choice(("th", "td")), rng.choice((word(), sentence(1, 4), str(rng.randint(1, 2000)))), 1)
                    page.append("</tr>")
                page.append("</table>")
            else:
                aside(rng.choice(("ad", "social", "aside", "notice")))
        if rng.random() < 0.15:
            aside("comments")
        page.append(f"</{tag}>")
        if cells:
            page.append("</td></tr><tr><td>")
        for kind in ("social", "comments", "aside", "ad", "notice", "footer"):
            if rng.random() < (0.85 if kind == "footer" else 0.35):
                aside(kind)
        out.append((f"<html><head><title>{sentence(2, 8)}</title><script>var a = '<p>';</script></head><body>{''.join(page)}</body></html>", truth))
    return out


def labelled(pages: list[tuple[str, list[tuple[str, int]]]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Vectors and labels of the blocks; a block's label is that of the text it holds."""
    xs, ys = [], []
    for page, truth in pages:
        found, labels, at = blocks(page), [], 0
        for text, _, _ in found:
            while at < len(truth) and _SPACE.sub(" ", truth[at][0]).strip() not in text:
                at += 1
            labels.append(truth[at][1] if at < len(truth) else 0)
        xs.append(vectors(found))
        ys.append(np.array(labels, np.float32))
    return xs, ys


@lru_cache(maxsize=1)
def model() -> lstm.Params:
    return lstm.train(*labelled(training_pages()))


def main_text(pages: list[str], params: lstm.Params) -> list[str]:
    """The main text of each page; pages of similar length are labelled together."""
    found = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i in range(len(pages)) if found[i]), key=lambda i: len(found[i]))
    low = 0
    while low < len(order):
        high = low + 1
        while high < len(order) and high - low < 64 and len(found[order[high]]) * (high - low + 1) <= 8192:
            high += 1
        some = order[low:high]
        x, lengths = lstm.padded([vectors(found[i]) for i in some])
        score, _ = lstm.forward(params, x, lengths)
        for k, i in enumerate(some):
            out[i] = "\n\n".join(text for (text, _, _), s in zip(found[i], score[:, k]) if s > 0)
        low = high
    return out


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """page_id, the columns in ``keep``, text and n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model())  # a few kilobytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = main_text(batch.column(batch.num_columns - 1).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(batch.num_columns - 1)], pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), *[pages[c] for c in keep],
                        F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("_html"))
    names = rows.columns[:-1]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{types}, text string, n_chars long")


@query("op7_html_extract", table="pages")
def html_extract(pages: DataFrame) -> DataFrame:
    return extract(pages)
