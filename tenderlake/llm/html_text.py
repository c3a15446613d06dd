"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one per block element.  Scripts, styles, forms,
navigation, headers, footers, sidebars, adverts, notices and comment sections
yield lines of no length.  The line-block function sums text lengths over a
sliding window of lines; text surges where a window first exceeds the
threshold and dives where the sums fall to zero.  Every line from the first
surge to the last dive is kept; a page without surge has no text.  Where the
page marks its article (``article``, ``main``; all such parts count), lines
outside have no length, and a check after the method adds the marked lines
that touch the stretch (a title, a short closing line): the neighbours of a
kept line, with less than a window of other text between.

The parser passes over a page once: open elements are found by name and by
block, and no pattern runs on to the end of the page more than once.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import map_arrow, text_or_empty

WINDOW_LINES = 3
SURGE_CHARS = 80

# HTML element names.
RAW = frozenset("script style noscript template svg iframe object canvas math title textarea select".split())
BOILERPLATE = frozenset("nav header footer aside form dialog button menu fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary
table tbody td tfoot th thead tr ul""".split())
#: A start tag that ends open elements of the same kind by itself.
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())

# Words of class, id and role attributes that name page furniture.
FURNITURE = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment
comments commentlist consent cookie cookies disclaimer disqus footer gdpr header login masthead menu modal nav navbar
navigation newsletter notice notification overlay pagination popup promo promoted promotion recommended related replies
respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar
widget""".split())

#: Name parts that tell how a container is laid out, not what it holds.
LAYOUT_PREFIXES = ("has-", "with-", "without-", "no-")

_OPENS = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_TAG_STOP = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""(?i)(?<![\w-])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_HIDDEN_STYLE = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")


def _is_furniture(attributes: str, in_article: bool) -> bool:
    if "=" not in attributes and "hidden" not in attributes:
        return False
    named: set[str] = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "style":
            if _HIDDEN_STYLE.search(value):
                return True
        elif name == "hidden":
            return True
        elif name == "aria-hidden":
            if "true" in value.lower():
                return True
        elif name == "role":
            if value.strip("\"'").lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "alert",
                                              "dialog", "form"):
                return True
        else:
            for token in value.strip("\"'").lower().split():
                if not token.startswith(LAYOUT_PREFIXES):
                    named.update(_WORD.findall(token))
    if in_article:
        named.discard("header")
    return not FURNITURE.isdisjoint(named)


#: Where a line lies: outside, in an article that is named like page furniture, in any other article or main part.
OUTSIDE, NAMED, MARKED = 0, 1, 2


def _tag_end(page: str, at: int) -> int:
    """Place of the ``>`` that ends the tag; the first one where its quotes don't match, -1 where there is none."""
    i = at
    while m := _TAG_STOP.search(page, i):
        if m[0] == ">":
            return m.start()
        i = page.find(m[0], m.end()) + 1
        if not i:
            break
    return page.find(">", at)


def _pieces(page: str) -> Iterator[tuple[str, str, str, bool]]:
    """(text before, element, attributes, closing) of every tag; comments and declarations have no element."""
    text = at = 0
    last = page.rfind(">")
    while m := _OPENS.search(page, at):
        if m[0] == "<!--":
            end = page.find("-->", m.end())
            at = len(page) if end < 0 else end + 3
            yield page[text:m.start()], "", "", False
        elif m.start() > last:  # no tag ends any more: an unfinished one at the very end is dropped, the rest is text
            tail = page.rfind("<")
            cut = tail if _OPENS.match(page, tail) else len(page)
            yield page[text:cut], "", "", False
            return
        else:
            end = _tag_end(page, m.end()) if m[2] else page.find(">", m.end())
            if end < 0:
                at = m.end()
                continue
            at = end + 1
            name = (m[2] or "").lower()
            yield page[text:m.start()], name, page[m.end():end] if name else "", bool(m[1])
            if name in RAW and not m[1] and page[end - 1] != "/":
                stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = stop.end() if stop else len(page)
        text = at
    yield page[text:], "", "", False


def lines(page: str) -> list[tuple[str, int, int]]:
    """(text, length, place) of every line.

    Lines of page furniture have no text; the length leaves link text out.
    Inside an article a ``header`` keeps its text (it holds the title);
    elsewhere it is furniture.
    """
    out: list[tuple[str, int, int]] = []
    buffer: list[str] = []
    linked = 0  # characters of the buffer that are link text
    stack: list[tuple[str, bool, int, bool]] = []  # element, inside furniture, place, inside a link
    where: dict[str, list[int]] = {}  # element -> its places in the stack
    blocks: list[int] = []  # places of block elements

    def flush() -> None:
        nonlocal linked
        _, hidden, place, _ = stack[-1] if stack else ("", False, OUTSIDE, False)
        text = _SPACE.sub(" ", html_lib.unescape("".join(buffer))).strip()
        if text:
            out.append(("", 0, place) if hidden else (text, max(0, len(text) - linked), place))
        buffer.clear()
        linked = 0

    def close(depth: int) -> None:
        while len(stack) > depth:
            where[stack.pop()[0]].pop()
        while blocks and blocks[-1] >= depth:
            blocks.pop()

    for text, name, attributes, closing in _pieces(page):
        buffer.append(text)
        if stack and stack[-1][3]:
            linked += len(text)
        if not name:
            continue
        if name == "br":
            buffer.append(" ")
        if closing:
            if name not in VOID and where.get(name):
                depth = where[name][-1]
                if blocks and blocks[-1] >= depth:
                    flush()
                close(depth)
            continue
        if name in RAW:
            continue
        if name in BLOCK:
            flush()
        if name in VOID or attributes.endswith("/"):
            continue
        # an element of the same kind that is the innermost block ends here; an open paragraph ends at any block
        if blocks and (name in SELF_CLOSING and stack[blocks[-1]][0] == name
                       or name in BLOCK and name not in SELF_CLOSING and stack[blocks[-1]][0] == "p"):
            close(blocks[-1])
        _, hidden, place, link = stack[-1] if stack else ("", False, OUTSIDE, False)
        if not hidden:
            furniture = name in BOILERPLATE and not (name == "header" and place)
            page_level = name in ("html", "body", "main", "article")
            hidden = furniture or (not page_level and _is_furniture(attributes, place > OUTSIDE)) \
                or (name == "article" and place > OUTSIDE and _is_furniture(attributes, True))
            if name in ("article", "main") and not hidden and not place:
                place = NAMED if name == "article" and _is_furniture(attributes, True) else MARKED
        where.setdefault(name, []).append(len(stack))
        if name in BLOCK:
            blocks.append(len(stack))
        stack.append((name, hidden, place, link or name == "a"))
    flush()
    return out


def block_stretch(lengths: list[int], window: int, threshold: int) -> tuple[int, int]:
    """[start, end) from the first surge to the last dive of the windowed sums."""
    n = len(lengths)
    sums = np.convolve(np.array(lengths), np.ones(window, dtype=np.int64))[window - 1:] if n else np.zeros(0)
    start, end, i = None, 0, 0
    while i < n:
        if sums[i] < threshold or not lengths[i]:
            i += 1
            continue
        start = i if start is None else start
        while i < n and sums[i] > 0:
            i += 1
        end = i
    return start or 0, end


def text_stretch(found: list[tuple[str, int, int]], chosen: int, window: int = WINDOW_LINES,
                 threshold: int = SURGE_CHARS) -> tuple[int, int]:
    """``block_stretch`` of a page's lines, of which those at other places than the chosen one have no length.

    Where all text is link text, it counts as text.
    """
    lengths = [n if place == chosen else 0 for _, n, place in found]
    if not any(lengths):
        lengths = [len(text) if place == chosen else 0 for text, _, place in found]
    return block_stretch(lengths, window, min(threshold, max(lengths))) if any(lengths) else (0, 0)


def _touching(found: list[tuple[str, int, int]], chosen: int, lines_of_text: range, window: int) -> list[int]:
    """The marked lines next to a stretch, away from it, until ``window`` other lines of text have come between."""
    out, other = [], 0
    for i in lines_of_text:
        text, _, place = found[i]
        if text and place == chosen:
            out.append(i)
            other = 0
        elif text:
            other += 1
            if other >= window:
                break
    return out


def main_text(page: str, window: int = WINDOW_LINES, threshold: int = SURGE_CHARS) -> str:
    """The article's lines in page order, joined by newlines; empty when the page has none."""
    found = lines(page)
    chosen = max((place for text, _, place in found if text), default=OUTSIDE)
    start, end = text_stretch(found, chosen, window, threshold)
    if end <= start:
        return ""
    kept = [i for i in range(start, min(end, len(found))) if found[i][0] and found[i][2] == chosen]
    if chosen and kept:  # the check after the method
        kept = (_touching(found, chosen, range(start - 1, -1, -1), window)[::-1] + kept
                + _touching(found, chosen, range(end, len(found)), window))
    return "\n".join(found[i][0] for i in kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row; NULL html gives an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    wanted = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                          text_or_empty(html_col).alias("html"))
    return map_arrow(wanted, run, "page_id long, url string, text string, n_chars long")
