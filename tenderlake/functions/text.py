"""Text hygiene applied while landing files."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters counted as blank by the load rule (space, tab, LF, CR, FF, VT).
BLANK_CLASS = "[ \\t\\n\\r\\f\\x0B]"


def strip_control(text: Column) -> Column:
    """Delete every tab and newline character from already-parsed text."""
    return F.translate(text, "\t\n", "")


def blank_as_null(text: Column) -> Column:
    """Empty or whitespace-only text becomes NULL."""
    return F.when(text.rlike(f"^{BLANK_CLASS}*\\z"), F.lit(None).cast("string")).otherwise(text)


def _cut_utf8(text: Column, width: int) -> Column:
    """``text`` (known to exceed ``width`` bytes) cut at a character boundary.

    A UTF-8 character spans at most 4 bytes, so only bytes ``width-2 ..
    width+1`` decide the cut: every continuation byte (hex 80-BF) at the end
    of that window belongs to a character that would be split, so the cut
    moves back by their count.  O(1) per value.
    """
    b = F.encode(text, "UTF-8")
    first = max(width - 2, 1)
    window = F.hex(F.substring(b, first, width + 2 - first))
    split = F.length(F.regexp_extract(window, "((?:[89AB][0-9A-F])*)$", 1)) / 2
    keep = (F.lit(width) - split).cast("int")
    return F.decode(F.substring(b, F.lit(1), keep), "UTF-8")


def truncate_utf8(text: Column, width: int) -> Column:
    """Cut text to at most ``width`` UTF-8 bytes without splitting a character.

    Values within the width cost one length test.  The cut itself sits in a
    one-element ``transform`` lambda: it is evaluated only for over-long
    values, and its code is not inlined into the stage, so a landing table
    with dozens of width-limited columns keeps a small generated method (a
    fused method past the JIT size limit runs interpreted, ~5x slower).
    """
    cut = F.transform(F.array(text), lambda v: _cut_utf8(v, width))[0]
    return F.when(F.octet_length(text) > width, cut).otherwise(text)
