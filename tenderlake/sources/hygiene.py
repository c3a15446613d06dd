"""Load rules applied to every landed text column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.functions import blank_as_null, truncate_utf8


def clean_loaded(df: DataFrame, widths: Mapping[str, int] | None = None) -> DataFrame:
    """SRC-7: empty and whitespace-only text -> NULL; text longer than its
    declared byte width (``widths``) is cut at a character boundary."""
    widths = dict(widths or {})
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    blanked = df.select(*[blank_as_null(F.col(c)).alias(c) if c in text else F.col(c) for c in df.columns])
    cut = [c for c in df.columns if c in text and c in widths]
    if not cut:
        return blanked
    # Separate projection: the cut reads each value several times, and the
    # blank test must not be re-evaluated (or hoisted) for every read.
    return blanked.select(*[truncate_utf8(F.col(c), widths[c]).alias(c) if c in cut else F.col(c)
                            for c in df.columns])
