"""Brute-force building blocks and awkward rows shared by the tests."""

from __future__ import annotations

import re

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "h1 string, fp string, _norm string, _rn string, _got string, hash string, score string")


def rows(spark, items):
    """documents rows from (doc_id, text) or (doc_id, text, lang), with clashing extra columns."""
    full = [(i[0], i[1], i[2] if len(i) > 2 else "en", None, None, "x", None, "y", None, "z", "", None) for i in items]
    return spark.createDataFrame(full, SCHEMA)


def union_find(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
