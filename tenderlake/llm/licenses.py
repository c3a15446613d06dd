"""Licence scan: Aho-Corasick over tags and notices, shunting-yard over expressions.

One automaton finds notice phrases in a document's words; identifier tags
(``SPDX-License-Identifier:``) are found in the raw text, and the expression
after a tag is parsed by a shunting-yard into postfix and evaluated: each
identifier maps to a family and an openness between 0 and 1, AND takes the
least open part, OR the most open, WITH lifts a licence half the way to 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import map_arrow, text_or_empty

# Phrases of the result's contract, with their labels.
BASE_PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Further notice phrases of well-known licences.
NOTICE_PHRASES = (
    ("affero general public license", "agpl"),
    ("lesser general public license", "lgpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("bsd license", "bsd"),
    ("2 clause bsd", "bsd"),
    ("3 clause bsd", "bsd"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("isc license", "isc"),
    ("permission is hereby granted free of charge", "mit"),
    ("boost software license", "bsl"),
    ("creative commons attribution", "cc-by"),
    ("cc by", "cc-by"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nd", "cc-by-nd"),
    ("cc by nc", "cc-by-nc"),
    ("cc by nc sa", "cc-by-nc"),
    ("cc by nc nd", "cc-by-nc"),
    ("cc0 1 0", "cc0"),
    ("public domain", "public-domain"),
    ("unlicense", "unlicense"),
    ("all rights reserved", "proprietary"),
)

# Identifier prefix -> family, and openness of each family.
ID_PREFIXES = (
    ("agpl", "agpl"), ("apache", "apache"), ("bsd", "bsd"), ("bsl-1.0", "bsl"), ("cc0", "cc0"),
    ("cc-by-nc", "cc-by-nc"), ("cc-by-nd", "cc-by-nd"), ("cc-by-sa", "cc-by-sa"), ("cc-by", "cc-by"),
    ("epl", "epl"), ("gpl", "gpl"), ("isc", "isc"), ("lgpl", "lgpl"), ("mit", "mit"), ("mpl", "mpl"),
    ("unlicense", "unlicense"),
)
OPENNESS = {
    "agpl": 0.2, "apache": 1.0, "bsd": 1.0, "bsl": 1.0, "cc0": 1.0, "cc-by": 0.9, "cc-by-nc": 0.1, "cc-by-nd": 0.2,
    "cc-by-sa": 0.5, "epl": 0.5, "gpl": 0.3, "isc": 1.0, "lgpl": 0.5, "mit": 1.0, "mpl": 0.6, "proprietary": 0.0,
    "public-domain": 1.0, "unlicense": 1.0,
}
UNKNOWN_OPENNESS = 0.0
TAG = "spdx-license-identifier:"

# Words are runs of what is not an ASCII control, space, punctuation or upper-case letter.
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_TO_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else 32 if c in set(_SEPARATORS) else c for c in range(256))
_EXPRESSION = re.compile(r"[ \t]*([A-Za-z0-9.+\-() \t:]*)")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+\-:]+")
_RANK = {"or": 1, "and": 2, "with": 3}


def family(identifier: str) -> str:
    """Licence family of an identifier; an unknown one stands for itself."""
    name = identifier.lower().rstrip(".:-")  # punctuation of a sentence that ends with the tag
    return next((label for prefix, label in ID_PREFIXES if name == prefix or name.startswith(prefix + "-")
                 or name.startswith(prefix + "+")), name)


def lead(tokens: list[str]) -> int:
    """How many tokens the longest well-formed expression at the beginning has."""
    best, depth, operand = 0, 0, True  # operand: the next token must start one
    for i, tok in enumerate(tokens):
        if tok.lower() in _RANK:
            if operand:
                break
            operand = True
        elif tok == "(":
            if not operand:
                break
            depth += 1
        elif tok == ")":
            if operand or not depth:
                break
            depth -= 1
        elif operand:
            operand = False
        else:
            break
        if not operand and not depth:
            best = i + 1
    return best


def postfix(expression: str, strict: bool = True) -> list[str] | None:
    """Shunting-yard: tokens in postfix order (operators lower-case).

    A plain identifier after a complete expression ends it (prose after a
    tag).  A bracket or operator out of place makes it malformed (None); with
    ``strict=False`` the longest well-formed lead counts.
    """
    tokens = _TOKEN.findall(expression)
    n = lead(tokens)
    if not n or strict and n < len(tokens) and (tokens[n] in "()" or tokens[n].lower() in _RANK):
        return None
    out, ops = [], []
    for tok in tokens[:n]:
        op = tok.lower()
        if op in _RANK:
            while ops and ops[-1] != "(" and _RANK[ops[-1]] >= _RANK[op]:
                out.append(ops.pop())
            ops.append(op)
        elif tok == "(":
            ops.append(tok)
        elif tok == ")":
            while ops[-1] != "(":
                out.append(ops.pop())
            ops.pop()
        else:
            out.append(tok)
    return out + ops[::-1]


def evaluate(tokens: list[str]) -> tuple[float, set[str]]:
    """(openness, families) of a postfix expression; an exception after WITH is no family."""
    stack: list[tuple[float, set[str]]] = []
    for tok in tokens:
        if tok in _RANK:
            b, a = stack.pop(), stack.pop()
            if tok == "with":
                stack.append(((1 + a[0]) / 2, a[1]))
            else:
                stack.append(((min if tok == "and" else max)(a[0], b[0]), a[1] | b[1]))
        else:
            label = family(tok)
            stack.append((OPENNESS.get(label, UNKNOWN_OPENNESS), {label}))
    return stack[0]


def tagged(text: str, tags) -> list[tuple[float, set[str]]]:
    """Evaluated expressions after the identifier tags of a raw text, each up to the next tag or the line's end."""
    low, out = text.lower(), []
    if len(low) != len(text):  # a character whose lower case is longer would shift positions
        text = low
    ends = [end + 1 for end, _ in tags.iter(low)]
    for at, following in zip(ends, [*[e - len(TAG) for e in ends[1:]], len(text)]):
        tokens = postfix(_EXPRESSION.match(text, at, max(at, following))[1], strict=False)
        if tokens:
            out.append(evaluate(tokens))
    return out


def tag_automaton():
    import ahocorasick
    machine = ahocorasick.Automaton()
    machine.add_word(TAG, TAG)
    machine.make_automaton()
    return machine


def automaton():
    """Phrases between spaces -> (label, words, is base); a phrase listed twice keeps both labels."""
    import ahocorasick
    machine, entries = ahocorasick.Automaton(), {}
    for phrases, base in ((BASE_PHRASES, True), (NOTICE_PHRASES, False)):
        for phrase, label in phrases:
            entries.setdefault(f" {phrase} ", []).append((label, base))
    for phrase, found in entries.items():
        machine.add_word(phrase, (len(phrase), found))
    machine.make_automaton()
    return machine


def scan(text: str, machine, tags=None) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score) of one text."""
    words = text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split(b" ")
    words = [w for w in words if w]
    flat = " " + b" ".join(words).decode("utf-8", "surrogatepass") + " "
    starts, base, labels, notices = [], set(), {}, []
    for end, (size, found) in machine.iter(flat):
        at = end - size + 1
        for label, is_base in found:
            if is_base:
                labels[label] = OPENNESS[label]
                starts.append(at)
                base.add(label)
            else:
                notices.append((at, end, label))
    reach = (-1, -1)  # of notices inside one another the longest counts
    for at, end, label in sorted(notices, key=lambda x: (x[0], -x[1])):
        if end > reach[1]:
            reach = (at, end)
        if reach == (at, end):
            labels[label] = OPENNESS[label]
    if starts:  # matches come by end, so starts may be out of order
        starts.sort()
        first, last = flat.count(" ", 0, starts[0]), flat.count(" ", 0, starts[-1])
    else:
        first = last = None
    score = min(labels.values(), default=None)
    for value, families in tagged(text, tags or tag_automaton()):
        score = value if score is None else min(score, value)
        labels.update(dict.fromkeys(families))
    return (len(words), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(labels)),
            0.0 if score is None else float(score))


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licences of every row; NULL and empty texts have no words, empty labels and score 0.

    ``score`` is the openness of the document: the least open of its notices
    and evaluated tag expressions, 0 when nothing was found.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, tags = automaton(), tag_automaton()
        for b in batches:
            cols = list(zip(*[scan(t, machine, tags) for t in b.column(1).to_pylist()])) or [()] * 7
            kinds = (pa.int64(),) * 4 + (pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(cols, kinds)]],
                                             names=[f.split()[0] for f in SCHEMA.split(", ")])

    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_arrow(wanted, run, SCHEMA)
