"""Conversation structure repair: a cheapest edit audit per conversation.

Rows are kept (K), reroled (R) or deleted (D), empty turns inserted (I), until
the roles read ``(s?(ua)+)?``.  A dynamic program over the rows keeps, for each
of the four states of that pattern, the cheapest audit and of equal ones the
ASCII-least.  Audits share their prefixes: an audit is a node linked to the
audit it extends (:class:`Audits`), with binary-lifting ancestors and a rolling
hash of its letters, so a tie is settled by a longest-common-prefix search in
logarithmic time; the prefixes that the hashes call equal are verified.

Audits of one length class never tie as proper prefixes of each other: an
audit's letters determine the state it ends in, and an extra letter I costs 2.
So the least audit of a state extends to the least whole audit, and the program
can be cut anywhere: a stretch of rows is a table (entry state, exit state) ->
(cost, audit), and tables of neighbouring stretches chain.

Rows are range-partitioned by conversation and place, so one long conversation
is spread over many tasks; only the few stretches at partition borders meet
again, two per partition.  Repeated rows travel as one row with a count, and a
text is known by its md5 until the repaired text itself is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import map_arrow, materialize

BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, DONE = range(4)
#: The initial that each state needs next (START also takes a kept s), and where it leads.
NEEDS = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", DONE), DONE: ("u", USER)}
ROLES = {"u": "user", "a": "assistant"}
#: Rows of a range partition, about; a stretch's audits take some 150 bytes a row in its task.
PARTITION_ROWS = 100_000


class Audits:
    """Persistent strings over D, I, K, R: every node extends its parent by one letter."""

    MODULUS = (1 << 61) - 1
    BASE = 1_000_003

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[0]]  # ancestors at distances 1, 2, 4, ... of each node

    def extend(self, node: int, letter: str) -> int:
        new = len(self.letter)
        ups, at, k = [node], node, 0
        while k < len(self.up[at]) and self.depth[at] >= 1 << k:
            at = self.up[at][k]
            ups.append(at)
            k += 1
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * self.BASE + ord(letter)) % self.modulus)
        self.up.append(ups)
        return new

    def lift(self, node: int, depth: int) -> int:
        """The ancestor of ``node`` at ``depth``."""
        while (by := self.depth[node] - depth) > 0:
            node = self.up[node][by.bit_length() - 1]
        return node

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def less(self, a: int, b: int) -> bool:
        """Whether the text of ``a`` is less than that of ``b``."""
        if a == b:
            return False
        shared = min(self.depth[a], self.depth[b])
        u, v = self.lift(a, shared), self.lift(b, shared)
        if self.hash[u] != self.hash[v]:
            # the shallowest ancestors with different hashes: above them is the longest common prefix
            for k in range(shared.bit_length() - 1, -1, -1):
                if k < len(self.up[u]) and k < len(self.up[v]):
                    p, q = self.up[u][k], self.up[v][k]
                    if self.hash[p] != self.hash[q]:
                        u, v = p, q
            differ = (u, v)
            u, v = self.up[u][0], self.up[v][0]
        else:
            differ = None
        while u != v:  # verify the prefix, back to a node that both share: a collision hides the first difference
            if self.letter[u] != self.letter[v]:
                differ = (u, v)
            u, v = self.up[u][0], self.up[v][0]
        if differ:
            return self.letter[differ[0]] < self.letter[differ[1]]
        return self.depth[a] < self.depth[b]


State = list  # per state: None or (cost, node)


def _better(audits: Audits, old, cost: int, node: int, letter: str):
    """The better of ``old`` and the audit ``node`` + ``letter`` at ``cost``."""
    if old is not None and old[0] < cost:
        return old
    new = (cost, audits.extend(node, letter))
    return old if old is not None and old[0] == cost and not audits.less(new[1], old[1]) else new


def relax(audits: Audits, at: State) -> State:
    """Insertions before the next row or at the end: at most a user and an assistant turn can pay."""
    out = list(at)
    for s in (START, SYSTEM, DONE):
        if at[s] is not None:
            out[USER] = _better(audits, out[USER], at[s][0] + 2, at[s][1], "I")
    if out[USER] is not None:
        out[DONE] = _better(audits, out[DONE], out[USER][0] + 2, out[USER][1], "I")
    return out


def consume(audits: Audits, at: State, initial: str, must_go: bool, truncated: bool) -> State:
    """All ways to take one row."""
    out: State = [None] * 4
    for s, value in enumerate(at):
        if value is None:
            continue
        cost, node = value
        out[s] = _better(audits, out[s], cost + 3, node, "D")
        if must_go:
            continue
        need, to = NEEDS[s]
        if s == START and initial == "s":
            out[SYSTEM] = _better(audits, out[SYSTEM], cost + truncated, node, "K")
        if initial == need:
            out[to] = _better(audits, out[to], cost + truncated, node, "K")
        else:
            out[to] = _better(audits, out[to], cost + 2 + truncated, node, "R")
    return out


class Stretch:
    """Consecutive rows of one conversation, taken one by one; ``entries``: states it may be entered in."""

    def __init__(self, entries: tuple[int, ...], modulus: int = Audits.MODULUS):
        self.audits = Audits(modulus)
        self.tables = {e: [(0, 0) if s == e else None for s in range(4)] for e in entries}
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.low = self.high = None
        self.first = self.last = None

    def take(self, turn: int | None, role: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        initial = role[:1]
        if self.first is None:
            self.first, self.first_turn = initial, turn
        elif self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None:
            if self.low is None:
                self.low = turn
            if turn != self.high:
                self.turns += 1
            self.high = turn
        self.last, self.last_turn = initial, turn
        self.blank += blank
        self.duplicate += duplicate and not blank
        faulty = blank or duplicate
        self.truncated += truncated and not faulty
        for e, at in self.tables.items():
            self.tables[e] = consume(self.audits, relax(self.audits, at), initial, faulty, truncated)

    def cells(self) -> list[tuple[int, int, int, str]]:
        """(entry, exit, cost, audit)."""
        return [(e, s, v[0], self.audits.text(v[1]))
                for e, at in self.tables.items() for s, v in enumerate(at) if v is not None]


def finish(states: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """Cost and audit of a whole conversation from (state -> cost, audit) after its last row."""
    ends = dict(states)
    for s in (START, SYSTEM):
        if s in states:
            ends[DONE] = min(ends.get(DONE, (1 << 62, "")), (states[s][0] + 4, states[s][1] + "II"))
    if USER in states:
        ends[DONE] = min(ends.get(DONE, (1 << 62, "")), (states[USER][0] + 2, states[USER][1] + "I"))
    return min(ends[s] for s in (START, DONE) if s in ends)


# -- rows ------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies after the fixed damage (NULL role or text: one space)."""
    def space(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = (F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space("text"), "[.!?]", ""))
            .otherwise(space("text")))
    role = F.when(kind == 4, "user").otherwise(space("role"))
    return (conversations.where(kind != 0)
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                    role.alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("copies")))


def as_they_are(conversations: DataFrame) -> DataFrame:
    """The same columns without damage."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.lit(1).alias("copies"))


def classified(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, copies, blank, truncated, original: equal rows as one.

    ``original``: the first of the copies has no equal row (role and text) before it.
    """
    end = F.rtrim("text", F.lit(BLANKS))
    seen = (rows.select("conv_id", "turn", "role", F.md5("text").alias("digest"), "copies", (end == "").alias("blank"),
                        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
            .groupBy("conv_id", "turn", "role", "digest", "blank", "truncated").agg(F.sum("copies").alias("copies")))
    firsts = (seen.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"))
              .agg(F.bool_or(F.col("turn").isNull()).alias("unplaced"), F.min("turn").alias("least")))
    same = seen["conv_id"].eqNullSafe(firsts["c"]) & (seen["role"] == firsts["r"]) & (seen["digest"] == firsts["d"])
    original = F.when(F.col("unplaced"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("least"))
    return seen.join(firsts, same).select("conv_id", "turn", "role", "digest", "copies", "blank", "truncated",
                                          original.alias("original"))


CELL = "struct<entry:int,exit:int,cost:long,audit:string>"
STRETCH = ("conv_id long, part int, blank long, duplicate long, truncated long, illegal long, low long, high long, "
           f"turns long, first_turn long, last_turn long, first string, last string, cells array<{CELL}>")


def _stretches(rows: DataFrame) -> DataFrame:
    """A row per conversation and partition; ``rows`` are sorted inside range partitions.

    Only a partition's first conversation may have begun before, so only its
    stretch has more than one entry state.
    """
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 9, pa.string(), pa.string(),
             pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()),
                                 ("audit", pa.string())]))]
    names = [x.split()[0] for x in STRETCH.split(", ")]

    def row(conv, part, s: Stretch) -> tuple:
        return (conv, part, s.blank, s.duplicate, s.truncated, s.illegal, s.low, s.high, s.turns, s.first_turn,
                s.last_turn, s.first, s.last,
                [dict(zip(("entry", "exit", "cost", "audit"), c)) for c in s.cells()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, held, conv = TaskContext.get().partitionId(), [], None, None
        for batch in batches:
            for c, turn, role, copies, blank, truncated, original in zip(*(x.to_pylist() for x in batch.columns)):
                if held is None or c != conv:
                    entries = tuple(range(4)) if held is None else (START,)
                    if held is not None:
                        out.append(row(conv, part, held))
                    held, conv = Stretch(entries), c
                for k in range(copies):
                    held.take(turn, role, blank, not original or k > 0, truncated)
            if len(out) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)
                out = []
        if held is not None:
            out.append(row(conv, part, held))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)

    narrow = rows.select("conv_id", "turn", "role", "copies", "blank", "truncated", "original")
    return map_arrow(narrow, run, STRETCH)


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def _chained(stretches: DataFrame) -> DataFrame:
    """One row per conversation from its stretches in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now = [], None
        for batch in batches:
            for s in batch.to_pylist():
                if now is not None and s["conv_id"] == now["conv_id"]:
                    _append(now, s)
                    continue
                if now is not None:
                    out.append(_result(now))
                now = s | {"states": _through({START: (0, "")}, s["cells"])}
            if len(out) > 1000:
                yield _batch(out)
                out = []
        if now is not None:
            out.append(_result(now))
        if out:
            yield _batch(out)

    ordered = stretches.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return map_arrow(ordered, run, RESULT)


def _through(states: dict[int, tuple[int, str]], cells: list[dict]) -> dict[int, tuple[int, str]]:
    out: dict[int, tuple[int, str]] = {}
    for c in cells:
        if c["entry"] in states:
            cost, audit = states[c["entry"]]
            new = (cost + c["cost"], audit + c["audit"])
            out[c["exit"]] = min(out.get(c["exit"], new), new)
    return out


def _append(now: dict, s: dict) -> None:
    for k in ("blank", "duplicate", "truncated", "illegal", "turns"):
        now[k] += s[k]
    now["illegal"] += now["last"] + s["first"] not in ("su", "ua", "au")
    if s["first_turn"] is not None and s["first_turn"] == now["last_turn"]:
        now["turns"] -= 1
    now["low"] = s["low"] if now["low"] is None else now["low"]
    now["high"] = now["high"] if s["high"] is None else s["high"]
    now["last"], now["last_turn"] = s["last"], s["last_turn"]
    now["states"] = _through(now["states"], s["cells"])


def _result(now: dict) -> tuple:
    gaps = 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["turns"]
    return (now["conv_id"], gaps, now["blank"], now["duplicate"], now["truncated"], now["illegal"],
            *finish(now["states"]))


def _batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = [*[pa.int64()] * 7, pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)],
                                      names=[x.split()[0] for x in RESULT.split(", ")])


def audits(rows: DataFrame, partition_rows: int = PARTITION_ROWS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation that has rows.

    ``rows``: conv_id, turn, role, text, copies.  Rows are taken by turn (NULL
    first), then role and md5 of the text.  NULL conv_id is a conversation of
    its own.  A role without initial is never legal.  Empty table: no rows.
    """
    flagged = materialize(classified(rows), "conversation-rows")
    n = max(1, -(-flagged.count() // partition_rows))
    order = ("conv_id", "turn", "role", "digest")
    spread = flagged.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return _chained(materialize(_stretches(spread), "conversation-stretches"))


def _replay(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation."""
    state, last = START, 0
    for letter in audit:
        if letter == "I":
            role, text = ROLES[NEEDS[state][0]], ""
        else:
            role, text = next(rows)
            if letter == "D":
                continue
            if letter == "K" and state == START and role[:1] == "s":
                state = SYSTEM
                yield role, text
                continue
            if letter == "R":
                role = ROLES[NEEDS[state][0]]
        state = NEEDS[state][1]
        yield role, text


def _with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit followed by its rows in order, conversations dealt by id."""
    none = F.lit(None)
    texts = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", F.md5("text").alias("digest"), "copies", "text")
    heads = found.select("conv_id", F.lit(0).alias("kind"), none.cast("long").alias("turn"), F.lit("").alias("role"),
                         F.lit("").alias("digest"), F.lit(0).alias("copies"), F.col("audit").alias("text"))
    return (heads.unionByName(texts).repartition("conv_id")
            .sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
            .select("conv_id", "kind", "role", "copies", "text"))


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[tuple[str, str]]]]:
    """(conv_id, its repaired rows) of sorted rows; holds one batch and one audit at a time."""
    def lines():
        for batch in batches:
            yield from zip(*(x.to_pylist() for x in batch.columns))

    stream = lines()
    head = next(stream, None)
    while head is not None:
        conv, audit, following = head[0], head[4], []

        def rows(conv=conv):
            for line in stream:
                if line[1] == 0:
                    following.append(line)
                    return
                for _ in range(line[3]):
                    yield line[2], line[4]

        own = rows()
        yield conv, _replay(audit, own)
        for _ in own:  # to the next conversation
            pass
        head = following[0] if following else None


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, at, role, text: the repaired conversations, row by row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                names=["conv_id", "at", "role", "text"])

        for conv, repaired in _conversations(batches):
            for k, (role, text) in enumerate(repaired):
                out.append((conv, k, role, text))
                if len(out) >= 2000:
                    yield batch()
                    out = []
        if out:
            yield batch()

    return map_arrow(_with_audits(rows, found), run, "conv_id long, at long, role string, text string")


def repaired_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of ``role:text`` lines.

    SHA-256 can't be computed in parts, so a conversation's repaired text
    streams through one task, a batch at a time; nothing of it is held.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.string()))],
                                              names=["conv_id", "repaired_sha256"])

        for conv, repaired in _conversations(batches):
            sha = hashlib.sha256()
            for k, (role, text) in enumerate(repaired):
                sha.update(f"{chr(10) if k else ''}{role}:{text}".encode())
            out.append((conv, sha.hexdigest()))
            if len(out) >= 2000:
                yield batch()
                out = []
        if out:
            yield batch()

    return map_arrow(_with_audits(rows, found), run, "conv_id long, repaired_sha256 string")


def report(conversations: DataFrame, rows: DataFrame, partition_rows: int = PARTITION_ROWS) -> DataFrame:
    """One row per conv_id of ``conversations``; zeros and an empty audit where ``rows`` has none of it."""
    found = materialize(audits(rows, partition_rows), "conversation-audits")
    digests = repaired_digests(rows, found)
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    a, d = found.withColumnRenamed("conv_id", "a"), digests.withColumnRenamed("conv_id", "d")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c)
               for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (ids.join(a, ids["conv_id"].eqNullSafe(a["a"]), "left").join(d, ids["conv_id"].eqNullSafe(d["d"]), "left")
            .select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")))
