"""Conversation structure repair by a persistent audit DP.

A conversation's rows, in order of ``turn``, are edited until the role
initials read ``(s?(ua)+)?``.  Edits and costs: Keep 0, Rerole to user or
assistant 3, Delete 4, Insert an empty user or assistant row 3; a truncated
row that stays adds 3; blank and duplicate rows must go.  The audit is the
string of the edits' initials of the cheapest repair, the ASCII-least one
where several cost the same.

1. Spark deals rows by conversation and sorts them; blank and truncated rows
   are found by string functions, duplicates by a window over (conversation,
   role, text) that needs no exchange of its own.
2. A task streams the sorted rows once.  The DP has four states (nothing
   yet, after s, after u, after a); each holds its cost, its audit and the
   running SHA-256 of the repaired text, so no text is kept.
3. Audits share their prefixes: a node is one edit with its depth, a rolling
   hash of the whole prefix and its ancestors 1, 2, 4, ... edits before.  A tie is
   decided by the longest common prefix, found by descending the ancestors
   while hashes differ; where hashes agree on different nodes the edits
   themselves are compared.  Audits of one state over the same rows and cost
   differ before either ends, so the lesser prefix stays the lesser.
4. Every ``SETTLE`` rows the prefix common to all states is written out as
   bytes and its nodes dropped.

A conversation is streamed by one task, in bounded memory but for its audit
(a byte an edit): its digest is one sequential hash over all its rows.

Defined results: a null role or text is one space (a blank row; no legal
initial); an empty role has no initial; null turns come first; rows of equal
turn are taken by (role, text); a null ``conv_id`` is a conversation of its
own; an empty table gives no rows; other columns are ignored.  ``gaps``
beyond a long is its greatest value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
#: rows of one conversation between two settlings of the common prefix
SETTLE = 4096
_BASE, _MOD = 1_000_003, (1 << 61) - 1
_LONG = (1 << 63) - 1

START, S, U, A = range(4)
#: state -> initial that may follow -> next state
_KEEP = ({"s": S, "u": U}, {"u": U}, {"a": A}, {"u": U})
#: state -> the role that a reroled or inserted row takes there
_NEXT = (U, U, A, U)
_ROLE = {U: b"user:", A: b"assistant:"}


class Node:
    """One edit behind a prefix; ``up[k]`` is the node 2**k edits before."""

    __slots__ = ("edit", "depth", "hash", "up")

    def __init__(self, edit: str = "", before: Node | None = None):
        self.edit = edit
        if before is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = before.depth + 1
        self.hash = (before.hash * _BASE + ord(edit)) % _MOD
        up, at, k = [before], before, 0
        while len(at.up) > k:
            at = at.up[k]
            up.append(at)
            k += 1
        self.up = up

    def lifted(self, depth: int) -> Node:
        at, k = self, 0
        far = self.depth - depth
        while far:
            if far & 1:
                at = at.up[k]
            far >>= 1
            k += 1
        return at


def edits(node: Node, root: Node | None = None) -> str:
    """The edits behind ``root`` up to ``node``."""
    out = []
    while node is not root and node.up:
        out.append(node.edit)
        node = node.up[0]
    return "".join(reversed(out))


def _same(x: Node, y: Node) -> bool:
    """Whether two prefixes of one length are equal, by their edits."""
    while x is not y:
        if x.edit != y.edit:
            return False
        x, y = x.up[0], y.up[0]
    return True


def less(x: Node, y: Node) -> bool:
    """Whether the audit at ``x`` is ASCII-less than that at ``y``."""
    depth = min(x.depth, y.depth)
    a, b = x.lifted(depth), y.lifted(depth)
    if a is b or (a.hash == b.hash and _same(a, b)):
        return x.depth < y.depth
    if a.hash == b.hash:                                    # a collision of whole prefixes
        return edits(x) < edits(y)
    k = len(a.up)
    while k:
        k -= 1
        if k < len(a.up) and a.up[k].hash != b.up[k].hash:
            a, b = a.up[k], b.up[k]
    # the parents' hashes agree: they end the longest common prefix unless they collide
    if _same(a.up[0], b.up[0]):
        return a.edit < b.edit
    return edits(x) < edits(y)


class Repair:
    """The DP over one conversation, row by row."""

    def __init__(self) -> None:
        self.settled: list[str] = []
        self.rows = 0
        # per state: cost, audit, running hash
        self.best: list[tuple | None] = [(0, Node(), hashlib.sha256()), None, None, None]
        self._insert()

    def _insert(self) -> None:
        """Rows that may be put in behind the rows so far; two at most."""
        best = self.best
        for to, origins in ((U, (START, S, A)), (A, (U,))):
            found = [(best[s][0] + INSERT, s, "I", b"") for s in origins if best[s]]
            if best[to]:
                found.append((best[to][0], -1, "", b""))
            self._choose(to, found, best, best)

    def _choose(self, to: int, found: list[tuple], old: list, new: list) -> None:
        if not found:
            return
        cost = min(f[0] for f in found)
        won = node = None
        for f in found:
            if f[0] == cost:
                _, s, edit, _ = f
                other = old[to][1] if s < 0 else Node(edit, old[s][1])
                if won is None or less(other, node):
                    won, node = f, other
        _, s, edit, said = won
        if s < 0:
            return
        digest = old[s][2]
        if edit != "D":
            digest = digest.copy()
            if s != START:
                digest.update(b"\n")
            digest.update(said if edit == "K" else _ROLE[to] + said)
        new[to] = (cost, node, digest)

    def row(self, initial: str, role: bytes, text: bytes, gone: bool, cut: bool) -> None:
        old, new = self.best, [None] * 4
        found: list[list[tuple]] = [[], [], [], []]
        for s in range(4):
            if old[s]:
                cost = old[s][0]
                found[s].append((cost + DELETE, s, "D", b""))
                if not gone:
                    if cut:
                        cost += CUT
                    to = _KEEP[s].get(initial)
                    if to:
                        found[to].append((cost, s, "K", role + b":" + text))
                    found[_NEXT[s]].append((cost + REROLE, s, "R", text))
        for to in range(4):
            self._choose(to, found[to], old, new)
        self.best = new
        self._insert()
        self.rows += 1
        if self.rows % SETTLE == 0:
            self._settle()

    def _settle(self) -> None:
        heads = [b[1] for b in self.best if b]
        depth = min(h.depth for h in heads)
        ends = [h.lifted(depth) for h in heads]
        while any(e is not ends[0] for e in ends):
            ends = [e.up[0] for e in ends]
        self.settled.append(edits(ends[0]))
        root, again = Node(), {}

        def rebuilt(node: Node) -> Node:
            path = []
            while node is not ends[0] and id(node) not in again:
                path.append(node)
                node = node.up[0]
            at = root if node is ends[0] else again[id(node)]
            for old in reversed(path):
                at = again[id(old)] = Node(old.edit, at)
            return at

        self.best = [b and (b[0], rebuilt(b[1]), b[2]) for b in self.best]

    def result(self) -> tuple[int, str, str]:
        """Cost, audit and the repaired text's SHA-256."""
        won = self.best[START]
        other = self.best[A]
        if other and (other[0] < won[0] or (other[0] == won[0] and less(other[1], won[1]))):
            won = other
        return won[0], "".join(self.settled) + edits(won[1]), won[2].hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults planted by the CRC-32 of ``conv_id:turn``.

    Modulo 20: 0 drops the row (``live`` is false), 1 empties its text, 2
    removes ``.!?`` from it, 3 repeats it, 4 sets its role to user."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    k = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return conversations.select(
        "conv_id", "turn",
        F.when(k == 4, "user").otherwise(role).alias("role"),
        F.when(k <= 1, "").when(k == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.explode(F.when(k == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        (k != 0).alias("live"))


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")]


def faulted(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copy, live) with their first ``fault``, dealt by conversation."""
    rows = rows.withColumns({"role": F.coalesce("role", F.lit(" ")), "text": F.coalesce("text", F.lit(" "))})
    said = F.rtrim("text", F.lit(BLANKS))
    earlier = Window.partitionBy("conv_id", "live", "role", "text").orderBy(F.col("turn").asc_nulls_first(), "copy")
    fault = (F.when(F.octet_length(said) == 0, "blank")
             .when(F.row_number().over(earlier) > 1, "duplicate")
             .when(~F.right(said, F.lit(1)).isin(*ENDS), "truncated"))
    return rows.repartition("conv_id").withColumn("fault", fault)


AUDIT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
         "audit string, repaired_sha256 string")


class _Conversation:
    def __init__(self, conv: int | None):
        self.conv, self.repair = conv, Repair()
        self.low = self.high = None
        self.turns = self.illegal = 0
        self.initial: str | None = None
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}

    def row(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if turn is not None:
            if self.low is None:
                self.low = turn
            if turn != self.high:
                self.turns += 1
                self.high = turn
        if fault:
            self.faults[fault] += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self.repair.row(initial, role.encode(), text.encode(), fault in ("blank", "duplicate"), fault == "truncated")

    def result(self) -> tuple:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, _LONG)
        return (self.conv, gaps, *self.faults.values(), self.illegal, *self.repair.result())


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64())
                        for n in (field.split()[0] for field in AUDIT.split(", "))])
    at: _Conversation | None = None
    done: list[tuple] = []

    def out() -> pa.RecordBatch:
        columns = list(zip(*done)) or [[]] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        for conv, turn, role, text, live, fault in zip(*(c.to_pylist() for c in batch.columns)):
            if at is None or conv != at.conv:
                if at:
                    done.append(at.result())
                at = _Conversation(conv)
            if live:
                at.row(turn, role, text, fault)
        if len(done) >= 2000:
            yield out()
            done = []
    if at:
        done.append(at.result())
    if done:
        yield out()


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``faulted`` rows: counts of faults, cost,
    audit and the digest of the repaired text (``role:text`` lines)."""
    ordered = rows.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *_order())
    return ordered.select("conv_id", "turn", "role", "text", "live", "fault").mapInArrow(_stream, AUDIT)


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired rows themselves: conv_id, position, edit, turn, role, text.

    Each edit of the ``found`` audits meets the row it was made for (inserted
    ones have none); the roles follow from the place behind the system row."""
    conv = Window.partitionBy("c").orderBy("at")
    steps = (found.select(F.struct("conv_id").alias("c"), F.posexplode(F.split("audit", "")).alias("at", "edit"))
             .where(F.col("edit") != "")
             .withColumn("row", F.sum(F.when(F.col("edit") == "I", 0).otherwise(1)).over(conv))
             .withColumn("own", F.when(F.col("edit") != "I", F.col("row"))))
    numbered = (rows.where("live").withColumn("c", F.struct("conv_id"))
                .withColumn("own", F.row_number().over(Window.partitionBy("c").orderBy(*_order()))))
    placed = (steps.where(F.col("edit") != "D")
              .join(numbered.select("c", "own", "turn", "role", "text"), ["c", "own"], "left")
              .withColumn("position", F.row_number().over(conv)))
    system = F.first(F.when((F.col("edit") == "K") & F.col("role").startswith("s"), 1).otherwise(0)).over(conv)
    legal = F.when((F.col("position") - system) % 2 == 1, "user").otherwise("assistant")
    return placed.select(
        "c.conv_id", "position", "edit", "turn",
        F.when(F.col("edit") == "K", F.col("role")).otherwise(legal).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))


def repair(conversations: DataFrame) -> DataFrame:
    """Audits of rows (conv_id, turn, role, text) as they are."""
    return audits(faulted(conversations.select("conv_id", "turn", "role", "text", F.lit(1).alias("copy"),
                                               F.lit(True).alias("live"))))
