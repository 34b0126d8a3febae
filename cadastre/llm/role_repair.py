"""Repair of the structure of conversations by a generalised LR parser with weighted edits.

Roles must read ``(s?(ua)+)?`` by their initials.  The parser's tables come from the grammar below.
Its stacks share their lower part (a graph-structured stack); each row moves every stack on by the
edits Keep, Rerole and Delete, and between rows user and assistant may be Inserted.  Stacks of equal
top have the same future, so they merge into the one of least (cost, audit).

Spark shuffles the rows once, by conversation, marks repeated rows by a window over the same
partitions and sorts; a task then reads its conversations as a stream.  What it holds of one is a
stack and a running SHA-256 for each of at most six tops and one letter a row, never its texts.
A conversation is one digest of its texts in order, so its rows are read by one task in any case.

Edge cases: a null role or text is one blank; null turns come first; rows of one turn go by role and
text; a null conversation is one conversation; a role whose initial is not s, u or a, or that is
empty, cannot be kept; a conversation that loses all rows has zeros and the digest of the empty
text; an empty table gives no row; other columns are not read; a gap count beyond 63 bits is cut there.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

# ---- the grammar: S is a conversation, T its turns; left recursion keeps stacks short
RULES = (("S", ""), ("S", "T"), ("S", "sT"), ("T", "ua"), ("T", "Tua"))
# ---- what edits cost, and the roles that may be given or inserted
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

_SPACES = " \t\n\x0b\f\r"
_COLUMNS = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
            "cost long, audit string, repaired_sha256 string")


def _closure(items: frozenset) -> frozenset:
    while True:
        more = items | {(r, 0) for rule, dot in items if dot < len(RULES[rule][1])
                        for r, (head, _) in enumerate(RULES) if head == RULES[rule][1][dot]}
        if more == items:
            return items
        items = more


_START = _closure(frozenset((r, 0) for r, (head, _) in enumerate(RULES) if head == "S"))


@functools.cache
def _goto(state: frozenset, symbol: str) -> frozenset | None:
    moved = frozenset((rule, dot + 1) for rule, dot in state if RULES[rule][1][dot:dot + 1] == symbol)
    return _closure(moved) if moved else None


@functools.cache
def _shift(stack: tuple, symbol: str) -> tuple | None:
    """The stack (top first, the rest shared below) after a role and the reductions it allows."""
    top = _goto(stack[0], symbol)
    if top is None:
        return None
    stack = (top, stack)
    while True:
        done = [rule for rule, dot in stack[0] if dot == len(RULES[rule][1]) and RULES[rule][0] != "S"]
        if not done:
            return stack
        head, body = RULES[done[0]]
        for _ in body:
            stack = stack[1]
        stack = (_goto(stack[0], head), stack)


def _accepts(state: frozenset) -> bool:
    return any(RULES[rule][0] == "S" and dot == len(RULES[rule][1]) for rule, dot in state)


class _Path:
    """A stack, what it cost, the letters of its edits since the last cut, and its text's digest."""

    __slots__ = ("stack", "cost", "old", "new", "digest")

    def __init__(self, stack, cost, old, new, digest):
        self.stack, self.cost, self.old, self.new, self.digest = stack, cost, old, new, digest

    def before(self, other: _Path | None) -> bool:
        if other is None or self.cost != other.cost:
            return other is None or self.cost < other.cost
        if self.old is other.old:
            return self.new < other.new
        return self.old + self.new < other.old + other.new


class _Parse:
    """All stacks of one conversation."""

    def __init__(self):
        self.tops: dict[frozenset, _Path] = {_START: _Path((_START, None), 0, "", "", None)}
        self.settled: list[str] = []
        self.rows = 0
        self._insert()

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        """Move every stack over one row."""
        extra = TRUNCATED if truncated else 0
        edits = []
        if not must_go:
            edits = [(x, "R", REROLE + extra, name) for x, name in ROLES.items()]
            if role[:1] in ("s", *ROLES):
                edits.append((role[:1], "K", KEEP + extra, role))
        tops: dict[frozenset, _Path] = {}
        told: dict[frozenset, tuple] = {}
        for path in self.tops.values():
            moves = [(path.stack, "D", DELETE, None)]
            for symbol, letter, cost, name in edits:
                stack = _shift(path.stack, symbol)
                if stack is not None:
                    moves.append((stack, letter, cost, name))
            for stack, letter, cost, name in moves:
                moved = _Path(stack, path.cost + cost, path.old, path.new + letter, path.digest)
                if moved.before(tops.get(stack[0])):
                    tops[stack[0]], told[stack[0]] = moved, name
        for top, path in tops.items():
            if told[top] is not None:
                path.digest = _told(path.digest, f"{told[top]}:{text}")
        self.tops = tops
        self._insert()
        self.rows += 1
        if self.rows % 512 == 0:
            self._settle()

    def _insert(self) -> None:
        """Give every stack the roles that may be inserted, while that makes one cheaper."""
        waiting = list(self.tops.values())
        while waiting:
            path = waiting.pop()
            for symbol, name in ROLES.items():
                stack = _shift(path.stack, symbol)
                if stack is None:
                    continue
                moved = _Path(stack, path.cost + INSERT, path.old, path.new + "I", None)
                if moved.before(self.tops.get(stack[0])):
                    moved.digest = _told(path.digest, f"{name}:")
                    self.tops[stack[0]] = moved
                    waiting.append(moved)

    def _settle(self) -> None:
        """Take out the letters that all stacks share."""
        whole = [path.old + path.new for path in self.tops.values()]
        least, most = min(whole), max(whole)
        same, end = 0, min(len(least), len(most))
        while same < end:
            middle = (same + end + 1) // 2
            if least[same:middle] == most[same:middle]:
                same = middle
            else:
                end = middle - 1
        self.settled.append(least[:same])
        for path, letters in zip(self.tops.values(), whole):
            path.old, path.new = letters[same:], ""

    def best(self) -> tuple[int, str, str]:
        found = None
        for top, path in self.tops.items():
            if _accepts(top) and path.before(found):
                found = path
        digest = found.digest or hashlib.sha256()
        return found.cost, "".join([*self.settled, found.old, found.new]), digest.hexdigest()


def _told(digest, line: str):
    """The digest of the lines so far and one more."""
    digest, line = (digest.copy(), "\n" + line) if digest else (hashlib.sha256(), line)
    digest.update(line.encode("utf-8", "surrogatepass"))
    return digest


class _Conversation:
    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.parse = _Parse()
        self.least = self.most = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last = None

    def row(self, turn, role, text, fault) -> None:
        if turn is not None:
            self.turns += turn != self.turn
            self.least = turn if self.least is None else self.least
            self.most = self.turn = turn
        if self.last is not None:
            self.illegal += self.last + role[:1] not in LEGAL
        self.last = role[:1]
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        self.parse.row(role, text, fault in ("blank", "duplicate"), fault == "truncated")

    def result(self) -> tuple:
        gaps = 0 if self.least is None else min(self.most - self.least + 1 - self.turns, (1 << 63) - 1)
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal,
                *self.parse.best())


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations in order of their rows; one may go on over any number of batches."""
    done, letters, now = [], 0, None

    def batch():
        columns = list(zip(*done))
        types = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_NAMES)

    for rows in batches:
        for conv, dropped, turn, role, text, fault in zip(*(c.to_pylist() for c in rows.columns)):
            if now is None or now.conv_id != conv:
                if now is not None:
                    done.append(now.result())
                    letters += len(done[-1][-2])
                now = _Conversation(conv)
                if len(done) >= 4096 or letters > 8 << 20:
                    yield batch()
                    done, letters = [], 0
            if not dropped:
                now.row(turn, role, text, fault)
    if now is not None:
        done.append(now.result())
    if done:
        yield batch()


_NAMES = [c.split()[0] for c in _COLUMNS.split(", ")]


def damage(rows: DataFrame) -> DataFrame:
    """Rows of conv_id, turn, role, text with the set faults; those that are dropped are marked."""
    code = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
                               F.coalesce(F.col("turn").cast("string"), F.lit(" "))).cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    return (rows.withColumn("_code", code)
            .select("conv_id", (F.col("_code") == 0).alias("dropped"), "turn",
                    F.when(F.col("_code") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
                    F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.regexp_replace(text, "[.!?]", ""))
                    .otherwise(text).alias("text"),
                    F.explode(F.when(F.col("_code") == 3, F.array(F.lit(0), F.lit(1)))
                              .otherwise(F.array(F.lit(0)))).alias("_copy"))
            .drop("_copy"))


def mend(rows: DataFrame) -> DataFrame:
    """Per conversation of ``conv_id, dropped, turn, role, text``: its faults and the cheapest edits.

    A dropped row only keeps its conversation in the result.
    """
    trimmed = F.btrim(F.col("text"), F.lit(_SPACES))
    seen = F.row_number().over(Window.partitionBy("conv_id", "dropped", "role", "text").orderBy("turn"))
    fault = (F.when(trimmed == "", "blank").when(F.col("_seen") > 1, "duplicate")
             .when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "truncated"))
    # the window's partitions hold whole conversations already: one shuffle
    return (rows.repartition("conv_id").withColumn("_seen", seen)
            .select("conv_id", "dropped", "turn", "role", "text", fault.alias("fault"))
            .sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_repair, _COLUMNS))


def damage_and_mend(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                                F.col("role").cast("string"), F.col("text").cast("string"))
    return mend(damage(rows))
