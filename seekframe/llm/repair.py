"""Conversation structure repair by aligning turns with an alternating grammar.

A sound conversation is empty, or has an optional system turn and then pairs of a user and an
assistant turn. Turns are kept (0), given another role (2) or deleted (3; blank and repeated turns
must go), and empty turns may be added (2); a truncated turn that stays costs 1 more. Of the cheapest
repairs the one whose edits, a letter each, are least in ASCII is taken.

Rows are laid out by one global sort, so a long conversation is spread over tasks, and are cut into
blocks of up to 64. For each block, Wagner-Fischer tables align its rows with the grammar's string
of each feasible length: targets that end alike are suffixes of each other and share a table. A
greedy repair gives the incumbent cost, and Ukkonen's band leaves out cells that cost more. Of
equally cheap lengths the backtraced audits are compared. A block gives the best audit between
each pair of grammar states at its ends; no added turn ends a block, so no audit is the beginning of
an equally cheap other, and the blocks' audits are chosen one after another. The digest of a
conversation needs its turns in order, so a last pass streams them, holding no text but the current one.

Nulls in ``role`` or ``text`` are one space. Turns are ordered by ``turn`` (null first), ties by role
and text, repeated rows each for itself. Rows without ``conv_id`` are one conversation. A role counts
by its first letter. A conversation without rows has zeros, an empty audit and the digest of nothing.
Texts are read whole; further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import parked

# Fixed costs of the edits, and the grammar's letters.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
OTHER = {"u": "a", "a": "u"}
#: Rows of a block, as bits of a place.
BLOCK_BITS = 6
#: Marks of a row.
BLANK, DUPLICATE, CUT = 1, 2, 3

# Where the grammar may stand between two rows: at its start, after the system turn, before a user
# turn that may be left out, before an assistant turn.
START, OPENED, USER, ASSISTANT = range(4)
#: What ends a conversation there: the turns to add.
CLOSING = {START: "", OPENED: "II", USER: "", ASSISTANT: "I"}

SPACE = " \t\n\x0b\x0c\r"


class Aligned:
    """Wagner-Fischer cost table of a block's rows against ``...uaua`` strings that end with ``last``.

    ``cost(i, k)``: least cost of aligning the rows from ``i`` on with the last ``k`` letters. Cells whose
    least possible cost is above ``most`` are left out.
    """

    def __init__(self, rows: list[tuple[str, int]], last: str, most: int):
        self.rows, self.last, n = rows, last, len(rows)
        # What the rows from i on cost at least, and how many of them can stay.
        self.least, self.able = [0] * (n + 1), [0] * (n + 1)
        for i in range(n - 1, -1, -1):
            gone = rows[i][1] in (BLANK, DUPLICATE)
            self.least[i] = self.least[i + 1] + (DELETE if gone else TRUNCATED if rows[i][1] == CUT else 0)
            self.able[i] = self.able[i + 1] + (not gone)
        spare = (most - self.least[0]) // min(INSERT, DELETE - TRUNCATED)
        self.low = [max(0, x - spare) for x in self.able]
        self.high = [x + spare for x in self.able]
        self.table: list[list[int]] = [[]] * (n + 1)
        # After the last row nothing is added: that belongs to the next block.
        self.low[n], self.high[n] = 0, 0
        self.table[n] = [0]
        for i in range(n - 1, -1, -1):
            self.table[i] = self._row(i)

    def letter(self, k: int) -> str:
        return self.last if k % 2 else OTHER[self.last]

    def cost(self, i: int, k: int) -> float:
        at = k - self.low[i]
        return self.table[i][at] if 0 <= at < len(self.table[i]) else float("inf")

    def stay(self, i: int, k: int) -> int | None:
        """Cost of letting row ``i`` stand for the ``k``-th letter from the end; None if it must go."""
        role, mark = self.rows[i]
        if mark in (BLANK, DUPLICATE):
            return None
        return (0 if role == self.letter(k) else REROLE) + (TRUNCATED if mark == CUT else 0)

    def _row(self, i: int) -> list[float]:
        out: list[float] = []
        role, mark = self.rows[i]
        stays = mark not in (BLANK, DUPLICATE)
        extra = TRUNCATED if mark == CUT else 0
        odd = extra + (0 if role == self.last else REROLE)
        even = extra + (0 if role == OTHER[self.last] else REROLE)
        below, shift = self.table[i + 1], self.low[i + 1]
        size = len(below)
        left = float("inf")
        for k in range(self.low[i], self.high[i] + 1):
            at = k - shift
            best = below[at] + DELETE if 0 <= at < size else float("inf")
            if stays and 0 < at <= size and (c := below[at - 1] + (odd if k % 2 else even)) < best:
                best = c
            if k and left + INSERT < best:
                best = left + INSERT
            out.append(best)
            left = best
        return out

    def audit(self, i: int, k: int) -> str:
        """Edits of a cheapest alignment from a cell on, least in ASCII."""
        out = []
        while i < len(self.rows):
            here = self.cost(i, k)
            if here == self.cost(i + 1, k) + DELETE:
                out.append("D")
                i += 1
            elif k and here == self.cost(i, k - 1) + INSERT:
                out.append("I")
                k -= 1
            else:
                out.append("K" if self.rows[i][0] == self.letter(k) else "R")
                i, k = i + 1, k - 1
        return "".join(out)


def incumbent(rows: list[tuple[str, int]]) -> int:
    """Cost of a greedy repair, with what it takes to begin and end it in any state."""
    cost, want = 0, "u"
    for role, mark in rows:
        if mark in (BLANK, DUPLICATE):
            cost += DELETE
            continue
        cost += TRUNCATED if mark == CUT else 0
        if role == want:
            want = OTHER[want]
        else:
            # A turn of the other role stays behind an added one; any other role is changed.
            cost += INSERT
            want = want if role in OTHER else OTHER[want]
    return cost + 2 * INSERT + REROLE


def solved(rows: list[tuple[str, int]]) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, audit) between grammar states: the cheapest over all feasible lengths, least in ASCII."""
    n, most, best = len(rows), incumbent(rows), {}

    def offer(start: int, end: int, cost: float, audit) -> None:
        kept = best.get((start, end))
        if cost == float("inf") or (kept is not None and kept[0] < cost):
            return
        said = audit()
        if kept is None or (cost, said) < kept:
            best[start, end] = (cost, said)

    for state in range(4):
        offer(state, state, DELETE * n, lambda: "D" * n)
    for last, end in (("a", USER), ("u", ASSISTANT)):
        table = Aligned(rows, last, most)
        lengths = [k for k in range(max(1, table.low[0]), table.high[0] + 1) if table.cost(0, k) < float("inf")]
        for k in lengths:
            cost = table.cost(0, k)
            for start in (START, OPENED, USER) if table.letter(k) == "u" else (ASSISTANT,):
                offer(start, end, cost, lambda: table.audit(0, k))
        # A system turn can only be kept: the rows before it go, the rest follows.
        for i, (role, mark) in enumerate(rows):
            if role != "s" or mark in (BLANK, DUPLICATE):
                continue
            before = DELETE * i + (TRUNCATED if mark == CUT else 0)
            if last == "a":
                offer(START, OPENED, before + DELETE * (n - i - 1), lambda: "D" * i + "K" + "D" * (n - i - 1))
            for k in range(table.low[i + 1], table.high[i + 1] + 1):
                if k and table.letter(k) == "u":
                    offer(START, end, before + table.cost(i + 1, k), lambda: "D" * i + "K" + table.audit(i + 1, k))
    return [(a, b, int(cost), audit) for (a, b), (cost, audit) in best.items()]


def joined(blocks: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """The cheapest way through all blocks, least in ASCII."""
    ends = [{s: INSERT * len(x) for s, x in CLOSING.items()}]
    for ways in reversed(blocks):
        own: dict[int, int] = {}
        for a, b, cost, _ in ways:
            if b in ends[-1] and cost + ends[-1][b] < own.get(a, 1 << 62):
                own[a] = cost + ends[-1][b]
        ends.append(own)
    total, state, out = ends[-1][START], START, []
    for ways, here, after in zip(blocks, reversed(ends[1:]), reversed(ends[:-1])):
        audit, state = min((audit, b) for a, b, cost, audit in ways if a == state and b in after and cost + after[b] == here[state])
        out.append(audit)
    return total, "".join(out) + CLOSING[state]


class Repaired:
    """The repaired turns of one conversation, one after another, from its audit and its rows."""

    def __init__(self, audit: str):
        self.audit, self.at, self.made, self.digest, self.opened = audit, 0, 0, hashlib.sha256(), False

    def _put(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.made else ''}{role}:{text}".encode())
        self.made += 1

    def _next(self) -> str:
        return ROLES["ua"[(self.made - self.opened) % 2]]

    def added(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._put(self._next(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.added()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.opened |= not self.made and role[:1] == "s"
            self._put(role, text)
        elif edit == "R":
            self._put(self._next(), text)


OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_OUT = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in OUT.split(", "))])
WAYS = "array<struct<start:int,end:int,cost:long,audit:string>>"
NOTHING = hashlib.sha256(b"").hexdigest()


def marked(conversations: DataFrame) -> DataFrame:
    """Rows in order, parked, with their ``place`` and ``mark``, the first fault of each (0: none).

    Places are given to sorted rows, which are then written, as a second sort may cut elsewhere.
    """
    plain = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    return parked(plain.orderBy(*order).withColumn("place", F.monotonically_increasing_id()))


def faults(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``place``, first letter of the role and mark of each row, without texts."""
    said = F.rtrim("text", F.lit(SPACE))
    narrow = rows.select(
        "conv_id",
        "place",
        "role",
        F.sha2("text", 256).alias("said"),
        F.when(said == "", BLANK).when(~F.right(said, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(0).alias("mark"),
    )
    # Turns said more than once, parked, so that one said by a third of all rows is split in the join.
    same = ("conv_id", "role", "said")
    twice = narrow.groupBy(*same).agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    twice = parked(twice.select(*[F.col(c).alias(f"_{c}") for c in same], "first"))
    matched = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("said") == F.col("_said"))
    again = F.col("first").isNotNull() & (F.col("place") > F.col("first")) & (F.col("mark") != BLANK)
    mark = F.when(again, DUPLICATE).otherwise(F.col("mark"))
    return narrow.join(twice, matched, "left").select("conv_id", "place", F.substring("role", 1, 1).alias("letter"), mark.alias("mark"))


def block_ways(found: DataFrame) -> DataFrame:
    """``conv_id``, ``block``, counts of marks, and the ways through each block of up to 64 rows."""
    items = F.array_sort(F.collect_list(F.struct("place", "letter", "mark"))).alias("items")
    counts = [F.count(F.when(F.col("mark") == m, 1)).alias(n) for m, n in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (CUT, "truncated"))]
    blocks = found.groupBy("conv_id", F.shiftright("place", BLOCK_BITS).alias("block")).agg(items, *counts)

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
        for batch in parts:
            ways = [[dict(zip(("start", "end", "cost", "audit"), w)) for w in solved([(x["letter"], x["mark"]) for x in items])] for items in batch.column("items").to_pylist()]
            columns = [batch.column(c) for c in ("conv_id", "block", "blank", "duplicate", "truncated")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ways, kind)], ["conv_id", "block", "blank", "duplicate", "truncated", "ways"])

    return blocks.mapInArrow(run, f"conv_id long, block long, blank long, duplicate long, truncated long, ways {WAYS}")


def repaired(conversations: DataFrame) -> DataFrame:
    """One row for each conversation that has rows: its faults, the cheapest repair's cost and audit, and the digest of its turns."""
    rows = marked(conversations)
    ways = parked(block_ways(faults(rows)))
    nothing = F.lit(None)
    texts = rows.select("conv_id", F.lit(1).alias("kind"), F.col("place").alias("at"), "turn", "role", "text", *[nothing.cast("long").alias(c) for c in ("blank", "duplicate", "truncated")], nothing.cast(WAYS).alias("ways"))
    first = ways.select("conv_id", F.lit(0).alias("kind"), F.col("block").alias("at"), nothing.cast("long").alias("turn"), nothing.cast("string").alias("role"), nothing.cast("string").alias("text"), "blank", "duplicate", "truncated", "ways")
    ordered = first.union(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "at")

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Stream | None = None
        for batch in parts:
            done = []
            for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        done.append(now.result())
                    now = Stream(conv_id)
                now.add(*row)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=_OUT)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.result()], schema=_OUT)

    return ordered.mapInArrow(run, OUT)


class Stream:
    """A conversation's blocks, then its rows, as they come."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.blocks, self.counts = conv_id, [], [0, 0, 0]
        self.turns, self.least, self.most, self.turn = 0, None, None, None
        self.illegal, self.letter, self.repaired = 0, None, None

    def add(self, kind: int, at: int, turn: int | None, role: str | None, text: str | None, blank, duplicate, truncated, ways) -> None:
        if kind == 0:
            self.blocks.append([(w["start"], w["end"], w["cost"], w["audit"]) for w in ways])
            self.counts = [a + b for a, b in zip(self.counts, (blank, duplicate, truncated))]
            return
        if self.repaired is None:
            self.cost, audit = joined(self.blocks)
            self.blocks, self.repaired = [], Repaired(audit)
        if turn is not None:
            self.turns += turn != self.turn
            self.least = turn if self.least is None else self.least
            self.most = self.turn = turn
        if self.letter is not None and self.letter + role[:1] not in LEGAL:
            self.illegal += 1
        self.letter = role[:1]
        self.repaired.row(role, text)

    def result(self) -> dict:
        self.repaired.added()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        blank, duplicate, truncated = self.counts
        return {
            "conv_id": self.conv_id, "gaps": gaps, "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": self.illegal,
            "cost": self.cost, "audit": self.repaired.audit, "repaired_sha256": self.repaired.digest.hexdigest(),
        }


def report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """A row for every conversation of ``conversations``, repaired from ``rows``, what is there of it."""
    found = parked(repaired(rows)).withColumnRenamed("conv_id", "_conv")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    whole = every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return whole.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(NOTHING)).alias("repaired_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults made by a checksum of their place: dropped, emptied, cut short, repeated, or of another role."""
    key = [F.coalesce(F.col(c).cast("long").cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(F.concat_ws(":", *key)) % 20).alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")
