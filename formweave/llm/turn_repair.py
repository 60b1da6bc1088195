"""Repair of conversations: the cheapest edits that give legal turns, by a dynamic program with checkpoints.

The roles of a repaired conversation follow ``(s?(ua)+)?``, so four states tell what may come next: nothing yet, after
a system, a user or an assistant turn. The cost to go from each state, computed from the last row backwards, says which
edits are tight; a walk forward then takes, of the tight edits, the one that is least in ASCII.

Cost vectors of a whole conversation are never kept. Rows are sorted by conversation and turn over all tasks and cut
into blocks of about the square root of their number. A block is summarised by the cheapest cost from each of its
first states to each of its last states. One backward pass over the summaries leaves a cost vector at the end of each
block, the checkpoints; the walk forward recomputes the vectors of one block at a time. Conversations that one task
holds as one block need no second pass.

So a task holds one block, however long a conversation is. Only the walk itself, which hashes the repaired text from
its first byte to its last, is one task's work per conversation; it streams.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial
from math import isqrt
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.llm.blocks import materialise, ship, slices, small_side

DELETE, REROLE, INSERT, LATE = 4, 3, 3, 3
NEVER = 1 << 50
# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
MADE = (2, 2, 3, 2)
MADE_ROLE = ("user", "user", "assistant", "user")
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"
BLOCK_BYTES = 8 << 20
LEAST_BLOCK = 256
REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
ORDER = ("conv_id", "turn", "role", "key")


# ---- the dynamic program -----------------------------------------------------------------------------------


@dataclass(slots=True)
class Line:
    """Equal rows of one turn. Of the copies only the first may stay; all go if it is blank or was seen before."""

    turn: int | None
    role: str
    text: str
    copies: int
    seen: bool
    blank: bool = field(init=False)
    late: bool = field(init=False)

    def __post_init__(self):
        last = self.text.rstrip(SPACE)[-1:]
        self.blank, self.late = not last, last not in ".!?"

    @property
    def stays(self) -> bool:
        return self.copies > 0 and not self.blank and not self.seen

    @property
    def gone(self) -> int:
        return self.copies - self.stays


def with_inserts(v: list[int]) -> list[int]:
    """Costs when turns may also be inserted before what the costs are for."""
    two = min(v[2], INSERT + v[3])
    return [min(v[0], INSERT + two), min(v[1], INSERT + two), two, min(v[3], INSERT + v[2])]


LAST = with_inserts([0, NEVER, NEVER, 0])


def before(line: Line, after: list[int]) -> list[int]:
    """Costs to go before a line, from those after it."""
    rest = [min(NEVER, v + DELETE * line.gone) for v in after]
    if not line.stays:
        return rest
    late, initial = LATE * line.late, line.role[:1]
    costs = []
    for state in range(4):
        keep = KEPT.get((state, initial))
        costs.append(min(NEVER, DELETE + rest[state], REROLE + late + rest[MADE[state]],
                         NEVER if keep is None else late + rest[keep]))
    return with_inserts(costs)


def vectors(lines: list[Line], end: list[int]) -> list[list[int]]:
    """Costs to go before each line of a block, and after the last."""
    out = [end]
    for line in reversed(lines):
        out.append(before(line, out[-1]))
    return out[::-1]


def summary(lines: list[Line]) -> list[int]:
    """Cheapest cost of a block from each state to each state, row by row."""
    ends = [[0 if s == t else NEVER for s in range(4)] for t in range(4)]
    starts = []
    for v in ends:
        for line in reversed(lines):
            v = before(line, v)
        starts.append(v)
    return [starts[t][s] for s in range(4) for t in range(4)]


def through(matrix: list[int], after: list[int]) -> list[int]:
    return [min(NEVER, *(matrix[4 * s + t] + after[t] for t in range(4))) for s in range(4)]


class Walk:
    """Walks a conversation forward, block by block, and counts its faults on the way."""

    def __init__(self):
        self.state, self.cost, self.audit = 0, 0, bytearray()
        self.hash, self.turns = hashlib.sha256(), 0
        self.counts = dict.fromkeys(REPORT, 0)
        self.low = self.high = self.initial = None
        self.distinct = 0

    def block(self, lines: list[Line], end: list[int]) -> Iterator[tuple[str, str, str]]:
        """The edits of a block as (edit, role, text); deletions give the role and text they delete."""
        costs = vectors(lines, end)
        for i, line in enumerate(lines):
            if not line.copies:
                continue
            self._count(line)
            if line.stays:
                rest = [v + DELETE * line.gone for v in costs[i + 1]]
                yield from self._row(line, costs[i], rest)
            for _ in range(line.gone):
                yield self._edit("D", DELETE, line.role, line.text)

    def finish(self) -> Iterator[tuple[str, str, str]]:
        while LAST[self.state]:
            yield self._insert()

    def _row(self, line: Line, now: list[int], rest: list[int]) -> Iterator[tuple[str, str, str]]:
        late, initial = LATE * line.late, line.role[:1]
        while now[self.state] != DELETE + rest[self.state]:
            s = self.state
            if now[s] == INSERT + now[MADE[s]]:
                yield self._insert()
                continue
            keep = KEPT.get((s, initial))
            if keep is not None and now[s] == late + rest[keep]:
                self.state = keep
                yield self._edit("K", late, line.role, line.text)
            else:
                self.state = MADE[s]
                yield self._edit("R", REROLE + late, MADE_ROLE[s], line.text)
            return
        yield self._edit("D", DELETE, line.role, line.text)

    def _insert(self) -> tuple[str, str, str]:
        role, self.state = MADE_ROLE[self.state], MADE[self.state]
        return self._edit("I", INSERT, role, "")

    def _edit(self, edit: str, cost: int, role: str, text: str) -> tuple[str, str, str]:
        self.cost += cost
        self.audit += edit.encode()
        if edit != "D":
            self.hash.update(("\n" if self.turns else "").encode() + f"{role}:{text}".encode())
            self.turns += 1
        return edit, role, text

    def _count(self, line: Line) -> None:
        counts, n = self.counts, line.copies
        if line.blank:
            counts["blank"] += n
        else:
            counts["duplicate"] += n - 1 + line.seen
            counts["truncated"] += line.late and not line.seen
        initial = line.role[:1]
        counts["illegal"] += n - 1 if initial * 2 not in LEGAL else 0
        if self.initial is not None:
            counts["illegal"] += self.initial + initial not in LEGAL
        self.initial = initial
        if line.turn is not None and line.turn != self.high:
            self.low = line.turn if self.low is None else self.low
            self.high, self.distinct = line.turn, self.distinct + 1

    def report(self) -> dict[str, Any]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return self.counts | {"gaps": gaps, "cost": self.cost, "audit": self.audit.decode(),
                              "repaired_sha256": self.hash.hexdigest()}


# ---- tasks -------------------------------------------------------------------------------------------------


class Rows:
    """Gathers dicts and gives them as Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, **row: Any) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += 200 + len(row.get("text") or "") + len(row.get("audit") or "")
        if self.size > BLOCK_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, self.schema)
        self.rows, self.size = [], 0


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in slices(iter(batches), 256):
        yield from batch.to_pylist()


def _line(row: dict) -> Line:
    return Line(row["turn"], row["role"], row["text"], row["copies"], row["seen"])


def _told(walk: Walk, edits: Iterable[tuple[str, str, str]], conv: Any, out: Rows, turns: bool):
    """Let the walk run; with `turns`, its edits become rows."""
    for edit, role, text in edits:
        if turns:
            yield from out.add(kind=DONE, conv_id=conv, place=len(walk.audit) - 1, edit=edit, role=role, text=text)


LINE, SUMMARY, DONE = 0, 1, 2


def _first_pass(batches: Iterator[pa.RecordBatch], block: int, turns: bool, schema: pa.Schema):
    """Finish the conversations this task holds as one block; of others give lines and block summaries. The first and
    the last conversation of a task may go on in another task."""
    part, out = TaskContext.get().partitionId(), Rows(schema)
    conv, lines, size, blocks, inner = None, [], 0, 0, False
    started = False

    def cut():
        for place, line in enumerate(lines):
            yield from out.add(kind=LINE, conv_id=conv, part=part, block=blocks, place=place, turn=line.turn,
                               role=line.role, text=line.text, copies=line.copies, seen=line.seen)
        yield from out.add(kind=SUMMARY, conv_id=conv, part=part, block=blocks, matrix=summary(lines))

    def whole():
        walk = Walk()
        yield from _told(walk, walk.block(lines, LAST), conv, out, turns)
        yield from _told(walk, walk.finish(), conv, out, turns)
        if not turns:
            yield from out.add(kind=DONE, conv_id=conv, **walk.report())

    for row in _records(batches):
        if started and row["conv_id"] != conv:
            yield from whole() if inner and not blocks else cut()
            lines, size, blocks, inner = [], 0, 0, True
        elif len(lines) >= block or size >= BLOCK_BYTES:
            yield from cut()
            lines, size, blocks = [], 0, blocks + 1
        started, conv = True, row["conv_id"]
        lines.append(_line(row))
        size += len(row["text"])
    if started:
        yield from cut()
    yield from out.flush()


def _checkpoints(batches: Iterator[pa.RecordBatch], schema: pa.Schema):
    """Costs at the end of each block; summaries come sorted by conversation, last block first."""
    out, conv, started, costs = Rows(schema), None, False, LAST
    for row in _records(batches):
        if not started or row["conv_id"] != conv:
            started, conv, costs = True, row["conv_id"], LAST
        yield from out.add(kind=LINE, conv_id=conv, part=row["part"], block=row["block"], place=-1, matrix=costs)
        costs = through(row["matrix"], costs)
    yield from out.flush()


def _second_pass(batches: Iterator[pa.RecordBatch], turns: bool, schema: pa.Schema):
    """Walk conversations of several blocks; each block's checkpoint comes before its lines."""
    out, conv, walk, lines, end = Rows(schema), None, None, [], LAST

    def close():
        yield from _told(walk, walk.block(lines, end), conv, out, turns)

    def finish():
        yield from close()
        yield from _told(walk, walk.finish(), conv, out, turns)
        if not turns:
            yield from out.add(kind=DONE, conv_id=conv, **walk.report())

    for row in _records(batches):
        if row["place"] >= 0:
            lines.append(_line(row))
            continue
        if walk is None or row["conv_id"] != conv:
            if walk is not None:
                yield from finish()
            conv, walk = row["conv_id"], Walk()
        else:
            yield from close()
        lines, end = [], row["matrix"]
    if walk is not None:
        yield from finish()
    yield from out.flush()


# ---- the operator ------------------------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows as the contract damages them. A dropped row has no copies, but keeps its
    conversation known. Nulls read as one space, in the numbers' texts too; a null turn stays null for the order."""
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    lot = F.crc32(F.concat(spaced["conv_id"], F.lit(":"), spaced["turn"]).cast("binary")) % 20
    role = F.when(lot == 4, "user").otherwise(spaced["role"])
    text = F.when(lot == 1, "").when(lot == 2, F.regexp_replace(spaced["text"], "[.!?]", "")).otherwise(spaced["text"])
    copies = F.when(lot == 0, 0).when(lot == 3, 2).otherwise(1)
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                copies.cast("bigint").alias("copies"))


def _sorted_lines(rows: DataFrame) -> DataFrame:
    """Equal rows combined, marked if an earlier turn of their conversation has the same role and text, sorted over all
    tasks by conversation and turn; equal turns by role and digest of the text."""
    key = F.sha2(F.col("text").cast("binary"), 256)
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    lines = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    groups = rows.where("copies > 0").groupBy("conv_id", "role", key.alias("key")).agg(
        F.min(place).alias("first"), F.max(place).alias("last"))
    again = materialise(groups.where("first <> last").select(
        F.col("conv_id").alias("of"), F.col("role").alias("of_role"), F.col("key").alias("of_key"), "first"), "repeated")
    joined = lines.withColumn("key", key).join(small_side(again, 160), F.col("conv_id").eqNullSafe(F.col("of")) & (
        F.col("role") == F.col("of_role")) & (F.col("key") == F.col("of_key")), "left")
    seen = F.coalesce(place > F.col("first"), F.lit(False))
    marked = joined.select("conv_id", "turn", "role", "key", "text", "copies", seen.alias("seen"))
    return marked.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)


def _walked(rows: DataFrame, turns: bool, block: int | None) -> DataFrame:
    spark = rows.sparkSession
    ship(spark)
    rows = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text", "copies")
    kind = dict(rows.dtypes)["conv_id"]
    counts = "".join(f", {name} bigint" for name in REPORT)
    ddl = (f"kind int, conv_id {kind}, part int, block bigint, place bigint, turn bigint, role string, text string, "
           f"copies bigint, seen boolean, edit string, matrix array<bigint>{counts}, audit string, repaired_sha256 string")
    schema = _arrow(spark, ddl)
    block = block or max(LEAST_BLOCK, isqrt(rows.count()))
    first = materialise(_sorted_lines(rows).mapInArrow(
        partial(_first_pass, block=block, turns=turns, schema=schema), ddl), "walked")
    back = ["conv_id", F.desc("part"), F.desc("block")]
    checkpoints = first.where(f"kind = {SUMMARY}").repartition("conv_id").sortWithinPartitions(*back).mapInArrow(
        partial(_checkpoints, schema=schema), ddl)
    there = first.where(f"kind = {LINE}").unionByName(checkpoints)
    rest = there.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block", "place").mapInArrow(
        partial(_second_pass, turns=turns, schema=schema), ddl)
    return first.where(f"kind = {DONE}").unionByName(rest)


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def repair_report(rows: DataFrame, block: int | None = None) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` has conv_id, turn, role, text (neither role nor text null) and copies, how often the row stands there; 0
    only makes the conversation known. Rows of one turn are ordered by role, then by the SHA-256 of their text; repeated
    rows are copies. A null conv_id is one conversation, a null turn comes first and counts for no gap. Conversations
    without copies have zeros, no audit and the hash of the empty string; an empty table has no conversations. Texts are
    used whole; a task holds ``block`` rows, or fewer if they are long, and at least one.
    """
    return _walked(rows, False, block).select("conv_id", *REPORT, "audit", "repaired_sha256")


def repaired_turns(rows: DataFrame, block: int | None = None) -> DataFrame:
    """The edits themselves: conv_id, place (from 0), edit (K, R, D or I), role, text; D tells what was deleted. Rows
    and their order as for `repair_report`."""
    return _walked(rows, True, block).select("conv_id", "place", "edit", "role", "text")


def as_rows(conversations: DataFrame) -> DataFrame:
    """Rows of a table as they are, nulls in role and text read as one space."""
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(" ")).alias(name)

    return conversations.select("conv_id", "turn", spaced("role"), spaced("text"),
                                F.lit(1).cast("bigint").alias("copies"))
