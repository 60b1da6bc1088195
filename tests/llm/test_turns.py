"""Conversation repair against a plain search for the cheapest edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from formweave.llm import turn_repair

LEGAL = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        role = "user" if lot == 4 else role
        out += [(conv, turn, role, text)] * (0 if lot == 0 else 2 if lot == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).hexdigest()))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        last = text.strip(" \t\n\v\f\r")[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """Least (cost, audit) over all edits, by search; a state is the place and the initials still of interest."""
    def ahead(initials):
        return any(LEGAL.fullmatch(initials + rest) for rest in ("", "ua", "a"))

    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, initials, turns = heapq.heappop(queue)
        tail = initials[-1:]
        if (at, tail) in done:
            continue
        # Costs order the queue, then audits: the first time a state is taken is the best way there.
        done.add((at, tail))
        if at == len(rows) and LEGAL.fullmatch(initials):
            return cost, audit, turns
        steps = [("I", 3, r, r + ":", at) for r in ("user", "assistant")]
        if at < len(rows):
            _, _, role, text = rows[at]
            late = 3 * (kinds[at] == "truncated")
            steps.append(("D", 4, None, None, at + 1))
            if kinds[at] not in ("blank", "duplicate"):
                steps.append(("K", late, role, f"{role}:{text}", at + 1))
                steps += [("R", 3 + late, r, f"{r}:{text}", at + 1) for r in ("user", "assistant")]
        for edit, price, role, line, then in steps:
            now = initials if role is None else initials + (role[:1] or "?")
            if role is None or ahead(now):
                heapq.heappush(queue, (cost + price, audit + edit, then, now, turns if role is None else (*turns, line)))


def report(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = in_order([r for r in damaged(rows) if r[0] == conv])
        kinds = faults(mine)
        cost, audit, turns = cheapest(mine, kinds)
        numbers = [r[1] for r in mine if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        out[conv] = (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                     hashlib.sha256("\n".join(turns).encode()).hexdigest())
    return out


def made(seed, conversations=60, longest=14):
    r, rows = random.Random(seed), []
    for conv in range(conversations):
        conv = None if conv == 7 else conv
        for _ in range(r.randint(1, longest)):
            turn = None if r.random() < 0.08 else r.randint(0, 12)
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "ünter"])
            text = r.choice(["Yes.", "No", "", None, "  ", "Well!\n", "So?\t ", "é", "a.b", "longer text here. " * 3])
            rows += [(conv, turn, role, text)] * r.choice([1, 1, 1, 1, 2, 3])
    return rows


def collected(frame):
    got = {r[0]: tuple(r)[1:] for r in frame.collect()}
    assert len(got) == frame.count()
    return got


@pytest.mark.parametrize("block", [1, 3, None])
def test_repair_against_search(spark, block):
    rows = made(block or 9)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert collected(turn_repair.repair_report(turn_repair.damage(frame), block)) == report(rows)


def test_one_conversation_in_many_tasks(spark):
    """A conversation over all tasks, in blocks of 16 rows, gives what one block gives."""
    r = random.Random(5)
    rows = [(1, i, r.choice(["user", "assistant", "user", "assistant", "system"]), r.choice(["Yes.", f"Row {i}", f"Row {i}.", ""]))
            for i in range(700)] + [(2, 0, "user", "Hi."), (0, 3, "assistant", "Ho.")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = collected(turn_repair.repair_report(turn_repair.damage(frame), 16))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == collected(turn_repair.repair_report(turn_repair.damage(frame.coalesce(1)), 100_000))
    assert got[1] == report(rows)[1]


def test_repaired_turns(spark):
    """The edits, in order, are the audit; what they leave is legal and is what the hash is of."""
    frame = turn_repair.damage(spark.createDataFrame(made(3), SCHEMA))
    edits = {}
    for r in sorted(turn_repair.repaired_turns(frame, 4).collect(), key=lambda r: r.place):
        edits.setdefault(r.conv_id, []).append(r)
    for conv, told in collected(turn_repair.repair_report(frame, 4)).items():
        mine = edits.get(conv, [])
        assert [r.place for r in mine] == list(range(len(mine)))
        assert "".join(r.edit for r in mine) == told[6]
        left = [r for r in mine if r.edit != "D"]
        assert LEGAL.fullmatch("".join(r.role[:1] for r in left))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in left).encode()).hexdigest() == told[7]


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert turn_repair.repair_report(turn_repair.damage(empty)).collect() == []
    long = [(1, 0, "user", "word " * 400_000 + "."), (1, 1, "assistant", "x" * 3_000_000), (1, 1, "assistant", "x" * 3_000_000)]
    for rows in (long, [(None, None, None, None)], [(5, 0, "s", None)] * 3):
        frame = spark.createDataFrame(rows, SCHEMA)
        for name in ("copies", "key", "kind", "part", "block", "place", "seen", "of", "first", "cost", "audit"):
            frame = frame.withColumn(name, F.lit("clash"))
        assert collected(turn_repair.repair_report(turn_repair.damage(frame))) == report(rows)
    # Every row dropped: the conversation stays, with zeros.
    gone = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = collected(turn_repair.repair_report(turn_repair.damage(spark.createDataFrame(gone, SCHEMA))))
    assert got and set(got.values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_rows_as_they_are(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, None, "Ho."), (1, 2, "assistant", None)]
    frame = turn_repair.as_rows(spark.createDataFrame(rows, SCHEMA))
    assert collected(turn_repair.repair_report(frame))[1][5:7] == (3 + 4, "KRD")
