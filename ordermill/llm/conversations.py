"""Conversation structure repair by a lightest-derivation agenda.

A conversation is repaired into ``(system? (user assistant)+)?``, told by the
roles' initials. Its rows in order are edited: (K)eep, (R)erole to user or
assistant, (D)elete, (I)nsert an empty turn. An item [i, state] says that the
first i rows can be turned into a beginning that leaves the grammar in that
state; every edit is a deduction from one item to the next whose weight adds
the edit's cost and appends its initial to the audit. Weights are ordered by
cost, then audit. They never fall along a deduction and keep their order (two
audits of one item and one cost never begin one another, since they differ in
inserts, which cost), so the agenda pops every item at its lightest weight, and
the first final item popped after the last row is the goal.

Conversations of up to ``max_rows`` rows are repaired one by one. Longer ones,
which may hold a third of all rows, are dealt out by ranges of their order and
cut into parts of ``max_rows`` rows. The agenda gives each part's lightest items
from every state to every state; a part is then one weighted deduction, and the
parts' deductions are chained in order. Both ways give the same result.

Rows are taken by turn (null turns first; rows of one turn by role, then text).
Repeated rows and null ids are rows like any other; a null role or text is one
space. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Iterable, Iterator
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ordermill.sources.shared import settle

SPACE = " \t\n\x0b\x0c\r"
MAX_ROWS = 4096

# The grammar's states: nothing yet, after system, after user, after assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = (EMPTY, SYSTEM, USER, ASSISTANT)
FINAL = (EMPTY, ASSISTANT)
MOVES = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER,
         (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The one role an inserted or reroled turn can have in each state.
NEXT_ROLE = ("user", "user", "assistant", "user")
LEGAL_PAIRS = ("su", "ua", "au")

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1


class Row(NamedTuple):
    """A row of a conversation, ``copies`` equal ones at once.

    ``fresh`` is whether no earlier row has its role and text.
    """

    turn: int | None
    role: str
    text: str
    fresh: bool
    copies: int = 1


class Edit(NamedTuple):
    """What the agenda needs to know of a row: its role's initial, whether it must
    be deleted, whether it is truncated, and how many deletions must follow it.
    """

    initial: str
    must_go: bool
    truncated: bool
    more: int


def fault(row: Row) -> str | None:
    """The row's first fault."""
    body = row.text.rstrip(SPACE)
    if not body:
        return "blank"
    if not row.fresh:
        return "duplicate"
    return None if body[-1] in ".!?" else "truncated"


def edit(row: Row) -> Edit:
    kind = fault(row)
    return Edit(row.role[:1], kind in ("blank", "duplicate"), kind == "truncated", row.copies - 1)


def lightest(
    rows: list[Edit], start: int, goals: Iterable[int], first_only: bool
) -> dict[int, tuple[int, str]]:
    """(cost, audit) of the lightest derivations from ``start`` to the goals after the last row.

    ``first_only`` ends with the first goal that is popped, the lightest of all.
    Deletions that must follow a row are taken with its edit: an insert is never
    better between them, as D sorts before I.
    """
    goals = set(goals)
    agenda = [(0, "", 0, start)]
    done: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str]] = {}
    while agenda and goals:
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in goals:
            found[state] = (cost, audit)
            if first_only:
                break
            goals.discard(state)
        turned = MOVES[state, NEXT_ROLE[state][0]]
        heapq.heappush(agenda, (cost + INSERT, audit + "I", i, turned))
        if i == len(rows):
            continue
        row = rows[i]
        tail = "D" * row.more
        late = row.truncated + DELETE * row.more
        heapq.heappush(
            agenda, (cost + DELETE * (row.more + 1), audit + "D" + tail, i + 1, state))
        if not row.must_go:
            heapq.heappush(agenda, (cost + REROLE + late, audit + "R" + tail, i + 1, turned))
            kept = MOVES.get((state, row.initial))
            if kept is not None:
                heapq.heappush(agenda, (cost + late, audit + "K" + tail, i + 1, kept))
    return found


def applied(rows: Iterable[Row], audit: str, state: int) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns an audit leaves of ``rows``, from a state on."""
    left = iter(rows)
    copies = 0
    row = None
    for letter in audit:
        if letter != "I":
            if not copies:
                row = next(left)
                copies = row.copies
            copies -= 1
        if letter == "D":
            continue
        role = row.role if letter == "K" else NEXT_ROLE[state]
        yield letter, role, "" if letter == "I" else row.text
        state = MOVES[state, role[:1]]


class Facts(NamedTuple):
    """Counts over consecutive rows, with what is needed to join those before and after."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    least: int | None = None
    most: int | None = None
    turns: int = 0

    def then(self, other: Facts) -> Facts:
        if self.first is None or other.first is None:
            return other if self.first is None else self
        border = self.last + other.first not in LEGAL_PAIRS
        shared = self.most is not None and self.most == other.least
        return Facts(
            *(a + b for a, b in zip(self[:3], other[:3])),
            self.illegal + other.illegal + border, self.first, other.last,
            other.least if self.least is None else self.least,
            self.most if other.most is None else other.most,
            self.turns + other.turns - shared)

    @property
    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.turns


def facts(row: Row) -> Facts:
    kind = fault(row)
    n = row.copies
    return Facts(
        n if kind == "blank" else 0,
        n if kind == "duplicate" else 0 if kind == "blank" else n - 1,
        1 if kind == "truncated" else 0,
        n - 1, row.role[:1], row.role[:1], row.turn, row.turn, 0 if row.turn is None else 1)


def all_facts(rows: Iterable[Row]) -> Facts:
    total = Facts()
    for row in rows:
        total = total.then(facts(row))
    return total


def shortened(audits: list[str]) -> list[str]:
    """Short texts that compare as the audits do, whatever is appended to both sides.

    Audits that begin with a smaller one keep what they have beyond it.
    """
    short: dict[str, str] = {}
    base, rank = None, 0
    for audit in sorted(set(audits)):
        if base is None or not audit.startswith(base):
            base, rank = audit, rank + 1
        short[audit] = chr(rank) + audit[len(base) :]
    return [short[a] for a in audits]


def chained(parts: Iterable[dict[tuple[int, int], tuple[int, str]]]) -> list[tuple[int, int]]:
    """The states before and after each part on the lightest way through all parts.

    ``parts`` give (cost, audit) from state to state. Only the parts' numbers and
    four short audits are held, not the conversation's audit.
    """
    front: dict[int, tuple[int, str]] = {EMPTY: (0, "")}
    back: list[dict[int, int]] = []
    for part in parts:
        best: dict[int, tuple[int, str, int]] = {}
        for (before, after), (cost, audit) in part.items():
            if before in front:
                so_far = front[before]
                way = (so_far[0] + cost, so_far[1] + audit, before)
                if after not in best or way < best[after]:
                    best[after] = way
        back.append({after: way[2] for after, way in best.items()})
        names = shortened([way[1] for way in best.values()])
        front = {after: (way[0], name) for (after, way), name in zip(best.items(), names)}
    state = min((front[s], s) for s in FINAL if s in front)[1]
    ways = []
    for step in reversed(back):
        ways.append((step[state], state))
        state = step[state]
    return ways[::-1]


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults by crc32 of ``conv_id:turn`` modulo 20, null as one space.

    0 drops a row, 1 empties its text, 2 removes its full stops, exclamation and
    question marks, 3 repeats it, 4 gives it to the user.
    """
    def text(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    key = F.concat(text("conv_id"), F.lit(":"), text("turn"))
    kind = F.crc32(key.cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")
    ).filter("kind > 0")
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _tuples(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


REPORT = ("conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string, repaired_sha256 string")
TURNS = "conv_id {id}, position long, edit string, role string, text string"

_Part = tuple[int, str, int, Facts, Iterable[Row]]


def _report(conv: object, parts: Iterable[_Part]) -> tuple:
    """One conversation's row of the report from (state, audit, cost, facts, rows) by part."""
    digest = hashlib.sha256()
    total, cost, audits, lead = Facts(), 0, [], b""
    for state, audit, price, found, rows in parts:
        total, cost = total.then(found), cost + price
        audits.append(audit)
        for _, role, text in applied(rows, audit, state):
            digest.update(lead + f"{role}:{text}".encode())
            lead = b"\n"
    return (conv, total.gaps, *total[:4], cost, "".join(audits), digest.hexdigest())


def _turns(conv: object, parts: Iterable[_Part]) -> Iterator[tuple]:
    """One conversation's repaired turns."""
    lines = (line for state, audit, _, _, rows in parts for line in applied(rows, audit, state))
    for position, line in enumerate(lines):
        yield (conv, position, *line)


def _written(
    found: Iterable[tuple[object, Iterable[_Part]]], turns: bool, kind: pa.DataType
) -> Iterator[pa.RecordBatch]:
    """Rows of the report, or the repaired turns, in batches of bounded size."""
    longs = [pa.int64()] * 6
    if turns:
        rows = (line for conv, parts in found for line in _turns(conv, parts))
        types = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
    else:
        rows = (_report(conv, parts) for conv, parts in found)
        types = [kind, *longs, pa.string(), pa.string()]
    names = [f.split()[0] for f in (TURNS if turns else REPORT).split(", ")]
    buffer, size = [], 0

    def flushed() -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array(c, t) for c, t in zip(zip(*buffer), types)], names=names)

    for row in rows:
        buffer.append(row)
        size += 64 + len(row[-1]) + len(row[-2])
        if size > 4 << 20:
            yield flushed()
            buffer, size = [], 0
    if buffer:
        yield flushed()


def _short(rows: DataFrame, turns: bool) -> DataFrame:
    """Conversations that fit one task's memory, each by the agenda alone."""
    kind = _arrow_type(rows)

    def conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, list[_Part]]]:
        for conv, group in itertools.groupby(_tuples(batches), key=itemgetter(0)):
            seen: set[tuple[str, str]] = set()
            found = []
            for _, mark, turn, role, text in group:
                if not mark:
                    found.append(Row(turn, role, text, (role, text) not in seen))
                    seen.add((role, text))
            goal = lightest([edit(r) for r in found], EMPTY, FINAL, True)
            cost, audit = next(iter(goal.values()))
            yield conv, [(EMPTY, audit, cost, all_facts(found), found)]

    ordered = rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.desc("mark"), "turn", "role", "text")
    schema = (TURNS if turns else REPORT).format(id=dict(rows.dtypes)["conv_id"])
    return ordered.mapInArrow(lambda b: _written(conversations(b), turns, kind), schema)


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["conv_id"].dataType)


_WEIGHT = "struct<before:long,after:long,cost:long,audit:string>"
_FACTS = ("struct<blank:long,duplicate:long,truncated:long,illegal:long,first:string,last:string,"
          "least:long,most:long,turns:long>")


def _long(rows: DataFrame, turns: bool, max_rows: int) -> DataFrame:
    """Conversations of any length, by parts of at most ``max_rows`` different rows.

    Equal rows are counted before anything else, and parts come from ranges of
    the rows' order, so neither a turn nor a text of many rows meets in one task.
    The last step passes a conversation's repaired text through one hash, in
    order and in a stream: a digest of it cannot be taken in any other way.
    """
    kind, name = _arrow_type(rows), dict(rows.dtypes)["conv_id"]
    counted = rows.filter("NOT mark").groupBy("conv_id", "turn", "role", "text").agg(
        F.count(F.lit(1)).alias("copies"))
    digest = F.unhex(F.sha2(F.concat("role", F.lit(":"), "text"), 256))
    order = ["conv_id", "turn", "role", "digest"]
    ranged = counted.withColumn("digest", digest).repartitionByRange(*order).sortWithinPartitions(
        "conv_id", "turn", "role", "text")
    key = ["conv_id", "block", "part"]
    fields = [*key, "at", "turn", "role", "text", "fresh", "copies"]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        conv, at, seen = object(), 0, set()
        for batch in batches:
            ats, fresh = [], []
            for now, mark in zip(
                batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist()
            ):
                if now != conv:
                    conv, at, seen = now, 0, set()
                ats.append(at)
                fresh.append(mark not in seen)
                seen.add(mark)
                at += 1
            yield pa.record_batch(
                [*batch.columns, pa.array([block] * len(ats), pa.int32()),
                 pa.array([a // max_rows for a in ats], pa.int32()), pa.array(ats, pa.int64()),
                 pa.array(fresh)],
                names=[*batch.schema.names, "block", "part", "at", "fresh"])

    listed = settle(
        ranged.mapInArrow(
            numbered,
            f"conv_id {name}, turn long, role string, text string, copies long, digest binary, "
            "block int, part int, at long, fresh boolean"),
        "conversation-rows")
    # Each block has a role and text once among its fresh rows: a key meets at most once a block.
    earliest = F.min("block").over(Window.partitionBy("conv_id", "digest"))
    fresh = listed.filter("fresh").withColumn("fresh", F.col("block") == earliest)
    rows = settle(
        fresh.unionByName(listed.filter("NOT fresh")).drop("digest"), "conversation-fresh")

    def read(group: Iterable[tuple]) -> list[Row]:
        return [Row(*row[len(key) + 1 : len(fields)]) for row in group]

    def derived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for where, group in itertools.groupby(_tuples(batches), key=itemgetter(0, 1, 2)):
            found = read(group)
            edits = [edit(r) for r in found]
            ways = [
                {"before": before, "after": after, "cost": cost, "audit": audit}
                for before in STATES
                for after, (cost, audit) in lightest(edits, before, STATES, False).items()
            ]
            yield pa.record_batch(
                [pa.array([where[0]], kind), pa.array([where[1]], pa.int32()),
                 pa.array([where[2]], pa.int32()), pa.array([ways], pa.list_(pa.struct(way_types))),
                 pa.array([all_facts(found)._asdict()], pa.struct(fact_types))],
                names=[*key, "ways", "facts"])

    way_types = [("before", pa.int64()), ("after", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]
    fact_types = [(n, pa.string() if n in ("first", "last") else pa.int64()) for n in Facts._fields]
    parts = settle(
        rows.select(*fields).repartition(*key).sortWithinPartitions(*key, "at").mapInArrow(
            derived,
            f"conv_id {name}, block int, part int, ways array<{_WEIGHT}>, facts {_FACTS}"),
        "conversation-parts")

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, group in itertools.groupby(_tuples(batches), key=itemgetter(0)):
            places: list[tuple[int, int]] = []

            def weights() -> Iterator[dict[tuple[int, int], tuple[int, str]]]:
                for _, block, part, ways in group:
                    places.append((block, part))
                    yield {(w["before"], w["after"]): (w["cost"], w["audit"]) for w in ways}

            ways = chained(weights())
            columns = [list(c) for c in zip(*places)] + [list(c) for c in zip(*ways)]
            yield pa.record_batch(
                [pa.array([conv] * len(ways), kind), *(pa.array(c, pa.int32()) for c in columns)],
                names=[*key, "before", "after"])

    ways = parts.select(*key, "ways").repartition("conv_id").sortWithinPartitions(*key).mapInArrow(
        chosen, f"conv_id {name}, block int, part int, before int, after int")
    same = F.col("p.conv_id").eqNullSafe(F.col("w.conv_id")) & F.expr(
        "p.block = w.block AND p.part = w.part")
    taken = parts.alias("p").join(settle(ways, "conversation-ways").alias("w"), same).select(
        *[F.col(f"p.{c}") for c in key],
        F.expr("struct(w.before AS state, "
               "filter(ways, x -> x.before = w.before AND x.after = w.after)[0] AS way, facts) AS plan"))
    stream = taken.withColumn("at", F.lit(-1).cast("long")).unionByName(
        rows.select(*fields), allowMissingColumns=True)

    def conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[_Part]]]:
        for conv, group in itertools.groupby(_tuples(batches), key=itemgetter(0)):
            yield conv, planned(group)

    def planned(group: Iterable[tuple]) -> Iterator[_Part]:
        for _, part in itertools.groupby(group, key=itemgetter(1, 2)):
            plan = next(part)[-1]
            way = plan["way"]
            yield plan["state"], way["audit"], way["cost"], Facts(**plan["facts"]), read(part)

    ordered = stream.select(*fields, "plan").repartition("conv_id").sortWithinPartitions(*key, "at")
    schema = (TURNS if turns else REPORT).format(id=name)

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _written(conversations(batches), turns, kind)

    return ordered.mapInArrow(plain, schema)


def repair(
    rows: DataFrame,
    ids: DataFrame | None = None,
    turns: bool = False,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """One row per conversation: its faults, the cost and audit of its cheapest repair.

    ``conv_id``; ``gaps`` in the turn numbers; rows by first fault (``blank``,
    ``duplicate``, ``truncated``); ``illegal`` neighbours; ``cost``; ``audit``, the
    edits' initials in order; ``repaired_sha256`` of the repaired ``role:text``
    lines. With ``turns`` the repaired conversations instead: conv_id, position,
    edit, role, text. ``ids`` names conversations to report even without rows:
    zeros, an empty audit, the hash of no text. An empty table gives no rows.

    Runs jobs: rows are counted by conversation, ids of those over ``max_rows``
    are written to the shared folder.
    """
    def text(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    rows = rows.select(
        "conv_id", F.lit(False).alias("mark"), F.col("turn").cast("long").alias("turn"),
        text("role").alias("role"), text("text").alias("text"))
    counts = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    large = settle(counts.filter(F.col("n") > max_rows).select("conv_id"), "long-conversations")
    named = (ids if ids is not None else rows).select("conv_id").distinct().select(
        "conv_id", F.lit(True).alias("mark"), F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"), F.lit("").alias("text"))
    rows = rows.unionByName(named) if ids is not None else rows
    if large.isEmpty():
        return _short(rows, turns)
    is_large = rows["conv_id"].eqNullSafe(large["conv_id"])
    return _short(rows.join(large, is_large, "left_anti"), turns).unionByName(
        _long(rows.join(large, is_large, "left_semi"), turns, max_rows))
