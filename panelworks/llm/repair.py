"""Repair of conversations whose turns do not follow the role grammar.

A generalised LR parser (:mod:`grammar`) reads the rows of a conversation in order.  Each row may
be kept, get another role or be deleted, and turns may be inserted before it, at a cost each;
of the ways that lead to the same stack the one with the smallest (cost, audit) stays,
where the audit has one letter per edit.  At the end the cheapest accepted stack wins.

A conversation may hold any share of all rows, so it is cut into chunks of rows.  A chunk is
parsed from every stack it may begin with, which gives a small table (first stack, last stack,
cost, audit).  Tables are chained per conversation, as costs add and audits join, and the
chosen audits go back to the chunks, which write the repaired rows.  Audits over the same rows
are never a prefix of each other, so the order of joined audits follows that of their parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelworks.llm.common import map_batches, stage
from panelworks.llm.grammar import Automaton
from panelworks.operators.ranking import join_groups, number_rows
from panelworks.session import tidy

# Rows parsed in one piece.
CHUNK = 256
ROLES = {"s": "system", "u": "user", "a": "assistant"}
# Initials that may follow each other.
FOLLOWING = ("su", "ua", "au")
WORD_CHAR = r"[^\x20\x09-\x0D]"
FAULTS = ("blank", "duplicate", "truncated")


@dataclass(frozen=True)
class Costs:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3  # on top, for a truncated row that is not deleted


KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
# Roles that edits may give.
GIVEN = ("u", "a")

Best = dict[int, tuple[int, str]]  # stack -> (cost, audit)
_AUTOMATON = Automaton()


def _offer(best: Best, stack: int, cost: int, audit: str) -> bool:
    old = best.get(stack)
    if old is None or (cost, audit) < old:
        best[stack] = (cost, audit)
        return True
    return False


def with_inserts(best: Best, costs: Costs) -> Best:
    """What insertions reach from the stacks of ``best``, those included."""
    best, todo = dict(best), list(best)
    while todo:
        stack = todo.pop()
        cost, audit = best[stack]
        for symbol in GIVEN:
            onward = _AUTOMATON.moves[stack].get(symbol)
            if onward is not None and _offer(best, onward, cost + costs.insert, audit + INSERT):
                todo.append(onward)
    return best


def after_row(best: Best, initial: str, fault: str | None, costs: Costs) -> Best:
    """The stacks after one more row."""
    out: Best = {}
    extra = costs.truncated if fault == "truncated" else 0
    for stack, (cost, audit) in with_inserts(best, costs).items():
        _offer(out, stack, cost + costs.delete, audit + DELETE)
        if fault in ("blank", "duplicate"):
            continue
        moves = _AUTOMATON.moves[stack]
        if initial in moves:
            _offer(out, moves[initial], cost + extra, audit + KEEP)
        for symbol in GIVEN:
            if symbol in moves:
                _offer(out, moves[symbol], cost + extra + costs.rerole, audit + REROLE)
    return out


def marked_rows(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, pos and fault of each row, stored.

    Rows of a conversation are numbered from 1 in the order of turns, nulls first, then
    of role and text.  A null role or text is one space.  Of the faults blank, duplicate
    (role and text seen earlier in the conversation) and truncated the first counts.
    """
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    placed = stage(number_rows(rows, ["conv_id"], ["turn", "role", "text"], "pos"), "placed")
    same = ["conv_id", "role", "text"]
    firsts = placed.groupBy(*same).agg(F.min("pos").alias("first"), F.count("pos").alias("copies"))
    repeats = firsts.where("copies > 1").drop("copies")
    seen = F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
    blank = ~F.col("text").rlike(WORD_CHAR)
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(blank, "blank").when(seen, "duplicate").when(~ended, "truncated")
    return stage(
        join_groups(placed, repeats, same, "left")
        .withColumn("fault", fault)
        .drop("first"),
        "marked",
    )


def _chunk(chunk: int) -> Column:
    return F.floor((F.col("pos") - 1) / chunk).cast("bigint")


_TABLE = (
    "conv_id bigint, chunk bigint, first string, last string, illegal bigint, "
    "begin array<int>, end array<int>, cost array<bigint>, audit array<string>"
)


def _legal(before: str | None, initial: str) -> bool:
    return before is None or (before[:1] + initial) in FOLLOWING


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]):
    """(key, rows) of neighbouring rows with the same first two columns; one run in memory."""
    key, rows = None, []
    for x in batches:
        for row in zip(*(x.column(c).to_pylist() for c in columns), strict=True):
            if rows and row[:2] != key:
                yield key, rows
                rows = []
            key = row[:2]
            rows.append(row)
    if rows:
        yield key, rows


def _out(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "string": pa.string(),
        "array<int>": pa.list_(pa.int32()),
        "array<bigint>": pa.list_(pa.int64()),
        "array<string>": pa.list_(pa.string()),
    }
    named = [part.split() for part in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(named)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, named, strict=True)],
        names=[name for name, _ in named],
    )


def _batched(rows: Iterator[tuple], schema: str, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _out(held, schema)
            held = []
    if held:
        yield _out(held, schema)


def chunk_tables(marked: DataFrame, costs: Costs, chunk: int) -> DataFrame:
    """Per chunk of a conversation, the cheapest way between each two stacks."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv, number), rows in _runs(batches, ["conv_id", "chunk", "initial", "fault"]):
            table, illegal, before = [], 0, None
            for _, _, initial, _ in rows:
                illegal += not _legal(before, initial)
                before = initial or "-"
            begins = range(len(_AUTOMATON.moves)) if number else (0,)
            for begin in begins:
                best: Best = {begin: (0, "")}
                for _, _, initial, fault in rows:
                    best = after_row(best, initial, fault, costs)
                table += [(begin, end, c, a) for end, (c, a) in best.items()]
            lists = [list(x) for x in zip(*table, strict=True)]
            yield (conv, number, rows[0][2], rows[-1][2], illegal, *lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(parsed(batches), _TABLE, 256)

    rows = marked.select(
        "conv_id", _chunk(chunk).alias("chunk"), F.left("role", F.lit(1)).alias("initial"),
        "fault", "pos",
    ).repartition("conv_id", "chunk")
    ordered = rows.sortWithinPartitions("conv_id", "chunk", "pos").drop("pos")
    return map_batches(ordered, run, _TABLE)


_CHOICE = (
    "conv_id bigint, chunk bigint, begin int, audit string, last_chunk int, cost bigint, "
    "illegal bigint"
)


def chosen_audits(tables: DataFrame, costs: Costs) -> DataFrame:
    """Per chunk, the stack it begins with and its audit in the cheapest repair; cost and
    illegal, of the whole conversation, are on the last chunk.

    The tables of a conversation stream by in order.  Kept are, per chunk and last stack, the
    stack before and the letters, which is as much as the audit itself.
    """

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        columns = [part.split()[0] for part in _TABLE.split(", ")]
        conv, state, steps, illegal, last = None, None, [], 0, None

        def finish() -> Iterator[tuple]:
            # what is open ends with insertions, whose letters join the last chunk's
            best: dict = {}
            for stack, (cost, rank) in state.items():
                for end, (more, letters) in with_inserts({stack: (0, "")}, costs).items():
                    if _AUTOMATON.accepting[end]:
                        offer = (cost + more, rank, letters, stack)
                        best[0] = min(best.get(0, offer), offer)
            cost, _, letters, stack = best[0]
            chosen = []
            for number, table in reversed(steps):
                begin, audit = table[stack]
                chosen.append((number, begin, audit + letters))
                stack, letters = begin, ""
            for k, (number, begin, audit) in enumerate(reversed(chosen)):
                end = k == len(chosen) - 1
                yield (
                    conv, number, begin, audit, int(end), cost if end else None,
                    illegal if end else None,
                )

        for x in batches:
            for row in zip(*(x.column(c).to_pylist() for c in columns), strict=True):
                if state is None or row[0] != conv:
                    if state is not None:
                        yield from finish()
                    conv, state, steps, illegal, last = row[0], {0: (0, 0)}, [], 0, None
                illegal += row[4] + (last is not None and not _legal(last or "-", row[2]))
                last = row[3]
                ways: dict = {}
                for begin, end, cost, audit in zip(*row[5:], strict=True):
                    if begin in state:
                        before, rank = state[begin]
                        offer = (before + cost, rank, audit, begin)
                        if end not in ways or offer < ways[end]:
                            ways[end] = offer
                steps.append((row[1], {end: (w[3], w[2]) for end, w in ways.items()}))
                order = sorted(ways, key=lambda end: ways[end][1:3])
                state = {end: (ways[end][0], order.index(end)) for end in ways}
        if state is not None:
            yield from finish()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(chained(batches), _CHOICE)

    ordered = tables.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return map_batches(ordered, run, _CHOICE)


_REPAIRED = "conv_id bigint, pos bigint, part int, edit string, role string, text string"


def repaired_rows(marked: DataFrame, choices: DataFrame, chunk: int) -> DataFrame:
    """conv_id, pos, part, edit, role, text: the rows of all conversations after repair.

    Order is (pos, part); inserted turns come before the row whose pos they have, or, at the
    end, after the last.  Rows of edit D are those that were deleted.
    """

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        columns = ["conv_id", "chunk", "pos", "role", "text", "begin", "audit"]
        for (conv, _), rows in _runs(batches, columns):
            stack, letters, at = rows[0][5], rows[0][6], 0
            for _, _, pos, role, text, _, _ in rows:
                part = 0
                while letters[at] == INSERT:
                    symbol, stack = given(stack)
                    yield conv, pos, part, INSERT, ROLES[symbol], ""
                    at, part = at + 1, part + 1
                edit = letters[at]
                at += 1
                if edit == KEEP:
                    stack = _AUTOMATON.moves[stack][role[:1]]
                elif edit == REROLE:
                    symbol, stack = given(stack)
                    role = ROLES[symbol]
                yield conv, pos, part, edit, role, text
            for part, _ in enumerate(letters[at:], 1):
                symbol, stack = given(stack)
                yield conv, rows[-1][2], part + len(letters), INSERT, ROLES[symbol], ""

    def given(stack: int) -> tuple[str, int]:
        """The one role that an edit can give at a stack, and the stack it leads to."""
        ((symbol, onward),) = (
            (s, _AUTOMATON.moves[stack][s]) for s in GIVEN if s in _AUTOMATON.moves[stack]
        )
        return symbol, onward

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(applied(batches), _REPAIRED, 1024)

    rows = marked.select("conv_id", _chunk(chunk).alias("chunk"), "pos", "role", "text")
    joined = join_groups(
        rows, choices.select("conv_id", "chunk", "begin", "audit"), ["conv_id", "chunk"], "inner"
    )
    ordered = joined.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "pos")
    return map_batches(ordered, run, _REPAIRED)


@tidy
def repair(
    turns: DataFrame, costs: Costs | None = None, chunk: int = CHUNK
) -> tuple[DataFrame, DataFrame]:
    """(rows, conversations) for ``turns`` with conv_id, turn, role and text.

    rows are those of :func:`repaired_rows`.  conversations have conv_id, gaps (turn numbers
    missing between the first and the last), blank, duplicate, truncated, illegal (neighbours
    whose initials may not follow each other), cost and audit.  A null conv_id is a conversation.
    Rows that repeat everything are rows of their own, duplicates by their fault.
    """
    costs = costs or Costs()
    marked = marked_rows(turns)
    choices = stage(chosen_audits(chunk_tables(marked, costs, chunk), costs), "choices")
    counts = marked.groupBy("conv_id").agg(
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        *[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in FAULTS],
    )
    turns_held = (
        marked.select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.count("turn").alias("held"))
    )
    audits = choices.groupBy("conv_id").agg(
        F.max("cost").alias("cost"),
        F.max("illegal").alias("illegal"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]
            ),
            "",
        ).alias("audit"),
    )
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("held"), F.lit(0))
    conversations = reduce(
        lambda a, b: join_groups(a, b, ["conv_id"], "inner"), [counts, turns_held, audits]
    ).select("conv_id", gaps.alias("gaps"), *FAULTS, "illegal", "cost", "audit")
    return repaired_rows(marked, choices, chunk), conversations


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): digest of ``role:text`` of what stays, joined by newlines.

    A digest needs its text in order, so a conversation streams through one task; memory
    holds a batch and the digest.
    """
    schema = "conv_id bigint, repaired_sha256 string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        conv, digest, begun = None, None, False
        for x in batches:
            columns = (x.column(c).to_pylist() for c in ("conv_id", "edit", "role", "text"))
            for own, edit, role, text in zip(*columns, strict=True):
                if digest is None or own != conv:
                    if digest is not None:
                        yield conv, digest.hexdigest()
                    conv, digest, begun = own, hashlib.sha256(), False
                if edit != DELETE:
                    digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                    begun = True
        if digest is not None:
            yield conv, digest.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(read(batches), schema)

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "part")
    return map_batches(ordered.select("conv_id", "edit", "role", "text"), run, schema)
