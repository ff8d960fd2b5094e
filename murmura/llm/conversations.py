"""Cheapest repair of conversation structure: a Viterbi search whose survivors coalesce.

A repaired conversation's role initials read ``(s?(ua)+)?``. The search has four states, by what has been written:
nothing, the system turn, a user turn, an assistant turn. Each state keeps its best path: least cost, then the
least edit initials in ASCII order. Paths share a tree of backpointers with reference counts. When a row leaves
some states without a path, their branches are freed; what all survivors share is final and leaves as edits at once,
so memory holds only the stretch on which survivors differ (for a stretch that stays open to the end, all of it).
Ties are decided on the complete unresolved suffixes: their order among the survivors is kept as a rank, which a
new edit extends, so that a comparison costs the same however long the suffixes are. States that another one
beats for certain are dropped, or "delete everything" would survive in every conversation.

Spark shuffles the rows by conversation once, finds repeated rows with a window and sorts; a task streams through its
conversations and holds no more than the open stretch of one. A conversation with a third of all rows is one
stream: its cheapest edits, its audit cell and its hash each depend on every turn before. The sorts spill to disk.

Cases: a null conv_id, turn, role or text is one space where it is text (so no known role, and a blank text);
rows with a null conv_id are one conversation. Turns come in order, nulls first; rows of one turn are ordered by
role, then text, so equal rows are neighbours and all but the first are duplicates. A role, empty ones too, of other initials
than s, u and a is never kept. Turns may have gaps or repeat. Other columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

#: Costs of the edits, and of a truncated turn that is not deleted.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
_BLANKS = " \t\n\x0b\x0c\r"

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after writing a turn with that initial.
_NEXT = {
    (NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT,
}
#: Turns that an end in this state still needs.
_MISSING = {NOTHING: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}
#: (state, other, slack): a path in ``other`` that costs more than one in ``state`` and the slack can't win. The first
#: six insert their way to ``other``; after an assistant turn, all that may follow nothing or a system turn may
#: follow too, but for the system turn itself, which can be deleted.
_BEATS = [
    (NOTHING, USER, INSERT), (SYSTEM, USER, INSERT), (ASSISTANT, USER, INSERT), (USER, ASSISTANT, INSERT),
    (NOTHING, ASSISTANT, 2 * INSERT), (SYSTEM, ASSISTANT, 2 * INSERT), (ASSISTANT, NOTHING, DELETE), (ASSISTANT, SYSTEM, 0),
]


def _moves(initial: str, fault: str | None) -> list[list[tuple[int, int, str, tuple]]]:
    """For each state, what may become of a row: (next state, cost, edit initials, roles written).

    An insertion stands before a kept or renamed row at most once (two return to where they began). Before a deleted
    row it never stands: behind it, it costs the same and reads less. A role of None is the row's own.
    """
    out = []
    for state in range(4):
        found = [(state, DELETE, "D", ())]
        if fault not in ("blank", "duplicate"):
            extra = TRUNCATED if fault == "truncated" else 0
            new = "a" if state == USER else "u"
            for at, cost, edits, made in ((state, 0, "", ()), (_NEXT[state, new], INSERT, "I", (ROLES[new],))):
                if (at, initial) in _NEXT:
                    found.append((_NEXT[at, initial], cost + extra, edits + "K", (*made, None)))
                for role in ROLES:
                    if (at, role) in _NEXT:
                        found.append((_NEXT[at, role], cost + extra + RENAME, edits + "R", (*made, ROLES[role])))
        out.append(found)
    return out


_MOVES = {(i, f): _moves(i, f) for i in ("s", "u", "a", "") for f in (None, "blank", "duplicate", "truncated")}


class _Step:
    """A node of the backpointer tree; ``later`` counts its references from the tree, ``held`` that of a state."""

    __slots__ = ("before", "later", "held", "edits", "made", "row")

    def __init__(self, before, edits, made, row):
        self.before, self.edits, self.made, self.row = before, edits, made, row
        self.later, self.held = [], True

    def resolved(self) -> Iterator[tuple]:
        """Its edits: (initial, role written, row); inserted turns have no row, deleted ones keep theirs."""
        for edit, role in zip(self.edits, self.made or (None,)):
            yield edit, role, None if edit == "I" else self.row


class Repair:
    """One conversation, row by row. ``push`` and ``finish`` return the edits that have become final."""

    def __init__(self):
        self.root = _Step(None, "", (), None)
        self.alive = {NOTHING: (0, 0, self.root)}  # state: cost, rank of its suffix, last step
        self.cost, self.open = 0, 0

    def push(self, row: tuple, initial: str, fault: str | None) -> list[tuple]:
        moves = _MOVES[initial, fault]
        best: dict[int, tuple] = {}
        for state, (cost, rank, step) in self.alive.items():
            for target, more, edits, made in moves[state]:
                new = (cost + more, rank, edits)
                if target not in best or new < best[target][0]:
                    best[target] = (new, step, made)
        lost = [y for x, y, slack in _BEATS if x in best and y in best and best[y][0][0] > best[x][0][0] + slack]
        for state in lost:
            best.pop(state, None)
        heads = [step for _, _, step in self.alive.values()]
        self.alive = {}
        for rank, state in enumerate(sorted(best, key=lambda s: best[s][0][1:])):
            (cost, _, edits), before, made = best[state]
            step = _Step(before, edits, made, row)
            before.later.append(step)
            self.open += 1
            self.alive[state] = (cost, rank, step)
        for step in heads:
            step.held = False
            while not step.later and not step.held and step is not self.root:
                step.before.later.remove(step)
                self.open -= 1
                step = step.before
        return self._shared()

    def _shared(self) -> list[tuple]:
        out = []
        while len(self.root.later) == 1 and not self.root.held:
            self.root = self.root.later[0]
            self.root.before = None
            self.open -= 1
            out.extend(self.root.resolved())
        return out

    def finish(self) -> list[tuple]:
        state, (cost, _, step) = min(
            self.alive.items(), key=lambda x: (x[1][0] + INSERT * len(_MISSING[x[0]]), x[1][1])
        )
        path, missing = [], _MISSING[state]
        while step is not self.root:
            path.append(step)
            step = step.before
        self.cost = cost + INSERT * len(missing)
        out = [edit for step in reversed(path) for edit in step.resolved()]
        return out + [("I", ROLES[role], None) for role in missing]


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, present) with the faults that crc32(``conv_id:turn``) mod 20 names.

    0 drops the row (it stays as a mark of its conversation, not present), 1 empties the text, 2 removes
    its ``[.!?]``, 3 repeats the row, 4 makes it the user's.
    """
    space = F.lit(" ")
    kind = F.crc32(
        F.concat(
            F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
        ).cast("binary")
    ) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").when(kind != 0, role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).when(kind != 0, text).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def ordered(turns: DataFrame, mark: str | None = None) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with their first fault, sorted by conversation.

    ``mark`` names a column that is false for rows that only stand for their conversation.
    One shuffle, by conversation; the window finds its rows in place.
    """
    present = F.lit(True) if mark is None else F.col(mark)
    space = F.lit(" ")
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"), present.alias("present"),
    ).repartition("conv_id")
    same = Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    body = F.rtrim(F.col("text"), F.lit(_BLANKS))
    return (
        rows.withColumn("nth", F.row_number().over(same))
        .withColumn(
            "fault",
            F.when(body == "", "blank").when(F.col("nth") > 1, "duplicate")
            .when(~F.right(body, F.lit(1)).isin(".", "!", "?"), "truncated"),
        )
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "nth")
        .drop("nth")
    )


class _Counts:
    """What a conversation looked like before its repair."""

    def __init__(self):
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal, self.initial = 0, None
        self.first = self.last = None
        self.turns = 0

    def add(self, turn: int | None, initial: str, fault: str | None) -> None:
        if fault:
            self.faults[fault] += 1
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1

    @property
    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.turns


def _walk(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[tuple]:
    """(conv_id, final edits, None) as they come, then (conv_id, last edits, (counts, cost)) for each conversation."""
    conv, repair, counts = None, None, None
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            columns = [part.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "present")]
            for own, turn, role, text, fault, present in zip(*columns):
                if repair is None or own != conv:
                    if repair is not None:
                        yield conv, repair.finish(), (counts, repair.cost)
                    conv, repair, counts = own, Repair(), _Counts()
                if present:
                    initial = role[:1]
                    counts.add(turn, initial, fault)
                    edits = repair.push((turn, role, text, fault), initial if initial in "sua" else "", fault)
                    if edits:
                        yield conv, edits, None
    if repair is not None:
        yield conv, repair.finish(), (counts, repair.cost)


def _packed(tuples, schema: str, rows: int = 1000):
    """``tuples(batches)`` as Arrow batches of a DDL schema."""
    fields = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        found = tuples(batches)
        while part := list(islice(found, rows)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), fields)], schema=fields)

    return run


def repair(turns: DataFrame, mark: str | None = None) -> DataFrame:
    """Every edit in its conversation's order: conv_id, place, edit (K, R, D or I), turn, role, text, fault.

    Rows other than D are the repaired conversation; R and I carry the role written, I an empty text.
    """
    rows = ordered(turns, mark)
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        place = 0
        for conv, edits, end in _walk(batches):
            for edit, role, row in edits:
                turn, was, text, fault = row or (None, None, "", None)
                yield conv, place, edit, turn, role or was, text, fault
                place += 1
            if end:
                place = 0

    schema = f"conv_id {kind}, place long, edit string, turn long, role string, text string, fault string"
    return rows.mapInArrow(_packed(run, schema), schema)


def report(turns: DataFrame, mark: str | None = None) -> DataFrame:
    """One row per conversation: its gaps and faults, the cost and initials of its edits, a digest of the repaired turns."""
    rows = ordered(turns, mark)
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        audit, digest, empty = bytearray(), hashlib.sha256(), True
        for conv, edits, end in _walk(batches):
            for edit, role, row in edits:
                audit += edit.encode()
                if edit != "D":
                    text = f"{role or row[1]}:{row[2] if row else ''}"
                    digest.update((text if empty else "\n" + text).encode())
                    empty = False
            if end:
                counts, cost = end
                yield conv, counts.gaps, *counts.faults.values(), counts.illegal, cost, audit.decode(), digest.hexdigest()
                audit, digest, empty = bytearray(), hashlib.sha256(), True

    longs = ", ".join(f"{c} long" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    schema = f"conv_id {kind}, {longs}, audit string, repaired_sha256 string"
    return rows.mapInArrow(_packed(run, schema), schema)
