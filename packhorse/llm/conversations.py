"""Operator 11: conversation structure repair by dynamic programming over sorted streams.

Rows are dealt by conversation and sorted by turn, and Python reads them in
Arrow batches with a state that does not grow: first from the last turn to the
first, where the state is the cheapest cost of repairing what comes after, for
each of the four states a conversation can be in. What to do with a row in each
state, its back pointers, takes one byte, which travels with the row; Spark's
sorter brings the rows back into the order of turns and spills them, pointers
and all, where a conversation is giant. Then the pointers are followed from the
first turn on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packhorse.llm.common import by_small_batches, give_back, table

# White space, sentence ends, edits in ASCII order with their costs.
WHITE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
EDITS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
COSTS = (4, 3, 0, 3)
TRUNCATED = 3
# States by what stands last: nothing, system, user, assistant. A conversation may end in ENDINGS.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
# The role that may come next, other than a first system row.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: b"user", ASSISTANT: b"assistant"}
# The cost after the last row: nothing to add, or the missing rows to insert.
AT_END = (0, 2 * COSTS[INSERT], COSTS[INSERT], 0)
LEGAL = {"su", "ua", "au"}
FAULTS = ("", "blank", "duplicate", "truncated")


def _kept(state: int, initial: int) -> int | None:
    """The state after a row with this initial is kept, if it may be."""
    if initial == SYSTEM:
        return SYSTEM if state == START else None
    return initial if initial == NEXT[state] else None


def step_back(after: tuple[int, ...], initial: int, fault: int) -> tuple[tuple[int, ...], int]:
    """One row earlier: the cost from each state on, less the least of them, and the row's back pointers.

    `after` holds the same costs behind the row. Costs are relative, so they
    take few values, and callers may look them up. Two bits of the pointers name
    the first edit of each state, the ASCII-least of the cheapest.
    """
    extra = TRUNCATED if FAULTS[fault] == "truncated" else 0
    choices: list[dict[int, int]] = []
    for state in range(4):
        found = {DELETE: COSTS[DELETE] + after[state]}
        if FAULTS[fault] not in ("blank", "duplicate"):
            found[REROLE] = COSTS[REROLE] + extra + after[NEXT[state]]
            to = _kept(state, initial)
            if to is not None:
                found[KEEP] = COSTS[KEEP] + extra + after[to]
        choices.append(found)
    costs = [min(found.values()) for found in choices]
    for _ in range(4):
        # Inserted rows lead from state to state in front of the row.
        costs = [min(costs[state], COSTS[INSERT] + costs[NEXT[state]]) for state in range(4)]
    pointers = 0
    for state, found in enumerate(choices):
        found[INSERT] = COSTS[INSERT] + costs[NEXT[state]]
        pointers |= min(edit for edit, cost in found.items() if cost == costs[state]) << 2 * state
    least = min(costs)
    return tuple(cost - least for cost in costs), pointers


def _with_pointers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds `pointers` to rows that come from each conversation's last to its first."""
    of, after = object(), AT_END
    known: dict[tuple, tuple[tuple[int, ...], int]] = {}
    for batch in batches:
        found = []
        columns = [batch.column(name).to_pylist() for name in ("name", "initial", "fault", "lost")]
        for name, initial, fault, lost in zip(*columns, strict=True):
            if name != of:
                of, after = name, AT_END
            pointers = 0
            if not lost:
                step = after, 1 + INITIALS.find(initial) if initial else 0, fault
                if step not in known:
                    known[step] = step_back(*step)
                after, pointers = known[step]
            found.append(pointers)
        names = [*batch.schema.names, "pointers"]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], names=names)


@dataclass
class _Walk:
    """One conversation, read from its first row on."""

    name: str | None
    state: int = START
    cost: int = 0
    faults: list[int] = field(default_factory=lambda: [0] * len(FAULTS))
    illegal: int = 0
    before: str | None = None
    first: int | None = None
    last: int | None = None
    turns: int = 0

    def see(self, initial: str, fault: int, turn: int | None) -> None:
        self.faults[fault] += 1
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1

    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.turns

    def _insert(self) -> tuple[str, bytes]:
        self.state = NEXT[self.state]
        self.cost += COSTS[INSERT]
        return EDITS[INSERT], NAMES[self.state]

    def edits(self, initial: str, fault: int, pointers: int, role: bytes) -> Iterator[tuple[str, bytes]]:
        """The edits that lead over one row, with the role each results in; the last is the row's own."""
        while (edit := pointers >> 2 * self.state & 3) == INSERT:
            yield self._insert()
        self.cost += COSTS[edit]
        if edit != DELETE:
            self.cost += TRUNCATED if FAULTS[fault] == "truncated" else 0
            if edit == REROLE:
                self.state = NEXT[self.state]
                role = NAMES[self.state]
            else:
                self.state = 1 + INITIALS.find(initial)
        yield EDITS[edit], role

    def end(self) -> Iterator[tuple[str, bytes]]:
        while AT_END[self.state]:
            yield self._insert()


_ROWS = ("name", "initial", "fault", "lost", "turn", "pointers", "role", "text")


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*[batch.column(name).to_pylist() for name in _ROWS], strict=True)


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One report per conversation; of a conversation only its audit grows with it."""
    walk, audit, digest = None, bytearray(), None

    def add(edits: Iterator[tuple[str, bytes]], text: bytes) -> None:
        for edit, role in edits:
            audit.extend(edit.encode())
            if edit != EDITS[DELETE]:
                if digest[1]:
                    digest[0].update(b"\n")
                digest[0].update(role + b":")
                digest[0].update(b"" if edit == EDITS[INSERT] else text)
                digest[1] = True

    def report() -> tuple:
        add(walk.end(), b"")
        _, blank, duplicate, truncated = walk.faults
        return (
            walk.name, walk.gaps(), blank, duplicate, truncated, walk.illegal, walk.cost,
            audit.decode(), digest[0].hexdigest(),
        )

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(_REPORT.names, row, strict=True)) for row in found], _REPORT)

    for batch in batches:
        found = []
        for name, initial, fault, lost, turn, pointers, role, text in _rows(batch):
            if walk is None or name != walk.name:
                if walk is not None:
                    found.append(report())
                walk, audit, digest = _Walk(name), bytearray(), [hashlib.sha256(), False]
            if not lost:
                walk.see(initial, fault, turn)
                add(walk.edits(initial, fault, pointers, role), text)
        yield batch_of(found)
    if walk is not None:
        yield batch_of([report()])
    give_back()


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per edit, in order."""
    walk, place = None, 0
    schema = _EDITED

    for batch in batches:
        found = []

        def add(edits: Iterator[tuple[str, bytes]], fault: int, turn: int | None, text: bytes, found: list = found) -> None:
            nonlocal place
            for edit, role in edits:
                own = edit != EDITS[INSERT]
                row = (walk.name, place, edit, turn if own else None, role, text if own else b"", FAULTS[fault] if own else "")
                found.append(dict(zip(schema.names, row, strict=True)))
                place += 1

        for name, initial, fault, lost, turn, pointers, role, text in _rows(batch):
            if walk is None or name != walk.name:
                if walk is not None:
                    add(walk.end(), 0, None, b"")
                walk, place = _Walk(name), 0
            if not lost:
                add(walk.edits(initial, fault, pointers, role), fault, turn, text)
        yield pa.RecordBatch.from_pylist(found, schema)
    if walk is not None:
        found = []
        add(walk.end(), 0, None, b"", found)
        yield pa.RecordBatch.from_pylist(found, schema)
    give_back()


_REPORT = pa.schema(
    [("name", pa.string())]
    + [(name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)
_EDITED = pa.schema([
    ("name", pa.string()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
    ("role", pa.binary()), ("text", pa.binary()), ("fault", pa.string()),
])


def _ended(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITE))


def _walked(
    df: DataFrame, conv: str, turn: str, role: str, text: str, lost: str | None,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str,
) -> DataFrame:
    """`work` on the rows of each conversation in order, with faults and back pointers.

    One shuffle, by conversation: the sorts and the search for duplicates happen
    within its partitions.
    """
    gone = F.lit(False) if lost is None else F.col(lost)
    space = F.lit(" ")
    rows = by_small_batches(df).select(
        F.col(conv).cast("string").alias("name"), F.col(turn).cast("long").alias("turn"),
        F.when(~gone, F.coalesce(F.col(role).cast("string"), space)).alias("role"),
        F.when(~gone, F.coalesce(F.col(text).cast("string"), space)).alias("text"), gone.alias("lost"),
    ).repartition("name")
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    alike = Window.partitionBy("name", "role", "text").orderBy(F.asc_nulls_first("turn"))
    ended = _ended(F.col("text"))
    fault = (
        F.when(F.col("lost"), 0).when(ended == "", FAULTS.index("blank"))
        .when(F.col("copy") > 1, FAULTS.index("duplicate"))
        .when(~F.right(ended, F.lit(1)).isin(*ENDS), FAULTS.index("truncated")).otherwise(0)
    )
    judged = rows.withColumn("copy", F.row_number().over(alike)).select(
        "name", "turn", "role", "text", "copy", "lost", fault.alias("fault"), F.substring("role", 1, 1).alias("initial")
    )
    backwards = [F.desc_nulls_last("turn"), F.desc("role"), F.desc("text"), F.desc("copy")]
    told = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in judged.schema.fields)
    pointed = judged.sortWithinPartitions("name", *backwards).mapInArrow(_with_pointers, f"{told}, pointers int")
    forwards = pointed.sortWithinPartitions("name", *order, "copy").select(
        "name", "initial", "fault", "lost", "turn", "pointers",
        F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"),
    )
    kind = df.schema[conv].dataType
    return forwards.mapInArrow(work, schema).withColumn("name", F.col("name").cast(kind))


def audits(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", lost: str | None = None
) -> DataFrame:
    """One row per conversation: gaps, faults, the cheapest repair's cost and edits, and a digest of what it gives.

    Rows are taken by turn, nulls first; rows of one turn by role and text. Null
    roles and texts are one space. Of repeated rows the first counts, the
    others are duplicates. A row whose role does not begin with s, u or a, as an
    empty one, can not be kept as it is. Rows with a null conversation are a
    conversation; one all of whose rows are `lost` has zeros and an empty audit.
    Other columns are left aside, whatever their names; an empty table gives
    an empty one. Long texts are hashed as they pass.
    """
    schema = (
        "name string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, repaired_sha256 string"
    )
    return _walked(df, conv, turn, role, text, lost, _told, schema).withColumnRenamed("name", conv)


def repair(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", lost: str | None = None
) -> DataFrame:
    """The cheapest edits of each conversation as rows, as `audits` counts them.

    `place` is the order within the conversation; `edit` is D for a row that
    goes, K for one that stays, R for one with another role and I for an empty
    one that is inserted, without a turn. All but those marked D make up the
    repaired conversation.
    """
    schema = "name string, place long, edit string, turn long, role binary, text binary, fault string"
    rows = _walked(df, conv, turn, role, text, lost, _repaired, schema)
    return rows.select(
        F.col("name").alias(conv), "place", "edit", F.col("turn").alias(turn),
        F.col("role").cast("string").alias(role), F.col("text").cast("string").alias(text), "fault",
    )


def damaged(df: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with the contract's damage; a row that it drops stays as `lost`."""
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    once, twice = F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))
    return df.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        (kind == 0).alias("lost"),
        F.explode(F.when(kind == 3, twice).otherwise(once)).alias("_copy"),
    ).drop("_copy")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits(damaged(table(spark, sf_dir, "conversations")), lost="lost")


# The cheapest edits are a path of minimal cost whose own order counts; SQL has no such fold.
QUERIES = {"op11_conversations": op11_conversations}
ORACLES: dict[str, str] = {}
