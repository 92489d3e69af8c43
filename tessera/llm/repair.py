"""Repair of conversation structure by survivor-coalescence Viterbi search.

A conversation's role initials shall match ``(s?(ua)+)?``: an optional
system message and pairs of user and assistant.  Rows are kept (cost 0),
given the role user or assistant (1) or deleted (2; blank and duplicate rows
must be), and empty user or assistant rows are inserted (5); a truncated row
that stays costs 5 more.  The cheapest edits win, of equally cheap ones the
ASCII-least sequence of their initials (K, R, D, I).

Search
    The states are what the repaired rows end in: nothing, system, user,
    assistant.  One path survives for each state and row.  Paths are leaves
    of a backpointer tree whose nodes count their references (children and
    survivors); a node that nothing refers to any more goes, and so do its
    forefathers.
Emission
    As soon as the root has a single child and is no survivor itself, all
    survivors share that child: its edits are final, are put out, and the
    child becomes the root.  Memory holds the unresolved rows of one
    conversation, whatever its length.
Pruning
    From any state every continuation of another can be followed at an extra
    cost of at most ``BRIDGE``: a survivor dearer than the cheapest by more
    can end in no cheapest repair, is dropped, and holds nothing back.
Ties
    Survivors of a row are ranked by their complete unresolved sequences of
    initials.  Both sequences hold one letter for each row and end in one, so
    neither is a prefix of the other, and the order of two survivors decides
    the order of whatever is appended to them; their ranks carry the
    comparison of the whole suffixes from row to row.
Placement
    Rows are shuffled once, by conversation, and sorted; duplicates are
    found there by an exact window over role and text.  A conversation is
    read as a stream by one task (its digest is sequential); nothing of it is
    collected but the unresolved rows.

Defined results: NULL roles and texts are one space (a blank text; a role
with a strange initial); rows are ordered by turn (NULLs first), rows of the
same turn by role and text, repeated rows after one another; rows with a NULL
conversation id are one conversation; conversations without rows have one
edit row with a NULL edit; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import BATCH_BYTES

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Most that it costs to follow another state's continuation: instead of a
#: system message that only a start can keep, one deletion; a system message
#: that nothing follows needs two insertions where a start needs none.
BRIDGE = DELETE + 2 * INSERT
#: States: what the repaired rows end in.
START, SYSTEM, USER, ASSISTANT = range(4)
#: White space of a text.
SPACE = " \t\n\x0b\x0c\r"
#: Adjacent role initials that are in order.
LEGAL = {"su", "ua", "au"}
BATCH_ROWS = 4096


def turn_of(state: int) -> int:
    """The state after the only role that can be made up in ``state``."""
    return ASSISTANT if state == USER else USER


def moves(initial: str, delete: bool, truncated: bool) -> list[tuple[int, int, int, str]]:
    """The cheapest ways (state before, state after, cost, initials of the
    edits) to take one row; of equally cheap ones the ASCII-least."""
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for x in range(4):
        at, cost, letters = x, 0, ""
        for _ in range(3):  # a third insertion comes back to a state seen
            ways = [(at, DELETE, "D")]
            if not delete:
                more = TRUNCATED if truncated else 0
                ways.append((turn_of(at), REROLE + more, "R"))
                if initial == "s" and at == START:
                    ways.append((SYSTEM, KEEP + more, "K"))
                elif initial == ("a" if at == USER else "u"):
                    ways.append((turn_of(at), KEEP + more, "K"))
            for y, c, letter in ways:
                best = (cost + c, letters + letter)
                found[x, y] = min(found.get((x, y), best), best)
            at, cost, letters = turn_of(at), cost + INSERT, letters + "I"
    return [(x, y, c, s) for (x, y), (c, s) in found.items()]


#: Edits that end a conversation well from each state.
ENDS = {START: (0, ""), ASSISTANT: (0, ""), USER: (INSERT, "I"), SYSTEM: (2 * INSERT, "II")}


class Node:
    """Edits of one row in the backpointer tree."""

    __slots__ = ("parent", "children", "survivor", "state", "letters", "row")

    def __init__(self, parent: Node | None, state: int, letters: str, row):
        self.parent, self.state, self.letters, self.row = parent, state, letters, row
        self.children: list[Node] = []
        self.survivor = False

    @property
    def references(self) -> int:
        return len(self.children) + self.survivor


class Search:
    """One conversation: ``feed`` its rows ``(initial, must be deleted,
    truncated, row)`` in order, then ``finish``.  Both return the edits that
    have become final, ``(letter, role made up or None, row or None)``."""

    def __init__(self) -> None:
        self.root = Node(None, START, "", None)
        self.root.survivor = True
        # state -> (cost, rank among the survivors' sequences, node)
        self.survivors: dict[int, tuple[int, int, Node]] = {START: (0, 0, self.root)}
        self.table: dict[tuple, list] = {}
        self.cost = 0

    def feed(self, initial: str, delete: bool, truncated: bool, row) -> list[tuple]:
        kind = ("", True, False) if delete else (initial if initial in ("s", "u", "a") else "", False, truncated)
        ways = self.table.get(kind)
        if ways is None:
            ways = self.table[kind] = moves(*kind)
        best: dict[int, tuple[int, int, str, int]] = {}
        for x, y, c, letters in ways:
            old = self.survivors.get(x)
            if old is not None:
                way = (old[0] + c, old[1], letters, x)
                if y not in best or way < best[y]:
                    best[y] = way
        before = [node for _, _, node in self.survivors.values()]
        most = min(way[0] for way in best.values()) + BRIDGE
        best = {y: way for y, way in best.items() if way[0] <= most}
        order = sorted(best, key=lambda y: best[y][1:3])
        new = {}
        for rank, y in enumerate(order):
            cost, _, letters, x = best[y]
            parent = self.survivors[x][2]
            node = Node(parent, x, letters, row)
            node.survivor = True
            parent.children.append(node)
            new[y] = (cost, rank, node)
        self.survivors = new
        for node in before:
            node.survivor = False
            self._release(node)
        return self._coalesced()

    def _release(self, node: Node) -> None:
        """Drop a node without references, and forefathers that have lost
        their last one."""
        while node is not self.root and not node.references:
            parent = node.parent
            parent.children.remove(node)
            node = parent

    def _coalesced(self) -> list[tuple]:
        out: list[tuple] = []
        while len(self.root.children) == 1 and not self.root.survivor:
            self.root = self.root.children[0]
            self.root.parent = None
            out += self._edits(self.root.state, self.root.letters, self.root.row)
        return out

    @staticmethod
    def _edits(state: int, letters: str, row) -> list[tuple]:
        out = []
        for letter in letters:
            made = None
            if letter in "IR":
                state = turn_of(state)
                made = "assistant" if state == ASSISTANT else "user"
            out.append((letter, made, None if letter == "I" else row))
        return out

    def finish(self) -> list[tuple]:
        state = min(self.survivors, key=lambda x: (self.survivors[x][0] + ENDS[x][0], self.survivors[x][1]))
        cost, _, node = self.survivors[state]
        self.cost = cost + ENDS[state][0]
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        out: list[tuple] = []
        for node in reversed(path):
            out += self._edits(node.state, node.letters, node.row)
        return out + self._edits(state, ENDS[state][1], None)

    def unresolved(self) -> int:
        """Nodes below the root."""
        count, below = 0, list(self.root.children)
        while below:
            node = below.pop()
            count += 1
            below += node.children
        return count


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by ``crc32(conv_id:turn) mod 20``: 0 drops the row (it
    stays, marked ``dropped``, so that its conversation is not forgotten), 1
    empties the text, 2 removes its full stops, exclamation and question
    marks, 3 repeats the row, 4 sets the role user."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).cast("int").alias("h"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(
            F.col("text")).alias("text"),
        (F.col("h") == 0).alias("dropped"),
        F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    ).drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """Add each row's first fault: ``blank``, ``duplicate``, ``truncated`` or
    NULL.  Rows are shuffled here, by conversation, and sorted."""
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    place = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    same = Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(place[0])
    fault = (F.when(bare == "", "blank").when(F.col("nth") > 1, "duplicate")
             .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated"))
    dealt = rows.repartition("conv_id").withColumn("nth", F.row_number().over(same))
    return (dealt.select("conv_id", "turn", "role", "text", "dropped", fault.alias("fault"))
            .sortWithinPartitions("conv_id", "dropped", *place))


class Writer:
    """Rows gathered into batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.columns, self.size = schema, [[] for _ in schema], 0

    def add(self, row: tuple, size: int = 0) -> bool:
        for column, value in zip(self.columns, row):
            column.append(value)
        self.size += size
        return len(self.columns[0]) >= BATCH_ROWS or self.size >= BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.schema)]
        self.columns, self.size = [[] for _ in self.schema], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def _scripts(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted rows -> edit rows, conversation by conversation."""
    out = Writer(schema)
    nothing = object()
    current, search, step, seen = nothing, Search(), 0, False

    def put(edits: list[tuple]) -> Iterator[pa.RecordBatch]:
        nonlocal step
        for letter, made, row in edits:
            turn, role, text, fault = row or (None, None, "", None)
            new = None if letter == "D" else (made or role)
            text = None if letter == "D" else text
            if out.add((current, step, letter, turn, new, text, role, fault), len(text or "")):
                yield out.batch()
            step += 1

    def end() -> Iterator[pa.RecordBatch]:
        if current is nothing:
            return
        if seen:
            yield from put(search.finish())
        if not step:  # no rows, or none that was not dropped
            out.add((current, 0, None, None, None, None, None, None))

    for batch in batches:
        for conv, turn, role, text, dropped, fault in zip(*(c.to_pylist() for c in batch.columns)):
            if current is nothing or conv != current:
                yield from end()
                current, search, step, seen = conv, Search(), 0, False
            if dropped:
                continue
            seen = True
            yield from put(search.feed(role[:1], fault in ("blank", "duplicate"), fault == "truncated",
                                       (turn, role, text, fault)))
    yield from end()
    if out.columns[0]:
        yield out.batch()


def edits(rows: DataFrame) -> DataFrame:
    """The edit script of every conversation, in order: ``conv_id``,
    ``step`` (from 0), ``edit`` (K, R, D, I), ``turn``, ``role`` and ``text``
    as repaired (NULL where deleted), ``role_before`` and ``fault``.  Rows need
    ``conv_id``, ``turn``, ``role``, ``text`` and, optionally, ``dropped``.

    Every partition holds whole conversations, their rows in order."""
    if "dropped" not in rows.columns:
        rows = rows.withColumn("dropped", F.lit(False))
    space = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"),
                       F.coalesce(F.col("text").cast("string"), space).alias("text"), "dropped")
    schema = T.StructType([_named(rows, "conv_id"), T.StructField("step", T.LongType()), _text("edit"), _named(rows, "turn"),
                           *[_text(c) for c in ("role", "text", "role_before", "fault")]])
    arrow = to_arrow_schema(schema)
    return faults(rows).mapInArrow(lambda batches: _scripts(batches, arrow), schema)


def _named(df: DataFrame, name: str) -> T.StructField:
    return T.StructField(name, df.schema[name].dataType)


def _text(name: str) -> T.StructField:
    return T.StructField(name, T.StringType())


class Report:
    """What the edit rows of one conversation add up to."""

    def __init__(self) -> None:
        self.low = self.high = self.turn = None
        self.turns = self.illegal = self.cost = self.rows = 0
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.before = None
        self.audit = bytearray()
        self.digest = hashlib.sha256()

    def add(self, edit: str, turn, role: str | None, text: str | None, role_before: str | None, fault: str | None) -> None:
        self.audit += edit.encode()
        self.cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
        if edit != "I":
            if fault:
                self.faults[fault] += 1
                if fault == "truncated" and edit != "D":
                    self.cost += TRUNCATED
            if turn is not None and turn != self.turn:
                self.low = turn if self.low is None else self.low
                self.high = self.turn = turn
                self.turns += 1
            initial = role_before[:1]
            if self.before is not None and self.before + initial not in LEGAL:
                self.illegal += 1
            self.before = initial
        if edit != "D":
            self.digest.update((f"\n{role}:{text}" if self.rows else f"{role}:{text}").encode())
            self.rows += 1

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, self.faults["blank"], self.faults["duplicate"], self.faults["truncated"], self.illegal, self.cost,
                self.audit.decode(), self.digest.hexdigest())


def _reports(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out = Writer(schema)
    current = report = None
    for batch in batches:
        for conv, step, edit, *rest in zip(*(c.to_pylist() for c in batch.columns)):
            if step == 0:
                if report and out.add((current, *report.row()), len(report.audit)):
                    yield out.batch()
                current, report = conv, Report()
            if edit:
                report.add(edit, *rest)
    if report:
        out.add((current, *report.row()))
    if out.columns[0]:
        yield out.batch()


def report(script: DataFrame) -> DataFrame:
    """One row for each conversation of a script as ``edits`` returns it
    (whole conversations in order; nothing is shuffled again): ``gaps``,
    numbers of ``blank``, ``duplicate`` and ``truncated`` rows and of
    ``illegal`` neighbours before the repair, its ``cost`` and ``audit``
    (the edits' initials) and the digest of the repaired rows."""
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = T.StructType([_named(script, "conv_id"), *[T.StructField(c, T.LongType()) for c in counts], _text("audit"),
                           _text("repaired_sha256")])
    arrow = to_arrow_schema(schema)
    columns = ["conv_id", "step", "edit", "turn", "role", "text", "role_before", "fault"]
    return script.select(*columns).mapInArrow(lambda batches: _reports(batches, arrow), schema)
