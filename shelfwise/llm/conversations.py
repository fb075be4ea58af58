"""Conversation repair: cheapest edits that give legal turns, by Four-Russians block tables.

Every row of a conversation is one of a few symbols. A vector holds, for each state of the role
grammar, what the rows from some place on cost at least; less its smallest entry, only few vectors
exist. For every vector and every block of ``BLOCK`` symbols a table has the vector before the
block and what the block adds. A conversation is worked through from its end, a block per lookup.
Then its blocks are expanded again, each from the vector after it, and the edits are read off from
the front: the least letter that keeps to the cheapest cost is the right one among ties.

Conversations are sorted and cut by ranges. One that lies inside a range and is short is repaired
where it is. Those at a range's edges, and long ones, go on as rows in chunks: the vector after each
chunk is found in one pass from the back, and the edits in one from the front; neither holds more
than a chunk. That second pass is one task for a conversation, however long it is, as the digest of
its whole text is one.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.common import unlike
from shelfwise.session import staged

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLOCK = 4
SPACE = " \t\n\x0b\x0c\r"
STOPS = ".!?"

# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
# The state after a kept turn of the initial, where it is legal.
KEPT = {
    (NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
# The state after a turn made to fit, and its role.
FITTED = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
# What is left to pay at the end: an assistant turn after a user's, both after the system's.
AT_END = (0, 2 * INSERT, INSERT, 0)

# Symbols: none, a row that must go, and a row of each initial (others last), whole or truncated.
NO_ROW, GONE, FIRST_KEPT = 0, 1, 2
SYMBOLS = FIRST_KEPT + 2 * (len(INITIALS) + 1)

# A conversation of more than this is handed on in chunks of this size.
CHUNK_ROWS = 1024
CHUNK_BYTES = 4 << 20


def symbol(initial: str, must_go: bool, truncated: bool) -> int:
    if must_go:
        return GONE
    place = INITIALS.find(initial) if initial else -1
    return FIRST_KEPT + 2 * (place if place >= 0 else len(INITIALS)) + truncated


def _moves(mark: int, state: int):
    """(letter, cost, next state) of the edits that use up a row."""
    if mark == NO_ROW:
        yield "", 0, state
        return
    yield "D", DELETE, state
    if mark != GONE:
        place, truncated = divmod(mark - FIRST_KEPT, 2)
        initial = INITIALS[place] if place < len(INITIALS) else ""
        extra = TRUNCATED * truncated
        if (state, initial) in KEPT:
            yield "K", extra, KEPT[state, initial]
        yield "R", REROLE + extra, FITTED[state]


def _before(mark: int, after: tuple) -> tuple:
    """Costs before a row from those after it; inserted turns may come first."""
    used = [min(cost + after[q] for _, cost, q in _moves(mark, state)) for state in range(4)]
    once = [min(used[q], INSERT + used[FITTED[q]]) for q in range(4)]
    return tuple(min(once[q], INSERT + once[FITTED[q]]) for q in range(4))


def _edits(mark: int, after: tuple, state: int) -> tuple[str, int]:
    """The least letters, inserts included, that use up a row at the cheapest cost, and the state
    after them."""
    before, letters = _before(mark, after), ""
    while True:
        options = [(letter, q) for letter, cost, q in _moves(mark, state)
                   if cost + after[q] == before[state]]
        if INSERT + before[FITTED[state]] == before[state]:
            options.append(("I", None))
        letter, q = min(options, key=lambda o: o[0])
        letters += letter
        if q is not None:
            return letters, q
        state = FITTED[state]


class Tables:
    """Vectors without their smallest entry, and the transitions over rows and over blocks.

    ``row_next[v, s]`` is the vector before symbol ``s`` when ``v`` is the one after it, and
    ``row_cost`` what was taken off. ``block_next`` and ``block_cost`` are the same for blocks, by
    the number whose digits to the base ``SYMBOLS`` are the block's symbols.
    """

    def __init__(self):
        self.vectors, number = [AT_END], {AT_END: 0}
        nexts, costs = [], []
        for vector in self.vectors:
            befores = [_before(mark, vector) for mark in range(SYMBOLS)]
            row = []
            for before in befores:
                least = min(before)
                small = tuple(x - least for x in before)
                if small not in number:
                    number[small] = len(self.vectors)
                    self.vectors.append(small)
                row.append(number[small])
            nexts.append(row)
            costs.append([min(b) for b in befores])
        self.row_next = np.array(nexts, np.int32)
        self.row_cost = np.array(costs, np.int64)
        size = len(self.vectors)
        self.block_next = np.arange(size, dtype=np.int32)[:, None]
        self.block_cost = np.zeros((size, 1), np.int64)
        for _ in range(BLOCK):
            # One more symbol in front: the block behind it first, then that symbol.
            cost = self.block_cost[:, None, :] + self.row_cost[self.block_next].transpose(0, 2, 1)
            self.block_next = self.row_next[self.block_next].transpose(0, 2, 1).reshape(size, -1)
            self.block_cost = cost.reshape(size, -1)
        self.edits = [
            [[_edits(mark, v, state) for state in range(4)] for mark in range(SYMBOLS)]
            for v in self.vectors
        ]

    def codes(self, marks: bytes) -> tuple[np.ndarray, list[int]]:
        """The symbols, filled up to whole blocks, and the number of each block."""
        filled = np.frombuffer(marks + bytes(-len(marks) % BLOCK), np.uint8).reshape(-1, BLOCK)
        digits = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
        return filled, (filled @ digits).tolist()

    def backward(self, marks: bytes, vector: int) -> tuple[list[int], int, int]:
        """The vector after each block, the one before all, and what they cost beside it."""
        after, cost = [], 0
        for code in reversed(self.codes(marks)[1]):
            after.append(vector)
            cost += int(self.block_cost[vector, code])
            vector = int(self.block_next[vector, code])
        return after[::-1], vector, cost

    def forward(self, marks: bytes, vector: int, state: int) -> tuple[list[str], int]:
        """The letters of each row and the state after the last, ``vector`` being the one there."""
        letters = []
        filled, _ = self.codes(marks)
        for block, end in zip(filled.tolist(), self.backward(marks, vector)[0]):
            inside = [end]
            for mark in reversed(block[1:]):
                inside.append(int(self.row_next[inside[-1], mark]))
            for mark, after in zip(block, reversed(inside)):
                row, state = self.edits[after][mark][state]
                letters.append(row)
        return letters[:len(marks)], state


class Repair:
    """One conversation, taken from the front in pieces; ``result`` at its end."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self.state, self.cost, self.audit = NOTHING, 0, []
        self.faults, self.illegal, self.initial = [0, 0, 0], 0, None
        self.low = self.high = self.turn = None
        self.turns, self.digest, self.begun = 0, hashlib.sha256(), False

    def add(self, rows: list[tuple], marks: bytes, faults: list[int], vector: int) -> None:
        """Rows (turn, role, text) with their symbols and faults (3: none) and the vector after
        them."""
        letters, _ = self.tables.forward(marks, vector, self.state)
        for (turn, role, text), fault, mark, edits in zip(rows, faults, marks, letters):
            if turn is not None:
                self.turns += turn != self.turn
                self.low = turn if self.low is None else self.low
                self.high = self.turn = turn
            if fault < 3:
                self.faults[fault] += 1
            if self.initial is not None:
                self.illegal += self.initial + role[:1] not in LEGAL
            self.initial = role[:1]
            for letter in edits:
                self._edit(letter, role, text, mark)

    def _edit(self, letter: str, role: str = "", text: str = "", mark: int = NO_ROW) -> None:
        self.audit.append(letter)
        if letter == "D":
            self.cost += DELETE
            return
        if letter == "K":
            self.state = KEPT[self.state, role[:1]]
        else:
            self.cost += INSERT if letter == "I" else REROLE
            self.state = FITTED[self.state]
            role, text = ROLES[self.state], "" if letter == "I" else text
        if letter != "I":
            self.cost += TRUNCATED * ((mark - FIRST_KEPT) % 2)
        self.digest.update((b"\n" if self.begun else b"") + f"{role}:{text}".encode())
        self.begun = True

    def result(self) -> tuple:
        while AT_END[self.state]:
            self._edit("I")
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, *self.faults, self.illegal, self.cost, "".join(self.audit),
                self.digest.hexdigest())


def faults_of(text: str, seen: bool) -> int:
    """0 blank, 1 duplicate, 2 truncated, 3 none: the first that a row has."""
    body = text.rstrip(SPACE)
    return 0 if not body else 1 if seen else 2 if body[-1] not in STOPS else 3


def _symbols(rows: list[tuple], faults: list[int]) -> bytes:
    return bytes(symbol(role[:1], f < 2, f == 2) for (_, role, _), f in zip(rows, faults))


FIGURES = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
    " audit string, repaired_sha256 string"
)
FIGURE_NAMES = [f.split()[0] for f in FIGURES.split(",")]
FIGURE_TYPES = [*[pa.int64()] * 6, pa.string(), pa.string()]
ROW = "part long, chunk long, place long, turn long, role string, text string, present boolean"
ROW_NAMES = [f.split()[0] for f in ROW.split(",")]
ROW_TYPES = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.bool_()]


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _short(rows: list[tuple], tables: Tables) -> tuple:
    """The figures of a conversation held as (turn, role, text, present)."""
    own = [r[:3] for r in rows if r[3]]
    seen, faults = set(), []
    for _, role, text in own:
        faults.append(faults_of(text, (role, text) in seen))
        seen.add((role, text))
    whole = Repair(tables)
    whole.add(own, _symbols(own, faults), faults, 0)
    return whole.result()


def _by_range(batches):
    """Sorted rows of one range: a row of figures for each conversation inside it, and the rows of
    those at its edges and of long ones."""
    names = ["conv", *FIGURE_NAMES, *ROW_NAMES]
    part, place = TaskContext.get().partitionId(), 0
    out, out_bytes = [], 0
    conv, held, held_bytes, is_open, chunk, kind = None, [], 0, False, 0, None
    blank_figures, blank_row = (None,) * len(FIGURE_NAMES), (None,) * len(ROW_NAMES)

    def handed_on():
        nonlocal place, chunk, held_bytes, out_bytes
        for row in held:
            out.append((conv, *blank_figures, part, chunk, place, *row))
            place += 1
        out_bytes += held_bytes
        chunk, held_bytes = chunk + 1, 0
        held.clear()

    def taken():
        nonlocal out_bytes
        batch = _batch(out, names, [kind, *FIGURE_TYPES, *ROW_TYPES])
        out.clear()
        out_bytes = 0
        return batch

    started, tables = False, Tables()
    for batch in batches:
        kind = batch.schema.field("conv").type
        columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "present")]
        for c, *row in zip(*columns):
            if not started or c != conv:
                if started and is_open:
                    handed_on()
                elif started:
                    out.append((conv, *_short(held, tables), *blank_row))
                    held.clear()
                # The first conversation may have begun in the range before.
                conv, held_bytes, chunk, is_open, started = c, 0, 0, not started, True
            held.append(tuple(row))
            held_bytes += len(row[2])
            if len(held) >= CHUNK_ROWS or held_bytes >= CHUNK_BYTES:
                is_open = True
                handed_on()
            if len(out) >= CHUNK_ROWS or out_bytes >= CHUNK_BYTES:
                yield taken()
    if started:
        # The last one may go on in the next range.
        handed_on()
        yield taken()


def _marked(batches):
    """Adds each row's fault and symbol; ``seen`` tells of an equal earlier one."""
    for batch in batches:
        faults = [
            faults_of(text, seen) if present else 3
            for text, seen, present in zip(*(batch.column(c).to_pylist()
                                             for c in ("text", "seen", "present")))
        ]
        marks = [
            symbol(role[:1], f < 2, f == 2) if present else NO_ROW
            for role, f, present in zip(batch.column("role").to_pylist(), faults,
                                        batch.column("present").to_pylist())
        ]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv", *ROW_NAMES)),
             pa.array(faults, pa.int32()), pa.array(marks, pa.int32())],
            ["conv", *ROW_NAMES, "fault", "mark"],
        )


def _runs(batches, columns: list[str], key: int):
    """Consecutive rows that agree in their first ``key`` columns, as (key, rows)."""
    rows = (
        row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns))
    )
    return groupby(rows, key=lambda r: r[:key])


def _vectors(kind):
    """Rows in falling order: the vector after every chunk."""

    def run(batches):
        names, tables = ["conv", "part", "chunk", "after"], Tables()
        conv, vector, out, begun = None, 0, [], False
        for (c, part, chunk), rows in _runs(batches, ["conv", "part", "chunk", "mark"], 3):
            if not begun or c != conv:
                conv, vector, begun = c, 0, True
            marks = bytes(r[3] for r in rows)[::-1]
            out.append((c, part, chunk, vector))
            vector = tables.backward(marks, vector)[1]
            if len(out) >= CHUNK_ROWS:
                yield _batch(out, names, [kind, *[pa.int64()] * 3])
                out = []
        yield _batch(out, names, [kind, *[pa.int64()] * 3])

    return run


def _repaired(kind):
    """Rows in rising order with the vector after their chunk: the figures of each conversation."""

    def run(batches):
        names, tables = ["conv", *FIGURE_NAMES], Tables()
        columns = ["conv", "part", "chunk", "after", "turn", "role", "text", "present", "fault",
                   "mark"]
        conv, whole = None, None
        for (c, _, _, after), rows in _runs(batches, columns, 4):
            if whole is None or c != conv:
                if whole is not None:
                    yield _batch([(conv, *whole.result())], names, [kind, *FIGURE_TYPES])
                conv, whole = c, Repair(tables)
            own = [r[4:] for r in rows if r[7]]
            whole.add([r[:3] for r in own], bytes(r[5] for r in own), [r[4] for r in own], after)
        if whole is not None:
            yield _batch([(conv, *whole.result())], names, [kind, *FIGURE_TYPES])

    return run


def _arrow_type(df: DataFrame, name: str):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def _open_figures(rows: DataFrame) -> DataFrame:
    """The figures of conversations that were handed on as rows."""
    kind = _arrow_type(rows, "conv")
    sql_kind = rows.schema["conv"].dataType.simpleString()
    hashed = rows.withColumn("same", F.md5(F.concat_ws(":", F.length("role"), "role", "text")))
    at = F.struct("part", "place")
    repeats = hashed.where("present").groupBy("conv", "same").agg(
        F.min(at).alias("first"), F.count("*").alias("n")
    ).where("n > 1").select(F.col("conv").alias("c"), F.col("same").alias("s"), "first")
    again = F.col("conv").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s"))
    seen = hashed.join(repeats, again, "left").select(
        "conv", *ROW_NAMES, F.coalesce(at > F.col("first"), F.lit(False)).alias("seen")
    )
    schema = f"conv {sql_kind}, {ROW}, fault int, mark int"
    marked = staged(seen.mapInArrow(_marked, schema), "open-turns")
    narrow = marked.select("conv", "part", "chunk", "place", "mark").repartition("conv")
    falling = narrow.sortWithinPartitions("conv", F.desc("part"), F.desc("place"))
    vectors = falling.mapInArrow(
        _vectors(kind), f"conv {sql_kind}, part long, chunk long, after long"
    ).toDF("c", "p", "k", "after")
    match = F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
    joined = marked.join(vectors, match & (F.col("chunk") == F.col("k"))).drop("c", "p", "k")
    rising = joined.repartition("conv").sortWithinPartitions("conv", "part", "place")
    return rising.mapInArrow(_repaired(kind), f"conv {sql_kind}, {FIGURES}")


def repair(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    present: str | None = None,
) -> DataFrame:
    """One row per conversation: its key, ``gaps``, ``blank``, ``duplicate``, ``truncated``,
    ``illegal``, ``cost``, ``audit`` and ``repaired_sha256``.

    Rows are taken by turn, null first; rows of an equal turn by a digest of role and text. The
    first fault of a row counts: blank, duplicate (role and text of an earlier row), truncated (the
    text does not end in ``.!?``). ``audit`` has the initials of the cheapest edits that leave an
    optional system turn and then pairs of user and assistant turns, or nothing: keep (0), rerole
    to user or assistant (3), delete (4; blank and duplicate rows must go), insert an empty user or
    assistant turn (3); a truncated row that stays adds 3. Of equally cheap ones it is the least by
    ASCII. Roles are read by their first character. ``gaps`` are turns missing between the first
    and the last, ``illegal`` neighbours other than system-user, user-assistant, assistant-user.

    Null role and text count as one space; rows with a null key are one conversation. Where the
    boolean column ``present`` is false, or null, the row only tells that its conversation exists;
    one without other rows has zeros, an empty audit and the digest of nothing. Repeated rows are
    duplicates. An empty table gives no rows. Other columns are not read.
    """
    clean = turns.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
        (F.lit(True) if present is None
         else F.coalesce(F.col(f"`{present}`"), F.lit(False))).alias("present"),
    ).withColumn("tie", tie(F.col("role"), F.col("text")))
    order = ["conv", "turn", "tie"]
    ranged = clean.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    sql_kind = clean.schema["conv"].dataType.simpleString()
    found = staged(ranged.mapInArrow(_by_range, f"conv {sql_kind}, {FIGURES}, {ROW}"), "turns")
    inside = found.where("part is null").select("conv", *FIGURE_NAMES)
    across = _open_figures(found.where("part is not null").select("conv", *ROW_NAMES))
    return inside.unionByName(across).toDF(*unlike([conv, *FIGURE_NAMES]))


def tie(role: Column, text: Column) -> Column:
    """Orders rows of an equal turn: 60 bits of a digest."""
    digest = F.md5(F.concat_ws(":", role, text))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def damaged(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Turns with faults put in, by the CRC-32 of ``conv:turn``, modulo 20.

    0 drops a row, 1 empties its text, 2 takes out ``.!?``, 3 repeats it, 4 makes it the user's.
    Dropped rows stay with a false ``present`` and without text, so that their conversation is not
    lost. Nulls count as one space. Columns: the four, and ``present``.
    """
    def known(name):
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    lot = F.crc32(F.encode(F.concat_ws(":", known(conv), known(turn)), "UTF-8")) % 20
    body = F.when(lot.isin(0, 1), "").when(lot == 2, F.translate(known(text), STOPS, ""))
    changed = turns.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.when(lot == 4, "user").otherwise(known(role)).alias("role"),
        body.otherwise(known(text)).alias("text"),
        (lot != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(lot == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
    return changed.toDF(*unlike([conv, turn, role, text, "present"]))
