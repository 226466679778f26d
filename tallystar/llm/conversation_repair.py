"""Repair of conversation structure by cheapest edits (operator 11).

A conversation's roles should read `(system)? (user assistant)*`. Each row is kept, rerolled to user
or assistant, or deleted, and empty rows may be inserted, at the least cost; of equally cheap
repairs the one whose edit initials are ASCII-least is taken. Four states say what was accepted
last: nothing, system, user, assistant.

Divide and conquer in linear space: a forward cost vector over the states from the start and a
backward one from the end meet in the middle. Of the crossings whose costs add up to the optimum the
one of the audit-least path is taken, and both halves are solved alike. From one state each edit has
another initial, so the audit-least path takes, at each place, the least initial among the edits
that are still optimal; where several crossings are optimal, following that rule backwards over the
first half, by pointers of four states, says which one it uses.

On Spark: equal rows become one with a count, rows are sorted by ranges of conversation and place, and
each task cuts its rows into pieces of bounded size, one for nearly every conversation. A
conversation that crosses a cut (also one with a third of all rows) is solved by pieces: each has a
4 x 4 table of costs between the states at its ends; one pass over these tables, from the last piece,
gives the backward vector at every cut, each piece finds its exit for each entry, one pass from the
first piece gives the entries, and the pieces are solved independently. The passes stream over one
small row a piece. Only the digest of a cut conversation needs its repaired rows in one stream.

Order of rows: by turn (null first), then role, then text. Null roles and texts are one space, which
makes such a text blank. Repeated rows follow one another, and all but the first are duplicates.
Null ids form a conversation of their own. A row that is longer than a piece's bound is a piece by
itself, whole. Extra columns are left out, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.tables import Scratch, id_type, ship

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The state that a user or assistant row leads to, and what must be inserted after the last row.
NEXT = (USER, USER, ASSISTANT, USER)
CLOSING = ("", "II", "I", "")
END = (0, 10, 5, 0)
FAR = 1 << 50
#: Bounds of a piece: rows, and characters of text.
PIECE_ROWS, PIECE_CHARS = 1 << 16, 1 << 24
#: Longest part of the table that is solved without halving.
LEAF = 32
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}

Vector = tuple[int, int, int, int]


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as `damage` by their ids leaves them, with their number of copies.

    crc32 of `conv_id:turn`, modulo 20: 0 drops a row (no copy of it is left), 1 empties its text,
    2 removes its ends of sentences, 3 repeats it, 4 makes it a user's. Nulls count as one space.
    """
    blank = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), blank),
    )
    kind = F.crc32(name.cast("binary")) % 20
    text = F.coalesce(F.col("text"), blank)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
        .alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


# A row's code: 3 * (0 system, 1 user, 2 assistant, 3 other) + (0 sound, 1 truncated, 2 to delete).


def _kept(code: int, state: int) -> int | None:
    """The state after keeping a row, if the row's role is legal there."""
    role = code // 3
    if role == 0:
        return SYSTEM if state == START else None
    return NEXT[state] if role < 3 and NEXT[state] == role + 1 else None


def _step_back(code: int, after: Vector) -> tuple[Vector, Vector, tuple[str, ...]]:
    """Costs from each state before a row to the end; the state after it and the edits taken."""
    extra = TRUNCATED if code % 3 == 1 else 0
    plain: list[list[tuple[int, str, int]]] = []
    for state in range(4):
        edits = [(DELETE + after[state], "D", state)]
        if code % 3 < 2:
            to = _kept(code, state)
            if to is not None:
                edits.append((extra + after[to], "K", to))
            edits.append((REROLE + extra + after[NEXT[state]], "R", NEXT[state]))
        plain.append(edits)
    least = [min(e)[0] for e in plain]
    two = min(least[USER], INSERT + least[ASSISTANT])
    three = min(least[ASSISTANT], INSERT + least[USER])
    costs = (min(least[START], INSERT + two), min(least[SYSTEM], INSERT + two), two, three)
    exits, letters = [], []
    for state in range(4):
        done, at = "", state
        while True:
            found = {letter: to for cost, letter, to in plain[at] if cost == costs[at]}
            if "D" in found or INSERT + costs[NEXT[at]] != costs[at]:
                letter = min(found)
                exits.append(found[letter])
                letters.append(done + letter)
                break
            done, at = done + "I", NEXT[at]
    return costs, tuple(exits), tuple(letters)


def _step_on(code: int, before: Vector) -> Vector:
    """Costs from the entry to each state after a row."""
    start, system, user, assistant = before
    two = min(user, start + INSERT, system + INSERT, assistant + INSERT)
    three = min(assistant, user + INSERT, start + 2 * INSERT, system + 2 * INSERT)
    reached = [start + DELETE, system + DELETE, two + DELETE, three + DELETE]
    if code % 3 < 2:
        extra = TRUNCATED if code % 3 == 1 else 0
        for state, cost in enumerate((start, system, two, three)):
            to = _kept(code, state)
            if to is not None:
                reached[to] = min(reached[to], cost + extra)
            reached[NEXT[state]] = min(reached[NEXT[state]], cost + extra + REROLE)
    return tuple(reached)


class Solver:
    """Costs and audits of runs of codes. Steps are remembered by code and differences of costs."""

    def __init__(self) -> None:
        self.back: dict[tuple[int, Vector], tuple] = {}
        self.on: dict[tuple[int, Vector], tuple[Vector, int]] = {}

    def _back(self, code: int, after: Vector) -> tuple:
        least = min(after)
        if least:
            after = tuple(x - least for x in after)
        found = self.back.get((code, after))
        if found is None:
            found = self.back[code, after] = _step_back(code, after)
        return found, least

    def backward(self, codes: bytes, after: Vector) -> Vector:
        for code in reversed(codes):
            (costs, _, _), least = self._back(code, after)
            after = tuple(x + least for x in costs)
        return after

    def forward(self, codes: bytes, before: Vector) -> Vector:
        for code in codes:
            least = min(before)
            key = code, tuple(min(x - least, FAR) for x in before)
            if key not in self.on:
                self.on[key] = _step_on(*key)
            before = tuple(x + least for x in self.on[key])
        return before

    def exits(self, codes: bytes, after: Vector) -> Vector:
        """The state in which the audit-least path from each state leaves the run."""
        ends: Vector = (0, 1, 2, 3)
        for code in reversed(codes):
            (costs, to, _), least = self._back(code, after)
            ends = tuple(ends[x] for x in to)
            after = tuple(x + least for x in costs)
        return ends

    def edits(self, codes: bytes, entry: int, after: Vector) -> tuple[list[str], int]:
        """The edits at each row (inserted rows before it first), and the exit."""
        if len(codes) <= LEAF:
            vectors = [after]
            for code in reversed(codes[1:]):
                (costs, _, _), least = self._back(code, vectors[-1])
                vectors.append(tuple(x + least for x in costs))
            out = []
            for code in codes:
                (_, to, letters), _ = self._back(code, vectors.pop())
                out.append(letters[entry])
                entry = to[entry]
            return out, entry
        mid = len(codes) // 2
        first, second = codes[:mid], codes[mid:]
        behind = self.backward(second, after)
        unit = tuple(0 if s == entry else FAR for s in range(4))
        costs = [a + b for a, b in zip(self.forward(first, unit), behind)]
        crossings = [s for s in range(4) if costs[s] == min(costs)]
        crossing = crossings[0]
        if len(crossings) > 1:
            crossing = self.exits(first, behind)[entry]
        left, _ = self.edits(first, entry, behind)
        right, leaves = self.edits(second, crossing, after)
        return left + right, leaves

    def table(self, codes: bytes, deleted: int) -> list[int]:
        """Costs between the states at both ends, entry by entry; `deleted` copies go besides."""
        out: list[int] = []
        for entry in range(4):
            unit = tuple(0 if s == entry else FAR for s in range(4))
            out += [min(x + DELETE * deleted, FAR) for x in self.forward(codes, unit)]
        return out


STATS = ("blank", "duplicate", "truncated", "illegal", "turns")


class _Run:
    """Rows of one conversation that one piece holds."""

    def __init__(self) -> None:
        self.codes = bytearray()
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.copies: list[int] = []
        self.chars = 0
        self.stats = dict.fromkeys(STATS, 0)
        self.first_turn = self.last_turn = None
        self.first_role = self.last_role = None

    def add(self, turn: int | None, role: str, text: str, copies: int, again: bool) -> None:
        if not copies:
            return
        stats = self.stats
        sound = text.rstrip(BLANKS)
        fault = 0
        if not sound:
            stats["blank"] += copies
            fault = 2
        elif again:
            stats["duplicate"] += copies
            fault = 2
        else:
            stats["duplicate"] += copies - 1
            if sound[-1] not in ".!?":
                stats["truncated"] += 1
                fault = 1
        initial = role[:1]
        if self.last_role is not None and self.last_role + initial not in LEGAL:
            stats["illegal"] += 1
        if initial + initial not in LEGAL:
            stats["illegal"] += copies - 1
        if self.first_role is None:
            self.first_role = initial
        self.last_role = initial
        if turn is not None and turn != self.last_turn:
            stats["turns"] += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
        self.codes.append(3 * {"s": 0, "u": 1, "a": 2}.get(initial, 3) + fault)
        self.roles.append(role)
        self.texts.append(text)
        self.copies.append(copies)
        self.chars += len(text) + len(role)


def _pieces(piece_rows: int, piece_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        solver = Solver()
        now: _Run | None = None
        cut = True  # the first run may continue the one of the task before
        conv = None
        kind = None

        def piece(open_: bool) -> pa.RecordBatch:
            nonlocal seq
            seq += 1
            own = {
                "conv_id": pa.array([conv], kind),
                "part": pa.array([part], pa.int32()),
                "seq": pa.array([seq], pa.int64()),
                "cut": [open_],
                "codes": pa.array([bytes(now.codes)], pa.binary()),
                "roles": pa.array([now.roles], pa.list_(pa.string())),
                "texts": pa.array([now.texts], pa.list_(pa.string())),
                "copies": pa.array([now.copies], pa.list_(pa.int64())),
                "first_turn": pa.array([now.first_turn], pa.int64()),
                "last_turn": pa.array([now.last_turn], pa.int64()),
                "first_role": pa.array([now.first_role], pa.string()),
                "last_role": pa.array([now.last_role], pa.string()),
                "costs": pa.array(
                    [solver.table(bytes(now.codes), sum(now.copies) - len(now.copies))]
                    if open_
                    else [None],
                    pa.list_(pa.int64()),
                ),
                **{s: pa.array([now.stats[s]], pa.int64()) for s in STATS},
            }
            return pa.RecordBatch.from_pydict(own)

        ready: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            kind = batch.column("conv_id").type
            rows = zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True)
            for conv_id, turn, role, text, copies, again in rows:
                if now is None:
                    now, conv = _Run(), conv_id
                elif conv_id != conv:
                    size += now.chars
                    ready.append(piece(cut))
                    now, conv, cut = _Run(), conv_id, False
                elif len(now.codes) >= piece_rows or now.chars >= piece_chars:
                    size += now.chars
                    ready.append(piece(True))
                    now, cut = _Run(), True
                now.add(turn, role, text, copies, again)
                if size >= PIECE_CHARS or len(ready) >= 2000:
                    yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
                    ready, size = [], 0
        if now is not None:
            ready.append(piece(True))
        if ready:
            yield from pa.Table.from_batches(ready).combine_chunks().to_batches()

    return run


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces, last one first: the cost vector behind each, and whether it is the last."""
    conv, begun, after = None, False, END
    for batch in batches:
        out = {"part": [], "seq": [], "after": [], "last": []}
        for r in batch.to_pylist():
            last = not begun or r["conv_id"] != conv
            if last:
                conv, begun, after = r["conv_id"], True, END
            for name, x in (("part", r["part"]), ("seq", r["seq"]), ("after", list(after)), ("last", last)):
                out[name].append(x)
            costs = r["costs"]
            after = tuple(
                min(min(costs[4 * p + q] + after[q] for q in range(4)), FAR) for p in range(4)
            )
        yield pa.RecordBatch.from_pydict(
            out, pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("after", pa.list_(pa.int64())), ("last", pa.bool_())])
        )


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    solver = Solver()
    for batch in batches:
        rows = batch.to_pylist()
        exits = [list(solver.exits(r["codes"], tuple(r["after"]))) for r in rows]
        own = [batch.column(c) for c in ("conv_id", "part", "seq", "after", "last")]
        yield pa.record_batch(
            [*own, pa.array(exits, pa.list_(pa.int64()))],
            names=["conv_id", "part", "seq", "after", "last", "exits"],
        )


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces, first one first: the state in which each begins."""
    conv, begun, state = None, False, START
    for batch in batches:
        entries = []
        for conv_id, exits in zip(batch.column("conv_id").to_pylist(), batch.column("exits").to_pylist()):
            if not begun or conv_id != conv:
                conv, begun, state = conv_id, True, START
            entries.append(state)
            state = exits[state]
        yield pa.record_batch(
            [batch.column(c) for c in ("part", "seq", "after", "last")] + [pa.array(entries, pa.int32())],
            names=["part", "seq", "after", "last", "entry"],
        )


def _edited(solver: Solver, r: dict) -> tuple[str, int, list[tuple[str, str, str]]]:
    """Audit, cost and remaining rows (edit, role, text) of a piece with its entry and its end."""
    state, audit, cost, rows = r["entry"], [], 0, []
    letters, leaves = solver.edits(r["codes"], state, tuple(r["after"]))
    for code, edits, role, text, copies in zip(
        r["codes"], letters, r["roles"], r["texts"], r["copies"], strict=True
    ):
        for edit in edits:
            if edit == "D":
                cost += DELETE
                continue
            cost += {"I": INSERT, "R": REROLE, "K": 0}[edit]
            cost += TRUNCATED if edit != "I" and code % 3 == 1 else 0
            state = _kept(code, state) if edit == "K" else NEXT[state]
            rows.append((edit, role if edit == "K" else ROLES[state], "" if edit == "I" else text))
        audit.append(edits + "D" * (copies - 1))
        cost += DELETE * (copies - 1)
    closing = CLOSING[leaves] if r["last"] else ""
    for edit in closing:
        state = NEXT[state]
        rows.append((edit, ROLES[state], ""))
        cost += INSERT
    return "".join(audit) + closing, cost, rows


def _summary_types(kind: str) -> str:
    longs = "".join(f", {c} long" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return f"conv_id {kind}{longs}, audit string, repaired_sha256 string"


def _gaps(first: int | None, last: int | None, turns: int) -> int:
    return 0 if first is None else last - first + 1 - turns


def _table(rows: list[dict], conv_type: pa.DataType) -> pa.RecordBatch:
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    columns = {"conv_id": pa.array([r["conv_id"] for r in rows], conv_type)}
    columns |= {n: pa.array([r[n] for r in rows], pa.int64()) for n in names}
    columns |= {n: pa.array([r[n] for r in rows], pa.string()) for n in ("audit", "repaired_sha256")}
    return pa.RecordBatch.from_pydict(columns)


def _summed_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to one row for each conversation; holds one piece at a time."""
    solver = Solver()
    now, digest = None, None
    for batch in batches:
        done = []

        def close() -> None:
            now["gaps"] = _gaps(now["first_turn"], now["last_turn"], now["turns"])
            now["audit"] = "".join(now["audit"])
            now["repaired_sha256"] = digest.hexdigest()
            done.append(now)

        kind = batch.column("conv_id").type
        for i in range(batch.num_rows):
            r = batch.slice(i, 1).to_pylist()[0]
            audit, cost, rows = _edited(solver, r)
            lines = "\n".join(f"{role}:{text}" for _, role, text in rows).encode()
            if now is None or r["first"]:
                if now is not None:
                    close()
                now = {k: r[k] for k in ("conv_id", "first_turn", "last_turn", "last_role", *STATS)}
                now |= {"audit": [audit], "cost": cost, "any": bool(rows)}
                digest = hashlib.sha256(lines)
                continue
            for name in STATS:
                now[name] += r[name]
            if r["first_role"] is not None:
                if now["last_role"] is not None:
                    now["illegal"] += now["last_role"] + r["first_role"] not in LEGAL
                now["last_role"] = r["last_role"]
            if r["first_turn"] is not None:
                now["turns"] -= now["last_turn"] == r["first_turn"]
                if now["first_turn"] is None:
                    now["first_turn"] = r["first_turn"]
                now["last_turn"] = r["last_turn"]
            now["audit"].append(audit)
            now["cost"] += cost
            if rows:
                digest.update((b"\n" if now["any"] else b"") + lines)
                now["any"] = True
        if done:
            yield _table(done, kind)
    if now is not None:
        done = []
        close()
        yield _table(done, kind)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    solver = Solver()
    for batch in batches:
        for i in range(batch.num_rows):
            own = batch.slice(i, 1)
            r = own.to_pylist()[0]
            _, _, rows = _edited(solver, r)
            n = len(rows)
            yield pa.RecordBatch.from_pydict(
                {
                    "conv_id": pa.array([r["conv_id"]] * n, own.column("conv_id").type),
                    "part": pa.array([r["part"]] * n, pa.int32()),
                    "seq": pa.array([r["seq"]] * n, pa.int64()),
                    "place": pa.array(range(n), pa.int64()),
                    **{c: pa.array([x[k] for x in rows], pa.string()) for k, c in enumerate(("edit", "role", "text"))},
                }
            )


class ConversationRepair:
    """The cheapest repair of each conversation of a table `conv_id, turn, role, text`.

    `copies` names a column with a number of copies of each row; rows with none only say that the
    conversation exists.
    """

    def __init__(
        self,
        conversations: DataFrame,
        copies: str | None = None,
        piece_rows: int = PIECE_ROWS,
        piece_chars: int = PIECE_CHARS,
    ) -> None:
        spark = conversations.sparkSession
        ship(spark)
        self.kind = id_type(conversations, "conv_id").simpleString()
        self.scratch = Scratch(spark)
        number = F.col(f"`{copies}`") if copies else F.lit(1)
        there = number > 0
        blank = F.lit(" ")
        rows = (
            conversations.select(
                "conv_id",
                F.when(there, F.col("turn").cast("long")).alias("turn"),
                F.when(there, F.coalesce(F.col("role").cast("string"), blank)).otherwise("").alias("role"),
                F.when(there, F.coalesce(F.col("text").cast("string"), blank)).otherwise("").alias("text"),
                number.cast("long").alias("copies"),
            )
            .groupBy("conv_id", "turn", "role", "text")
            .agg(F.sum("copies").alias("copies"))
            .withColumn("content", F.sha2(F.concat("role", F.lit("\0"), "text"), 256))
        )
        rows = self.scratch.saved(rows, "rows")
        place = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
        # A content under several turns: all rows but those of the first turn repeat it.
        repeated = (
            rows.where("copies > 0")
            .groupBy(F.col("conv_id").alias("c"), F.col("content").alias("t"))
            .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
            .where("n > 1")
            .drop("n")
        )
        marked = rows.join(
            repeated, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("content") == F.col("t")), "left"
        ).select(
            "conv_id", "turn", "role", "text", "copies",
            (F.col("first").isNotNull() & (F.col("first") != place)).alias("again"),
        )
        # Ranges go by the first characters, which agree with the whole order.
        heads = [F.substring(c, 1, 64) for c in ("role", "text")]
        ordered = marked.repartitionByRange("conv_id", "turn", *heads).sortWithinPartitions(
            "conv_id", "turn", "role", "text"
        )
        longs = "".join(f", {s} long" for s in STATS)
        pieces = ordered.mapInArrow(
            _pieces(piece_rows, piece_chars),
            f"conv_id {self.kind}, part int, seq long, cut boolean, codes binary, roles array<string>, "
            "texts array<string>, copies array<long>, first_turn long, last_turn long, "
            f"first_role string, last_role string, costs array<long>{longs}",
        )
        self.pieces = self.scratch.saved(pieces, "pieces")
        self.scratch.drop("rows")
        self.crossings = self._crossings()

    def _crossings(self) -> DataFrame:
        """`part, seq, after, last, entry` of the pieces of conversations that cross a cut."""
        open_ = self.pieces.where("cut")
        costs = open_.select("conv_id", "part", "seq", "costs")
        backward = (
            costs.repartition("conv_id")
            .sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq"))
            .mapInArrow(_backward, "part int, seq long, after array<long>, last boolean")
        )
        exits = (
            open_.select("conv_id", "part", "seq", "codes")
            .join(backward, ["part", "seq"])
            .mapInArrow(
                _exits,
                f"conv_id {self.kind}, part int, seq long, after array<long>, last boolean, "
                "exits array<long>",
            )
        )
        entries = (
            exits.repartition("conv_id")
            .sortWithinPartitions("conv_id", "part", "seq")
            .mapInArrow(_entries, "part int, seq long, after array<long>, last boolean, entry int")
        )
        return self.scratch.saved(entries, "crossings")

    def _solvable(self, cut: bool) -> DataFrame:
        """Pieces with the state they begin in and the cost vector behind them."""
        own = self.pieces.where(F.col("cut") == cut)
        if cut:
            return own.join(self.crossings, ["part", "seq"]).withColumn(
                "first", F.lit(False)
            )
        return own.withColumns(
            {
                "after": F.array(*[F.lit(x).cast("long") for x in END]),
                "last": F.lit(True),
                "entry": F.lit(START),
                "first": F.lit(True),
            }
        )

    def summary(self) -> DataFrame:
        """One row for each conversation: its faults before and the repair's cost, audit and digest."""
        kind = _summary_types(self.kind)
        whole = self._solvable(False).mapInArrow(_summed_up, kind)
        cut = self._solvable(True)
        # The first piece of a conversation is the one after which no earlier one stands.
        firsts = (
            self.pieces.where("cut")
            .groupBy(F.col("conv_id").alias("c"))
            .agg(F.min(F.struct("part", "seq")).alias("f"))
            .select("f.part", "f.seq", F.lit(True).alias("begins"))
        )
        joined = (
            cut.join(firsts, ["part", "seq"], "left")
            .withColumn("first", F.col("begins").isNotNull())
            .drop("begins")
            .repartition("conv_id")
            .sortWithinPartitions("conv_id", "part", "seq")
            .mapInArrow(_summed_up, kind)
        )
        return whole.unionByName(joined)

    def repaired(self) -> DataFrame:
        """The rows that a repair leaves or inserts, in the order of `part, seq, place`."""
        kind = f"conv_id {self.kind}, part int, seq long, place long, edit string, role string, text string"
        sides = [self._solvable(cut).mapInArrow(_rows, kind) for cut in (False, True)]
        return reduce(DataFrame.unionByName, sides)
