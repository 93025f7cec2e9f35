"""Conversation structure repair: cheapest edits that give every conversation its turn order, by Four-Russians block tables.

A conversation is a sequence of symbols (what a row's role is, and whether it is cut short or has to go). Its cheapest repair
is a shortest path through four states, and the cost vector over the states, less its least entry, takes few values. So what
a block of ``BLOCK`` symbols makes of each such vector is computed once, and conversations are read block by block by lookup.
Blocks run from the end to the beginning; a vector then holds the costs still to come, and each block is expanded backward from
the vector at its end, so that going forward the least edit letter that keeps the cost is known at every place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerloom.functions.joins import lookup_join
from ledgerloom.llm.shared import partitions, written

#: States: nothing yet, after a leading system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)

REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1

#: Symbols of a block.
BLOCK = 4

#: Most rows and text bytes of a piece of a conversation; a longer single row is a piece of its own.
PIECE_ROWS, PIECE_BYTES = 4096, 1 << 20

#: Symbol 0 has to go; 1 + 2 * kind + cut is a row of role kind s, u, a or another, cut short or not.
KINDS = {"s": 0, "u": 1, "a": 2}
OTHER, SYMBOLS = 3, 9

#: Where a kept row of each kind leads, and where an inserted or re-roled one does: there is one legal role in each state.
_KEEP = ({0: SYSTEM, 1: USER}, {1: USER}, {2: ASSISTANT}, {1: USER})
_NEED = (USER, USER, ASSISTANT, USER)

#: What is still to be paid at the end of a conversation: a user row needs its answer, a system row both.
END = (0, 2 * INSERT, INSERT, 0)


def _closed(costs: list[int]) -> list[int]:
    """Costs with insertions, at most two in a row."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[_NEED[q]]) for q, c in enumerate(costs)]
    return costs


def before(costs: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """The costs to come in each state before a symbol, from those after it."""
    out = [DELETE + c for c in costs]
    if symbol:
        kind, cut = divmod(symbol - 1, 2)
        for q in range(4):
            out[q] = min(out[q], REROLE + CUT * cut + costs[_NEED[q]], CUT * cut + costs[_KEEP[q][kind]] if kind in _KEEP[q] else out[q])
    return tuple(_closed(out))


class BlockTables:
    """For each normalised cost vector and each run of 1 or ``block`` symbols, the vector before it."""

    def __init__(self, block: int = BLOCK) -> None:
        self.block = block
        self.vectors: list[tuple[int, ...]] = [END]
        known, rows = {END: 0}, []
        for vector in self.vectors:  # grows while it is read
            row = []
            for symbol in range(SYMBOLS):
                costs = before(vector, symbol)
                least = min(costs)
                costs = tuple(c - least for c in costs)
                if costs not in known:
                    known[costs] = len(self.vectors)
                    self.vectors.append(costs)
                row.append(known[costs])
            rows.append(row)
        one = np.array(rows, dtype=np.int32)
        table = one
        for _ in range(block - 1):
            # A symbol is put before each run: the vector before the run is the vector after the symbol.
            table = one[table].transpose(0, 2, 1).reshape(len(one), -1)
        self.one, self.many = one.tolist(), table.tolist()
        self.one_array, self.many_array = one, table

    def runs(self, symbols: list[int]) -> list[tuple[int, int]]:
        """(code, symbols in it) of the blocks from the left, what is left over one by one."""
        full = len(symbols) - len(symbols) % self.block
        out = []
        for at in range(0, full, self.block):
            code = 0
            for s in symbols[at : at + self.block]:
                code = code * SYMBOLS + s
            out.append((code, self.block))
        return out + [(s, 1) for s in symbols[full:]]

    def ends(self, runs: list[tuple[int, int]], vector: int) -> list[int]:
        """The vector before the first run, and after each, by lookup from the last one."""
        out = [vector]
        for code, length in reversed(runs):
            vector = (self.one if length == 1 else self.many)[vector][code]
            out.append(vector)
        return out[::-1]

    def trace(self, symbols: list[int], vector: int, state: int) -> tuple[str, int]:
        """(edit letters, state after them): the cheapest from ``state`` on, ties by the least letter; ``vector``: what follows."""
        runs = self.runs(symbols)
        after = self.ends(runs, vector)[1:]
        letters = []
        for (code, length), v in zip(runs, after, strict=True):
            part, state = self.expand(code, length, v, state)
            letters.append(part)
        return "".join(letters), state

    @lru_cache(maxsize=1 << 17)  # noqa: B019  one object per process
    def expand(self, code: int, length: int, vector: int, state: int) -> tuple[str, int]:
        """One run's edit letters: costs backward over its symbols, then forward by the least letter that keeps the cost."""
        symbols = [code // SYMBOLS ** (length - 1 - k) % SYMBOLS for k in range(length)]
        costs = [self.vectors[vector]]
        for s in reversed(symbols):
            costs.append(before(costs[-1], s))
        costs.reverse()
        letters = ""
        for k, s in enumerate(symbols):
            kind, cut = divmod(s - 1, 2) if s else (None, 0)
            while True:
                left, after = costs[k][state], costs[k + 1]
                if DELETE + after[state] == left:
                    letters += "D"
                elif INSERT + costs[k][_NEED[state]] == left:
                    letters += "I"
                    state = _NEED[state]
                    continue
                elif kind in _KEEP[state] and CUT * cut + after[_KEEP[state][kind]] == left:
                    letters += "K"
                    state = _KEEP[state][kind]
                else:
                    letters += "R"
                    state = _NEED[state]
                break
        return letters, state


@lru_cache(maxsize=1)
def tables() -> BlockTables:
    return BlockTables()


def role_kind(role: str) -> int:
    return KINDS.get(role[:1], OTHER)


_SPACE = " \t\n\x0b\x0c\r"


def elements(roles: list[str], texts: list[str], copies: list[int], repeated: set[int]) -> tuple[list[int], list[int], list[int], list[int]]:
    """(symbol, its number of rows, its row) of a piece's rows in order, and how many rows are blank, duplicate and truncated.

    ``repeated``: rows whose role and text some earlier piece has. Further copies of a row follow it as one symbol.
    """
    symbols, times, rows, faults = [], [], [], [0, 0, 0]
    seen: set[tuple[str, str]] = set()
    for k, (role, text, n) in enumerate(zip(roles, texts, copies, strict=True)):
        if n <= 0:
            continue
        left = text.rstrip(_SPACE)
        if not left:
            faults[0] += n
            first = False
        else:
            first = k not in repeated and (role, text) not in seen
            seen.add((role, text))
            faults[1] += n - first
        if first:
            cut = left[-1] not in ".!?"
            faults[2] += cut
            symbols.append(1 + 2 * role_kind(role) + cut)
            times.append(1)
            rows.append(k)
        if n - first:
            symbols.append(0)
            times.append(n - first)
            rows.append(k)
    return symbols, times, rows, faults


_PIECE = "part int, piece long, whole boolean, turns array<bigint>, roles array<string>, texts array<string>, copies array<bigint>"


def _pieces(kind: str, rows: DataFrame) -> DataFrame:
    """Sorted rows as pieces of bounded size. ``whole``: a conversation that begins and ends in the piece for certain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        schema = None
        out: list[tuple] = []
        now: list[tuple] = []
        at, size, bytes_out, begins, first = 0, 0, 0, True, True

        def flush(ends: bool) -> None:
            nonlocal now, at, size, begins, bytes_out
            out.append((now[0][0], part, at, begins and ends, [r[1] for r in now], [r[2] for r in now], [r[3] for r in now], [r[4] for r in now]))
            bytes_out += size
            now, at, size, begins = [], at + 1, 0, ends

        def batch_of() -> pa.RecordBatch:
            nonlocal bytes_out
            columns = [list(c) for c in zip(*out, strict=True)]
            types = [schema.field(0).type, pa.int32(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64())]
            names = ["conv", "part", "piece", "whole", "turns", "roles", "texts", "copies"]
            out.clear()
            bytes_out = 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            schema = batch.schema
            for row in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                if first:
                    begins, first = False, False  # the partition before may hold its beginning
                if now and row[0] != now[0][0]:
                    flush(True)
                elif len(now) >= PIECE_ROWS or size >= PIECE_BYTES:
                    flush(False)
                now.append(row)
                size += 40 + len(row[3] or "")
            if bytes_out >= PIECE_BYTES:
                yield batch_of()
        if now:
            flush(False)  # the next partition may hold its end
        if out:
            yield batch_of()

    return rows.mapInArrow(run, f"conv {kind}, {_PIECE}")


_REPAIRED = (
    "part int, piece long, whole boolean, rows long, first_turn long, last_turn long, different_turns long, blank long, duplicate long, truncated long, "
    "illegal long, cost long, audit string, repaired array<struct<role:string,text:string>>"
)
_REPAIRED_ARROW = [
    ("part", pa.int32()), ("piece", pa.int64()), ("whole", pa.bool_()), *[(n, pa.int64()) for n in ("rows", "first_turn", "last_turn", "different_turns", "blank", "duplicate", "truncated", "illegal", "cost")],
    ("audit", pa.string()), ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
]


def _repair_piece(row: dict) -> tuple:
    """One piece's repair, from the vector after it, the state before it, and the turn and role initial of the row before it."""
    table = tables()
    roles, texts, copies = row["roles"], row["texts"], row["copies"]
    symbols, times, at, faults = elements(roles, texts, copies, set(row.get("repeated") or ()))
    state, vector = row.get("state") or START, row.get("vector") or 0
    letters, state = table.trace(symbols, vector, state)
    if row.get("last", True):
        closing = 0
        while END[state] > 0:
            letters, state, closing = letters + "I", _NEED[state], closing + 1
    audit, repaired, cost, k = [], [], 0, 0
    state = row.get("state") or START
    names = {USER: "user", ASSISTANT: "assistant"}
    for letter in letters:
        if letter == "I":
            state = _NEED[state]
            repaired.append({"role": names[state], "text": ""})
            audit.append("I")
            cost += INSERT
            continue
        role, text = roles[at[k]], texts[at[k]]
        audit.append(letter * times[k])
        if letter == "D":
            cost += DELETE * times[k]
        else:
            cost += CUT * ((symbols[k] - 1) % 2) + REROLE * (letter == "R")
            state = _NEED[state] if letter == "R" else _KEEP[state][role_kind(role)]
            repaired.append({"role": names[state] if letter == "R" else role, "text": text})
        k += 1
    illegal, different, previous, turn = 0, 0, row.get("initial_before"), row.get("turn_before")
    first_turn = last_turn = None
    n_rows = 0
    for role, n, t in zip(roles, copies, row["turns"], strict=True):
        if n <= 0:
            continue
        n_rows += n
        initial = role[:1]
        illegal += n - 1 + (previous is not None and previous + initial not in ("su", "ua", "au"))
        previous = initial
        if t is not None:
            different += t != turn
            turn = t
            first_turn = t if first_turn is None else first_turn
            last_turn = t
    return (n_rows, first_turn, last_turn, different, *faults, illegal, cost, "".join(audit), repaired)


def _repaired(pieces: DataFrame, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            done = [_repair_piece(r) for r in rows]
            columns = [batch.column("conv"), batch.column("part"), batch.column("piece"), batch.column("whole")]
            columns += [pa.array([d[k] for d in done], t) for k, (_, t) in enumerate(_REPAIRED_ARROW[3:])]
            yield pa.RecordBatch.from_arrays(columns, names=["conv", *[n for n, _ in _REPAIRED_ARROW]])

    return pieces.mapInArrow(run, f"conv {kind}, {_REPAIRED}")


def _mark(role: str, text: str, conv: object) -> bytes:
    body = f"{conv!r}\0{len(role)}:{role}{text}"
    return hashlib.blake2b(body.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _seen_before(torn: DataFrame) -> DataFrame:
    """``part, piece, repeated``: places in a piece whose role and text an earlier piece of the conversation has."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                known: set[bytes] = set()
                for k, (role, text, n) in enumerate(zip(row["roles"], row["texts"], row["copies"], strict=True)):
                    if n <= 0 or not text.rstrip(_SPACE):
                        continue
                    mark = _mark(role, text, row["conv"])
                    if mark not in known:
                        known.add(mark)
                        out.append((mark, row["part"], row["piece"], k))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            types = (pa.binary(), pa.int32(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["mark", "part", "piece", "place"])

    light = torn.mapInArrow(marks, "mark binary, part int, piece long, place int")
    here = F.struct("part", "piece", "place")
    firsts = light.groupBy("mark").agg(F.min(here).alias("earliest"), F.count("*").alias("times")).where("times > 1").select("mark", "earliest")
    return lookup_join(light, firsts, ["mark"]).where(here > F.col("earliest")).groupBy("part", "piece").agg(F.collect_list("place").alias("repeated"))


def _streamed(rows: DataFrame, order: list[Column], step: Callable[[], Callable[[object, bool, dict], tuple | None]], names: list[str], types: list[pa.DataType], schema: str) -> DataFrame:
    """One pass over each conversation's rows in order, keeping no more than ``step``'s state; (new conversation, row) gives a row or none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        go, now, began = step(), None, False
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                fresh = not began or row["conv"] != now
                began, now = True, row["conv"]
                out.append(go(fresh, row))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], names=names)

    return rows.repartition(partitions(rows.sparkSession), "conv").sortWithinPartitions("conv", *order).mapInArrow(run, schema)


def _places(torn: DataFrame, kind: str) -> DataFrame:
    """``part, piece, vector, state, last, initial_before, turn_before`` of the pieces of torn conversations.

    Pieces are summed up independently: the vector before a piece for every vector after it, and the state after it for every vector
    and state. Two passes over these short rows then fix the vectors from the end and the states from the beginning.
    """

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tables()
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                symbols, *_ = elements(row["roles"], row["texts"], row["copies"], set(row["repeated"] or ()))
                runs = table.runs(symbols)
                after = np.arange(len(table.vectors))
                ends = [after]
                for code, length in reversed(runs):
                    after = (table.one_array if length == 1 else table.many_array)[after, code]
                    ends.append(after)
                ends.reverse()
                states = []
                for v in range(len(table.vectors)):
                    for state in range(4):
                        for (code, length), vectors in zip(runs, ends[1:], strict=True):
                            state = table.expand(code, length, int(vectors[v]), state)[1]
                        states.append(state)
                there = [(r, t) for r, t, n in zip(row["roles"], row["turns"], row["copies"], strict=True) if n > 0]
                turns = [t for _, t in there if t is not None]
                out.append((row["conv"], row["part"], row["piece"], ends[0].tolist(), states, there[-1][0][:1] if there else None, turns[-1] if turns else None))
            columns = list(zip(*out, strict=True)) if out else [[]] * 7
            types = (batch.schema.field("conv").type, pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["conv", "part", "piece", "vectors", "states", "initial", "turn"])

    def backward() -> Callable:
        vector = 0

        def go(fresh: bool, row: dict) -> tuple:
            nonlocal vector
            after = 0 if fresh else vector
            vector = row["vectors"][after]
            return row["conv"], row["part"], row["piece"], after, fresh, row["states"][4 * after : 4 * after + 4], row["initial"], row["turn"]

        return go

    def forward() -> Callable:
        state, initial, turn = START, None, None

        def go(fresh: bool, row: dict) -> tuple:
            nonlocal state, initial, turn
            if fresh:
                state, initial, turn = START, None, None
            out = row["part"], row["piece"], row["vector"], state, row["last"], initial, turn
            state = row["states"][state]
            initial = initial if row["initial"] is None else row["initial"]
            turn = turn if row["turn"] is None else row["turn"]
            return out

        return go

    arrow = to_arrow_type(torn.schema["conv"].dataType)
    sums = torn.mapInArrow(summary, f"conv {kind}, part int, piece long, vectors array<int>, states array<int>, initial string, turn long")
    ints = pa.list_(pa.int32())
    back = _streamed(
        sums, [F.col("part").desc(), F.col("piece").desc()], backward, ["conv", "part", "piece", "vector", "last", "states", "initial", "turn"],
        [arrow, pa.int32(), pa.int64(), pa.int32(), pa.bool_(), ints, pa.string(), pa.int64()],
        f"conv {kind}, part int, piece long, vector int, last boolean, states array<int>, initial string, turn long",
    )
    return _streamed(
        back, [F.col("part"), F.col("piece")], forward, ["part", "piece", "vector", "state", "last", "initial_before", "turn_before"],
        [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.int64()],
        "part int, piece long, vector int, state int, last boolean, initial_before string, turn_before long",
    )


def repair(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: Column | None = None) -> DataFrame:
    """The pieces of every conversation, repaired: ``conv, part, piece, whole``, counts, ``audit`` and the ``repaired`` rows.

    A conversation's rows go by turn, nulls first, then by role and text; ``copies`` says how often each row is there (0: it is
    not, but its conversation is). Null roles and texts are one space. Pieces hold at most ``PIECE_ROWS`` different rows and about
    ``PIECE_BYTES`` of text and are in order by (part, piece); most conversations are one, and :func:`summaries` joins the rest.
    Edits: keep K, re-role R (2), delete D (3, and the only one for a blank or repeated row), insert I (2); a truncated
    row that stays adds 1. Equal rows are counted before they are dealt out, and long conversations are cut by the ordered exchange, so
    no task holds a conversation. A conversation of a null id is one conversation; other columns of ``rows`` are not read.
    """
    kind = rows.schema[conv].dataType.simpleString()
    there = F.lit(1) if copies is None else copies
    one_space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    counted = (
        rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), one_space(role).alias("role"), one_space(text).alias("text"), there.cast("long").alias("copies"))
        .groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    )
    keys = ["conv", "turn", "role", "text"]
    ordered = counted.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    pieces = written(_pieces(kind, ordered), "pieces")
    torn = pieces.where("not whole")
    torn = written(torn.join(_seen_before(torn), ["part", "piece"], "left").select(*pieces.columns, "repeated"), "torn_pieces")
    placed = torn.join(_places(torn, kind), ["part", "piece"])
    return _repaired(pieces.where("whole"), kind).unionByName(_repaired(placed, kind))


def summaries(repaired: DataFrame) -> DataFrame:
    """One row per conversation of :func:`repair`: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    ``gaps``: turns missing between the first and the last (0 without any). A digest is one chain over a conversation's bytes, so a
    conversation passes through one task piece by piece, and only the running hash and the audit letters are kept.
    """
    kind = repaired.schema["conv"].dataType.simpleString()
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict = {}

        def result(x: dict) -> tuple:
            gaps = x["last"] - x["first"] + 1 - x["different"] if x["first"] is not None else 0
            return (x["conv"], gaps, *x["counts"], "".join(x["audit"]), x["hash"].hexdigest())

        def batch_of(out: list[tuple], arrow: pa.DataType) -> pa.RecordBatch:
            types = [arrow, *[pa.int64()] * 6, pa.string(), pa.string()]
            columns = list(zip(*out, strict=True)) if out else [[]] * 9
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["conv", "gaps", *counts, "audit", "repaired_sha256"])

        arrow = None
        for batch in batches:
            arrow = batch.schema.field("conv").type
            out = []
            for row in batch.to_pylist():
                if not now or row["conv"] != now["conv"]:
                    if now:
                        out.append(result(now))
                    now = {"conv": row["conv"], "first": None, "last": None, "different": 0, "counts": [0] * 5, "audit": [], "hash": hashlib.sha256(), "lines": 0}
                now["first"] = row["first_turn"] if now["first"] is None else now["first"]
                now["last"] = now["last"] if row["last_turn"] is None else row["last_turn"]
                now["different"] += row["different_turns"]
                now["counts"] = [a + row[c] for a, c in zip(now["counts"], counts, strict=True)]
                now["audit"].append(row["audit"])
                for line in row["repaired"]:
                    now["hash"].update((("\n" if now["lines"] else "") + f"{line['role']}:{line['text']}").encode("utf-8", "surrogatepass"))
                    now["lines"] += 1
            yield batch_of(out, arrow)
        if now:
            yield batch_of([result(now)], arrow)

    schema = f"conv {kind}, gaps long, {', '.join(f'{c} long' for c in counts)}, audit string, repaired_sha256 string"
    whole = repaired.where("whole").mapInArrow(run, schema)
    torn = repaired.where("not whole").repartition(partitions(repaired.sparkSession), "conv").sortWithinPartitions("conv", "part", "piece").mapInArrow(run, schema)
    return whole.unionByName(torn)
