"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn and then user and assistant turns in
alternation, ending with the assistant.  Dynamic programming over this automaton finds the
cheapest way to make a conversation legal: a turn is kept, merged into the turn before it,
relabelled, or preceded by empty turns.

A step of the automaton is a table of least costs between its states, and such tables
combine associatively (minimum of sums).  The turns are stored in their order, and what a
scan task meets of a conversation in one stretch is a run: it is reduced to one row with
its roles, a byte each, and its table.  The tables of a conversation are combined to the
states between its runs, each run is repaired on its own, and the choices join the turns by
their number, so that texts never leave the JVM.  One conversation with a third of all turns
is many runs, and the repaired turns come as rows, a merged turn as several, so nothing has
to hold a conversation whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

ROLES = ("system", "user", "assistant")
#: Other names of roles (fixed values).
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)
_LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
_NONE = 1 << 40


@dataclass(frozen=True)
class Costs:
    merge: int = 2  # two neighbouring turns of a role
    insert: int = 5  # an empty turn
    relabel: int = 7
    name: int = 3  # a turn of an unknown role


def _insertions() -> tuple[np.ndarray, list[list[tuple[int, ...]]]]:
    """Least numbers of turns between two states and the turns themselves."""
    least = np.full((4, 4), _NONE, dtype=np.int64)
    paths: list[list[tuple[int, ...]]] = [[() for _ in range(4)] for _ in range(4)]
    for state in range(4):
        least[state, state] = 0
        front = [(state, ())]
        while front:
            following = []
            for at, path in front:
                for nxt in _LEGAL[at]:
                    if least[state, nxt] == _NONE:
                        least[state, nxt] = len(path) + 1
                        paths[state][nxt] = (*path, nxt)
                        following.append((nxt, (*path, nxt)))
            front = following
    return least, paths


class RoleRepair:
    """Least costs and choices of one step, for each role a turn may have (0: unknown)."""

    def __init__(self, costs: Costs = Costs()):
        between, self.paths = _insertions()
        self.step = np.full((4, 4, 4), _NONE, dtype=np.int64)
        self.choice: dict[tuple[int, int, int], tuple[str, tuple[int, ...]]] = {}
        for role in range(4):
            for state in range(4):
                for new in (SYSTEM, USER, ASSISTANT):
                    label = 0 if new == role else costs.relabel if role else costs.name
                    options = [
                        (costs.insert * int(between[state, at]) + label, len(self.paths[state][at]), at)
                        for at in range(4)
                        if new in _LEGAL[at] and between[state, at] < _NONE
                    ]
                    best = min(options, default=None)
                    if new == state:
                        merged = costs.merge + label
                        if best is None or merged <= best[0]:
                            self.step[role, state, new] = merged
                            self.choice[role, state, new] = "merge", ()
                            continue
                    if best is not None:
                        self.step[role, state, new] = best[0]
                        kind = "keep" if new == role else "relabel"
                        self.choice[role, state, new] = kind, self.paths[state][best[2]]
        self.end = np.minimum(costs.insert * between[:, ASSISTANT], _NONE)
        self.end[START] = 0

    def table(self, roles: bytes) -> np.ndarray:
        """Least costs between the states before and after a run."""
        total = np.where(np.eye(4, dtype=bool), 0, _NONE)
        for role in roles:
            total = self.join(total, self.step[role])
        return total

    @staticmethod
    def join(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return np.minimum((first[:, :, None] + second[None, :, :]).min(axis=1), _NONE)

    def borders(self, tables: list[list[int]]) -> list[int]:
        """States before, between and after the runs of a conversation, the cheapest legal way."""
        steps = [np.array(table).reshape(4, 4) for table in tables]
        costs = [np.where(np.arange(4) == START, 0, _NONE)]
        for step in steps:
            costs.append(np.minimum((costs[-1][:, None] + step).min(axis=0), _NONE))
        states = [int(np.argmin(costs[-1] + self.end))]
        for cost, step in zip(costs[-2::-1], steps[::-1]):
            states.append(int(np.argmin(cost + step[:, states[-1]])))
        return states[::-1]

    def codes(self, roles: bytes, begin: int, end: int) -> bytes:
        """The cheapest step of each turn of a run between two states (see ``code``)."""
        steps = self.step.tolist()
        costs, came = [0 if state == begin else _NONE for state in range(4)], []
        for role in roles:
            step = steps[role]
            ways = [min((costs[old] + step[old][new], old) for old in range(4)) for new in range(4)]
            costs = [min(cost, _NONE) for cost, _ in ways]
            came.append(bytes(old for _, old in ways))
        found, new = bytearray(len(roles)), end
        for i in range(len(roles) - 1, -1, -1):
            old = came[i][new]
            found[i], new = code(roles[i], old, new), old
        return bytes(found)


def code(role: int, old: int, new: int) -> int:
    """One number for the role a turn has and the states before and after it."""
    return 16 * role + 4 * old + new


def role_number(role: Column) -> Column:
    """1 to 3 for a role or an alias of one in any case, else 0."""
    name = F.lower(F.trim(F.coalesce(role, F.lit(""))))
    chain = F
    for i, known in enumerate(ROLES):
        names = [known, *(alias for alias, of in ALIASES.items() if of == known)]
        chain = chain.when(name.isin(names), F.lit(i + 1))
    return chain.otherwise(F.lit(0))


def _ordered(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Turns in their order, which ``nr`` counts; without gaps within a file."""
    conv = F.col(conv_col).cast("string")
    rows = turns.select(
        F.coalesce(F.concat(F.lit("="), conv), F.lit("")).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.col(text_col).alias("text"),
        role_number(F.col(role_col)).alias("role"),
        # Range partitioning brings a sample of its keys to the driver: no texts among them.
        F.xxhash64(text_col).alias("hash"),
        # Equal rows are interchangeable; this only lets very many of them be cut.
        F.monotonically_increasing_id().alias("nr"),
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_last(), F.col("role"), F.col("hash"), F.col("nr")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("hash")
    return placed.withColumn("nr", F.monotonically_increasing_id())


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], size: int = 5_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of ``size`` rows of an iterator."""
    schema, held = pa.schema(list(zip(names, types))), []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()


def _runs(rows: DataFrame, machine: RoleRepair) -> DataFrame:
    """One row for each run: ``first`` number, ``roles`` by a byte each, table of ``costs``."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        short = lru_cache(50_000)(lambda roles: machine.table(roles).ravel().tolist())
        in_run, first, roles = None, 0, bytearray()

        def closed() -> tuple:
            whole = bytes(roles)
            return in_run, first, whole, short(whole) if len(whole) <= 32 else short.__wrapped__(whole)

        for conv, nr, role in _records(batches):
            if conv != in_run or nr != first + len(roles):
                if in_run is not None:
                    yield closed()
                in_run, first, roles = conv, nr, bytearray()
            roles.append(role)
        if in_run is not None:
            yield closed()

    names = ["conv", "first", "roles", "costs"]
    types = [pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    return rows.select("conv", "nr", "role").mapInArrow(
        lambda batches: _batches(found(batches), names, types), "conv string, first long, roles binary, costs array<long>"
    )


def _borders(runs: DataFrame, machine: RoleRepair) -> DataFrame:
    """States that the cheapest repair has before and after each run of a conversation."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        alone = lru_cache(50_000)(lambda costs: machine.borders([costs]))
        for _, group in groupby(_records(batches), itemgetter(0)):
            held = list(group)
            states = alone(tuple(held[0][3])) if len(held) == 1 else machine.borders([r[3] for r in held])
            before = 0
            for i, (_, first, n, _) in enumerate(held):
                yield first, states[i], states[i + 1], before, i == len(held) - 1
                before += n

    names = ["first", "enters", "leaves", "before", "ends"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()]
    return (
        runs.select("conv", "first", F.octet_length("roles").alias("n"), "costs")
        .repartition("conv")
        .sortWithinPartitions("conv", "first")
        .mapInArrow(
            lambda batches: _batches(found(batches), names, types),
            "first long, enters int, leaves int, before long, ends boolean",
        )
    )


def _choices(runs: DataFrame, machine: RoleRepair, size: int = 50_000) -> DataFrame:
    """The step of each turn: ``nr``, ``place`` in its conversation, ``code``, whether it ``ends`` that."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, held, n = lru_cache(50_000)(machine.codes), [], 0

        def batch() -> pa.RecordBatch:
            counts = [len(steps) for steps, *_ in held]
            last = np.cumsum(counts) - 1
            within = np.arange(last[-1] + 1) - np.repeat(last + 1 - counts, counts)
            ends = np.zeros(len(within), dtype=bool)
            ends[last] = [row[3] for row in held]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([row[1] for row in held], counts) + within),
                    pa.array(np.repeat([row[2] for row in held], counts) + within),
                    pa.array(np.frombuffer(b"".join(row[0] for row in held), dtype=np.uint8).astype(np.int32)),
                    pa.array(ends),
                ],
                names=["nr", "place", "code", "ends"],
            )

        for first, roles, enters, leaves, before, ends in _records(batches):
            steps = (short if len(roles) <= 32 else machine.codes)(roles, enters, leaves)
            for start in range(0, len(steps), size):
                piece = steps[start : start + size]
                held.append((piece, first + start, before + start, ends and start + size >= len(steps)))
                n += len(piece)
                if n >= size:
                    yield batch()
                    held, n = [], 0
        if held:
            yield batch()

    return (
        runs.select("first", "roles")
        .join(_borders(runs, machine), "first")
        .select("first", "roles", "enters", "leaves", "before", "ends")
        .mapInArrow(chosen, "nr long, place long, code int, ends boolean")
    )


def _parts(machine: RoleRepair, costs: Costs, opening: str, closing: str) -> list[tuple]:
    """What becomes of a turn by ``code`` and ``ends``, a row for itself and each turn inserted."""
    out = []
    for (role, old, new), (action, inserted) in machine.choice.items():
        for ends in (False, True):
            rows, first = [], old == START
            for state in inserted:
                name = ROLES[state - 1]
                head = ("" if first else closing) + opening.format(role=name)
                rows.append((False, name, "insert", costs.insert, head))
                first = False
            name = ROLES[new - 1]
            head = "\n" if action == "merge" else ("" if first else closing) + opening.format(role=name)
            cost = int(machine.step[role, old, new]) - costs.insert * len(inserted)
            rows.append((True, name, action, cost, head))
            for state in machine.paths[new][ASSISTANT] if ends else ():
                name = ROLES[state - 1]
                rows.append((False, name, "insert", costs.insert, closing + opening.format(role=name)))
            for part, row in enumerate(rows):
                tail = closing if ends and part == len(rows) - 1 else ""
                out.append((code(role, old, new), ends, part, *row, tail))
    return out


def repair(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    costs: Costs = Costs(),
    template: tuple[str, str] = ("<|im_start|>{role}\n", "<|im_end|>\n"),
) -> DataFrame:
    """The repaired conversations, one row for each turn given or inserted.

    ``place`` counts the turns given of a conversation from 0 and ``part`` the rows of one
    place: empty turns inserted before it, itself, and after the last place a turn that
    was missing at the end.  ``action`` is keep, merge (goes on with the turn before),
    relabel or insert, ``role`` that of the repaired turn, ``turn`` the number given (null
    if inserted) and ``cost`` what the row costs.  ``rendered``, joined in order of place
    and part, is the formatted conversation.

    Turns stand in order of their numbers, null last, those of equal numbers by role and
    hash of the text; equal rows are all kept.  Null and unfamiliar roles are unknown, null
    texts are empty, null conversations are one conversation of their own.  Other columns
    are not read; an empty table gives an empty table.
    """
    machine = RoleRepair(costs)
    conv_type = turns.schema[conv_col].dataType
    rows = stored(_ordered(turns, conv_col, turn_col, role_col, text_col), "turns")
    runs = stored(_runs(rows, machine), "runs")
    # At most 128 pairs of code and ends, whatever the input.
    parts = turns.sparkSession.createDataFrame(
        _parts(machine, costs, *template),
        "code int, ends boolean, part int, given boolean, role string, action string, cost long, head string, tail string",
    )
    result = rows.drop("role").join(_choices(runs, machine), "nr").join(F.broadcast(parts), ["code", "ends"])
    conv_id = F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).cast(conv_type)
    text = F.when(F.col("given"), F.coalesce("text", F.lit(""))).otherwise("")
    return result.select(
        conv_id.alias("conv_id"), "place", "part", F.when(F.col("given"), F.col("turn")).alias("turn"),
        "role", "action", "cost", F.concat("head", text, "tail").alias("rendered"),
    )
