"""Conversation structure repair by a run-length min-plus dynamic program.

A legal conversation's role initials read `(s?(ua)+)?`.  The automaton of that form has four states;
a row, with the edits allowed for it and any insertions before it, is a 4 x 4 matrix of edit costs in
the min-plus algebra.  Equal neighbouring rows (same initial, same fault) are one run, and a run of
k rows is passed in log k steps through cached powers of its matrix.  Costs come from the end of the
conversation to its start; the edits are then unrolled from the start, always the ASCII-least one that
stays cheapest.

Edits: K keeps a row (0), R makes it a user's or assistant's row (2), D deletes it (3, required for
blank and duplicate rows), I inserts an empty user or assistant row (2); a truncated row that is not
deleted adds 1.

Conversations are cut into bounded pieces dealt over all tasks.  A piece's matrix is the product of its
runs, so costs of a very long conversation are worked out piece by piece.  Only its edits and its
digest, which are one sequence by definition, are streamed in one task, piece after piece.

Defined cases: null texts and roles are one space (a blank row; a role that is none of the three); a
null conv_id is a conversation; null turns come first and are left out of the gaps; turns that tie are
ordered by role and text; repeated rows are duplicates; roles count by their first character, so an empty
one has none; a conversation without rows has zeros, no edits and the digest of an empty string; gaps
beyond 64 bits are held at the largest value; an empty table gives no rows; further columns of the
input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm import common, turns

_INF = 1 << 60
_LARGEST = (1 << 63) - 1
WHITE = " \t\n\v\f\r"
#: Automaton: 0 nothing yet, 1 behind the system row, 2 behind a user's, 3 behind an assistant's row.
_STATES = range(4)
_KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEXT = (2, 2, 3, 2)
_NEW_ROLE = ("user", "user", "assistant", "user")
#: Cost of the insertions that finish a conversation in each state.
_FINAL = (0, 4, 2, 0)
#: Symbols of a row: initial, then what is wrong with it.
_FINE, _DELETE, _CUT = "f", "d", "c"
_LEGAL = {"su", "ua", "au"}


def _product(a, b):
    return tuple(tuple(min(a[i][k] + b[k][j] for k in _STATES) for j in _STATES) for i in _STATES)


def _applied(matrix, vector):
    return tuple(min(matrix[i][j] + vector[j] for j in _STATES) for i in _STATES)


_SAME = tuple(tuple(0 if i == j else _INF for j in _STATES) for i in _STATES)
_ONE_INSERT = tuple(tuple(0 if i == j else 2 if j == _NEXT[i] else _INF for j in _STATES) for i in _STATES)
_INSERTS = _product(_product(_ONE_INSERT, _ONE_INSERT), _ONE_INSERT)


def _edits(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, state behind it) of a row in a state, ASCII-least first."""
    initial, fault = symbol[0], symbol[1]
    found = [("D", 3, state)]
    if fault != _DELETE:
        extra = int(fault == _CUT)
        if (state, initial) in _KEPT:
            found.append(("K", extra, _KEPT[state, initial]))
        found.append(("R", 2 + extra, _NEXT[state]))
    return found


@lru_cache(maxsize=None)
def _steps(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """The edits of a row and the insertion before it, ASCII-least first."""
    own = _edits(symbol, state)
    return [own[0], ("I", 2, _NEXT[state]), *own[1:]]


@lru_cache(maxsize=None)
def _power(symbol: str, doublings: int):
    """Matrix of 2^doublings rows of a symbol."""
    if doublings:
        half = _power(symbol, doublings - 1)
        return _product(half, half)
    row = [[_INF] * 4 for _ in _STATES]
    for i in _STATES:
        for _, cost, j in _edits(symbol, i):
            row[i][j] = min(row[i][j], cost)
    return _product(_INSERTS, row)


def _powers(symbol: str, times: int):
    return [_power(symbol, b) for b in range(times.bit_length()) if times >> b & 1]


def runs(symbols: list[str]) -> list[tuple[str, int]]:
    return [(s, len(list(own))) for s, own in groupby(symbols)]


def matrix(symbols: list[str]):
    """Costs from each state before some rows to each state behind them."""
    whole = _SAME
    for symbol, times in runs(symbols):
        for power in _powers(symbol, times):
            whole = _product(whole, power)
    return whole


def unroll(symbols: list[str], state: int, after: tuple[int, ...], last: bool) -> tuple[str, int]:
    """(cheapest edits, ASCII-least, state behind them); `after` are the costs behind the rows."""
    passed, ends = runs(symbols), [after]
    for symbol, times in reversed(passed):
        vector = ends[-1]
        for power in _powers(symbol, times):
            vector = _applied(power, vector)
        ends.append(vector)
    ends.pop()
    edits = []
    for symbol, times in passed:
        inner = [ends.pop()]
        one = _power(symbol, 0)
        for _ in range(times):
            inner.append(_applied(one, inner[-1]))
        for left in range(times, 0, -1):
            here, behind = inner[left], inner[left - 1]
            while True:
                edit, state = next(((e, j) for e, cost, j in _steps(symbol, state) if cost + (here if e == "I" else behind)[j] == here[state]))
                edits.append(edit)
                if edit != "I":
                    break
    while last and _FINAL[state]:
        edits.append("I")
        state = _NEXT[state]
    return "".join(edits), state


def _mark(conv, role: str, text: str) -> bytes:
    return hashlib.sha256(f"{conv!r}:{len(role)}:{role}{text}".encode()).digest()


def symbols_of(roles: list[str], texts: list[str], conv=None, before=()) -> list[str]:
    """One symbol a row: its role's initial and its first fault (b blank, d duplicate, c truncated)."""
    found, seen, earlier = [], set(), set(before or ())
    for role, text in zip(roles, texts, strict=True):
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        stripped = text.strip(WHITE)
        if not stripped:
            fault = "b"
        elif (role, text) in seen or (earlier and _mark(conv, role, text) in earlier):
            fault = "d"
        else:
            fault = _FINE if stripped[-1] in ".!?" else _CUT
        seen.add((role, text))
        found.append(initial + fault)
    return found


def _cost_symbols(found: list[str]) -> list[str]:
    return [s[0] + (_DELETE if s[1] in "bd" else s[1]) for s in found]


class Mender:
    """Takes a conversation's pieces in order and gives the repaired rows of each and, at last, the report."""

    def __init__(self, conv):
        self.conv, self.state, self.cost = conv, 0, None
        self.faults = {"b": 0, "d": 0, "c": 0}
        self.illegal = self.turns = 0
        self.low = self.high = self.initial = None
        self.audit: list[str] = []
        self.digest, self.any_row = hashlib.sha256(), False

    def piece(self, numbers, roles, texts, before, after, last: bool) -> tuple[list[str], list[str]]:
        found = symbols_of(roles, texts, self.conv, before)
        for s in found:
            if s[1] in self.faults:
                self.faults[s[1]] += 1
        for role in roles:
            if self.initial is not None and self.initial + role[:1] not in _LEGAL:
                self.illegal += 1
            self.initial = role[:1]
        for number in numbers:
            if number is not None and number != self.high:
                self.turns += 1
                self.low = number if self.low is None else self.low
                self.high = number
        symbols = _cost_symbols(found)
        after = _FINAL if after is None else tuple(after)
        if self.cost is None:
            self.cost = _applied(matrix(symbols), after)[0]
        edits, end = unroll(symbols, self.state, after, last)
        mended = self._mended(edits, roles, texts)
        self.state = end
        self.audit.append(edits)
        return mended

    def _mended(self, edits: str, roles, texts) -> tuple[list[str], list[str]]:
        state, at, new_roles, new_texts = self.state, 0, [], []
        for edit in edits:
            if edit in "IR":
                role, state = _NEW_ROLE[state], _NEXT[state]
            elif edit == "K":
                role = roles[at]
                state = _KEPT[state, role[:1]]
            if edit != "D":
                text = "" if edit == "I" else texts[at]
                new_roles.append(role)
                new_texts.append(text)
                self.digest.update((("\n" if self.any_row else "") + f"{role}:{text}").encode())
                self.any_row = True
            at += edit != "I"
        return new_roles, new_texts

    def report(self) -> tuple:
        gaps = 0 if self.low is None else min(_LARGEST, self.high - self.low + 1 - self.turns)
        return (gaps, self.faults["b"], self.faults["d"], self.faults["c"], self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


REPORT = [
    *((n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
    ("audit", T.StringType()),
    ("repaired_sha256", T.StringType()),
]


def _forward(schema: T.StructType):
    """Pieces sorted by conversation and place -> repaired pieces; the report stands in the last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes: list[int] = []

        def mended() -> Iterator[tuple]:
            current = None
            for conv, numbers, roles, texts, before, after, last in turns.rows_of(batches):
                current = current or Mender(conv)
                kept = current.piece(numbers, roles, texts, before, after, last)
                sizes.append(64 + sum(map(len, kept[1])))
                if last:
                    row = (conv, True, *kept, *current.report())
                    current = None
                else:
                    row = (conv, False, *kept, *(None for _ in REPORT))
                yield row

        def taken() -> Iterator[int]:
            while True:
                yield sizes.pop()

        return turns.batched(mended(), schema, taken())

    return run


def _with_earlier(split: DataFrame) -> DataFrame:
    """Split pieces with `before`: marks of their rows that an earlier piece of the conversation holds."""
    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("mark", T.BinaryType())])

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def own() -> Iterator[tuple]:
            for conv, part, seq, roles, texts in turns.rows_of(batches):
                for mark in {_mark(conv, r, t) for r, t in zip(roles, texts, strict=True)}:
                    yield part, seq, mark

        return turns.batched(own(), schema)

    marked = split.select("conv_id", "part", "seq", "roles", "texts").mapInArrow(marks, schema)
    place = F.struct("part", "seq")
    firsts = marked.groupBy("mark").agg(F.min(place).alias("first"), F.max(place).alias("final")).where(F.col("first") < F.col("final"))
    later = marked.join(firsts, "mark").where(place > F.col("first")).groupBy("part", "seq").agg(F.collect_list("mark").alias("before"))
    return split.join(later, ["part", "seq"], "left")


def _with_costs(split: DataFrame, conv_type: T.DataType) -> DataFrame:
    """Split pieces with `after`, the costs behind them, and whether they are the last of their conversation."""
    place = [T.StructField("part", T.LongType()), T.StructField("seq", T.LongType())]
    costs = T.ArrayType(T.LongType())
    light = T.StructType([T.StructField("conv_id", conv_type), *place, T.StructField("matrix", costs)])
    ended = T.StructType([*place, T.StructField("after", costs), T.StructField("last", T.BooleanType())])

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def own() -> Iterator[tuple]:
            for conv, part, seq, roles, texts, before in turns.rows_of(batches):
                whole = matrix(_cost_symbols(symbols_of(roles, texts, conv, before)))
                yield conv, part, seq, [c for line in whole for c in line]

        return turns.batched(own(), light)

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def own() -> Iterator[tuple]:
            begun, current, after = False, None, _FINAL
            for conv, part, seq, flat in turns.rows_of(batches):
                last = not begun or conv != current
                after = _FINAL if last else after
                yield part, seq, list(after), last
                begun, current = True, conv
                after = _applied([flat[i : i + 4] for i in range(0, 16, 4)], after)

        return turns.batched(own(), ended)

    found = split.select("conv_id", "part", "seq", "roles", "texts", "before").mapInArrow(matrices, light)
    ordered = found.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq"))
    return split.join(ordered.mapInArrow(backward, ended), ["part", "seq"])


def repair(rows: DataFrame, piece_rows: int = turns.PIECE_ROWS) -> DataFrame:
    """Repaired conversations of (conv_id, turn, role, text, gone).

    One row per piece of a conversation, nearly always one per conversation: conv_id, last, roles and
    texts of the repaired rows, and in the last piece gaps, blank, duplicate, truncated, illegal (all
    counted before the repair), cost, audit and repaired_sha256.
    """
    own = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "gone",
    )
    conv_type = rows.schema["conv_id"].dataType
    cut = turns.pieces(own, piece_rows)
    schema = T.StructType(
        [T.StructField("conv_id", conv_type), T.StructField("last", T.BooleanType())]
        + [T.StructField(n, T.ArrayType(T.StringType())) for n in ("roles", "texts")]
        + [T.StructField(n, t) for n, t in REPORT]
    )
    wanted = ["conv_id", "turns", "roles", "texts", "before", "after", "last"]
    nothing = [F.lit(None).cast("array<binary>").alias("before"), F.lit(None).cast("array<bigint>").alias("after"), F.lit(True).alias("last")]
    whole = cut.where("whole").select("conv_id", "turns", "roles", "texts", *nothing)
    split = _with_costs(common.stored(_with_earlier(cut.where("NOT whole").drop("whole")), "split-pieces"), conv_type)
    ordered = split.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").select(*wanted)
    return whole.mapInArrow(_forward(schema), schema).unionByName(ordered.mapInArrow(_forward(schema), schema))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows damaged by the CRC of `conv_id:turn` modulo 20: 0 gone, 1 emptied, 2 without `.!?`, 3 twice, 4 a user's."""
    spelled = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(spelled.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    changed = rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"), F.when(kind == 3, 2).otherwise(1).alias("times"),
    )
    return changed.withColumn("time", F.explode(F.sequence(F.lit(1), "times"))).drop("time", "times")
