"""Cheapest repair of conversations to the form ``(s?(ua)+)?``, by a run-length DP.

A row is reduced to a symbol: the class of its role and of its first fault. Edits move through
four states (nothing yet, after system, after user, after assistant), so a symbol is a 4 x 4
matrix of costs, and rows in sequence are a product in the min-plus algebra. Equal consecutive
symbols are a run, which advances by the cached binary powers of its symbol's matrix.

A conversation is cut into blocks of ``BLOCK`` rows. Blocks become matrices in parallel, the
matrices of a conversation are folded from its end as narrow rows that stream by, and the last
pass reads the texts in order once, unrolling each block's choices as it comes: halves of a power
are unrolled with the cost that follows them, equal halves from a cache. Only one block's choices
are held there. That pass is per conversation, since the digest of a repaired conversation is one
hash over all its text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from turnwise.llm.ranks import rank_rows
from turnwise.llm.text import release_memory
from turnwise.session import landed

BLOCK = 1 << 16
NEVER = 1 << 60

# States, and where the next user or assistant leads: nothing yet, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
# Costs of the contract.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
# A symbol is a role class plus four times a fault class.
SYSTEM_ROLE, USER_ROLE, ASSISTANT_ROLE, OTHER_ROLE = range(4)
CLEAN, CUT, GONE = range(3)
# What follows the last row: inserts up to an accepted state.
END = (0, 2 * INSERT, INSERT, 0)

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]


def _kept_in(role: int, state: int) -> int | None:
    """The state after keeping a row of this role class, if it may be kept there."""
    if role == SYSTEM_ROLE:
        return SYSTEM if state == START else None
    wanted = {USER_ROLE: USER, ASSISTANT_ROLE: ASSISTANT}.get(role)
    return NEXT[state] if NEXT[state] == wanted else None


def _moves(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits that use up one row, by initial."""
    role, fault = symbol % 4, symbol // 4
    moves = [("D", DELETE, state)]
    if fault != GONE:
        more = TRUNCATED if fault == CUT else 0
        kept = _kept_in(role, state)
        if kept is not None:
            moves.append(("K", more, kept))
        moves.append(("R", more + REROLE, NEXT[state]))
    return moves


def before_row(symbol: int, after: Vector) -> Vector:
    """Cheapest cost from each state before a row, given the costs after it; inserts may come first."""
    plain = [min(cost + after[to] for _, cost, to in _moves(symbol, s)) for s in range(4)]
    # Two inserts at most: a third only comes back to where the first one led.
    return tuple(min(plain[s], INSERT + plain[NEXT[s]], 2 * INSERT + plain[NEXT[NEXT[s]]]) for s in range(4))


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(row[k] + v[k] for k in range(4)) for row in a)


IDENTITY: Matrix = tuple(tuple(0 if i == j else NEVER for j in range(4)) for i in range(4))


@lru_cache(maxsize=None)
def binary_power(symbol: int, k: int) -> Matrix:
    """The matrix of 2^k rows of a symbol."""
    if k:
        half = binary_power(symbol, k - 1)
        return times(half, half)
    columns = [before_row(symbol, tuple(0 if i == j else NEVER for i in range(4))) for j in range(4)]
    return tuple(tuple(min(columns[j][i], NEVER) for j in range(4)) for i in range(4))


def _bits(length: int) -> list[int]:
    return [k for k in range(length.bit_length()) if length >> k & 1]


def run_matrix(symbol: int, length: int) -> Matrix:
    out = IDENTITY
    for k in _bits(length):
        out = times(out, binary_power(symbol, k))
    return out


@lru_cache(maxsize=1 << 16)
def _unrolled(symbol: int, k: int, state: int, after: Vector) -> tuple[str, int]:
    """(audit, state after) of 2^k rows of a symbol, ASCII-least among the cheapest."""
    if k:
        half = binary_power(symbol, k - 1)
        first, state = _unrolled(symbol, k - 1, state, _level(apply(half, after)))
        second, state = _unrolled(symbol, k - 1, state, after)
        return first + second, state
    best, audit = before_row(symbol, after), ""
    while True:
        choices = [(name, to) for name, cost, to in _moves(symbol, state) if cost + after[to] == best[state]]
        if INSERT + best[NEXT[state]] == best[state]:
            choices.append(("I", None))
        name, to = min(choices, key=lambda c: c[0])
        audit += name
        if name != "I":
            return audit, to
        state = NEXT[state]


def _level(v: Vector) -> Vector:
    """The same differences with the least at zero, so equal situations are one in the cache."""
    low = min(v)
    return tuple(x - low for x in v)


def unroll(runs: list[tuple[int, int]], state: int, after: Vector) -> tuple[str, int]:
    """(audit, state after) of runs (symbol, length), given the costs that follow them."""
    # From the end: the costs after each binary piece of each run.
    pieces = []
    for symbol, length in reversed(runs):
        for k in _bits(length):
            pieces.append((symbol, k, _level(after)))
            after = apply(binary_power(symbol, k), after)
    out = []
    for symbol, k, follows in reversed(pieces):
        audit, state = _unrolled(symbol, k, state, follows)
        out.append(audit)
    return "".join(out), state


def closing(state: int) -> str:
    """Inserts after the last row."""
    return "I" * (END[state] // INSERT)


BLANKS = "\t\n\x0b\x0c\r "


def with_symbols(rows: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(rows with pos, block, role, text; symbols (conv, block, pos, role class, fault) of the same).

    A row's first fault counts: blank (1), role and text seen earlier in its conversation (2), last
    character that is no blank not of ``.!?`` (3), else 0.
    """
    rows = rows.select("conv", F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col("text"), F.lit(" ")).alias("text"))
    rows = rows.withColumn("_digest", F.unhex(F.sha2("text", 256)))
    placed, _ = rank_rows(rows, "conv", ["turn", "role", "_digest"], label)
    placed = placed.withColumn("block", F.floor(F.col("pos") / F.lit(BLOCK)))
    bare = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    role = (F.when(initial == "s", SYSTEM_ROLE).when(initial == "u", USER_ROLE).when(initial == "a", ASSISTANT_ROLE).otherwise(OTHER_ROLE))
    flat = landed(rows.sparkSession, placed.select(
        "conv", "block", "pos", role.alias("role_class"), (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", F.hex("_digest")), 256)).alias("same")), f"{label}-flags")
    first = flat.groupBy("conv", "same").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("conv", "same", "first")
    fault = (F.when(F.col("blank"), 1).when(F.col("pos") > F.col("first"), 2).when(F.col("cut"), 3).otherwise(0))
    marked = flat.join(first.hint("merge"), ["conv", "same"], "left").select("conv", "block", "pos", "role_class", fault.alias("fault"))
    return placed.select("conv", "block", "pos", "turn", "role", "text"), marked


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows of equal leading ``keys`` columns, from batches sorted by them."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        names = list(zip(*[batch.column(i).to_pylist() for i in range(keys)]))
        at = 0
        for k in range(len(names)):
            if names[k] != last:
                if k > at:
                    waiting.append(batch.slice(at, k - at))
                if waiting:
                    yield last, pa.Table.from_batches(waiting)
                waiting, at, last = [], k, names[k]
        if len(names) > at:
            waiting.append(batch.slice(at))
    if waiting:
        yield last, pa.Table.from_batches(waiting)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of symbols sorted by (conv, block, pos): one row per block with its runs and matrix."""
    out: list[dict] = []
    for (conv, block), rows in _grouped(batches, 2):
        roles, faults = rows.column("role_class").to_numpy(), rows.column("fault").to_numpy()
        symbols = roles + 4 * np.array([CLEAN, GONE, GONE, CUT])[faults]
        begins = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
        runs = list(zip(symbols[begins].tolist(), np.diff(np.r_[begins, len(symbols)]).tolist()))
        matrix = IDENTITY
        for symbol, length in runs:
            matrix = times(matrix, run_matrix(symbol, length))
        pairs = roles[:-1] * 4 + roles[1:]
        fine = np.isin(pairs, [SYSTEM_ROLE * 4 + USER_ROLE, USER_ROLE * 4 + ASSISTANT_ROLE, ASSISTANT_ROLE * 4 + USER_ROLE])
        out.append({"conv": conv, "block": block, "symbols": [r[0] for r in runs], "lengths": [r[1] for r in runs],
                    "matrix": [min(x, NEVER) for row in matrix for x in row], "blank": int((faults == 1).sum()), "duplicate": int((faults == 2).sum()),
                    "truncated": int((faults == 3).sum()), "illegal": int((~fine).sum()), "first": int(roles[0]), "last": int(roles[-1])})
        if len(out) >= 500:
            yield pa.RecordBatch.from_pylist(out, schema=BLOCK_SCHEMA)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=BLOCK_SCHEMA)


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
BLOCK_SCHEMA = pa.schema([("conv", pa.string()), ("block", pa.int64()), ("symbols", pa.list_(pa.int32())), ("lengths", pa.list_(pa.int32())),
                          ("matrix", pa.list_(pa.int64())), *[(c, pa.int64()) for c in _COUNTS], ("first", pa.int32()), ("last", pa.int32())])
BLOCK_DDL = ("conv string, block bigint, symbols array<int>, lengths array<int>, matrix array<bigint>, "
             "blank bigint, duplicate bigint, truncated bigint, illegal bigint, first int, last int")


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (conv, block, matrix, first, last) sorted by conv and block from the last: what follows each block.

    ``before`` are the costs before the block, ``seam`` whether its last role and the next
    block's first are an illegal pair.
    """
    conv, after, first = None, END, None
    legal = {(SYSTEM_ROLE, USER_ROLE), (USER_ROLE, ASSISTANT_ROLE), (ASSISTANT_ROLE, USER_ROLE)}
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["conv"] != conv:
                conv, after, first = row["conv"], END, None
            m = row["matrix"]
            before = tuple(min(x, NEVER) for x in apply(tuple(tuple(m[4 * i:4 * i + 4]) for i in range(4)), after))
            out.append({"conv": conv, "block": row["block"], "after": list(after), "cost": before[START],
                        "seam": int(first is not None and (row["last"], first) not in legal)})
            after, first = before, row["first"]
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
            ("conv", pa.string()), ("block", pa.int64()), ("after", pa.list_(pa.int64())), ("cost", pa.int64()), ("seam", pa.int64())]))


class _Conversation:
    """Edits of one conversation as its blocks and rows stream by."""

    def __init__(self, conv: str):
        self.conv, self.state, self.audits = conv, START, []
        self.digest, self.lines, self.edits, self.at, self.place = hashlib.sha256(), 0, "", 0, START

    def enter(self, symbols: list[int], lengths: list[int], after: list[int]) -> None:
        """A new block; its rows follow."""
        self.edits, self.state = unroll(list(zip(symbols, lengths)), self.state, tuple(after))
        self.audits.append(self.edits)
        self.at = 0

    def _say(self, role: str, text: str) -> tuple[int, str, str]:
        line = ("\n" if self.lines else "") + role + ":" + text
        self.digest.update(line.encode("utf-8", "surrogatepass"))
        self.lines += 1
        return self.lines - 1, role, text

    def _inserted(self, edits: str) -> Iterator[tuple[int, str, str]]:
        while self.at < len(edits) and edits[self.at] == "I":
            self.place = NEXT[self.place]
            yield self._say(ROLE_OF[self.place], "")
            self.at += 1

    def row(self, role: str, text: str) -> Iterator[tuple[int, str, str]]:
        """The repaired lines (number, role, text) up to and with this row."""
        yield from self._inserted(self.edits)
        edit = self.edits[self.at]
        self.at += 1
        if edit == "D":
            return
        if edit == "K" and role[:1] == "s":
            self.place = SYSTEM
        else:
            self.place = NEXT[self.place]
        yield self._say(role if edit == "K" else ROLE_OF[self.place], text)

    def end(self) -> Iterator[tuple[int, str, str]]:
        self.audits.append(closing(self.state))
        self.at = 0
        yield from self._inserted(self.audits[-1])


REPORT_SCHEMA = pa.schema([("conv", pa.string()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
LINES_SCHEMA = pa.schema([("conv", pa.string()), ("line", pa.int64()), ("role", pa.string()), ("text", pa.string())])
LINES_AT_ONCE = 500


def _repaired(report: bool):
    """Of blocks and rows, sorted by (conv, block, pos) with a block (pos -1) before its rows.

    Gives one row of audit and digest per conversation, or the repaired lines.
    """
    schema = REPORT_SCHEMA if report else LINES_SCHEMA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def said(lines: Iterator[tuple[int, str, str]]) -> None:
            for line, role, text in lines:
                if not report:
                    out.append({"conv": now.conv, "line": line, "role": role, "text": text})

        def over() -> None:
            if now is not None:
                said(now.end())
                if report:
                    out.append({"conv": now.conv, "audit": "".join(now.audits), "repaired_sha256": now.digest.hexdigest()})

        for batch in batches:
            for conv, pos, role, text, symbols, lengths, after in zip(*[batch.column(c).to_pylist() for c in (
                    "conv", "pos", "role", "text", "symbols", "lengths", "after")]):
                if now is None or now.conv != conv:
                    over()
                    now = _Conversation(conv)
                if pos < 0:
                    now.enter(symbols, lengths, after)
                else:
                    said(now.row(role, text))
                if len(out) >= LINES_AT_ONCE:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        over()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        release_memory()
    return run


class Repair:
    """Repairs of a table of (conv_id, turn, role, text), as reports or as repaired lines.

    Rows are taken by turn, null first, and by role and text digest among equal turns; a null role
    or text is one space. ``conv_id`` may be null, which is a conversation like others. A role
    whose initial is none of s, u, a (or is empty) cannot be kept as it is. Repeated rows are
    duplicates. Other columns are ignored; an empty table has no conversations.
    """

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        self.kind = rows.schema["conv_id"].dataType
        named = rows.select(conv_key().alias("conv"), "turn", "role", "text")
        self.rows, marked = with_symbols(named, "repair")
        self.blocks = landed(spark, marked.repartition("conv", "block").sortWithinPartitions("conv", "block", "pos")
                             .mapInArrow(_blocks, BLOCK_DDL), "repair-blocks")
        chain = self.blocks.select("conv", "block", "matrix", "first", "last").repartition("conv").sortWithinPartitions("conv", F.col("block").desc())
        self.follows = landed(spark, chain.mapInArrow(_followed, "conv string, block bigint, after array<bigint>, cost bigint, seam bigint"),
                              "repair-follows")

    def _stream(self) -> DataFrame:
        heads = self.blocks.select("conv", "block", "symbols", "lengths").join(self.follows.select("conv", "block", "after").hint("merge"), ["conv", "block"])
        rows = self.rows.select("conv", "block", "pos", "role", "text")
        both = rows.unionByName(heads.withColumn("pos", F.lit(-1).cast("bigint")), allowMissingColumns=True)
        return both.repartition("conv").sortWithinPartitions("conv", "block", "pos")

    def lines(self) -> DataFrame:
        """(conv_id, line, role, text) of the repaired conversations."""
        made = self._stream().mapInArrow(_repaired(False), "conv string, line bigint, role string, text string")
        return made.select(conv_value(self.kind).alias("conv_id"), "line", "role", "text")

    def report(self) -> DataFrame:
        """Per conversation (as ``conv``): gaps, faults, illegal, cost, audit, repaired_sha256."""
        said = self._stream().mapInArrow(_repaired(True), "conv string, audit string, repaired_sha256 string")
        turns = self.rows.groupBy("conv", "turn").agg(F.lit(1).alias("_1")).groupBy("conv").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
        counts = self.blocks.join(self.follows.select("conv", "block", "cost", "seam").hint("merge"), ["conv", "block"]).groupBy("conv").agg(
            *[F.sum(c).alias(c) for c in _COUNTS[:3]], F.sum(F.col("illegal") + F.col("seam")).alias("illegal"), F.min_by("cost", "block").alias("cost"))
        return turns.join(counts.hint("merge"), "conv").join(said.hint("merge"), "conv")


def conv_key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def conv_value(kind) -> Column:
    return F.when(F.col("conv") != "", F.substr("conv", F.lit(2)).cast(kind))


def damage(rows: DataFrame) -> DataFrame:
    """The contract's damage to conversations, decided by the CRC-32 of ``conv_id:turn`` modulo 20."""
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text, role = F.coalesce(F.col("text"), space), F.coalesce(F.col("role"), space)
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Every conversation of the table after :func:`damage`, repaired; see :class:`Repair`.

    One without rows after the damage has zeros, an empty audit and the hash of nothing.
    """
    report = Repair(damage(conversations)).report()
    every = conversations.select(conv_key().alias("conv")).distinct()
    joined = every.join(report.hint("merge"), "conv", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", *_COUNTS, "cost")]
    return joined.select(conv_value(conversations.schema["conv_id"].dataType).alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
