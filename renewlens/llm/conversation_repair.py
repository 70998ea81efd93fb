"""Cheapest repair of conversations to well-formed role orders.

A conversation is well formed if its roles read: system at most once and first, then
pairs of user and assistant. Rows are kept, given another role, or deleted, and empty
rows are inserted, at the least total cost; among cheapest repairs the one whose edits
read least in ASCII is taken.

The costs of finishing from each of the four states of that pattern are a vector. Less
its least entry there are only a few such vectors, so the step by any symbol is a table
of small numbers, and so is the step by any block of ``BLOCK`` symbols (Four-Russians
tables). A conversation is read from its end by one lookup a block. The edits are then
read off from the start: each block is expanded backward from the vector at its end,
and the least letter that stays on a cheapest path is taken, so ties are told exactly.
Expansions are remembered, for the same blocks come again and again.

Spark sorts the rows by range, so one conversation may lie in many tasks; duplicates
are found by a sum over equal rows; segments of at most ``2 ** SEGMENT`` rows are
repaired apart once their edits are known. What is brought together for a conversation
is a byte a row, less than its audit. Its digest is read from its rows as a stream.

Defined results: a NULL role or text counts as one space. Rows with the same turn are
ordered by role and digest of the text; a NULL turn comes first; rows without a
conversation are one conversation. An empty table gives no rows. Other columns of the
table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens.session import staged

# What counts as space, what ends a text, the letters and costs of edits.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3

BLOCK = 4  # symbols in a block
SEGMENT = 8  # bits of a row's number inside a segment

# States: nothing yet, after system, after user, after assistant.
STATES = 4
ACCEPTED = (0, 3)
# A row's code: 3 * role (system, user, assistant, other) + how it is.
SOUND, TRUNCATED, MUST_GO = 0, 1, 2
SYSTEM, USER, ASSISTANT, OTHER = range(4)
CODES = 12


def next_role(state: int) -> int:
    """The role that an inserted or changed row takes after a state."""
    return ASSISTANT if state == 2 else USER


def after(state: int, role: int) -> int | None:
    """The state after a row of that role; None where it must not stand."""
    if role == SYSTEM:
        return 1 if state == 0 else None
    if role == OTHER or role != next_role(state):
        return None
    return 3 if role == ASSISTANT else 2


def choices(state: int, code: int) -> list[tuple[str, int, int]]:
    """Edits of a row in a state: letter, cost, state after it."""
    role, how = divmod(code, 3)
    found = [(DELETE, DELETE_COST, state)]
    if how != MUST_GO:
        more = TRUNCATED_COST if how == TRUNCATED else 0
        kept = after(state, role)
        if kept is not None:
            found.append((KEEP, more, kept))
        found.append((REROLE, REROLE_COST + more, after(state, next_role(state))))
    return found


def _inserted(costs: list[int]) -> tuple[int, ...]:
    """Costs where rows may be inserted first; two rounds lead through every state."""
    for _ in range(2):
        costs = [
            min(c, INSERT_COST + costs[after(q, next_role(q))]) for q, c in enumerate(costs)
        ]
    return tuple(costs)


LAST = _inserted([0 if q in ACCEPTED else 1_000 for q in range(STATES)])


def costs_before(costs: tuple[int, ...], code: int) -> tuple[int, ...]:
    """Least costs of finishing from each state, one row further to the front."""
    return _inserted(
        [min(cost + costs[to] for _, cost, to in choices(q, code)) for q in range(STATES)]
    )


class Tables(NamedTuple):
    """Steps between cost vectors, each less its least entry."""

    vectors: list[tuple[int, ...]]
    step: np.ndarray  # vector, code -> vector before it
    added: np.ndarray  # what the least entry grows by
    block_step: np.ndarray  # vector, block of codes -> vector before it
    block_added: np.ndarray


@lru_cache(maxsize=4)
def tables(block: int = BLOCK) -> Tables:
    """All vectors that can occur, and their steps by a code and by a block of codes."""

    def normal(costs):
        least = min(costs)
        return tuple(c - least for c in costs), least

    first, _ = normal(LAST)
    number = {first: 0}
    steps: list[list[tuple[int, int]]] = []
    queue = [first]
    for vector in queue:  # grows while it is read
        row = []
        for code in range(CODES):
            before, least = normal(costs_before(vector, code))
            if before not in number:
                number[before] = len(queue)
                queue.append(before)
            row.append((number[before], least))
        steps.append(row)
    table = np.array(steps, np.int32)
    step, added = table[..., 0], table[..., 1]
    block_step, block_added = step, added
    for _ in range(block - 1):
        # One code more in front: the last codes of a block are its low digits.
        longer = step[block_step]  # vector, rest, code
        more = added[block_step] + block_added[..., None]
        block_step = longer.transpose(0, 2, 1).reshape(len(queue), -1)
        block_added = more.transpose(0, 2, 1).reshape(len(queue), -1)
    return Tables(queue, step, added, block_step, block_added)


@lru_cache(maxsize=1 << 16)
def expand(codes: bytes, vector: int, state: int) -> tuple[str, int]:
    """Edits of a block between a state before it and a cost vector after it.

    The vectors inside the block are made again backward; then the least letter is
    taken that stays on a cheapest path. Also gives the state after the block.
    """
    behind = [tables().vectors[vector]]
    for code in reversed(codes):
        behind.append(costs_before(behind[-1], code))
    behind.reverse()
    letters = []
    for at, code in enumerate(codes):
        while True:
            costs = behind[at]
            edits = [
                (letter, to)
                for letter, cost, to in choices(state, code)
                if cost + behind[at + 1][to] == costs[state]
            ]
            onward = after(state, next_role(state))
            if INSERT_COST + costs[onward] == costs[state]:
                edits.append((INSERT, onward))
            letter, state = min(edits)
            letters.append(letter)
            if letter != INSERT:
                break
    return "".join(letters), state


def solve(codes: np.ndarray, block: int = BLOCK) -> tuple[int, str]:
    """Least cost and the edits of one conversation, given its rows' codes."""
    t = tables(block)
    whole = len(codes) // block * block
    vector, cost = 0, min(LAST)
    for code in codes[whole:][::-1].tolist():
        cost += int(t.added[vector, code])
        vector = int(t.step[vector, code])
    weights = CODES ** np.arange(block - 1, -1, -1)
    numbers = (codes[:whole].reshape(-1, block).astype(np.int64) @ weights).tolist()
    vectors = [vector]
    for number in reversed(numbers):
        cost += int(t.block_added[vector, number])
        vector = int(t.block_step[vector, number])
        vectors.append(vector)
    vectors.reverse()
    cost += t.vectors[vector][0]
    raw = codes.astype(np.uint8).tobytes()
    state, letters = 0, []
    for k in range(len(numbers)):
        part, state = expand(raw[k * block : (k + 1) * block], vectors[k + 1], state)
        letters.append(part)
    part, state = expand(raw[whole:], 0, state)
    letters.append(part)
    while state not in ACCEPTED:
        letters.append(INSERT)
        state = after(state, next_role(state))
    return cost, "".join(letters)


def _states(letters: np.ndarray, system_first: bool) -> np.ndarray:
    """The state before each letter, and after the last, from how many rows stand by then."""
    rows = np.concatenate([[0], np.cumsum(letters != ord(DELETE))]) - int(system_first)
    paired = np.where(rows % 2 == 1, 2, 3)
    none = 1 if system_first else 0
    return np.where(rows < 0, 0, np.where(rows == 0, none, paired))


def cuts(audit: str, codes: np.ndarray, lengths: list[int]) -> list[tuple[str, int]]:
    """The edits of consecutive segments of rows, and the state before each."""
    letters = np.frombuffer(audit.encode("ascii"), np.uint8)
    ends = np.flatnonzero(letters != ord(INSERT))  # the letter of every row
    standing = np.flatnonzero(letters != ord(DELETE))
    system_first = False
    if len(standing) and letters[standing[0]] == ord(KEEP):
        row = int(np.searchsorted(ends, standing[0]))
        system_first = bool(codes[row] // 3 == SYSTEM)
    states = _states(letters, system_first)
    found, row, begin = [], 0, 0
    for length in lengths:
        row += length
        end = len(letters) if row == len(codes) else int(ends[row - 1]) + 1
        found.append((audit[begin:end], int(states[begin])))
        begin = end
    return found


LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
_LEGAL = np.array([[(a, b) in LEGAL for b in range(4)] for a in range(4)])


def illegal_pairs(codes: np.ndarray) -> int:
    """Neighbours whose roles do not follow each other."""
    roles = codes // 3
    return int((~_LEGAL[roles[:-1], roles[1:]]).sum())


def damaged(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows spoilt by a checksum of conversation and turn: a test of the repair.

    Of twenty remainders, 0 drops a row, 1 empties its text, 2 takes the marks that end
    sentences, 3 repeats it, and 4 gives it the role of a user.
    """
    known = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)]
    kind = F.crc32(F.concat_ws(":", *known)) % 20
    words, speaker = (F.coalesce(F.col(c), F.lit(" ")) for c in (text, role))
    spoilt = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(speaker).alias("role"),
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.translate(words, ENDS, ""))
        .otherwise(words)
        .alias("text"),
        kind.alias("kind"),
    ).where("kind <> 0")
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return spoilt.select("conv_id", "turn", "role", "text", copies.alias("copy")).drop("copy")


def _ordered(turns: DataFrame) -> DataFrame:
    """Rows in order, numbered by ``at``, with what can be told of each by itself."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = turns.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-")).alias("key"),
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    rows = rows.select(
        "*",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(*ENDS)).alias("cut_off"),
    )
    # Rows alike in all of it are the same row again: they may go to any task.
    order = [F.col("key"), F.col("turn").asc_nulls_first(), "role", "digest", F.rand(3)]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(placed.withColumn("at", F.monotonically_increasing_id()), "turns")


def _faults(rows: DataFrame) -> DataFrame:
    """``at``, ``key``, and the first fault of each row."""
    firsts = rows.groupBy("key", "role", "digest").agg(F.min("at").alias("at"))
    firsts = firsts.select("at", F.lit(True).alias("first"))
    fault = (
        F.when(F.col("blank"), "blank")
        .when(F.col("first").isNull(), "duplicate")
        .when(F.col("cut_off"), "truncated")
    )
    told = rows.drop("text", "digest").join(firsts, "at", "left")
    return told.select("at", "key", "turn", "role", fault.alias("fault"))


def _code() -> Column:
    initial = F.substring("role", 1, 1)
    role = (
        F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT)
    )
    how = (
        F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO)
        .when(F.col("fault") == "truncated", TRUNCATED)
        .otherwise(SOUND)
    )
    return (3 * F.coalesce(role, F.lit(OTHER)) + how).alias("code")


def _segment() -> Column:
    return F.shiftright("at", SEGMENT)


SOLVED = (
    "key string, cost long, illegal long, audit string, "
    "cuts array<struct<segment:long,at:long,letters:string,state:int>>"
)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations from their segments, which come in order."""

    def finished(key, parts):
        codes = np.concatenate([c for _, c in parts])
        cost, audit = solve(codes)
        pieces = cuts(audit, codes, [len(c) for _, c in parts])
        told = [
            {"segment": at >> SEGMENT, "at": at, "letters": letters, "state": state}
            for (at, _), (letters, state) in zip(parts, pieces)
        ]
        return key, cost, illegal_pairs(codes), audit, told

    fields = {"segment": pa.int64(), "at": pa.int64(), "letters": pa.string(), "state": pa.int32()}
    kind = pa.list_(pa.struct(list(fields.items())))
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), kind)
    names = ["key", "cost", "illegal", "audit", "cuts"]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 5, kinds)], names=names
        )

    open_key, parts = None, []
    for batch in batches:
        rows = []
        key_column, at_column, code_column = batch.columns
        for key, at, codes in zip(key_column.to_pylist(), at_column.to_pylist(), code_column):
            if key != open_key and parts:
                rows.append(finished(open_key, parts))
                parts = []
            open_key = key
            parts.append((at, np.frombuffer(codes.as_py(), np.uint8)))
        yield batch_of(rows)
    if parts:
        yield batch_of([finished(open_key, parts)])


ROLE_NAMES = {USER: "user", ASSISTANT: "assistant"}
TURNS = "key string, at long, place int, edit string, role string, text string"


def _edited(own: pa.Table, found: pa.Table) -> pa.Table:
    """Rows of one segment after their edits, in order."""
    own, found = own.sort_by("at"), found.sort_by("at")
    at, roles, texts, keys = (own.column(c).to_pylist() for c in ("at", "role", "text", "key"))
    out = []
    row = 0
    for cut in found.to_pylist():
        letters, state = cut["letters"], cut["state"]
        key, last, place = keys[row], at[row], 0
        for letter in letters:
            if letter == DELETE:
                last, place, row = at[row], 0, row + 1
                continue
            own_row = letter != INSERT
            number = at[row] if row < len(at) and keys[row] == key else last
            role = next_role(state)
            if letter == KEEP and roles[row][:1] == "s":
                role = SYSTEM
            name = roles[row] if letter == KEEP else ROLE_NAMES[role]
            place += 1
            out.append((key, number, place, letter, name, texts[row] if own_row else ""))
            state = after(state, role)
            if own_row:
                last, row = at[row], row + 1
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string())
    columns = list(zip(*out)) or [()] * 6
    names = ["key", "at", "place", "edit", "role", "text"]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of every conversation, whose rows come in order, as a stream."""

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.string()) for c in (list(zip(*rows)) or [(), ()])],
            names=["key", "repaired_sha256"],
        )

    open_key, digest = None, None
    for batch in batches:
        rows = []
        for key, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if digest is not None and key == open_key:
                digest.update(b"\n")
            else:
                if digest is not None:
                    rows.append((open_key, digest.hexdigest()))
                open_key, digest = key, hashlib.sha256()
            digest.update(f"{role}:{text}".encode())
        yield batch_of(rows)
    if digest is not None:
        yield batch_of([(open_key, digest.hexdigest())])


class Repaired(NamedTuple):
    turns: DataFrame  # conversation key, order (at, place), edit, role, text
    conversations: DataFrame  # one row a conversation


def repair(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> Repaired:
    """Repaired rows, and per conversation its faults, cost, edits and digest.

    ``turns`` are the rows that stand, of every edit but those deleted. Conversations:
    ``conv_id``, ``gaps`` in the turns, first faults ``blank``, ``duplicate`` and
    ``truncated``, ``illegal`` neighbours, ``cost``, ``audit`` and ``repaired_sha256``.
    """
    given = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.col(role).alias("role"),
        F.col(text).alias("text"),
    )
    rows = _ordered(given)
    faults = staged(_faults(rows), "faults")
    segments = (
        faults.select("key", "at", _code())
        .groupBy("key", _segment().alias("segment"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "code"))).alias("own"))
    )
    digits = F.transform("own", lambda x: F.lpad(F.hex(x["code"]), 2, "0"))
    codes = F.unhex(F.array_join(digits, ""))
    segments = segments.select("key", F.col("own")[0]["at"].alias("at"), codes.alias("codes"))
    in_order = segments.repartition("key").sortWithinPartitions("key", "at")
    solved = staged(in_order.mapInArrow(_solved, SOLVED), "solved")
    edits = solved.select(F.explode("cuts").alias("cut")).select("cut.*")
    texts = rows.select("key", "at", "role", "text", _segment().alias("segment"))
    fixed = texts.groupBy("segment").cogroup(edits.groupBy("segment")).applyInArrow(_edited, TURNS)
    fixed = staged(fixed, "repaired")
    streamed = fixed.repartition("key").sortWithinPartitions("key", "at", "place")
    digests = streamed.select("key", "role", "text").mapInArrow(
        _digested, "key string, repaired_sha256 string"
    )

    def times(fault: str) -> Column:
        return F.count_if(F.col("fault") == fault).alias(fault)

    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    kinds = ("blank", "duplicate", "truncated")
    by_turn = faults.groupBy("key", "turn").agg(*(times(f) for f in kinds))
    counts = by_turn.groupBy("key").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *(F.sum(f).alias(f) for f in kinds)
    )
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    told = counts.join(solved.drop("cuts"), "key").join(digests, "key", "left")
    named = F.when(F.col("key") != "-", F.substr("key", F.lit(2)))
    kind = given.schema["conv_id"].dataType
    told = told.select(
        named.cast(kind).alias("conv_id"),
        "gaps",
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        "cost",
        "audit",
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )
    return Repaired(fixed, told)


def all_conversations(told: DataFrame, conversations: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``told`` with a row of zeros for every conversation that has no rows left."""
    known = conversations.select(F.col(conv).alias("__conv")).distinct()
    same = F.col("__conv").eqNullSafe(F.col("conv_id"))
    whole = known.join(told, same, "left")
    zeros = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.select(
        F.col("__conv").alias("conv_id"),
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in zeros),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )
