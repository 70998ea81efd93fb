"""Repairs against a search over all of them, step by step and over whole tables."""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from renewlens.llm import conversation_repair as repair

SCHEMA = (
    "conv_id long, turn long, role string, text string, key string, at long, code int, "
    "segment long, fault string"
)
WANTED = re.compile(r"(s?(ua)+)?")


def cheapest(codes) -> tuple[int, str]:
    """Cheapest, then least edits: paths in order of cost and letters."""
    start = (0, "", 0, "")
    queue, done = [start], set()
    while queue:
        cost, letters, row, roles = heapq.heappop(queue)
        # Only whether a system row leads and who spoke last can matter later on.
        state = (row, roles[:1] == "s", roles[-1:])
        if state in done:
            continue
        done.add(state)
        if row == len(codes) and WANTED.fullmatch(roles):
            return cost, letters

        def add(more, letter, step, role):
            new = roles + role
            if any(WANTED.fullmatch(new + end) for end in ("", "a", "ua")):
                heapq.heappush(queue, (cost + more, letters + letter, row + step, new))

        for role in "ua":
            add(3, "I", 0, role)
        if row < len(codes):
            role, how = divmod(int(codes[row]), 3)
            add(4, "D", 1, "")
            if how != repair.MUST_GO:
                late = 3 * (how == repair.TRUNCATED)
                add(late, "K", 1, "suao"[role])
                for other in "ua":
                    add(3 + late, "R", 1, other)
    raise AssertionError


@pytest.mark.parametrize("block", [1, 3, 4])
def test_cheapest_and_least(block):
    rng = np.random.default_rng(block)
    for _ in range(300):
        codes = rng.integers(0, repair.CODES, rng.integers(0, 12))
        if rng.random() < 0.5:  # mostly well formed, as real ones are
            good = np.resize([3, 6], len(codes))
            codes = np.where(rng.random(len(codes)) < 0.25, codes, good)
        if block == repair.BLOCK:
            assert repair.solve(codes) == cheapest(codes)
        else:
            t = repair.tables(block)
            assert t.block_step.shape == (len(t.vectors), repair.CODES**block)
            assert repair.solve(codes)[0] == cheapest(codes)[0]


def test_block_tables_are_their_steps():
    t = repair.tables(3)
    rng = np.random.default_rng(0)
    for _ in range(500):
        vector = int(rng.integers(len(t.vectors)))
        codes = rng.integers(0, repair.CODES, 3)
        costs = t.vectors[vector]
        for code in codes[::-1].tolist():
            costs = repair.costs_before(costs, code)
        number = int(codes @ [repair.CODES**2, repair.CODES, 1])
        added = int(t.block_added[vector, number])
        assert added == min(costs)
        after = t.vectors[int(t.block_step[vector, number])]
        assert tuple(c + added for c in after) == costs
    assert len(t.vectors) < 200


def test_segments_know_their_state():
    rng = np.random.default_rng(5)
    for _ in range(200):
        codes = rng.integers(0, repair.CODES, rng.integers(1, 20))
        _, audit = repair.solve(codes)
        for first in range(1, len(codes)):
            (a, start), (b, state) = repair.cuts(audit, codes, [first, len(codes) - first])
            assert a + b == audit and start == 0
            assert sum(x != "I" for x in a) == first
            seen = 0
            row = 0
            for letter in a:
                if letter == "K" and codes[row] // 3 == repair.SYSTEM:
                    seen = repair.after(seen, repair.SYSTEM)
                elif letter != "D":
                    seen = repair.after(seen, repair.next_role(seen))
                row += letter != "I"
            assert seen == state


def by_hand(rows):
    """Conversations of (conv, turn, role, text), row after row."""
    spaces = " \t\n\x0b\x0c\r"
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    found = {}
    for conv, own in groups.items():
        own.sort(
            key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())
        )
        seen, codes = set(), []
        faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in own:
            bare = text.rstrip(spaces)
            kind = None
            if not bare:
                kind = "blank"
            elif (role, text) in seen:
                kind = "duplicate"
            elif bare[-1] not in ".!?":
                kind = "truncated"
            if kind:
                faults[kind] += 1
            seen.add((role, text))
            how = {None: 0, "truncated": 1}.get(kind, 2)
            codes.append(3 * "sua".find(role[:1]) + how if role[:1] in tuple("sua") else 9 + how)
        cost, audit = repair.solve(np.array(codes, np.int64))
        initials = [r[1][:1] for r in own]
        pairs = [a + b for a, b in zip(initials, initials[1:])]
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        lines, row, state = [], 0, 0
        for letter in audit:
            if letter != "D":
                role = repair.next_role(state)
                if letter == "K" and own[row][1][:1] == "s":
                    role = repair.SYSTEM
                name = own[row][1] if letter == "K" else repair.ROLE_NAMES[role]
                lines.append(f"{name}:{'' if letter == 'I' else own[row][2]}")
                state = repair.after(state, role)
            row += letter != "I"
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        found[conv] = (gaps, *faults.values(), illegal, cost, audit, digest)
    return found


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, 3, "f") for r in rows], SCHEMA)


def rows_of(df):
    return {
        r.conv_id: (
            r.gaps,
            r.blank,
            r.duplicate,
            r.truncated,
            r.illegal,
            r.cost,
            r.audit,
            r.repaired_sha256,
        )
        for r in df.collect()
    }


def awkward(n: int = 400):
    rng = np.random.default_rng(9)
    roles = ["user", "assistant", "system", None, "", "tool", "user", "assistant"]
    texts = ["Yes.", "No!", "cut", "", " \t", None, "Why?  \n", "é.", "a.b"]
    rows = [
        (
            int(rng.integers(0, 40)),
            int(rng.integers(0, 9)) if rng.random() < 0.95 else None,
            roles[rng.integers(len(roles))],
            f"{texts[k]}" if (k := int(rng.integers(len(texts)))) != 5 else None,
        )
        for _ in range(n)
    ]
    rows += [(None, 0, "user", "Hello."), (None, None, "assistant", "Hi."), (77, None, "user", None)]
    rows += [(78, 3, "user", "word " * 100_000 + ".")]
    # One conversation of many segments, and one row many times.
    rows += [(99, t, ("user", "assistant")[t % 2], f"line {t}.") for t in range(900)]
    return rows + [(98, 1, "user", "again.")] * 600


def test_whole_tables(spark):
    rows = awkward()
    found = repair.repair(frame(spark, rows))
    assert rows_of(found.conversations) == by_hand(rows)
    roles = defaultdict(str)
    for r in sorted(found.turns.collect(), key=lambda r: (r.key, r.at, r.place)):
        roles[r.key] += r.role[:1]
    assert all(WANTED.fullmatch(order) for order in roles.values())


def test_damage(spark):
    rows = list(dict.fromkeys(awkward(300)))
    spoilt = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        new = (conv, turn, "user" if kind == 4 else role, text)
        spoilt += [new] * {0: 0, 3: 2}.get(kind, 1)
    df = repair.damaged(frame(spark, rows), "conv_id", "turn", "role", "text")
    assert sorted(map(tuple, df.collect()), key=str) == sorted(spoilt, key=str)
    told = repair.repair(df).conversations
    whole = rows_of(repair.all_conversations(told, frame(spark, rows)))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert whole == {r[0]: nothing for r in rows} | by_hand(spoilt)


def test_no_rows(spark):
    none = frame(spark, [])
    found = repair.repair(none)
    assert found.turns.collect() == [] and found.conversations.collect() == []
    assert repair.all_conversations(found.conversations, none).collect() == []
