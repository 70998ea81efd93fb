from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np

from frames_llm import documents, empty_documents
from renewlens.llm import blocks, catalog, order_minhash
from renewlens.llm.order_minhash import Settings, fingerprint, likeness, written


def by_hand(text, s=Settings()):
    """The same sketch, element by element."""
    if not text:
        return np.zeros(s.functions, np.uint32)
    points = np.array([ord(c) + 1 for c in text], np.uint64)
    k = min(s.k, len(points))
    seen, own = Counter(), []
    for i in range(len(points) - k + 1):
        value = int(blocks.run_hashes(points[i : i + k], k)[0])
        number = seen[value]
        seen[value] += 1
        if number:
            step = number * 0xA0761D6478BD642F
            value = int(blocks.mix(np.array([(value + step) % 2**64], np.uint64))[0])
        own.append(value)
    seeds = [int(x) >> 32 for x in blocks.seeds(2 * s.functions, s.seed)]
    out = []
    for f in range(s.functions):
        key = [((v >> 32) ^ seeds[f]) * (seeds[s.functions + f] | 1) % 2**32 for v in own]
        order = sorted(range(len(own)), key=lambda i: (key[i], i))[: s.chosen]
        value = f + 1
        for i in sorted(order):
            total = (value * 0x9E3779B97F4A7C15 + own[i]) % 2**64
            value = int(blocks.mix(np.array([total], np.uint64))[0])
        out.append(max(value >> 32, 1))
    return np.array(out, np.uint32)


def test_equals_the_plain_form():
    rng = np.random.default_rng(1)
    texts = ["", "a", "abcabcabcabcabc", "short", "ééééééééééé", "x" * 40]
    texts.append("".join(rng.choice(list("abcd "), 300)))
    for text in texts:
        assert (fingerprint(text) == by_hand(text)).all()


def test_order_counts():
    rng = np.random.default_rng(2)
    parts = ["".join(rng.choice(list("abcdefghij "), 400)) for _ in range(6)]
    text, moved = "".join(parts), "".join(reversed(parts))
    edited = text[:1000] + "#" + text[1001:]
    own = fingerprint(text)
    assert likeness(own, own) == 1
    assert likeness(own, fingerprint(edited)) > 0.9
    assert likeness(own, fingerprint(moved)) < 0.75
    assert likeness(own, fingerprint("".join(rng.choice(list("abcdefghij "), 2400)))) < 0.1


def expected(rows):
    """By id, descending; after the last comes the first."""
    rows = [(i, t or "") for i, t in rows]
    ordered = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (i, text), (_, other) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        own, changed = fingerprint(text), fingerprint(edited)
        out[i] = (
            len(text),
            hashlib.sha256(edited.encode()).hexdigest(),
            written(own),
            written(changed),
            likeness(own, changed),
            likeness(own, fingerprint(other)),
        )
    return out


def test_edit_check_of_awkward_rows(spark):
    rows = [(i * 7 % 101, f"text number {i} é🙂 " * (i % 5)) for i in range(60)]
    rows += [(500, None), (501, ""), (502, "z" * 50_000), (503, "ab")]
    found = order_minhash.edit_check(documents(spark, rows)).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == expected(rows)


def test_edit_check_of_few_rows(spark):
    assert order_minhash.edit_check(empty_documents(spark)).collect() == []
    (row,) = order_minhash.edit_check(documents(spark, [(4, "alone here")])).collect()
    assert tuple(row)[1:] == expected([(4, "alone here")])[4]
    rows = [(1, "same text"), (1, "same text"), (None, "no id"), (1, "other")]
    found = order_minhash.edit_check(documents(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in found) == [(0, 5), (1, 5), (1, 9), (1, 9)]
    prints = {r.fingerprint for r in found if r.n_chars == 9}
    assert len(prints) == 1


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = catalog.op4_order_minhash(spark, folder).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == expected([tuple(r) for r in docs])
    assert np.mean([r.near_edited > r.near_next for r in found]) > 0.95
