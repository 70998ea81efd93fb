"""The manifest against a tree built row by row, and its least sets of nodes."""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from renewlens.llm import merkle_manifest as merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row) -> str:
    values = (row[0], row[1], row[2], row[3], row[4])
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_of(leaves: list[str]) -> list[list[str]]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def path_of(levels: list[list[str]], place: int) -> list[tuple[str, str]]:
    steps = []
    for level in levels[:-1]:
        other = level[place ^ 1] if place ^ 1 < len(level) else ""
        steps.append((other, "") if place & 1 else ("", other))
        place >>= 1
    return steps


def expected(rows) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in names:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = tree_of([leaf_of(r) for r in groups[lang]])
    top = tree_of([trees[lang][-1][0] for lang in names])
    found = []
    for k, lang in enumerate(names):
        for place, row in enumerate(groups[lang]):
            proof = path_of(trees[lang], place) + path_of(top, k)
            found.append((row[0], leaf_of(row), trees[lang][-1][0], top[-1][0], proof))
    return found


def result(df) -> list[tuple]:
    return [
        (r.doc_id, r.leaf, r.subroot, r.root, [(s.before, s.after) for s in r.proof])
        for r in df.collect()
    ]


def by_text(rows):
    return sorted(rows, key=str)


def sample_rows(n: int):
    langs = ["en", "en", "en", "de", None, "", "é", "=x", "-"]
    rows = [
        (i * 7 % n if i % 11 else None, f"s{i % 3}", langs[i % len(langs)], i, f"text {i}é", "x")
        for i in range(n)
    ]
    rows += [rows[3], rows[3], (5, None, "en", None, None, None), (5, "", "en", 0, "", "")]
    return rows + [(9, "s", "only", 1, "long " * 50_000, None)]


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_same_as_row_by_row(spark, levels):
    rows = sample_rows(60)
    docs = spark.createDataFrame(rows, SCHEMA)
    found = merkle.manifest(docs, levels=levels)
    assert by_text(result(found)) == by_text(expected(rows))
    assert found.where("NOT verified OR folded_root <> root").count() == 0


def test_tampering_is_seen(spark):
    docs = spark.createDataFrame(sample_rows(30), SCHEMA)
    odd = F.col("doc_id") % 2 == 1
    more = F.when(odd, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = merkle.manifest(docs, changed={"n_chars": more}, levels=2).collect()
    for row in found:
        touched = row.changed_leaf != row.leaf
        assert row.verified is not touched
        digest_now = row.changed_leaf
        for step in row.proof:
            digest_now = digest(step.before, digest_now, step.after)
        assert digest_now == row.folded_root
    assert {r.verified for r in found} == {True, False}


def test_one_row_no_rows_and_proof_digest(spark):
    row = (1, "s", "en", 4, "text", None)
    one = merkle.manifest(spark.createDataFrame([row], SCHEMA))
    found = one.withColumn("proved", merkle.proof_digest(F.col("proof"))).first()
    assert found.leaf == found.subroot == found.root == leaf_of(row)
    assert found.proof == [] and found.proved == digest("") and found.verified
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13])
def test_missing_is_least(n):
    """Every set of leaves: the nodes asked for suffice, and none can be left out."""
    leaves = [digest(str(i)) for i in range(n)]
    levels = tree_of(leaves)
    for size in range(1, min(n, 4) + 1):
        for places in itertools.combinations(range(n), size):
            asked = merkle.missing(np.array(places), n)
            nodes = {(level, p): levels[level][p] for level, p in asked}
            known = {p: leaves[p] for p in places}
            whole = merkle.derive(known, nodes, n)
            assert whole[-1] == {0: levels[-1][0]}
            for left_out in asked:
                fewer = {c: d for c, d in nodes.items() if c != left_out}
                with pytest.raises(KeyError):
                    merkle.derive(known, fewer, n)
