from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from renewlens.llm import catalog, multi_index
from renewlens.llm.multi_index import Settings, search

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score double, key long"


def frame(spark, rows):
    def floats(vector):
        return vector and [None if x is None else float(x) for x in vector]

    return spark.createDataFrame([(i, floats(v), 0, 9, 0.1, 5) for i, v in rows], SCHEMA)


def by_hand(rows, top, queries=lambda i: i % 20 == 0):
    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and usable(v)]
    out = {}
    for q, v in good:
        if queries(q):
            scored = sorted((-float(v @ w), i) for i, w in good if i != q)[:top]
            out[q] = [(k + 1, i, pytest.approx(-s)) for k, (s, i) in enumerate(scored)]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_walk_visits_pairs_by_their_sum():
    rng = np.random.default_rng(0)
    book = multi_index.Codebook(rng.normal(size=(7, 3)), rng.normal(size=(7, 4)))
    query = rng.normal(size=7)
    population = rng.integers(0, 3, (7, 7))
    cells = multi_index.walk(query, book, population, 10**9)
    assert len(set(cells)) == len(cells) == (population > 0).sum()
    sums = [book.first[i] @ query[:3] + book.second[j] @ query[3:] for i, j in cells]
    assert sums == sorted(sums, reverse=True)
    few = multi_index.walk(query, book, population, 9)
    assert few == cells[: len(few)] and sum(population[c] for c in few) >= 9


def test_awkward_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(90)]
    rows += [(100 + i, [0.5, 0.25, 0.0, -1.0, 2.0]) for i in range(60)]  # copies
    rows += [(200, None), (220, [0.0] * 5), (240, [1.0, None, 0, 0, 0]), (260, [math.nan] * 5)]
    rows += [(280, [math.inf, 0, 0, 0, 0]), (300, []), (None, [1.0] * 5), (320, [-0.0, 1, 0, 0, 0])]
    rows += [(321, [0.0, 1, 0, 0, 0])]
    df = search(frame(spark, rows), F.col("vec_id") % 20 == 0, Settings(least=4096))
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    assert found(df) == by_hand(rows, 20)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (3, [2.0, 1.0])]
    assert found(search(frame(spark, rows), F.col("vec_id") % 20 == 0)) == by_hand(rows, 20)
    assert search(frame(spark, [(20, [1.0])]), F.lit(True)).collect() == []
    assert search(frame(spark, []), F.lit(True)).collect() == []
    assert search(frame(spark, [(1, None)]), F.lit(True)).collect() == []


def test_other_lengths_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 1.0]), (2, [9.0]), (3, [9.0, 9.0, 9.0])]
    got = found(search(frame(spark, rows), F.col("vec_id") == 0))
    assert [i for _, i, _ in got[0]] == [1]


def test_recall_when_not_all_cells_are_seen(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(3000, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    settings = Settings(index_rows=64, query_rows=32)
    got = found(search(frame(spark, rows), F.col("vec_id") % 20 == 0, settings))
    want = by_hand(rows, 20)
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.95
    assert all(len(v) == 20 for v in got.values())


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_recall(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [
        (r.vec_id, r.embedding)
        for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ]
    got = found(catalog.op7_inverted_multi_index(spark, folder))
    want = by_hand(rows, 20)
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.95
