from __future__ import annotations

import random

import pytest

from frames_llm import components_by_hand, documents, empty_documents
from renewlens.llm import bottom_sketch, catalog
from renewlens.llm.components import components


def found(df):
    return sorted(
        (tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r)
    )


def wanted(rows, **kw):
    return sorted(components_by_hand(rows, **kw), key=lambda r: tuple((x is None, x) for x in r))


def varied(base, rng, edits):
    own = list(base)
    for _ in range(edits):
        own[rng.randrange(len(own))] = f"x{rng.randrange(10**9)}"
    return " ".join(own)


def test_awkward_rows(spark):
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "One two"),
        (5, "one TWO"),
        (6, "one two three four"),
        (7, "one two three four five"),
        (None, "one two"),
        (9, "é one two three É"),
        (10, "é one two three é"),
        (11, "a a a a a a a"),
        (12, "a a a a"),
        (12, "a a a a"),
    ]
    df = bottom_sketch.near_copies(documents(spark, rows), bottom_sketch.Settings(width=4))
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert found(df) == wanted(rows)


def test_no_rows(spark):
    assert bottom_sketch.near_copies(empty_documents(spark)).collect() == []


@pytest.mark.parametrize("short_list", [2, 48])
def test_groups_of_near_copies_equal_all_pairs(spark, short_list):
    rng = random.Random(3)
    rows, k = [], 0
    passage = [f"p{i}" for i in range(60)]
    for group in range(6):
        base = [f"g{group}w{rng.randrange(400)}" for _ in range(150)]
        for _ in range(25):
            rows.append((k, varied(base, rng, rng.randrange(0, 12))))
            k += 1
    for _ in range(30):  # a passage they share, and little else
        rows.append((k, " ".join(passage + [f"o{rng.randrange(10**9)}" for _ in range(20)])))
        k += 1
    rows += [(k + i, text) for i, (_, text) in enumerate(rows[:20])]
    rng.shuffle(rows)
    settings = bottom_sketch.Settings(width=4, short_list=short_list, block_values=2000)
    assert found(bottom_sketch.near_copies(documents(spark, rows), settings)) == wanted(rows)


def test_exactly_at_the_limit(spark):
    rows = [(1, "a b c d e f g h i"), (2, "a b c d e f g h"), (3, "a b c d e f g"), (4, "a b c d e")]
    for percent in (80, 83, 84, 75):
        settings = bottom_sketch.Settings(width=4, percent=percent)
        df = bottom_sketch.near_copies(documents(spark, rows), settings)
        assert found(df) == wanted(rows, percent=percent)


def test_query_equals_all_pairs(spark):
    folder = "/root/testdata/sf0.001"
    rows = [
        tuple(r)
        for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    ]
    assert found(catalog.op9_bottom_sketch_dedup(spark, folder)) == wanted(rows)


def test_components_of_long_chains_and_stars(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(300)]
    star = [(10_000, 1_000 + i) for i in range(200)]
    pairs = chain + star + [(5, 5), (7, 6), (7, 6)]
    rng.shuffle(pairs)
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {
        i: 1_000 for i in [*range(1_001, 1_200), 10_000]
    }
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
