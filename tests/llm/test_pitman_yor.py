from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from frames_llm import documents, empty_documents, words
from renewlens.llm import blocks, catalog, pitman_yor
from renewlens.llm.pitman_yor import Settings, draw_tables, log_stirling
from renewlens.session import shared_folder


def partitions(n):
    """Sizes of the tables, over all seatings of n numbered customers."""
    if n == 0:
        yield []
        return
    for sizes in partitions(n - 1):
        yield sizes + [1]
        for k in range(len(sizes)):
            yield sizes[:k] + [sizes[k] + 1] + sizes[k + 1 :]


def test_stirling_numbers_count_seatings():
    d = 0.3
    table = log_stirling(d, 6)
    for n in range(1, 7):
        by_tables = Counter()
        for sizes in partitions(n):
            by_tables[len(sizes)] += math.prod(
                math.prod(i - d for i in range(1, s)) for s in sizes
            )
        for t, total in by_tables.items():
            assert table[n, t] == pytest.approx(math.log(total))


def keys(n, seed=1):
    return blocks.mix(np.arange(n, dtype=np.uint64) + np.uint64(seed << 32))


def test_tables_follow_their_distribution():
    d, pull, n, size = 0.4, 0.7, 5, 60_000
    weight = np.exp(log_stirling(d, n)[n, 1 : n + 1] + np.arange(1, n + 1) * math.log(pull))
    drawn = draw_tables(np.full(size, n), np.full(size, pull), d, log_stirling(d, 50), keys(size))
    share = np.bincount(drawn, minlength=n + 1)[1:] / size
    assert np.abs(share - weight / weight.sum()).max() < 0.01


@pytest.mark.parametrize("discount", [0.2, 0.5, 0.8])
@pytest.mark.parametrize("pull", [0.05, 0.5, 5.0, 60.0, 600.0])
def test_many_customers_by_the_scaling_law(discount, pull):
    n, size = 1500, 3000
    row = log_stirling(discount, n)[n, 1 : n + 1] + np.arange(1, n + 1) * math.log(pull)
    weight = np.exp(row - row.max())
    weight /= weight.sum()
    mean = (weight * np.arange(1, n + 1)).sum()
    spread = math.sqrt((weight * (np.arange(1, n + 1) - mean) ** 2).sum())
    args = (np.full(size, n), np.full(size, pull), discount, log_stirling(discount, 200))
    drawn = draw_tables(*args, keys(size))
    assert drawn.mean() == pytest.approx(mean, rel=0.05)
    assert drawn.std() == pytest.approx(spread, rel=0.15, abs=0.05)


def test_gammas_have_their_moments():
    for shape in (0.3, 1.0, 7.5, 4000.0):
        drawn = pitman_yor.gammas(np.full(100_000, shape), keys(100_000, 3))
        assert drawn.mean() == pytest.approx(shape, rel=0.02)
        assert drawn.var() == pytest.approx(shape, rel=0.04)


def test_joint_seating_of_a_restaurant():
    """Draws of all dishes by the auxiliary gamma against all combinations of tables."""
    d, theta = 0.5, 1.0
    n, base = [3, 2, 4], [0.2, 0.5, 0.3]
    stirling = log_stirling(d, 5)
    weights = {}
    for t in itertools.product(*(range(1, k + 1) for k in n)):
        rise = math.prod(theta + d * i for i in range(sum(t)))
        own = (math.exp(stirling[k, x]) * b**x for k, x, b in zip(n, t, base))
        weights[t] = rise * math.prod(own)
    total = sum(weights.values())
    size = 40_000  # chains side by side
    tables = np.ones((size, 3), np.int64)
    for sweep in range(12):
        rate = pitman_yor.gammas(theta / d + tables.sum(1), keys(size, 100 + sweep))
        for k in range(3):
            pull = d * rate * base[k]
            tables[:, k] = draw_tables(
                np.full(size, n[k]), pull, d, stirling, keys(size, 1000 + 3 * sweep + k)
            )
    found = Counter(map(tuple, tables.tolist()))
    assert all(abs(found[t] / size - w / total) < 0.012 for t, w in weights.items())


def fitted(spark, texts, **kw):
    return pitman_yor.fit(spark.createDataFrame([(t,) for t in texts], "text string"), Settings(**kw))


def code(word):
    found, _ = blocks.words(*blocks.byte_offsets(pa.array([word])))
    return int(found.view(np.int64)[0]) if len(found) else pitman_yor.END


def probabilities(model):
    """P(word | context) as a function, from the model's tables."""
    seen = {(r.context, r.word): 10**r.score for r in pitman_yor.pair_scores(model).collect()}
    by_word = {r.word: r for r in model.words.collect()}
    samples = range(len(model.unknown))

    def p(context, word):
        if (context, word) in seen:
            return seen[context, word]
        c, w = by_word.get(context), by_word.get(word)
        each = [
            (c[f"share{i}"] if c else 1.0) * (w[f"parent{i}"] if w else model.unknown[i])
            for i in samples
        ]
        return sum(each) / len(each)

    return p, list(by_word)


def test_probabilities_add_up(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.5, 60) % 500) for _ in range(50)]
    p, known = probabilities(fitted(spark, texts))
    for context in [*known[:40], pitman_yor.END, 12345]:
        assert sum(p(context, w) for w in [*known, 54321]) == pytest.approx(1)


def test_contexts_of_rare_words_are_learned(spark):
    common = [f"c{i}" for i in range(1500)]
    texts = [" ".join(common)] * 3 + ["rare one and rare two", "ping pong", "ping pong"]
    p, _ = probabilities(fitted(spark, texts))
    ping, pong, rare = code("ping"), code("pong"), code("rare")
    assert p(ping, pong) > 0.4
    assert p(pong, pong) < 0.02 and p(rare, pong) < 0.02


def sequential(texts, discount, parent_discount, theta, sweeps, burn_in, seed):
    """One customer at a time leaves and is seated again, there and in the parent."""
    rng = np.random.default_rng(seed)
    places = [(c, w) for t in texts for c, w in zip(["", *words(t)], [*words(t), ""])]
    outcomes = len({w for _, w in places}) + 1
    rooms = {c: {} for c, _ in places}  # context: word: sizes of its tables
    top = {}

    def from_top(w):
        n, k = sum(map(sum, top.values())), sum(map(len, top.values()))
        own = top.get(w, [])
        return (
            sum(own) - parent_discount * len(own) + (theta + parent_discount * k) / outcomes
        ) / (theta + n)

    def sit(room, w, d, new):
        sizes = room.setdefault(w, [])
        weight = np.array([s - d for s in sizes] + [new])
        at = rng.choice(len(weight), p=weight / weight.sum())
        if at == len(sizes):
            sizes.append(0)
        sizes[at] += 1
        return sizes[at] == 1

    def leave(room, w):
        sizes = room[w]
        at = rng.choice(len(sizes), p=np.array(sizes) / sum(sizes))
        sizes[at] -= 1
        if not sizes[at]:
            sizes.pop(at)
            return True
        return False

    def seat(c, w):
        t = sum(map(len, rooms[c].values()))
        if sit(rooms[c], w, discount, (theta + discount * t) * from_top(w)):
            k = sum(map(len, top.values()))
            sit(top, w, parent_discount, (theta + parent_discount * k) / outcomes)

    for c, w in places:
        seat(c, w)
    pairs = sorted(set(places))
    total = np.zeros(len(pairs))
    for sweep in range(sweeps):
        for c, w in places:
            if leave(rooms[c], w):
                leave(top, w)
            seat(c, w)
        if sweep >= burn_in:
            for i, (c, w) in enumerate(pairs):
                own = rooms[c][w]
                n, t = sum(map(sum, rooms[c].values())), sum(map(len, rooms[c].values()))
                total[i] += (sum(own) - discount * len(own) + (theta + discount * t) * from_top(w)) / (
                    theta + n
                )
    return dict(zip(pairs, total / (sweeps - burn_in)))


def test_agrees_with_seating_one_by_one(spark):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{int(x) % 9}" for x in rng.zipf(1.7, 12)) for _ in range(14)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = pitman_yor.fit(df, Settings(burn_in=2, samples=12))
    served = pitman_yor._token_table(pitman_yor.pair_counts(df)).collect()
    ones, twos = (sum(r.served == k for r in served) for k in (1, 2))
    parent_discount = pitman_yor.estimated_discount(ones, twos)
    want = sequential(texts, model.discount, parent_discount, model.strength, 250, 50, 5)
    p, _ = probabilities(model)
    off = [p(code(c), code(w)) - q for (c, w), q in want.items()]
    assert np.abs(off).max() < 0.06 and np.abs(off).mean() < 0.01


def base_by_hand(rows, held):
    tokens = {i: [*words(t), ""] for i, t in rows}
    counts = Counter()
    for i, own in tokens.items():
        if not held(i):
            counts.update(own)
    n, v = sum(counts.values()), len(counts)
    return {
        i: (
            len(own),
            sum(counts[w] > 0 for w in own),
            n,
            sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own),
        )
        for i, own in tokens.items()
    }


def test_query_equals_counts_by_hand_and_beats_the_base(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    held = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 5 == 1 for d in docs}
    want = base_by_hand([tuple(d) for d in docs], held.get)
    found = catalog.op5_pitman_yor(spark, folder).collect()
    assert len(found) == len(docs)
    for r in found:
        assert r.held_out == held[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert r.base_score == pytest.approx(want[r.doc_id][3])
    unseen = [r for r in found if r.held_out]
    assert sum(r.score for r in unseen) > -3.6 * sum(r.n_tokens for r in unseen)
    assert np.mean([r.score > r.base_score for r in unseen]) > 0.95


def scored(spark, docs, held):
    rows = pitman_yor.scores(docs, held).collect()
    return {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows}


def zipf_documents(spark, n, seed=11):
    rng = np.random.default_rng(seed)
    texts = [" ".join(f"w{int(x) % 3000}" for x in rng.zipf(1.3, 80) % 10**9) for _ in range(n)]
    return documents(spark, list(enumerate(texts))).cache()


def test_any_grid_and_blocks_give_the_same_scores(spark, monkeypatch):
    docs, held = zipf_documents(spark, 150), F.col("doc_id") % 5 == 1
    whole = scored(spark, docs, held)
    monkeypatch.setattr(pitman_yor, "CELL_TOKENS", 1000)
    monkeypatch.setattr(pitman_yor, "BLOCK_BYTES", 1500)
    parted = scored(spark, docs, held)
    assert whole.keys() == parted.keys() == set(range(150))
    for i, values in whole.items():
        assert parted[i] == pytest.approx(values, rel=1e-9)


def test_tables_in_between_are_small_and_go(spark):
    """Stored pairs took 16 bytes and more each, and all tables stayed."""
    docs = zipf_documents(spark, 400)
    folder = Path(shared_folder(spark).removeprefix("file:")) / "renewlens"
    before = set(folder.iterdir()) if folder.exists() else set()
    assert len(scored(spark, docs, F.col("doc_id") % 5 == 1)) == 400
    assert [p.name.split("-")[0] for p in set(folder.iterdir()) - before] == ["scores"]
    written = pitman_yor._Tables(spark)
    rows = docs.select(F.col("doc_id").alias("id"), "text", F.lit(False).alias("held_out"))
    texts, numbered, cells, _ = pitman_yor._grid(rows, written)
    (row,) = cells.select(F.length("pairs").alias("size"), "pairs").collect()
    pairs = pitman_yor._unpacked(bytes(row.pairs), True)
    assert len(pairs) > 10_000 and row["size"] < 4 * len(pairs)
    (tokens,) = texts.agg(F.sum(F.length("tokens")), F.sum("size")).collect()
    assert tokens[0] < 2 * tokens[1]


def test_awkward_rows(spark):
    rows = [(i, f"the cat {i % 7} sat on the mat") for i in range(40)]
    rows += [(100, None), (101, ""), (None, "the cat"), (102, "the " * 40_000)]
    rows += [(103, "new words only"), (103, "new words only"), (103, "the same id")]
    docs = documents(spark, rows)
    held = F.col("doc_id").isin(101, 103)
    found = pitman_yor.scores(docs, held).collect()
    assert len(found) == len(rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[100][0].n_tokens == by_id[101][0].n_tokens == 1
    assert sorted(r.n_tokens for r in by_id[103]) == [4, 4, 4]
    assert sorted(r.n_known for r in by_id[103]) == [1, 1, 2]
    assert by_id[102][0].n_tokens == 40_001


def test_nothing_to_learn_from(spark):
    found = pitman_yor.scores(documents(spark, [(1, "a b"), (2, None)]), F.lit(True)).collect()
    assert [(r.score, r.base_score, r.n_known, r.train_tokens) for r in found] == [(0, 0, 0, 0)] * 2
    assert pitman_yor.scores(empty_documents(spark), F.lit(False)).collect() == []
