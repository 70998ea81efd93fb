"""The chain against all of its paths, and the tagger on held-out rows."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from frames_llm import documents, empty_documents
from renewlens.llm import blocks, catalog, toxic_spans

BAD = ("grobian", "schuft", "lump")


def all_paths(score, turn):
    """Marginals of one row by summing over every path."""
    total, toxic = 0.0, np.zeros(len(score))
    for path in itertools.product((0, 1), repeat=len(score)):
        value, last = 0.0, 0
        for s, state in zip(score, path):
            value += state * (s + turn[last])
            last = state
        total += np.exp(value)
        toxic += np.exp(value) * np.array(path)
    return toxic / total


def test_marginals_are_sums_over_paths():
    rng = np.random.default_rng(3)
    turn = np.array([-1.0, 1.5])
    lengths = [0, 1, 2, 7, 0, 5, 3, 0]
    first = np.concatenate([[0], np.cumsum(lengths)])
    score = rng.normal(0, 2, first[-1])
    found = toxic_spans.marginals(score, first, turn)
    for a, b in zip(first, first[1:]):
        if a < b:
            assert found[a:b] == pytest.approx(all_paths(score[a:b], turn), abs=1e-12)


def test_long_rows_by_lanes():
    """Any number of lanes: a row's marginals do not depend on where it lies."""
    rng = np.random.default_rng(4)
    turn = np.array([-2.0, 1.0])
    score = rng.normal(0, 3, 1000)
    alone = toxic_spans.marginals(score, np.array([0, 1000]), turn)
    more = np.concatenate([rng.normal(0, 3, 37), score, rng.normal(0, 3, 5)])
    inside = toxic_spans.marginals(more, np.array([0, 37, 1037, 1042]), turn)
    assert inside[37:1037] == pytest.approx(alone, abs=1e-12)
    assert np.isfinite(toxic_spans.marginals(np.full(9, 500.0), np.array([0, 9]), turn)).all()
    assert len(toxic_spans.marginals(np.zeros(0), np.array([0, 0]), turn)) == 0


def test_gradient_reaches_a_known_model():
    """Windows drawn from a chain: its marginals are found again."""
    rng = np.random.default_rng(5)
    words, turn = 6, np.array([-1.0, 1.0])
    own = np.array([-1.0, -0.5, 0.0, 0.5, 1.0, 2.0])
    codes = rng.integers(0, words, (6000, 9))
    labels = np.zeros(codes.shape)
    for t in range(9):
        # Drawn from left to right, so what comes behind tells nothing more.
        last = labels[:, t - 1] if t else np.zeros(len(codes))
        p = 1 / (1 + np.exp(-(own[codes[:, t]] + turn[last.astype(int)])))
        labels[:, t] = rng.random(len(codes)) < p
    weights, learned = toxic_spans.train(codes, labels, words)
    model = toxic_spans.Tagger(np.arange(words, dtype=np.uint64), weights, learned)
    before, behind = toxic_spans.beside(codes.ravel(), np.arange(0, codes.size + 1, 9))
    flat = codes.ravel()
    score = weights[flat, 0] + weights[before, 1] + weights[behind, 2]
    found = toxic_spans.marginals(score, np.arange(0, codes.size + 1, 9), model.turn)
    # Calibrated: tokens given about p are toxic about that often.
    for low in np.arange(0, 1, 0.2):
        some = (found >= low) & (found < low + 0.2)
        if some.sum() > 500:
            assert abs(labels.ravel()[some].mean() - found[some].mean()) < 0.03


def test_tokens():
    column = pa.array(["A-b! élan", None, "", "..", "x"])
    hashes, begins, ends, first = toxic_spans.tokens(*blocks.byte_offsets(column))
    assert first.tolist() == [0, 3, 3, 3, 3, 4]
    data, _ = blocks.byte_offsets(column)
    cut = [bytes(data[a:b]).decode() for a, b in zip(begins, ends)]
    assert cut == ["A", "b", "élan", "x"]
    again, *_ = toxic_spans.tokens(*blocks.byte_offsets(pa.array(["a", "b"])))
    assert (hashes[:2] == again).all()


def corpus(spark, rows=600):
    """Texts of a small language; every third is toxic by one of three words."""
    rng = np.random.default_rng(6)
    vocabulary = [f"w{k}" for k in range(400)]
    made, labels = [], []
    for i in range(rows):
        words = [str(w) for w in rng.choice(vocabulary, rng.integers(5, 60))]
        if i % 3 == 0:
            for _ in range(rng.integers(1, 4)):
                words.insert(int(rng.integers(len(words) + 1)), str(rng.choice(BAD)))
        made.append((i, " ".join(words).capitalize() + ".", "en", "s"))
        labels.append((i, int(i % 3 == 0)))
    # A toxic document with hundreds of copies, changed here and there.
    base = ["copied"] + [f"c{k}" for k in range(60)] + ["lump"]
    for i in range(rows, rows + 200):
        words = list(base)
        words[int(rng.integers(61))] = str(rng.choice(vocabulary))
        made.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1))
    docs = documents(spark, made)
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), made


def test_held_out_rows_and_spans(spark):
    docs, labels, made = corpus(spark)
    learned = labels.where("doc_id % 5 <> 0")
    model = toxic_spans.fit(docs, learned)
    found = toxic_spans.score(docs, model).collect()
    texts = {r[0]: r[1] for r in made}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    for r in found:
        assert r.predicted == truth[r.doc_id] == int(r.score >= 0.5), (r, texts[r.doc_id])
        marked = {texts[r.doc_id][s.begin : s.end].lower() for s in r.spans if s.marginal >= 0.5}
        assert marked <= set(BAD) and bool(marked) == bool(truth[r.doc_id])
    # Words of the copied passage are not toxic where they stand alone.
    clean = documents(spark, [(9001, "c1 c2 w3 w4 copied w5"), (9002, "ein Schuft, sagt er")])
    alone = {r.doc_id: r for r in toxic_spans.score(clean, model).collect()}
    assert alone[9001].predicted == 0 and alone[9002].predicted == 1
    assert [(s.begin, s.end) for s in alone[9002].spans] == [(4, 10)]


def test_awkward_rows(spark):
    docs, labels, _ = corpus(spark, 300)
    model = toxic_spans.fit(docs, labels)
    long = "w1 w2 " * 100_000
    odd = documents(
        spark,
        [(1, None), (2, ""), (3, " ... "), (4, long), (4, long + "Schuft"), (None, "lump"), (5, "é lump")],
    )
    found = sorted(
        (str(r.doc_id), r.predicted, [(s.begin, s.end) for s in r.spans], r.score)
        for r in toxic_spans.score(odd, model).collect()
    )
    places = [f[:3] for f in found]
    end = len(long)
    assert places == [
        ("1", 0, []),
        ("2", 0, []),
        ("3", 0, []),
        ("4", 0, []),
        ("4", 1, [(end, end + 6)]),
        ("5", 1, [(2, 6)]),
        ("None", 1, [(0, 4)]),
    ]
    assert [f[3] for f in found[:3]] == [0, 0, 0]
    assert toxic_spans.score(empty_documents(spark), model).collect() == []


def test_nothing_to_learn(spark):
    docs, labels, _ = corpus(spark, 60)
    for none in (labels.where("false"), labels.where("toxic = 1"), labels.where("toxic = 0")):
        model = toxic_spans.fit(docs, none)
        assert model is None
        assert {r.score for r in toxic_spans.score(docs, model).collect()} == {0.0}
    assert toxic_spans.fit(empty_documents(spark), labels) is None


def test_sample_is_bounded_by_rows(spark):
    """However many rows an id has, and whatever its labels say."""
    many = documents(spark, [(1, f"text {i}") for i in range(500)] + [(2, "other")] * 300)
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 1), (4, None)], "doc_id long, toxic int")
    rows = toxic_spans.training_rows(many, labels, "doc_id", "text", sample=50).collect()
    assert sum(r.toxic == 1 for r in rows) == 50 and sum(r.toxic == 0 for r in rows) == 1


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    found = catalog.op12_toxic_spans(spark, folder)
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = found.join(labels, "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("share"))
    share = {r.toxic: r.share for r in judged.collect()}
    assert share[0] <= 0.01 and share[1] >= 0.6
    assert found.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
