"""Document quality without labels.

Heuristic labellers vote good, bad or nothing on every document. Expectation-
maximisation over the counts of their vote patterns estimates how often each is
right, which gives every pattern a posterior. These posteriors label a bounded
sample, on which a hashed linear scorer is trained; the scorer judges all
documents.

The labellers are fixed rules on shares of bytes and words; there are 4**8 vote
patterns at most, so the pattern counts are a bounded table however many
documents there are. Counting and scoring cover all rows, each in one pass
without a shuffle of texts.

NULL and empty texts, and texts without a word, score 0 and are rejected.
Repeated rows give repeated results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens.llm import blocks
from renewlens.llm.sampling import least_marks, row_mark
from renewlens.session import staged

# Different rows used to train the scorer, in hash order of id and text.
SAMPLE = 4096
WIDTH = 1024  # hashed features
RUN = 3  # bytes in a feature
EM_ROUNDS = 50
THRESHOLD = 0.35
GOOD, BAD, SILENT, EXEMPT = 0, 1, 2, 3
SHORT = 40  # byte runs by which the features of short texts are shrunk

# Labellers: name, statistic, vote, least words. A labeller votes for one side, or
# not at all: on the bad side from a share on, on the good side from or below one.
LABELLERS = (
    ("symbols", "symbol_share", "bad", ">=", 0.05, 1),
    ("ragged", "ragged_share", "bad", ">=", 0.25, 2),
    ("capitals", "capital_share", "bad", ">=", 0.4, 4),
    ("shouting", "bang_share", "bad", ">=", 0.2, 1),
    ("stutter", "repeat_share", "bad", ">=", 0.15, 4),
    ("few_words", "same_share", "bad", ">=", 0.9, 40),
    ("prose", "prose_share", "good", ">=", 0.93, 1),
    ("variety", "repeat_share", "good", "<", 0.03, 4),
)


SHARES = (
    "symbol_share",
    "ragged_share",
    "capital_share",
    "bang_share",
    "repeat_share",
    "same_share",
    "plain_share",
)


@dataclass(frozen=True)
class QualityModel:
    prior: float
    votes: np.ndarray  # class x labeller x vote
    weights: np.ndarray
    bias: float

    def accuracies(self) -> dict[str, float]:
        """Chance that a document is of the side a labeller votes for."""
        side = np.array([GOOD if rule[2] == "good" else BAD for rule in LABELLERS])
        each = np.arange(len(LABELLERS))
        cast = np.array([self.prior, 1 - self.prior])[:, None] * self.votes[:, each, side]
        return {r[0]: float(c[s] / c.sum()) for r, s, c in zip(LABELLERS, side, cast.T)}


_KIND = np.zeros((5, 256), bool)  # symbol, capital, letter, digit, space
_KIND[0, list(b"#$%&*|!<>{}[]\\^~=+@_")] = True
_KIND[1, ord("A") : ord("Z") + 1] = True
_KIND[2, ord("A") : ord("Z") + 1] = _KIND[2, ord("a") : ord("z") + 1] = True
_KIND[3, ord("0") : ord("9") + 1] = True
_KIND[4] = blocks.SEPARATORS


def _statistics(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    def within(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[bounds[1:]] - sums[bounds[:-1]]

    symbol, capital, letter, digit, space = (within(kind[data]) for kind in _KIND)
    ink = np.maximum(np.diff(bounds) - space, 1)
    hashes, first = blocks.words(data, bounds)
    count = np.diff(first)
    rows = np.repeat(np.arange(len(count)), count)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    repeats = np.bincount(rows, again, len(count))
    ordered = hashes[np.lexsort((hashes, rows))]
    same = np.zeros(len(hashes), bool)
    same[1:] = (ordered[1:] == ordered[:-1]) & (rows[1:] == rows[:-1])
    some = np.maximum(count, 1)
    # Plain are lower-case letters, capitals that begin a word, full stops and commas.
    begins = np.zeros(len(data), bool)
    begins[1:] = _KIND[4][data[:-1]]
    begins[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    plain = letter - capital + within(data >= 0x80)
    plain = plain + within((begins & _KIND[1][data]) | (data == ord(".")) | (data == ord(",")))
    # A word is ragged if its last byte is a symbol.
    ends = np.zeros(len(data), bool)
    ends[:-1] = _KIND[4][data[1:]]
    ends[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = True
    return {
        "words": count,
        "symbol_share": symbol / ink,
        "ragged_share": within(ends & _KIND[0][data]) / some,
        "capital_share": capital / np.maximum(letter, 1),
        "bang_share": within(data == ord("!")) / some,
        "repeat_share": repeats / np.maximum(count - 1, 1),
        "same_share": np.bincount(rows, same, len(count)) / some,
        "plain_share": plain / ink,
        "prose_share": plain / ink * (1 - repeats / np.maximum(count - 1, 1)),
    }


def _votes(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Votes, one row per document, one column per labeller."""
    out = np.full((len(stats["words"]), len(LABELLERS)), EXEMPT, np.int64)
    for k, (_, name, side, order, share, least) in enumerate(LABELLERS):
        met = stats[name] >= share if order == ">=" else stats[name] < share
        entitled = stats["words"] >= least
        out[entitled, k] = SILENT
        out[entitled & met, k] = GOOD if side == "good" else BAD
    return out


def _features(
    data: np.ndarray, bounds: np.ndarray, stats: dict[str, np.ndarray]
) -> np.ndarray:
    """Hashed byte runs, letters reduced to upper and lower case, as shrunk root shares.

    The last places hold the roots of the labellers' own shares.
    """
    shape = data.copy()
    shape[(data >= ord("a")) & (data <= ord("z"))] = ord("a")
    shape[_KIND[1][data]] = ord("A")
    shape[data >= 0x80] = ord("a")
    shape[_KIND[3][data]] = ord("0")
    code, rows = blocks.grams(shape, bounds, RUN)
    shift = np.uint64(64 - WIDTH.bit_length() + 1)
    place = (code * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64)
    n = len(bounds) - 1
    # A block of very short rows is taken in parts, so that the matrix stays small.
    counts = np.bincount(rows * WIDTH + place, minlength=n * WIDTH).reshape(n, WIDTH)
    out = np.sqrt(counts / (counts.sum(1) + SHORT)[:, None]).astype(np.float32)
    for place, name in enumerate(SHARES):
        out[:, -1 - place] = np.sqrt(np.minimum(stats[name], 1))
    # Texts too short to be judged by repeated words show none.
    out[:, -1 - SHARES.index("same_share")] *= stats["words"] >= 40
    return out


def _parts(column: pa.Array, rows: int = 512):
    for first, end, data, bounds in blocks.blocks(column):
        for at in range(0, end - first, rows):
            to = min(at + rows, end - first)
            yield (
                first + at,
                first + to,
                data[bounds[at] : bounds[to]],
                bounds[at : to + 1] - bounds[at],
            )


def _pattern_codes(votes: np.ndarray) -> np.ndarray:
    return votes @ (4 ** np.arange(len(LABELLERS)))


def pattern_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows per vote pattern, over all documents with a word: (pattern, n)."""

    def run(batches):
        for batch in batches:
            total = np.zeros(4 ** len(LABELLERS), np.int64)
            for _, _, data, bounds in _parts(blocks.string_column(batch, "__text")):
                stats = _statistics(data, bounds)
                codes = _pattern_codes(_votes(stats)[stats["words"] > 0])
                total += np.bincount(codes, minlength=len(total))
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen), pa.array(total[seen])], names=["pattern", "n"]
            )

    counts = docs.select(F.col(text_col).alias("__text")).mapInArrow(
        run, "pattern long, n long"
    )
    return counts.groupBy("pattern").agg(F.sum("n").alias("n"))


def estimate(patterns: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
    """Share of good documents, and each labeller's votes by class, by EM.

    It starts from believing any single bad vote, for the labellers each know one
    kind of bad text, so that most of them are silent on most bad documents.
    """
    votes = patterns[:, None] // 4 ** np.arange(len(LABELLERS)) % 4
    good = np.where((votes == BAD).any(1), 0.05, 0.95)
    weight = counts / counts.sum()
    for _ in range(EM_ROUNDS):
        prior = float(np.clip((weight * good).sum(), 1e-6, 1 - 1e-6))
        table = np.empty((2, len(LABELLERS), 3))
        for k, belief in enumerate((good, 1 - good)):
            for vote in (GOOD, BAD, SILENT):
                table[k, :, vote] = (weight * belief) @ (votes == vote)
            table[k] = (table[k] + 1e-4) / (table[k].sum(1, keepdims=True) + 3e-4)
        good = _posterior(votes, prior, table)
    return prior, table


def _posterior(votes: np.ndarray, prior: float, table: np.ndarray) -> np.ndarray:
    each = np.arange(len(LABELLERS))
    told = np.concatenate([np.log(table), np.zeros((2, len(LABELLERS), 1))], axis=2)
    good, bad = (told[k, each, votes].sum(1) for k in (0, 1))
    gap = np.log1p(-prior) + bad - np.log(prior) - good
    return 1 / (1 + np.exp(np.clip(gap, -500, 500)))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> QualityModel | None:
    """Label model over all rows, scorer on the bounded sample; None without words."""
    rows = sorted(pattern_counts(docs, text_col).collect())
    if not rows:
        return None
    prior, table = estimate(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float))
    texts = docs.select(
        F.col(id_col).alias("__id"),
        F.col(text_col).alias("__text"),
        row_mark(id_col, text_col).alias("mark"),
    ).where("__id IS NOT NULL")
    sample = staged(least_marks(texts, SAMPLE), "quality-sample")
    # SAMPLE different rows at most, however often an id or a row comes again.
    chosen = texts.join(F.broadcast(sample), "mark").dropDuplicates(["mark"])

    def encode(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("__id"))
            for first, end, data, bounds in _parts(blocks.string_column(batch, "__text")):
                stats = _statistics(data, bounds)
                good = _posterior(_votes(stats), prior, table)
                x = _features(data, bounds, stats).astype(np.float16)
                part = pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, end - first).cast(pa.string()),
                        pa.array(good),
                        pa.array([row.tobytes() for row in x], pa.binary()),
                    ],
                    names=["id", "good", "x"],
                )
                yield part.filter(pa.array(stats["words"] > 0))

    found = chosen.mapInArrow(encode, "id string, good double, x binary").collect()
    found = sorted(found, key=lambda r: (r.id, r.x))
    if not found:
        return QualityModel(prior, table, np.zeros(WIDTH, np.float32), 5.0)
    x = np.stack([np.frombuffer(r.x, np.float16) for r in found]).astype(np.float32)
    weights, bias = _train(x, np.array([r.good for r in found]))
    return QualityModel(prior, table, weights, bias)


def _train(x: np.ndarray, good: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels: accelerated gradient, small ridge."""
    w = np.zeros(x.shape[1], np.float32)
    good = good.astype(np.float32)
    b = 0.0
    last_w, last_b, step, ridge = w, b, np.float32(3), np.float32(1e-5)
    for k in range(rounds):
        pace = np.float32(k / (k + 3))
        at_w, at_b = w + pace * (w - last_w), b + pace * (b - last_b)
        error = 1 / (1 + np.exp(-(x @ at_w + np.float32(at_b)))) - good
        last_w, last_b = w, b
        w = at_w - step * (error @ x / np.float32(len(x)) + ridge * at_w)
        b = float(at_b - step * error.mean())
    return w.astype(np.float32), b


def _judge(column: pa.Array, model: QualityModel | None):
    """Scorer's probability of good and the labellers' posterior: (first row, end, both)."""
    if model is None:
        yield 0, len(column), np.zeros(len(column)), np.zeros(len(column))
        return
    for first, end, data, bounds in _parts(column):
        stats = _statistics(data, bounds)
        some = stats["words"] > 0
        value = _features(data, bounds, stats) @ model.weights + model.bias
        belief = _posterior(_votes(stats), model.prior, model.votes)
        yield (
            first,
            end,
            np.where(some, 1 / (1 + np.exp(-value.astype(float))), 0),
            np.where(some, belief, 0),
        )


def score(
    docs: DataFrame,
    model: QualityModel | None,
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """``keep`` columns, ``weak_posterior``, ``score`` and ``kept``, one row per input row."""
    source = docs.select(
        *(F.col(c).alias(f"__{k}") for k, c in enumerate(keep)), F.col(text_col).alias("__text")
    )

    def run(batches):
        for batch in batches:
            for first, end, value, belief in _judge(blocks.string_column(batch, "__text"), model):
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(first, end - first) for k in range(len(keep))),
                        pa.array(belief),
                        pa.array(value),
                        pa.array(value >= THRESHOLD),
                    ],
                    names=[*keep, "weak_posterior", "score", "kept"],
                )

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(run, f"{kept}, weak_posterior double, score double, kept boolean")


def accepted(docs: DataFrame, model: QualityModel | None, text_col: str = "text") -> DataFrame:
    """Whole rows that the scorer finds good."""

    def run(batches):
        for batch in batches:
            for first, end, value, _ in _judge(blocks.string_column(batch, text_col), model):
                yield batch.slice(first, end - first).filter(pa.array(value >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
