"""Language of a text, by a string kernel.

Kernel: the blended spectrum of byte runs of 1 to ``MAX_RUN`` bytes, as
presence: two texts are as alike as the share of different runs they have in
common, ``|A and B| / sqrt(|A| |B|)``. Runs are hashed to ``WIDTH`` places.
Landmark texts stand in for the training set (Nystroem), one-versus-rest kernel
ridge regression gives one weight per landmark and language, and texts are
scored by two matrix products a batch.

Fitting uses a sample of at most ``SAMPLE`` rows, an equal number of each
language, taken in hash order of the id; everything else runs over all rows in
one pass without a shuffle.

How familiar a text is does not follow from its scores, which are near 0.5 for any
text unlike the landmarks. It is the mean, over the text's different runs, of the
logarithm of the share of a language's sample texts that have the run, in the
language where this is largest. ``recognised`` also asks for the least familiarity,
by number of runs. It is set from the sample's texts and their beginnings, each held
against all sample texts but itself: half as far below the ``STRANGE`` quantile as
that is below the median. A language with one sample text sets none.

A NULL text, or one without a letter, is ``und`` with score 0; so is every text
where there was nothing to learn from. Repeated rows give repeated results;
equal scores go to the first language in alphabetical order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens.llm import blocks
from renewlens.llm.sampling import least_marks_by, row_mark
from renewlens.session import staged

MAX_RUN = 3
WIDTH = 8192
LANDMARKS = 192
SAMPLE = 3072
RIDGE = 1e-3
BATCH_ROWS = 256
CUTS = (4, 8, 32, 128, 512)  # characters of the beginnings
STRANGE = 0.005
LEAST_ROWS = 20  # texts that set a limit for their number of runs
UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    landmarks: np.ndarray  # packed bits, one row per landmark
    weights: np.ndarray  # landmarks x languages
    log_shares: np.ndarray  # places x languages: log share of texts with a run there
    familiar: np.ndarray  # least familiarity, by the binary logarithm of the runs


def presence(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """0/1 matrices, at most ``BATCH_ROWS`` texts each: (first row, end, matrix)."""
    shift = np.uint64(64 - WIDTH.bit_length() + 1)
    for first, end, data, bounds in blocks.blocks(column):
        data = blocks.LOWER[data]
        for at in range(0, end - first, BATCH_ROWS):
            to = min(at + BATCH_ROWS, end - first)
            part, edges = data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
            found = np.zeros((to - at, WIDTH), np.float32)
            for n in range(1, MAX_RUN + 1):
                code, rows = blocks.grams(part, edges, n)
                place = (code + np.uint64(n << 56)) * np.uint64(0x9E3779B97F4A7C15) >> shift
                found[rows, place.astype(np.int64)] = 1
            yield first + at, first + to, found


def _kernel(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.maximum(left.sum(1), 1))[:, None] * np.sqrt(np.maximum(right.sum(1), 1))
    return (left @ right.T) / size


def _packed(column: pa.Array) -> list[bytes]:
    """Presence bits of each text."""
    return [
        bytes(row)
        for _, _, found in presence(column)
        for row in np.packbits(found.astype(np.uint8), axis=1)
    ]


def _magnitude(runs: np.ndarray) -> np.ndarray:
    """Binary logarithm of the number of runs, rounded down."""
    return np.frexp(np.maximum(runs, 1))[1] - 1


def _familiarity(bits: np.ndarray, labels: np.ndarray, owner: np.ndarray, cuts: np.ndarray):
    """Log shares of places, and the least familiarity. owner: the text of each cut."""
    # Exact copies count once.
    _, once = np.unique(bits, axis=0, return_index=True)
    languages = labels.max() + 1
    texts = np.bincount(labels[once], minlength=languages)
    counts = np.zeros((WIDTH, languages))
    for k in range(languages):
        for at in range(0, len(own := once[labels[once] == k]), BATCH_ROWS):
            counts[:, k] += np.unpackbits(bits[own[at : at + BATCH_ROWS]], axis=1).sum(0)
    log_shares = np.log((counts + 0.5) / (texts + 1))
    values, runs = [], []
    kept = np.isin(owner, once)
    every = np.concatenate([bits[once], cuts[kept]])
    label = labels[np.concatenate([once, owner[kept]])]
    for k in np.flatnonzero(texts > 1):
        # A beginning has no run that its text lacks.
        without = np.log(np.maximum(counts[:, k] - 0.5, 0.5) / texts[k])
        tables = log_shares.copy()
        tables[:, k] = without
        for at in range(0, len(own := every[label == k]), BATCH_ROWS):
            found = np.unpackbits(own[at : at + BATCH_ROWS], axis=1).astype(np.float32)
            runs.append(found.sum(1))
            values.append((found @ tables).max(1) / np.maximum(runs[-1], 1))
    limits = np.full(WIDTH.bit_length(), -np.inf)
    if values:
        value, size = np.concatenate(values), _magnitude(np.concatenate(runs))
        often = np.flatnonzero(np.bincount(size) >= LEAST_ROWS)
        for k in range(len(limits)):
            same = size == often[np.abs(often - k).argmin()] if len(often) else slice(None)
            low, middle = np.quantile(value[same], [STRANGE, 0.5])
            limits[k] = low - (middle - low) / 2
    return log_shares.astype(np.float32), limits


def has_letter(column: pa.Array) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    data, bounds = blocks.byte_offsets(column)
    lower = blocks.LOWER[data]
    ascii_letter = (lower >= ord("a")) & (lower <= ord("z"))
    sums = np.concatenate([[0], np.cumsum(ascii_letter)])
    found = sums[bounds[1:]] > sums[bounds[:-1]]
    for row in np.flatnonzero(~found & (bounds[1:] > bounds[:-1])):
        text = bytes(data[bounds[row] : bounds[row + 1]]).decode("utf-8", "replace")
        found[row] = any(map(str.isalpha, text))
    return found


def _training_rows(rows: DataFrame) -> DataFrame:
    """Marks of the sample: an equal share of each language, in hash order.

    A mark stands for id, text and language, so a text is learned under its own row's
    language and the bound holds however often an id comes again. With more languages
    than the sample has room for, those with the least marks are learned.
    """
    languages = max(1, rows.select("__lang").distinct().count())
    quota = max(2, SAMPLE // languages)
    marks = least_marks_by(rows, "__lang", quota).select("mark")
    return marks.orderBy("mark").limit(SAMPLE)


def fit(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> LanguageModel | None:
    """Learn from rows with text and language; None if there are none.

    Only presence bits of the bounded sample reach the driver.
    """
    texts = labelled.select(
        F.col(id_col).alias("__id"),
        F.col(lang_col).alias("__lang"),
        F.col(text_col).alias("__text"),
        row_mark(id_col, lang_col, text_col).alias("mark"),
    ).where("__id IS NOT NULL AND __lang IS NOT NULL AND __text IS NOT NULL")
    # At most SAMPLE marks, hence a bounded broadcast; equal rows are learned once.
    sample = staged(_training_rows(texts.select("__lang", "mark")), "language-sample")
    chosen = texts.join(F.broadcast(sample), "mark").dropDuplicates(["mark"])

    def encode(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                texts = blocks.string_column(batch, "__text")
                cuts = [[] for _ in range(len(texts))]
                for length in CUTS:
                    short = pc.utf8_slice_codeunits(texts, 0, length)
                    fits = pc.greater(pc.utf8_length(texts), length).to_numpy(False)
                    fits = fits & has_letter(short)
                    packed = _packed(short.filter(pa.array(fits)))
                    for row, bits in zip(np.flatnonzero(fits), packed):
                        cuts[row].append(bits)
                ids = batch.column(batch.schema.get_field_index("__id"))
                part = pa.RecordBatch.from_arrays(
                    [
                        ids.cast(pa.string()),
                        batch.column(batch.schema.get_field_index("__lang")),
                        pa.array(_packed(texts), pa.binary()),
                        pa.array(cuts, pa.list_(pa.binary())),
                    ],
                    names=["id", "lang", "bits", "cuts"],
                )
                yield part.filter(pa.array(has_letter(texts)))

    kinds = "id string, lang string, bits binary, cuts array<binary>"
    rows = chosen.mapInArrow(encode, kinds).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.lang, r.id, r.bits))
    languages = tuple(sorted({r.lang for r in rows}))
    labels = np.array([languages.index(r.lang) for r in rows])
    bits = np.stack([np.frombuffer(r.bits, np.uint8) for r in rows])
    rng = np.random.default_rng(5)
    share = max(1, LANDMARKS // len(languages))
    picked = [
        np.sort(rng.permutation(own)[:share])
        for own in (np.flatnonzero(labels == k) for k in range(len(languages)))
    ]
    landmarks = bits[np.concatenate(picked)]
    every = np.unpackbits(bits, axis=1).astype(np.float32)
    marks = np.unpackbits(landmarks, axis=1).astype(np.float32)
    cross = _kernel(every, marks).astype(np.float64)
    inner = _kernel(marks, marks).astype(np.float64)
    target = np.where(labels[:, None] == np.arange(len(languages)), 1.0, -1.0)
    system = cross.T @ cross + RIDGE * len(rows) * inner
    system += 1e-8 * np.trace(system) / len(system) * np.eye(len(system))
    owner = np.repeat(np.arange(len(rows)), [len(r.cuts) for r in rows])
    cuts = [np.frombuffer(c, np.uint8) for r in rows for c in r.cuts]
    cuts = np.array(cuts, np.uint8).reshape(-1, WIDTH // 8)
    known = _familiarity(bits, labels, owner, cuts)
    return LanguageModel(languages, landmarks, np.linalg.solve(system, cross.T @ target), *known)


def _judge(column: pa.Array, model: LanguageModel | None):
    """Language number (-1: undetermined), score and whether familiar, of texts:
    (first row, end, all three)."""
    if model is None:
        none = np.zeros(len(column))
        yield 0, len(column), np.full(len(column), -1), none, none.astype(bool)
        return
    marks = np.unpackbits(model.landmarks, axis=1).astype(np.float32)
    for first, end, found in presence(column):
        values = _kernel(found, marks).astype(np.float64) @ model.weights
        silent = ~has_letter(column.slice(first, end - first))
        best = np.where(silent, -1, values.argmax(1))
        score = np.where(silent, 0, np.clip((1 + values.max(1)) / 2, 0, 1))
        runs = found.sum(1)
        shares = (found @ model.log_shares).max(1) / np.maximum(runs, 1)
        yield first, end, best, score, shares >= model.familiar[_magnitude(runs)]


def predict(
    docs: DataFrame,
    model: LanguageModel | None,
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """``keep`` columns plus ``lang_pred`` and ``score``, one row per input row."""
    source = docs.select(
        *(F.col(c).alias(f"__{k}") for k, c in enumerate(keep)), F.col(text_col).alias("__text")
    )
    names = (UNDETERMINED, *(model.languages if model else ()))

    def run(batches):
        for batch in batches:
            texts = blocks.string_column(batch, "__text")
            for first, end, best, score, _ in _judge(texts, model):
                langs = pa.array(names).take(pa.array(best + 1))
                columns = [batch.column(k).slice(first, end - first) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, langs, pa.array(score)], names=[*keep, "lang_pred", "score"]
                )

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(run, f"{kept}, lang_pred string, score double")


def recognised(
    docs: DataFrame, model: LanguageModel | None, least: float, text_col: str = "text"
) -> DataFrame:
    """Whole rows whose language was recognised with at least this score and whose text
    is familiar."""

    def run(batches):
        for batch in batches:
            texts = blocks.string_column(batch, text_col)
            for first, end, best, score, familiar in _judge(texts, model):
                rows = batch.slice(first, end - first)
                yield rows.filter(pa.array((best >= 0) & (score >= least) & familiar))

    return docs.mapInArrow(run, docs.schema)
