"""Toxic spans by a linear-chain conditional random field.

Labels say which documents are toxic, not where. Tokens are labelled first: a word is
taken as toxic if it stands in many different places of toxic documents and hardly ever
in clean ones. Places are counted so that no two share the word before or the word
behind, so a passage that many documents share, changed here and there, counts about
once. On windows of such tokens a chain of two states (plain, toxic) is trained, whose
features are the word, the words beside it, and the state before.

Every document is one chain over all of its tokens. Forward and backward sums are made
by products of two-by-two matrices, lane by lane, so long texts cost no more a token
than short ones. The marginals give offending offsets and the score: the probability
that any offending token is toxic.

Tokens are runs of letters, digits and bytes outside ASCII, A-Z lower-cased. The model
is fitted on a bounded sample: at most ``SAMPLE`` labelled rows of either label, by the
hash of id and text, and ``WINDOWS`` windows of each; all documents are scored in one
pass without a shuffle.

Defined results: NULL and empty texts, and texts without a token, score 0. Without
toxic and clean training rows, or without a word that tells them apart, all scores are
0. Rows without an id are scored, never learned. A document with several labels is toxic
if one says so. Repeated rows give repeated results; an empty table gives no rows. Other
columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens.llm import blocks
from renewlens.session import staged

SAMPLE = 4096  # training rows of either label
WINDOWS = 4  # of a training row
REACH = 7  # tokens on either side of a window's middle
TIMES_CLEAN = 10  # as often a toxic word has to stand in toxic documents, token by token
SURE = 3.0  # what its evidence has to exceed beyond chance, in nats
FLOOR = 0.1  # marginals from which a token counts as offending
THRESHOLD = 0.5
LANE = 64
ROUNDS = 200

INSIDE = np.zeros(256, bool)  # bytes of a token
INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
# Codes beside those of known words: any other word, and no word at all.
UNKNOWN, NOTHING = -2, -1


def tokens(
    data: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every token, and where each row's tokens begin."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(bounds), np.int64)
    # Bytes outside tokens become spaces; then tokens are words.
    hashes, first = blocks.words(np.where(INSIDE[data], data, np.uint8(0x20)), bounds)
    inside = INSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begins = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    return hashes, begins, ends, first


@dataclass(frozen=True)
class Tagger:
    """Known words (hashes, ascending), their weights by role, and the chain's weights."""

    words: np.ndarray
    weights: np.ndarray  # word (two more: any other, none) by self, before, behind
    turn: np.ndarray  # plain to toxic, toxic to toxic; plain is 0

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == hashes, at, UNKNOWN)


def _reset_chain(step: np.ndarray, reset: np.ndarray) -> np.ndarray:
    """Share of the second state after every step of a chain of two states.

    ``step`` is (n, 2, 2), new state by old; where ``reset``, the old state does not
    matter (both columns are alike). Lanes are multiplied out side by side, then each
    goes on from where the one before ends.
    """
    n = len(step)
    lanes = -(-n // LANE)
    whole = np.zeros((lanes * LANE, 2, 2))
    whole[:n] = step
    whole[n:] = np.eye(2)
    whole = whole.reshape(lanes, LANE, 2, 2).transpose(1, 2, 3, 0).copy()
    a, b, c, d = whole[0, 0, 0], whole[0, 0, 1], whole[0, 1, 0], whole[0, 1, 1]
    product = [(a, b, c, d)]
    for k in range(1, LANE):
        p, q, r, s = whole[k, 0, 0], whole[k, 0, 1], whole[k, 1, 0], whole[k, 1, 1]
        a, b, c, d = p * a + q * c, p * b + q * d, r * a + s * c, r * b + s * d
        scale = 1 / np.maximum(np.maximum(a, b), np.maximum(c, d))
        a, b, c, d = a * scale, b * scale, c * scale, d * scale
        product.append((a, b, c, d))
    entry = np.zeros(lanes)
    share = 0.0
    for lane, (p, q, r, s) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist())):
        entry[lane] = share
        plain = p * (1 - share) + q * share
        toxic = r * (1 - share) + s * share
        share = toxic / (plain + toxic)
    out = np.empty((LANE, lanes))
    for k, (p, q, r, s) in enumerate(product):
        plain, toxic = p * (1 - entry) + q * entry, r * (1 - entry) + s * entry
        out[k] = toxic / (plain + toxic)
    return out.T.reshape(-1)[:n]


def marginals(score: np.ndarray, first: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Probability of the toxic state at every token.

    ``score`` is its advantage at each token, ``first`` where rows begin (and the end);
    a row starts from the plain state.
    """
    n = len(score)
    if n == 0:
        return np.zeros(0)
    here = np.exp(np.clip(score, -30, 30))
    into, stay = np.exp(turn)
    filled = first[:-1] < first[1:]
    start, end = np.zeros(n, bool), np.zeros(n, bool)
    start[first[:-1][filled]] = True
    end[first[1:][filled] - 1] = True
    forward = np.empty((n, 2, 2))
    forward[:, 0, :] = 1
    forward[:, 1, 0] = here * into
    forward[:, 1, 1] = np.where(start, here * into, here * stay)
    alpha = _reset_chain(forward, start)
    backward = np.empty((n, 2, 2))
    backward[:, 0, 0] = 1
    backward[:, 0, 1] = np.where(end, 1, into)
    backward[:, 1, 0] = here
    backward[:, 1, 1] = np.where(end, here, here * stay)
    beta = _reset_chain(backward[::-1], end[::-1])[::-1]
    toxic = alpha * beta / here
    return toxic / (toxic + (1 - alpha) * (1 - beta))


def beside(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes before and behind each token inside its row."""
    before = np.concatenate([[NOTHING], codes[:-1]])[: len(codes)]
    behind = np.concatenate([codes[1:], [NOTHING]])[: len(codes)]
    filled = first[:-1] < first[1:]
    before[first[:-1][filled]] = NOTHING
    behind[first[1:][filled] - 1] = NOTHING
    return before, behind


def tagged(data: np.ndarray, bounds: np.ndarray, model: Tagger):
    """(marginals, first bytes, ends, where rows begin) of a block of texts."""
    hashes, begins, ends, first = tokens(data, bounds)
    codes = model.codes(hashes)
    before, behind = beside(codes, first)
    w = model.weights
    score = w[codes, 0] + w[before, 1] + w[behind, 2]
    return marginals(score, first, model.turn), begins, ends, first


def train(codes: np.ndarray, labels: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights by the likelihood of labelled windows; NOTHING fills windows up.

    Adam on the mean gradient with a small ridge. Codes are (windows, tokens), labels
    0 or 1 alike.
    """
    n, length = codes.shape
    real = codes != NOTHING
    pad = np.full((n, 1), NOTHING)
    before = np.hstack([pad, codes[:, :-1]])
    behind = np.hstack([codes[:, 1:], pad])
    size = words + 2
    at = [c % size for c in (codes, before, behind)]  # negative codes are the last rows
    weights, turn = np.zeros((size, 3)), np.array([-2.0, 0.0])
    weights[UNKNOWN, 0] = -2.0
    truth = np.where(real, labels, 0)
    was = np.hstack([np.zeros((n, 1), int), truth[:, :-1]])
    kept = [(truth * real * (was == k)).sum() for k in (0, 1)]
    params = [weights, turn]
    mean = [np.zeros_like(p) for p in params]
    square = [np.zeros_like(p) for p in params]
    tokens_in = real.sum()
    for k in range(1, ROUNDS + 1):
        score = weights[at[0], 0] + weights[at[1], 1] + weights[at[2], 2]
        here = np.exp(np.clip(np.where(real, score, -30), -30, 30))
        into, stay = np.exp(turn)
        alpha = np.empty((length, n))  # share of toxic going forward
        share = np.zeros(n)
        for t in range(length):
            toxic = here[:, t] * ((1 - share) * into + share * stay)
            share = toxic / (toxic + 1)  # plain: 1 from either state
            alpha[t] = share
        prob, pairs = np.empty((length, n)), np.zeros((2, n))
        beta = np.full(n, 0.5)  # share of toxic of what comes behind
        for t in range(length - 1, -1, -1):
            toxic = alpha[t] * beta
            prob[t] = toxic / (toxic + (1 - alpha[t]) * (1 - beta))
            # From each state before: what follows if this token is plain or toxic.
            plain_now, toxic_now = 1 - beta, here[:, t] * beta
            from_plain, from_toxic = plain_now + into * toxic_now, plain_now + stay * toxic_now
            last = alpha[t - 1] if t else np.zeros(n)
            weight = (1 - last) * from_plain + last * from_toxic
            pairs[0] += np.where(real[:, t], (1 - last) * into * toxic_now / weight, 0)
            pairs[1] += np.where(real[:, t], last * stay * toxic_now / weight, 0)
            beta = from_toxic / (from_plain + from_toxic)
        error = np.where(real, prob.T - labels, 0).ravel()
        slope = np.stack([np.bincount(a.ravel(), error, size) for a in at], axis=1)
        slope = slope / tokens_in + 1e-6 * weights
        steps = [slope, np.array([pairs[j].sum() - kept[j] for j in (0, 1)]) / tokens_in]
        for p, g, m, s in zip(params, steps, mean, square):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= 0.3 * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.99**k)) + 1e-9)
    return weights, turn


def training_rows(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int = SAMPLE
) -> DataFrame:
    """At most ``sample`` different rows of either label: ``mark``, ``text``, ``toxic``.

    ``labels`` has the id and ``toxic``. A mark is the hash of id and text, so the bound
    holds however often an id comes again.
    """
    told = labels.groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").alias("toxic"))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(id_col, text_col).alias("mark"),
        F.col(text_col).alias("text"),
    )
    marks = rows.select("id", "mark").join(told.where("toxic IN (0, 1)"), "id")
    each = marks.groupBy("mark").agg(F.max("toxic").alias("toxic"))
    chosen = [each.where(F.col("toxic") == k).orderBy("mark").limit(sample) for k in (0, 1)]
    chosen = staged(chosen[0].unionByName(chosen[1]), "toxic-marks")
    # 2 * sample marks at most.
    found = rows.join(F.broadcast(chosen), "mark").groupBy("mark")
    return found.agg(F.first("text").alias("text"), F.first("toxic").alias("toxic"))


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different (word, word before, word behind) of each block, by label."""
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False)
        for begin, _, data, bounds in blocks.blocks(batch.column(0)):
            hashes, _, _, first = tokens(data, bounds)
            words = hashes.view(np.int64)
            before = np.concatenate([[0], words[:-1]])[: len(words)]
            behind = np.concatenate([words[1:], [0]])[: len(words)]
            filled = first[:-1] < first[1:]
            before[first[:-1][filled]] = 0
            behind[first[1:][filled] - 1] = 0
            row = np.repeat(np.arange(len(bounds) - 1), np.diff(first)) + begin
            found = np.unique(np.stack([words, before, behind, toxic[row]], 1), axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[:, k]) for k in range(4)],
                names=["word", "before", "behind", "toxic"],
            )


def toxic_words(rows: DataFrame) -> np.ndarray:
    """Hashes of the words that mark toxic rows, ascending.

    Bounded by the sample: a word needs a few places of its own.
    """
    met = rows.select("text", F.col("toxic").cast("long")).mapInArrow(
        contexts, "word long, before long, behind long, toxic long"
    )
    met = staged(met.distinct(), "contexts")
    sums = met.groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good")
    )
    total = sums.agg(F.sum("bad"), F.sum("good"), F.count_if(F.col("bad") > 1)).first()
    if not total[0] or not total[1]:
        return np.zeros(0, np.uint64)
    odds = total[1] / total[0]
    likely = F.col("bad") * odds > TIMES_CLEAN * F.col("good")
    some = sums.where(likely & (F.col("bad") > 1)).select("word", "good")
    # Of the places that share a neighbour one counts: the least for both neighbours.
    place = F.xxhash64("word", "before", "behind")
    places = met.where("toxic = 1").join(some, "word").withColumn("place", place)
    least = [
        places.groupBy("word", side).agg(F.min("place").alias(f"least_{side}"))
        for side in ("before", "behind")
    ]
    for side, table in zip(("before", "behind"), least):
        places = places.join(table, ["word", side])
    apart = places.where("place = least_before AND place = least_behind")
    found = apart.groupBy("word").agg(
        F.count(F.lit(1)).alias("bad"), F.first("good").alias("good")
    )
    # Log likelihood ratio of the word's own share of toxic places against everybody's.
    n, share = F.col("bad") + F.col("good"), total[0] / (total[0] + total[1])
    own = F.col("bad") / n
    gain = F.col("bad") * F.log(own / share) + F.when(
        F.col("good") > 0, F.col("good") * F.log((1 - own) / (1 - share))
    ).otherwise(0.0)
    enough = float(np.log(max(total[2], 1)) + SURE)
    sure = found.where((own > share) & (gain > enough) & likely).select("word").collect()
    return np.sort(np.array([r.word for r in sure], np.int64).view(np.uint64))


def windows(rows: DataFrame, lexicon: np.ndarray) -> DataFrame:
    """Labelled windows of the training rows, ``WINDOWS`` a row at most: ``words``, ``labels``.

    Of toxic rows, around words of the lexicon; of clean ones, anywhere, such words
    first. What a toxic row holds besides is not known to be clean, and not learned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for begin, _, data, bounds in blocks.blocks(batch.column(0)):
                hashes, _, _, first = tokens(data, bounds)
                bad = np.isin(hashes, lexicon)
                order = blocks.mix(hashes + np.arange(len(hashes), dtype=np.uint64))
                words, labels = [], []
                for row in range(len(bounds) - 1):
                    a, b = first[row], first[row + 1]
                    middles = np.arange(a, b)
                    if toxic[begin + row]:
                        middles = middles[bad[a:b]]
                    middles = middles[np.lexsort((order[middles], ~bad[middles]))[:WINDOWS]]
                    for m in middles.tolist():
                        span = slice(max(a, m - REACH), min(b, m + REACH + 1))
                        words.append(hashes[span].view(np.int64))
                        labels.append((bad[span] & bool(toxic[begin + row])).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.list_(pa.int64())) for c in (words, labels)],
                    names=["words", "labels"],
                )

    return rows.select("text", F.col("toxic").cast("long")).mapInArrow(
        run, "words array<long>, labels array<long>"
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> Tagger | None:
    """Learn from ``labels`` (id, toxic 0 or 1) of rows in ``docs``; None if they tell nothing."""
    rows = staged(training_rows(docs, labels, id_col, text_col, sample), "toxic-rows")
    lexicon = toxic_words(rows)
    if len(lexicon) == 0:
        return None
    found = windows(rows, lexicon).collect()  # WINDOWS * 2 * sample at most
    found = sorted((tuple(r.words), tuple(r.labels)) for r in found)
    length = 2 * REACH + 1
    hashes = np.zeros((len(found), length), np.uint64)
    truth = np.zeros((len(found), length))
    real = np.zeros((len(found), length), bool)
    for k, (words, marks) in enumerate(found):
        hashes[k, : len(words)] = np.array(words, np.int64).view(np.uint64)
        truth[k, : len(marks)] = marks
        real[k, : len(words)] = True
    known, times = np.unique(hashes[real], return_counts=True)
    known = np.union1d(known[times > 1], lexicon)
    none = Tagger(known, np.zeros((len(known) + 2, 3)), np.zeros(2))
    codes = np.where(real, none.codes(hashes), NOTHING)
    weights, turn = train(codes, truth, len(known))
    return Tagger(known, weights.astype(np.float32), turn)


SPANS = "array<struct<begin:int,end:int,marginal:double>>"


def _judged(column: pa.Array, model: Tagger | None):
    """(first row, end, scores, spans) by blocks; spans in code points."""
    if model is None:
        yield 0, len(column), np.zeros(len(column)), [[]] * len(column)
        return
    for begin, end, data, bounds in blocks.blocks(column):
        prob, starts, ends, first = tagged(data, bounds, model)
        rows = end - begin
        score = np.zeros(rows)
        spans: list[list[dict]] = [[] for _ in range(rows)]
        filled = np.flatnonzero(first[:-1] < first[1:])
        if len(filled):
            score[filled] = np.maximum.reduceat(prob, first[:-1][filled])
        hit = np.flatnonzero(prob >= FLOOR)
        if len(hit):
            row = np.searchsorted(first, hit, side="right") - 1
            gone = np.zeros(rows)
            np.add.at(gone, row, np.log1p(-np.minimum(prob[hit], 1 - 1e-9)))
            score = np.where(gone < 0, -np.expm1(gone), score)
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            for r, t in zip(row.tolist(), hit.tolist()):
                origin = points[bounds[r]]
                spans[r].append(
                    {
                        "begin": int(points[starts[t]] - origin),
                        "end": int(points[ends[t]] - origin),
                        "marginal": float(prob[t]),
                    }
                )
        yield begin, end, np.clip(score, 0, 1), spans


def score(
    docs: DataFrame,
    model: Tagger | None,
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """``keep`` columns, ``score``, ``predicted`` (0 or 1) and offending ``spans``, row by row.

    Spans are code points of the text, the end not included, with their marginal.
    """
    source = docs.select(
        *(F.col(c).alias(f"__{k}") for k, c in enumerate(keep)), F.col(text_col).alias("__text")
    )
    fields = {"begin": pa.int32(), "end": pa.int32(), "marginal": pa.float64()}
    kind = pa.list_(pa.struct(list(fields.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, value, spans in _judged(blocks.string_column(batch, "__text"), model):
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(first, end - first) for k in range(len(keep))),
                        pa.array(value),
                        pa.array((value >= THRESHOLD).astype(np.int32)),
                        pa.array(spans, kind),
                    ],
                    names=[*keep, "score", "predicted", "spans"],
                )

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(run, f"{kept}, score double, predicted int, spans {SPANS}")
