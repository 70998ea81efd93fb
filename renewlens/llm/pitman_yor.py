"""Language-model score of documents: a hierarchical Pitman-Yor model.

A token is a word or the end of the text. Every token of the training texts is a context:
a restaurant whose customers are the tokens that follow it (the first token of a text
follows an end). All these restaurants share one parent, whose customers are their tables
and whose base is uniform over the known tokens and one place for all unknown ones. So a
text's probability is a product over the same V + 1 outcomes a token as for a plain
unigram model, and a token after a context nobody trained on is drawn from the parent.

Seating is sampled by Gibbs. Two auxiliary draws make it a matter of rows:

* The tables of one restaurant meet in a factor (s)(s + d)(s + 2d)..., one term a table.
  With a gamma variable of shape s/d + tables a restaurant, that factor becomes a power,
  and the tables of its dishes are independent of each other.
* The parent's probabilities are drawn as well (gammas of customers less discounts; the
  mass it leaves to its base is spread evenly), and given them the restaurants are
  independent of each other.

So every (context, token) pair draws its tables from its own count, its context's gamma
and its token's probability, and no restaurant, however busy, is one task's work. A pair
seen once has one table and need not be drawn. Up to ``exact`` customers the draw is exact,
by generalised Stirling numbers; beyond, their ratios follow from those at ``exact`` by a
scaling law and from a saddle point, and where 500 tables or more could be expected the
draw is normal around its mode. Predictive probabilities are averaged over the sweeps after
``burn_in``.

Everything is stored in blocks, an array a row, and every table grows with the corpus:

* Texts are encoded once, some megabytes a row: their different words, and tokens as places
  among these. Words are dealt by hash into slices, where they get a number.
* Pairs lie in a grid of cells, context slice by token slice, so the pairs of a context
  are spread over a row of cells and those of a token over a column. A block of texts tells
  each cell its different pairs; the cell counts them and notes who told which. In a sweep
  a cell sends the tables of its words to their slices, and gets draws for these words.
* Counts and tables go back from the cells to the blocks, in the order in which pairs were
  told, and shares from the slices; scores are taken there. A pair or word that no training
  text has is in the tables with a count of 0.

The number of cells grows with the tokens, so cells and blocks keep their size; a slice
holds the words of a row of cells, and grows with the square root. The driver sees one row of sums a sweep. Random numbers are hashes of
token, pair and sweep, so a repeated task draws the same ones.

NULL and empty texts are one end token. Rows without id are learned from. Without any
training row all scores are 0, the logarithm of the only outcome; an empty table gives no
rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from renewlens.llm import blocks
from renewlens.session import fresh_path

END = 0  # among the 64-bit hashes that stand for words; the least of them
BLOCK_BYTES = 4 << 20  # of texts in one row
CELL_TOKENS = 2 << 20  # a cell of the grid for so many tokens
_MARK = np.dtype("<u2")  # the low bits of a word's hash, which tell its slice
_ROWS = 4  # of blocks in one Arrow batch


@dataclass(frozen=True)
class Settings:
    burn_in: int = 2
    samples: int = 3
    strength: float = 1.0
    exact: int = 200
    seed: int = 23


# --- random numbers and seating -----------------------------------------------


def uniforms(keys: np.ndarray, draw: int) -> np.ndarray:
    """The ``draw``-th number between 0 and 1 of each 64-bit key."""
    step = np.uint64(draw * 0x9E3779B97F4A7C15 % (1 << 64))
    return ((blocks.mix(keys + step) >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)


def gammas(shapes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """One gamma variable of each shape, by Marsaglia and Tsang's rejection."""
    small = shapes < 1
    d = np.where(small, shapes + 1, shapes) - 1 / 3
    c = 1 / np.sqrt(9 * d)
    out = np.zeros(len(shapes))
    rows, draw = np.arange(len(shapes)), 1
    while len(rows):
        u, angle, limit = (uniforms(keys[rows], draw + k) for k in range(3))
        z = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * angle)
        v = (1 + c[rows] * z) ** 3
        level = z * z / 2 + d[rows] * (1 - v + np.log(np.maximum(v, 1e-300)))
        taken = (v > 0) & (np.log(limit) < level)
        out[rows[taken]] = d[rows[taken]] * v[taken]
        rows, draw = rows[~taken], draw + 3
    out[small] *= uniforms(keys[small], 0) ** (1 / shapes[small])
    return out


def log_stirling(discount: float, most: int) -> np.ndarray:
    """Logarithms of generalised Stirling numbers, [customers, tables]."""
    out = np.full((most + 1, most + 2), -np.inf)
    out[0, 0] = 0
    tables = np.arange(1, most + 1)
    for n in range(1, most + 1):
        stay = n - 1 - discount * tables
        kept = np.where(stay > 0, out[n - 1, 1:-1] + np.log(np.maximum(stay, 1e-300)), -np.inf)
        out[n, 1:-1] = np.logaddexp(out[n - 1, :-2], kept)
    return out


def draw_tables(
    customers: np.ndarray,
    pull: np.ndarray,
    discount: float,
    stirling: np.ndarray,
    keys: np.ndarray,
) -> np.ndarray:
    """Tables of each dish: p(t) ~ S(customers, t) pull**t."""
    exact = len(stirling) - 1
    tables = np.minimum(customers, 1)
    sizes = np.minimum(customers, exact)
    for n in np.unique(sizes[(sizes > 1) & (customers <= exact)]):
        rows = np.flatnonzero(customers == n)
        t = np.arange(1, n + 1)
        weight = stirling[n, 1 : n + 1] + t * np.log(pull[rows, None])
        edge = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), axis=1)
        tables[rows] = 1 + (edge < uniforms(keys[rows], 0)[:, None] * edge[:, -1:]).sum(1)
    many = np.flatnonzero(customers > exact)
    if len(many):
        first, second = uniforms(keys[many], 0), uniforms(keys[many], 1)
        falls = _falls(discount, stirling)
        for row, u, v in zip(many, first, second):
            tables[row] = _draw_many(int(customers[row]), pull[row], discount, falls, u, v)
    return tables


def _falls(discount: float, stirling: np.ndarray):
    """Slopes of log S(n, t) in t for many customers n, as two functions to interpolate.

    For few tables S(n, t) is about a multiple of f(t / n**discount) / (discount**t
    gamma(t)); the largest exact row shows the slope of log f for all n beyond. For many,
    S(n, t) = n! / (t! discount**t) times the coefficient of z**n in F(z)**t, where
    F(z) = 1 - (1 - z)**discount, and the slope is log F at the saddle point, where
    z t F'(z) = n F(z): a function of n / t.
    """
    exact = len(stirling) - 1
    t, scale = np.arange(1, exact // 10 + 1), exact**discount
    ratio = stirling[exact, 2 : len(t) + 2] - stirling[exact, 1 : len(t) + 1]
    gap = np.concatenate([1 - np.logspace(-9, -1, 2000), np.logspace(np.log10(0.9), -30, 4000)])
    value = -np.expm1(discount * np.log(gap))
    turn = np.log((1 - gap) * discount / value) + (discount - 1) * np.log(gap)
    return (t + 0.5) / scale, (ratio + np.log(discount * t)) * scale, turn, np.log(value)


def _draw_many(n: int, pull: float, discount: float, falls, u: float, v: float) -> int:
    """Tables of a dish with many customers; 1 + Poisson(pull / discount) is the most."""
    mean = pull / discount
    places, few, turns, many = falls

    def slope(t):
        place = (t + 0.5) / n**discount
        near = np.log(mean / t) + np.interp(place, places, few) / n**discount
        far = np.log(mean / (t + 1)) + np.interp(np.log(n / (t + 0.5)), turns, many)
        return np.where(place <= places[-1], near, far)

    if mean < 500:
        t = np.arange(1, min(n, int(mean + 12 * np.sqrt(mean) + 30)) + 1)
        weight = np.concatenate([[0.0], np.cumsum(slope(t[:-1]))])
        edge = np.cumsum(np.exp(weight - weight.max()))
        return 1 + int((edge < u * edge[-1]).sum())
    low, high = 1.0, float(min(n, mean + 1))
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if slope(middle) > 0 else (low, middle)
    width = max(low * 1e-3, 1.0)
    bend = (slope(low + width) - slope(max(low - width, 0.5))) / (2 * width)
    normal = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)
    return int(np.clip(np.rint(low + 0.5 + normal / np.sqrt(max(-bend, 1e-12))), 1, n))


def estimated_discount(ones: int, twos: int) -> float:
    """From the numbers of dishes with one and with two customers."""
    return float(np.clip(ones / max(ones + 2 * twos, 1), 0.1, 0.9))


# --- blocks -------------------------------------------------------------------


def _packed(values: np.ndarray, ascending: bool = False) -> bytes:
    """Integers in few bytes: (steps of) 64-bit values, byte by byte, compressed."""
    values = values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64)
    if ascending:
        values = np.diff(values, prepend=0)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(data: bytes, ascending: bool = False) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(data[8:], 8 * n, "zstd", asbytes=True), np.uint8)
    values = np.ascontiguousarray(planes.reshape(8, n).T).view(np.int64).ravel()
    return np.cumsum(values) if ascending else values


def _hashes(data: bytes) -> np.ndarray:
    """Ascending 64-bit hashes, packed."""
    return _unpacked(data, True).view(np.uint64)


def _doubles(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.float64)


def _rows(batch) -> Iterator[dict]:
    """Rows of a table or batch, one at a time."""
    for i in range(batch.num_rows):
        yield {k: batch.column(j)[i].as_py() for j, k in enumerate(batch.schema.names)}


def _arrow(schema: str):
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    kinds |= {"binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, schema.split(","))])


def _each(df: DataFrame, row, schema: str) -> DataFrame:
    """``row`` of a dict yields the dicts of the rows that come of it."""

    def run(batches):
        for batch in batches:
            for found in _rows(batch):
                for made in row(found):
                    yield pa.RecordBatch.from_pylist([made], schema=_arrow(schema))

    return df.mapInArrow(run, schema)


def _met(left: DataFrame, right: DataFrame, on: list[str], rows, schema: str) -> DataFrame:
    """``rows`` of the dicts of both sides with the same key yields dicts."""

    def run(a, b):
        made = list(rows([*_rows(a)], [*_rows(b)]))
        return pa.Table.from_pylist(made, schema=_arrow(schema))

    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(run, schema)


def _own_session(spark: SparkSession) -> SparkSession:
    """One for rows of blocks: few in a batch, and shuffles deleted as soon as a table is
    written. The caller's session keeps its settings."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_ROWS))
    own.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    # A row is large, so that few bytes are many rows' work.
    own.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    return own


class _Tables:
    """Tables written by one run, each in a folder that can be dropped."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(self.spark, name)
        df.write.parquet(path)
        self.drop(name)  # that of the sweep before, which nothing needs now
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for path in filter(None, (self.paths.pop(name, None) for name in names)):
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


# --- counting -----------------------------------------------------------------


def _tokens(column: pa.Array):
    """Hashes of the tokens of some texts, an end after each, and tokens a text."""
    out, lengths = [], []
    for _, _, data, bounds in blocks.blocks(column):
        hashes, first = blocks.words(data, bounds)
        out.append(np.insert(hashes, first[1:], np.uint64(END)))
        lengths.append(np.diff(first) + 1)
    return np.concatenate(out), np.concatenate(lengths)


_TEXTS = (
    "block long, lengths binary, held binary, tokens binary, words binary, marks binary,"
    " times binary, trained binary"
)


def _by_times(times: np.ndarray) -> np.ndarray:
    """Places of words, the most frequent first: tokens packed as ranks take fewer bytes."""
    return np.argsort(-times, kind="stable")


def _encoded(rows: DataFrame) -> DataFrame:
    """Rows of (id, text, held_out) in blocks: ids, tokens a row, whether it is held out,
    tokens as places among the different words, and how often these are learned from."""

    limit = BLOCK_BYTES

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            column = blocks.string_column(batch, "text")
            for first, end, _, _ in blocks.blocks(column, limit):
                tokens, lengths = _tokens(column.slice(first, end - first))
                held = batch.column(2).slice(first, end - first).to_numpy(zero_copy_only=False)
                words, places, times = np.unique(tokens, return_inverse=True, return_counts=True)
                learned = places[np.repeat(~held.astype(bool), lengths)]
                values = [
                    _packed(lengths),
                    _packed(held),
                    _packed(np.argsort(_by_times(times))[places]),
                    _packed(words, True),
                    words.astype(_MARK).tobytes(),
                    _packed(times),
                    _packed(np.bincount(learned, minlength=len(words))),
                ]
                ids = batch.column(0).slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block]),
                        *(pa.array([v], pa.binary()) for v in values),
                        pa.array([len(tokens)]),
                        pa.array([len(learned)]),
                        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    ],
                    names=[f.split()[0] for f in _TEXTS.split(",")] + ["size", "learned", "ids"],
                )
                block += 1

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"{_TEXTS}, size long, learned long, ids array<{kind}>")


def _numbered(texts: DataFrame, side: int) -> DataFrame:
    """Words' numbers ``at`` in their slice and training counts n: a row (slice, block) for
    the words of a block, and one of block -1 with all words of the slice."""

    def deal(row):
        words, trained = _hashes(row["words"]), _unpacked(row["trained"])
        slices = words.astype(_MARK) % side
        for k in np.unique(slices).tolist():
            own = slices == k
            yield {
                "slice": k,
                "block": row["block"],
                "words": _packed(words[own], True),
                "n": _packed(trained[own]),
            }

    def number(table):
        found, words = [*_rows(table)], np.zeros(0, np.uint64)
        for first in range(0, len(found), 64):
            some = (_hashes(r["words"]) for r in found[first : first + 64])
            words = np.unique(np.concatenate([words, *some]))
        n, made = np.zeros(len(words), np.int64), []
        for r in found:
            at, own = np.searchsorted(words, _hashes(r["words"])), _unpacked(r["n"])
            n[at] += own
            made.append(r | {"words": b"", "at": _packed(at, True), "n": _packed(own)})
        key = {"slice": found[0]["slice"], "block": -1}
        made.append(key | {"words": _packed(words, True), "n": _packed(n)})
        return pa.Table.from_pylist(made, schema=_arrow(f"{schema}, at binary"))

    schema = "slice int, block long, words binary, n binary"
    dealt = _each(texts.select("block", "words", "trained"), deal, schema)
    return dealt.groupBy("slice").applyInArrow(number, f"{schema}, at binary")


def _slices(row: dict, side: int) -> np.ndarray:
    return np.frombuffer(row["marks"], _MARK).astype(np.int64) % side


def _places(row: dict) -> np.ndarray:
    """The tokens of a block, as places among its words."""
    return _by_times(_unpacked(row["times"]))[_unpacked(row["tokens"])]


def _block_pairs(row: dict, side: int):
    """The different pairs of a block, ordered by cell and words: each token's pair, how
    often a pair is learned from, the places of its words, the cells and where each begins."""
    slices, tokens = _slices(row, side), _places(row)
    before = np.concatenate([[0], tokens[:-1]])  # an end, the first word of any block
    pairs, own = np.unique(before * len(slices) + tokens, return_inverse=True)
    contexts, follow = pairs // len(slices), pairs % len(slices)
    cell = slices[contexts] * side + slices[follow]
    order = np.argsort(cell, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    held = np.repeat(_unpacked(row["held"]), _unpacked(row["lengths"]))
    times = np.bincount(own[held == 0], minlength=len(pairs))
    cells, first = np.unique(cell[order], return_index=True)
    return place[own], times[order], contexts[order], follow[order], cells, first


def _told(texts: DataFrame, numbered: DataFrame, side: int) -> DataFrame:
    """(i, j, block, contexts, follow, n): the different pairs of a block in a cell."""

    def tell(left, right):
        (row,) = left
        slices = _slices(row, side)
        at = np.zeros(len(slices), np.int64)
        for r in right:
            at[slices == r["slice"]] = _unpacked(r["at"], True)
        _, times, contexts, follow, cells, first = _block_pairs(row, side)
        contexts, follow = at[contexts], at[follow]
        for k, own in zip(cells.tolist(), _spans(first, len(times))):
            yield {
                "i": k // side,
                "j": k % side,
                "block": row["block"],
                "pairs": _packed(contexts[own] << 32 | follow[own], True),
                "n": _packed(times[own]),
            }

    texts = texts.select("block", "lengths", "held", "tokens", "marks", "times")
    numbers = numbered.where("block >= 0").select("block", "slice", "at")
    schema = "i int, j int, block long, pairs binary, n binary"
    return _met(texts, numbers, ["block"], tell, schema)


def _spans(first: np.ndarray, size: int) -> list[slice]:
    return [slice(a, b) for a, b in zip(first.tolist(), [*first[1:].tolist(), size])]


def _gathered(told: DataFrame) -> DataFrame:
    """A row a cell: its different pairs (numbers of context and token in one), their
    training counts, and for the blocks the places of the pairs that each told."""
    schema = "i int, j int, pairs binary, n binary, blocks binary, sizes binary, places binary"

    def gather(table):
        found = sorted(_rows(table), key=lambda r: r["block"])
        parts = [_unpacked(r["pairs"], True) for r in found]
        pairs, places = np.unique(np.concatenate(parts), return_inverse=True)
        n = np.zeros(len(pairs), np.int64)
        np.add.at(n, places, np.concatenate([_unpacked(r["n"]) for r in found]))
        row = {
            "i": found[0]["i"],
            "j": found[0]["j"],
            "pairs": _packed(pairs, True),
            "n": _packed(n),
            "blocks": _packed(np.array([r["block"] for r in found])),
            "sizes": _packed(np.array([len(p) for p in parts])),
            "places": _packed(places, True),
        }
        return pa.Table.from_pylist([row], schema=_arrow(schema))

    return told.groupBy("i", "j").applyInArrow(gather, schema)


def _halves(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return pairs >> 32, pairs & 0xFFFFFFFF


def _sums(pairs: np.ndarray, tables: np.ndarray) -> dict:
    """The different contexts and tokens of a cell's pairs and the tables of each."""
    made = {}
    for name, words in zip(("context", "token"), _halves(pairs)):
        at, own = np.unique(words, return_inverse=True)
        made[f"{name}s"] = _packed(at, True)
        made[f"{name}_tables"] = _packed(np.bincount(own, tables, len(at)))
    return made


_SUMS = "contexts binary, context_tables binary, tokens binary, token_tables binary"
_SEATING = f"i int, j int, pairs binary, n binary, kept binary, tables binary, {_SUMS}"


def _begun(cells: DataFrame) -> DataFrame:
    """Pairs that come more than once, one table each, and sums of those that come once."""
    names = [f.split()[0] for f in _SUMS.split(",")]

    def begin(row):
        pairs, n = _unpacked(row["pairs"], True), _unpacked(row["n"])
        lone, several = pairs[n == 1], n > 1
        once, ones = _sums(lone, np.ones(len(lone))), np.ones(several.sum(), np.int64)
        yield {
            "i": row["i"],
            "j": row["j"],
            "pairs": _packed(pairs[several], True),
            "n": _packed(n[several]),
            "kept": _packed(0 * ones),
            "tables": _packed(ones),
            "twos": int((n == 2).sum()),
            **_sums(pairs[several], ones),
            **{f"lone_{c}": once[c] for c in names},
        }

    lone = ", ".join(f"lone_{c} binary" for c in names)
    return _each(cells.select("i", "j", "pairs", "n"), begin, f"{_SEATING}, {lone}, twos long")


def _partials(seating: DataFrame, prefix: str = "") -> DataFrame:
    """(slice, i, j, seated, at, tables): a cell's sums by context (seated) and by token."""
    sides = [
        seating.select(
            F.col(k).alias("slice"),
            "i",
            "j",
            F.lit(c == "context").alias("seated"),
            F.col(f"{prefix}{c}s").alias("at"),
            F.col(f"{prefix}{c}_tables").alias("tables"),
        )
        for k, c in (("i", "context"), ("j", "token"))
    ]
    return sides[0].unionByName(sides[1])


def _added(size: int, parts: list[dict], begin: dict | None = None) -> list[np.ndarray]:
    """Sums of a slice's words as dish (served) and as context (seated)."""
    names = ("lone_served", "lone_seated")
    out = [_unpacked(begin[c]) if begin else np.zeros(size, np.int64) for c in names]
    for r in parts:
        out[r["seated"]][_unpacked(r["at"], True)] += _unpacked(r["tables"])
    return out


def _known(numbered: DataFrame, begun: DataFrame) -> DataFrame:
    """A row a slice: hashes and counts of its words, the pairs of each that were seen once,
    as dish and as context, and what the driver needs to know of the slice.

    Every token is followed by one, so its count is also the number of its restaurant's
    customers.
    """

    def add(left, right):
        (row,) = left
        n = _unpacked(row["n"])
        lone = _added(len(n), [r for r in right if r["lone"]])
        more = _added(len(n), [r for r in right if not r["lone"]])
        served = lone[0] + more[0]
        yield {
            "slice": row["slice"],
            "words": row["words"],
            "n": row["n"],
            "lone_served": _packed(lone[0]),
            "lone_seated": _packed(lone[1]),
            "tokens": int(n.sum()),
            "types": int((n > 0).sum()),
            "ones": int(lone[0].sum()),
            "parent_ones": int((served == 1).sum()),
            "parent_twos": int((served == 2).sum()),
        }

    parts = _partials(begun, "lone_").withColumn("lone", F.lit(True))
    parts = parts.unionByName(_partials(begun).withColumn("lone", F.lit(False)))
    schema = (
        "slice int, words binary, n binary, lone_served binary, lone_seated binary,"
        " tokens long, types long, ones long, parent_ones long, parent_twos long"
    )
    vocabulary = numbered.where("block < 0").select("slice", "words", "n")
    return _met(vocabulary, parts, ["slice"], add, schema)


def _grid(rows: DataFrame, written: _Tables):
    """Rows of (id, text, held_out) encoded and, if any is learned from, the numbers of
    their words, the cells of their pairs and the side of the grid."""
    texts = written.write(_encoded(rows), "texts")
    size, learned = texts.agg(F.sum("size"), F.sum("learned")).first()
    if not learned:
        return texts, None, None, 0
    side = min(max(1, math.ceil(math.sqrt(size / CELL_TOKENS))), 1 << 8 * _MARK.itemsize)
    numbered = written.write(_numbered(texts, side), "numbers")
    return texts, numbered, written.write(_gathered(_told(texts, numbered, side)), "cells"), side


def _plain(texts: DataFrame) -> DataFrame:
    return texts.select(F.lit(None).cast("int").alias("id"), "text", F.lit(False).alias("held_out"))


def pair_counts(texts: DataFrame) -> DataFrame:
    """(context, word, n): how often a token follows another, over all rows of (text)."""
    schema = "context long, word long, n long"
    written = _Tables(_own_session(texts.sparkSession))
    _, numbered, cells, side = _grid(_plain(texts), written)
    if cells is None:
        return texts.sparkSession.createDataFrame([], schema)

    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                at, to = _halves(_unpacked(row["pairs"], True))
                columns = [
                    _hashes(row["contexts"]).view(np.int64)[at],
                    _hashes(row["words"]).view(np.int64)[to],
                    _unpacked(row["n"]),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["context", "word", "n"]
                )

    slices = numbered.where("block < 0")
    cells = cells.select("i", "j", "pairs", "n")
    return _beside(cells, slices, side, {"contexts": "words"}, {"words": "words"}).mapInArrow(run, schema)


def _token_table(pairs: DataFrame) -> DataFrame:
    """A row a token: its count, its pairs, and those seen once, as dish and as context."""
    once = F.count_if(F.col("n") == 1)
    dishes = pairs.groupBy("word").agg(
        F.sum("n").alias("n"), F.count("*").alias("served"), once.alias("lone_served")
    )
    seats = pairs.groupBy(F.col("context").alias("word")).agg(
        F.count("*").alias("seated"), once.alias("lone_seated")
    )
    return dishes.join(seats, "word")


# --- fitting ------------------------------------------------------------------


@dataclass(frozen=True)
class Fit:
    """What tasks need to know of a model besides its tables."""

    discount: float
    strength: float
    parent_discount: float
    customers: tuple[int, ...]  # of the parent, by sample
    unknown: tuple[float, ...]  # an unknown token's probability in the parent, by sample

    def shares(self, words: dict) -> list[np.ndarray]:
        """Of words as contexts, the share of customers sent to the parent, by sample."""
        n, theta = words["n"], self.strength
        return [
            np.where(
                n > 0,
                (theta + self.discount * words[f"seated{i}"]) / np.maximum(theta + n, theta or 1),
                1.0,
            )
            for i in range(len(self.unknown))
        ]

    def parents(self, words: dict) -> list[np.ndarray]:
        """The parent's probabilities of words, by sample."""
        return [
            (words[f"served{i}"] - self.parent_discount * words[f"parent_tables{i}"])
            / (self.strength + self.customers[i])
            + rest
            for i, rest in enumerate(self.unknown)
        ]


@dataclass(frozen=True)
class Model:
    """``cells``: all pairs and counts; ``seating``: tables of those that come more than once
    (summed over the samples); ``slices``: words, counts and for every sample i their tables
    as a token, served{i}, and as a context, seated{i}, and tables in the parent."""

    cells: DataFrame
    seating: DataFrame
    slices: DataFrame
    side: int
    tokens: int
    types: int
    fit: Fit

    @property
    def discount(self) -> float:
        return self.fit.discount

    @property
    def strength(self) -> float:
        return self.fit.strength

    @property
    def unknown(self) -> tuple[float, ...]:
        return self.fit.unknown

    @property
    def words(self) -> DataFrame:
        """(word, n, share{i}, parent{i}), a row a token of the training texts."""
        fit = self.fit
        names = [f"{c}{i}" for c in ("share", "parent") for i in range(len(fit.unknown))]

        def run(batches):
            for batch in batches:
                for row in _rows(batch):
                    found = {c: _unpacked(row[c]) for c in row if c not in ("slice", "words")}
                    n = found["n"]
                    columns = [_hashes(row["words"]).view(np.int64), n]
                    columns += [*fit.shares(found), *fit.parents(found)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[n > 0]) for c in columns], names=["word", "n", *names]
                    )

        return self.slices.mapInArrow(
            run, "word long, n long, " + ", ".join(f"{c} double" for c in names)
        )


def _drawn_parent(known, partials, concentration, discount, parent_discount, pull, stirling, seed):
    """The draws of a sweep: a row a slice of the words, and for each cell one with the
    rates of its contexts and one with the weights of its tokens."""

    def draw(left, right):
        (row,) = left
        words, n = _hashes(row["words"]), _unpacked(row["n"])
        served, seated = _added(len(n), right, row)
        own = n > 0
        tables, weight, rate = np.zeros(len(n), np.int64), np.zeros(len(n)), np.zeros(len(n))
        keys = blocks.mix(words[own] + np.uint64(seed))
        tables[own] = draw_tables(
            served[own], np.full(own.sum(), pull), parent_discount, stirling, keys
        )
        weight[own] = gammas(
            served[own] - parent_discount * tables[own], blocks.mix(keys + np.uint64(1))
        )
        rate[own] = gammas(concentration / discount + seated[own], blocks.mix(keys + np.uint64(2)))
        yield {
            "slice": row["slice"],
            "served": _packed(served),
            "seated": _packed(seated),
            "parent_tables": _packed(tables),
            "all_served": int(served.sum()),
            "all_tables": int(tables.sum()),
            "all_weight": float(weight.sum()),
        }
        for r in right:
            at = _unpacked(r["at"], True)
            values = (rate if r["seated"] else weight)[at]
            made = {"words": _packed(words[at], True), "draws": values.tobytes()}
            yield {"slice": row["slice"], "i": r["i"], "j": r["j"], "contexts": r["seated"]} | made

    schema = (
        "slice int, served binary, seated binary, parent_tables binary, all_served long,"
        " all_tables long, all_weight double, i int, j int, contexts boolean, words binary, draws binary"
    )
    return _met(known, partials, ["slice"], draw, schema)


def _beside(cells: DataFrame, slices: DataFrame, side: int, contexts: dict, tokens: dict) -> DataFrame:
    """Cells with columns of the slice of their contexts and of that of their tokens, each
    given as {new name: name}."""
    every = F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    across = slices.select(
        F.col("slice").alias("i"), every.alias("j"), *(F.col(v).alias(k) for k, v in contexts.items())
    )
    down = slices.select(
        every.alias("i"), F.col("slice").alias("j"), *(F.col(v).alias(k) for k, v in tokens.items())
    )
    return cells.join(across, ["i", "j"]).join(down, ["i", "j"])


def _seated_anew(seating, parent, discount, stirling, rest, outcomes, weights, keep, seed):
    """The seating of a sweep; ``keep``: the tables of the one before count as a sample."""

    def seat(left, right):
        (row,), drawn = left, {r["contexts"]: r for r in right}
        pairs, n = _unpacked(row["pairs"], True), _unpacked(row["n"])
        at, to = (np.unique(x, return_inverse=True)[1] for x in _halves(pairs))
        kept, tables = _unpacked(row["kept"]), _unpacked(row["tables"])
        chance = (_doubles(drawn[False]["draws"])[to] + rest / outcomes) / (weights + rest)
        pull = discount * _doubles(drawn[True]["draws"])[at] * chance
        contexts, words = _hashes(drawn[True]["words"])[at], _hashes(drawn[False]["words"])[to]
        keys = blocks.mix(blocks.mix(contexts + np.uint64(seed)) + words)
        anew = draw_tables(n, pull, discount, stirling, keys)
        yield {
            **{c: row[c] for c in ("i", "j", "pairs", "n")},
            "kept": _packed(kept + tables) if keep else row["kept"],
            "tables": _packed(anew),
            **_sums(pairs, anew),
        }

    state = seating.select("i", "j", "pairs", "n", "kept", "tables")
    drawn = parent.where("i IS NOT NULL").select("i", "j", "contexts", "words", "draws")
    return _met(state, drawn, ["i", "j"], seat, _SEATING)


def fit(texts: DataFrame, settings: Settings = Settings()) -> Model | None:
    """The model of all rows of (text); None without rows."""
    written = _Tables(_own_session(texts.sparkSession))
    _, numbered, cells, side = _grid(_plain(texts), written)
    return _fitted(numbered, cells, side, written, settings) if side else None


def _fitted(numbered: DataFrame, cells: DataFrame, side: int, written: _Tables, s: Settings) -> Model:
    theta = s.strength
    seating = begun = written.write(_begun(cells), "begun")
    known = written.write(_known(numbered, begun), "known")
    totals = known.agg(
        *(F.sum(c).alias(c) for c in ("tokens", "types", "ones", "parent_ones", "parent_twos"))
    ).first()
    outcomes = totals["types"] + 1
    twos = begun.agg(F.sum("twos")).first()[0]
    discount = estimated_discount(totals["ones"], twos)
    parent_discount = estimated_discount(totals["parent_ones"], totals["parent_twos"])
    stirling = log_stirling(discount, s.exact)
    parent_stirling = log_stirling(parent_discount, s.exact)
    rng = np.random.default_rng(s.seed)

    def parent(dishes: int, sweep: int):
        """The parent seated anew and its probabilities drawn."""
        pull = parent_discount * rng.gamma(theta / parent_discount + dishes) / outcomes
        seed = s.seed * 1000 + 2 * sweep
        drawn = _drawn_parent(
            known, _partials(seating), theta, discount, parent_discount, pull, parent_stirling, seed
        )
        table = written.write(drawn, "parent")
        return table, table.agg(F.sum("all_served"), F.sum("all_tables"), F.sum("all_weight")).first()

    # To begin with, every pair has one table and every token one in the parent.
    table, sums = parent(totals["types"], 0)
    samples, unknown, customers = None, [], []
    for sweep in range(1, s.burn_in + s.samples + 1):
        rest = rng.gamma(theta + parent_discount * sums[1])
        seating = written.write(
            _seated_anew(
                seating,
                table,
                discount,
                stirling,
                rest,
                outcomes,
                sums[2],
                sweep > s.burn_in + 1,
                s.seed * 1000 + 2 * sweep + 1,
            ),
            "seating",
        )
        table, sums = parent(sums[1], sweep)
        if sweep > s.burn_in:
            i = sweep - s.burn_in - 1
            unknown.append((theta + parent_discount * sums[1]) / (theta + sums[0]) / outcomes)
            customers.append(sums[0])
            found = table.where("i IS NULL").select(
                "slice", *(F.col(c).alias(f"{c}{i}") for c in ("served", "seated", "parent_tables"))
            )
            found = written.write(found, f"sample{i}")
            samples = found if samples is None else samples.join(found, "slice")

    slices = written.write(known.select("slice", "words", "n").join(samples, "slice"), "slices")
    written.drop("begun", "known", "parent", *(f"sample{i}" for i in range(s.samples)))
    return Model(
        cells,
        seating,
        slices,
        side,
        totals["tokens"],
        totals["types"],
        Fit(discount, theta, parent_discount, tuple(customers), tuple(unknown)),
    )


# --- scoring ------------------------------------------------------------------


def _tables_of_pairs(row: dict, samples: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the pairs of a cell, and their tables summed over the samples."""
    n = _unpacked(row["n"])
    tables = np.minimum(n, 1) * samples
    tables[n > 1] = _unpacked(row["kept"]) + _unpacked(row["tables"])
    return n, tables


def _log_scores(n, tables, customers, shares, parents, fit: Fit):
    """Log10 probabilities of pairs; ``shares``, ``parents``: those of each sample."""
    own, seen = np.zeros(len(n)), n > 0
    taken = n[seen] - fit.discount * (tables[seen] / len(shares))
    own[seen] = taken / (fit.strength + customers[seen])
    each = [share * parent for share, parent in zip(shares, parents)]
    return np.log10(own + sum(each[1:], each[0]) / len(each))


def _counted_cells(model: Model, *columns: str) -> DataFrame:
    seating = model.seating.select("i", "j", "kept", "tables")
    return model.cells.select("i", "j", "n", *columns).join(seating, ["i", "j"])


def pair_scores(model: Model) -> DataFrame:
    """(context, word, count, score) of every pair of the training texts: the word's count
    and the pair's log10 probability."""
    fit, samples = model.fit, range(len(model.unknown))
    sent = [f"seated{i}" for i in samples]
    top = [f"{c}{i}" for c in ("served", "parent_tables") for i in samples]

    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                n, tables = _tables_of_pairs(row, len(samples))
                at, to = _halves(_unpacked(row["pairs"], True))
                customers = _unpacked(row["customers"])
                words = {c: _unpacked(row[c]) for c in sent + top} | {"n": customers}
                shares = [c[at] for c in fit.shares(words)]
                parents = [c[to] for c in fit.parents(words)]
                columns = [
                    _hashes(row["contexts"]).view(np.int64)[at],
                    _hashes(row["words"]).view(np.int64)[to],
                    _unpacked(row["counts"])[to],
                    _log_scores(n, tables, customers[at], shares, parents, fit),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[n > 0]) for c in columns], names=["context", "word", "count", "score"]
                )

    contexts = {"contexts": "words", "customers": "n"} | {c: c for c in sent}
    tokens = {"words": "words", "counts": "n"} | {c: c for c in top}
    cells = _beside(_counted_cells(model, "pairs"), model.slices, model.side, contexts, tokens)
    return cells.mapInArrow(run, "context long, word long, count long, score double")


def _answers(model: Model) -> DataFrame:
    """(block, cell, pair_n, tables): what became of the pairs that a block told a cell."""
    samples, side = len(model.unknown), model.side

    def answer(row):
        n, tables = _tables_of_pairs(row, samples)
        places, ends = _unpacked(row["places"], True), np.cumsum(_unpacked(row["sizes"]))
        for block, own in zip(_unpacked(row["blocks"]).tolist(), np.split(places, ends[:-1])):
            found = {"pair_n": _packed(n[own]), "tables": _packed(tables[own])}
            yield {"block": block, "cell": row["i"] * side + row["j"]} | found

    cells = _counted_cells(model, "blocks", "sizes", "places")
    return _each(cells, answer, "block long, cell int, pair_n binary, tables binary")


def _words_of_blocks(numbered: DataFrame, model: Model) -> DataFrame:
    """Counts and tables, as in the model's slices, of the words of a block in a slice."""
    names = [c for c in model.slices.columns if c not in ("slice", "words")]

    def take(left, right):
        (row,) = left
        columns = {c: _unpacked(row[c]) for c in names}
        for r in right:
            at = _unpacked(r["at"], True)
            own = {c: _packed(values[at]) for c, values in columns.items()}
            yield {"block": r["block"], "slice": r["slice"]} | own

    asked = numbered.where("block >= 0").select("slice", "block", "at")
    schema = "block long, slice int, " + ", ".join(f"{c} binary" for c in names)
    return _met(model.slices.select("slice", *names), asked, ["slice"], take, schema)


def _totals(texts: DataFrame, words: DataFrame, answers: DataFrame, model: Model) -> DataFrame:
    """Blocks with the sums of each text: known tokens, base score and score."""
    side, outcomes = model.side, model.tokens + 0.5 * (model.types + 1)
    fit, names = model.fit, [c for c in model.slices.columns if c not in ("slice", "words")]

    def add(left, right):
        (row,) = left
        tokens, lengths, slices = _places(row), _unpacked(row["lengths"]), _slices(row, side)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        known = {c: np.zeros(len(slices), np.int64) for c in names}
        for r in right:
            if r["slice"] is not None:
                for c, values in known.items():
                    values[slices == r["slice"]] = _unpacked(r[c])
        own, _, contexts, follow, _, _ = _block_pairs(row, side)
        cells = sorted((r for r in right if r["cell"] is not None), key=lambda r: r["cell"])
        n, tables = (np.concatenate([_unpacked(r[c]) for r in cells]) for c in ("pair_n", "tables"))
        count = known["n"]
        shares = [c[contexts] for c in fit.shares(known)]
        parents = [c[follow] for c in fit.parents(known)]
        each = _log_scores(n, tables, count[contexts], shares, parents, fit)
        base = np.log10((count + 0.5) / outcomes)
        yield {
            "block": row["block"],
            "n_known": _packed(np.bincount(owner, count[tokens] > 0).astype(np.int64)),
            "base_score": np.bincount(owner, base[tokens]).tobytes(),
            "score": np.bincount(owner, each[own]).tobytes(),
        }

    parts = words.unionByName(answers, allowMissingColumns=True)
    texts = texts.select("block", "lengths", "held", "tokens", "marks", "times")
    schema = "block long, n_known binary, base_score binary, score binary"
    return _met(texts, parts, ["block"], add, schema)


def _by_text(found: DataFrame, train_tokens: int, id_col: str) -> DataFrame:
    """Blocks with their sums as a row a text."""
    names = [id_col, "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kind = found.schema["ids"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            for i, row in enumerate(_rows(batch.select(["lengths", *names[2:3], *names[4:]]))):
                lengths = _unpacked(row["lengths"])
                known, none = row["n_known"], np.zeros(len(lengths))
                columns = [
                    lengths,
                    _unpacked(known) if known else none.astype(np.int64),
                    np.full(len(lengths), train_tokens),
                    *(_doubles(row[c]) if known else none for c in names[4:]),
                ]
                yield pa.RecordBatch.from_arrays(
                    [ids[i].values, *(pa.array(c) for c in columns)], names=names
                )

    schema = "n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return found.mapInArrow(run, f"`{id_col}` {kind}, {schema}")


def scores(
    docs: DataFrame,
    held_out: Column,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: id, n_tokens, n_known, train_tokens, base_score and score
    (log10 probabilities of the whole text)."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    spark = docs.sparkSession
    written = _Tables(_own_session(spark))
    texts, numbered, cells, side = _grid(rows, written)
    if not side:
        nothing = (F.lit(None).cast("binary").alias(c) for c in ("n_known", "base_score", "score"))
        found = _by_text(texts.select("ids", "lengths", *nothing), 0, id_col)
    else:
        model = _fitted(numbered, cells, side, written, settings)
        answers = written.write(_answers(model), "answers")
        written.drop("cells", "seating")
        words = _words_of_blocks(numbered, model)
        totals = written.write(_totals(texts, words, answers, model), "totals")
        written.drop("answers", "numbers", "slices")
        found = _by_text(texts.select("block", "ids", "lengths").join(totals, "block"), model.tokens, id_col)
    found = written.write(found, "scores")
    written.drop("texts", "totals")
    return spark.read.schema(found.schema).parquet(written.paths["scores"])
