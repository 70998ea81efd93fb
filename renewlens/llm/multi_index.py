"""Approximate nearest neighbours by largest inner product: inverted multi-index.

The two halves of a vector are quantised separately, so that ``K`` centroids a half
make ``K * K`` cells. For each query, pairs of centroids are walked from the most
promising (largest sum of the halves' inner products) on, with a heap, until the
cells seen hold enough vectors; these are reranked by the exact inner product of the
original vectors in double precision.

Equal vectors are indexed once, with the smallest ids that can be among anyone's
nearest, so a large group of copies is one entry. Queries are dealt in packs of bounded
size, the index in blocks that come to every pack which looks into them; the task of a
pack keeps the best of each query and writes them once.

Centroids are fitted on at most ``SAMPLE`` different vectors; all vectors are indexed.
The same settings hold at every size. Vectors without structure need many cells: with
``3 * sqrt(n)`` centroids a half (``most_centroids`` at most), 60 % of the vectors hold
0.95 or more of the nearest.

Vectors that are NULL, zero, without components, with NULL or non-finite components,
or of another length than most (the longest of equally frequent lengths) take no
part, neither do rows without an id. Queries have no neighbours but other rows; a
query with fewer candidates gets all it has. Ties go to the smaller id.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renewlens.llm.narrow import joined_blocks
from renewlens.session import staged

SAMPLE = 16384


@dataclass(frozen=True)
class Settings:
    neighbours: int = 20
    share: float = 0.6  # of the vectors, to be seen by a query before it stops
    least: int = 0  # vectors seen at any rate
    rounds: int = 10  # of the centroids' fit
    most_centroids: int = 128
    index_rows: int = 4096  # vectors in a block
    query_rows: int = 1024
    seed: int = 17

    def centroids(self, vectors: int) -> int:
        return max(1, min(self.most_centroids, int(3 * vectors**0.5)))


def usable(vector: Column) -> Column:
    """Not NULL or zero, and all components finite."""
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)),
    )
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


@dataclass(frozen=True)
class Codebook:
    first: np.ndarray
    second: np.ndarray

    @property
    def half(self) -> int:
        return self.first.shape[1]

    def codes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = (vectors[:, : self.half], self.first), (vectors[:, self.half :], self.second)
        return tuple(_nearest(part, book) for part, book in parts)


def _nearest(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book * book).sum(1) - 2 * rows @ book.T).argmin(1)


def _fit_half(rows: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    book = rows[rng.permutation(len(rows))[:k]].copy()
    for _ in range(rounds):
        code = _nearest(rows, book)
        counts = np.bincount(code, minlength=len(book))
        for c in np.flatnonzero(counts):
            book[c] = rows[code == c].mean(0)
    return book


def fit(sample: np.ndarray, k: int, settings: Settings) -> Codebook:
    half = max(1, sample.shape[1] // 2)
    books = [
        _fit_half(part, k, settings.rounds, settings.seed + i)
        for i, part in enumerate((sample[:, :half], sample[:, half:]))
    ]
    return Codebook(*books)


def walk(
    query: np.ndarray, book: Codebook, population: np.ndarray, enough: int
) -> list[tuple[int, int]]:
    """Cells in falling order of promise, until they hold ``enough`` vectors."""
    left = book.first @ query[: book.half]
    right = book.second @ query[book.half :]
    rows, columns = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
    a, b = left[rows].tolist(), right[columns].tolist()
    heap = [(-(a[0] + b[0]), 0, 0)]
    held, cells = 0, []
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = (int(rows[i]), int(columns[j]))
        if population[cell]:
            cells.append(cell)
            held += int(population[cell])
        if j + 1 < len(b):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):  # every pair has one way to be reached
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))
    return cells


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _entries(rows: DataFrame, settings: Settings) -> DataFrame:
    """(key, vector, ids): different vectors with their smallest ids.

    One more than the neighbours asked for, as a query leaves itself out.
    """
    order = Window.partitionBy("vector").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(order)).where(
        F.col("n") <= settings.neighbours + 1
    )
    return few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(
        F.xxhash64("vector").alias("key"), "vector", "ids"
    )


def _blocks(rows: DataFrame, by: list[str], fields: list[str]) -> DataFrame:
    """Rows of equal ``by`` as one row of lists; the caller bounds their number."""
    held = rows.groupBy(*by).agg(F.collect_list(F.struct(*fields)).alias("held"))
    lists = [
        (F.flatten("held.vector") if f == "vector" else F.col(f"held.{f}")).alias(f) for f in fields
    ]
    return held.select(*by, *lists)


def search(
    vectors: DataFrame,
    is_query: Column,
    settings: Settings = Settings(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id_col, score): the nearest found of each query, nearest first."""
    spark = vectors.sparkSession
    top = settings.neighbours
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(
        F.col(id_col).alias("id"),
        F.col(vector_col).alias("vector"),
        is_query.alias("is_query"),
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("size")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    answer = f"query_id {kind}, rank int, {id_col} {kind}, score double"
    if common is None:
        return spark.createDataFrame([], answer)
    width = common["size"]
    rows = rows.where(F.size("vector") == width)
    # -0.0 and 0.0 are the same component.
    rows = staged(
        rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0).cast("float"))),
        "ann-rows",
    )
    entries = staged(_entries(rows, settings), "ann-entries")
    total = entries.count()
    sample = entries.orderBy("key").limit(SAMPLE).select("vector")
    book = fit(
        np.array([r[0] for r in sample.collect()], np.float64), settings.centroids(total), settings
    )
    k = len(book.first)

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                first, second = book.codes(_matrix(batch.column(1), width))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(first, pa.int32()), pa.array(second, pa.int32())],
                    names=["key", "vector", "least_id", "first", "second"],
                )

    with_least = entries.select("key", "vector", F.col("ids")[0].alias("least_id"))
    located = staged(
        with_least.mapInArrow(
            assign, f"key long, vector array<float>, least_id {kind}, first int, second int"
        ),
        "ann-cells",
    )
    population = np.zeros((k, k), np.int64)
    for row in located.groupBy("first", "second").count().collect():  # k * k rows at most
        population[row["first"], row["second"]] = row["count"]
    # A query leaves itself out; all candidates are seen where they are so few.
    enough = max(settings.least, top + 1, math.ceil(settings.share * total))

    # Blocks of neighbouring centroids; a centroid with too many vectors is cut by hash.
    held = population.sum(1)
    pieces = np.maximum(1, -(-held // settings.index_rows))
    shard = (np.cumsum(held) - held) // settings.index_rows

    def of_first(values: np.ndarray) -> Column:
        return F.element_at(F.array(*map(F.lit, values.tolist())), F.col("first") + 1)

    index = _blocks(
        located.withColumn("shard", of_first(shard)).withColumn(
            "chunk", F.pmod(F.xxhash64("key"), of_first(pieces))
        ),
        ["shard", "chunk"],
        ["key", "least_id", "first", "second", "vector"],
    )

    asked = rows.where("is_query").select(
        F.col("id").alias("query_id"), F.xxhash64("vector").alias("key"), "vector"
    )
    questions = asked.groupBy("key").agg(F.any_value("vector").alias("vector"))
    # As many packs as the queries need, or as tasks can run: more only share out work.
    asking = asked.count()
    parallel = min(math.ceil(asking / 64), spark.sparkContext.defaultParallelism)
    parts = max(1, math.ceil(asking / settings.query_rows), parallel)
    packs = _blocks(
        questions.withColumn("pack", F.pmod(F.xxhash64("key"), F.lit(parts))),
        ["pack"],
        ["key", "vector"],
    ).repartition(parts, "pack")

    def probe(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                keys = batch.column(1)[r].values.to_numpy()
                table = _matrix(batch.column(2).slice(r, 1), width)
                seen = np.zeros((len(keys), k * k), bool)
                for q, query in enumerate(table):
                    cells = walk(query, book, population, enough)
                    seen[q, [i * k + j for i, j in cells]] = True
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(r, 1),
                        pa.array([keys], pa.list_(pa.int64())),
                        pa.array([table.astype(np.float32).ravel()], pa.list_(pa.float32())),
                        pa.array([np.packbits(seen, axis=1).tobytes()], pa.binary()),
                    ],
                    names=["pack", "queries", "questions", "seen"],
                )

    probes = packs.mapInArrow(
        probe, "pack long, queries array<long>, questions array<float>, seen binary"
    )
    every_pack = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))

    def rerank(batches):
        best = _Best(top + 1)
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for r in range(batch.num_rows):
                keys = column["key"][r].values.to_numpy()
                least = column["least_id"][r].values.to_numpy()
                first = column["first"][r].values.to_numpy().astype(np.int64)
                cell = first * k + column["second"][r].values.to_numpy()
                queries = column["queries"][r].values.to_numpy()
                bits = np.frombuffer(column["seen"][r].as_py(), np.uint8)
                bits = bits.reshape(len(queries), -1)
                # The bit of each vector's cell, for every query at once.
                seen = (bits[:, cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1
                if not seen.any():
                    continue
                scores = _matrix(column["questions"].slice(r, 1), width) @ (
                    _matrix(column["vector"].slice(r, 1), width).T
                )
                scores[seen == 0] = -np.inf
                best.add(queries, keys, least, scores)
                if best.full():
                    yield best.drain(names)
        yield best.drain(names)

    names = ["query", "key", "least_id", "score"]
    near = joined_blocks(
        index,
        probes,
        ["pack"],
        rerank,
        f"query long, key long, least_id {kind}, score double",
        "ann-near",
        # Dealt by pack even where the packs are small, so that each is in one task.
        spread=lambda blocks: blocks.withColumn("pack", every_pack).hint("merge"),
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "least_id")
    nearest = (
        near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= top + 1)
    )
    candidates = nearest.join(entries.select("key", "ids"), "key").select(
        "query", "score", F.explode("ids").alias("id")
    )
    own = asked.select("query_id", F.col("key").alias("query"))
    found = own.join(candidates, "query").where(F.col("id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


class _Best:
    """The best entries of each query so far, in bounded memory."""

    def __init__(self, top: int, limit: int = 1 << 19) -> None:
        self.top, self.limit = top, limit
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, queries, keys, least, scores) -> None:
        width = scores.shape[1]
        if width > self.top:
            # Entries as good as the last one in stay; ties are settled later.
            edge = -np.partition(-scores, self.top - 1, axis=1)[:, self.top - 1 : self.top]
            at = np.nonzero((scores >= edge) & (scores > -np.inf))
        else:
            at = np.nonzero(scores > -np.inf)
        self.parts.append((queries[at[0]], keys[at[1]], least[at[1]], scores[at]))
        self.size += len(at[0])
        if self.size > self.limit:
            self._shrink()

    def _shrink(self) -> None:
        query, key, least, score = (np.concatenate(p) for p in zip(*self.parts))
        order = np.lexsort((least, -score, query))
        query = query[order]
        start = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
        place = np.arange(len(query)) - np.repeat(start, np.diff([*start, len(query)]))
        keep = order[place < self.top]
        self.parts = [(query[place < self.top], key[keep], least[keep], score[keep])]
        self.size = len(keep)

    def full(self) -> bool:
        return self.size > self.limit // 2

    def drain(self, names: list[str]) -> pa.RecordBatch:
        if self.parts:
            self._shrink()
            columns = self.parts[0]
        else:
            columns = (np.zeros(0, np.int64),) * 3 + (np.zeros(0),)
        self.parts, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
