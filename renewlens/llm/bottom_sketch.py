"""Near-copies by bottom-k sketches.

A document is its set of word shingles. One hash function turns the set into
numbers; the ``k`` smallest are its sketch. Steps:

1. Documents with equal sets (equal size and 128-bit digest) become one class.
2. Inverted lists over retained values, cut to the rarest ones of each sketch: two
   sketches that share enough values must share one of these, so a passage that
   many documents share makes no long list unless it fills the document.
3. In each list the member with most shared values is compared with all others (a
   star), so a list costs as many pairs as it has members. Members of one star are
   not compared again. Those that stars leave apart are compared in full: in short
   lists with each other; in long ones each member that is not linked with the centre
   is compared with all, block by block, and only links leave the blocks.
4. The sketch of the union filters the pairs, the exact Jaccard measure of the
   full sets decides.

Only connected components are returned, so pairs inside one that is already
found need no proof. The chance to lose a link to sketching is the chance that a
pair with the required likeness estimates below ``slack`` standard deviations;
sets of at most ``k`` shingles are compared exactly throughout.

NULL and empty texts, and texts without a word, have an empty set and no links;
a row without an id stays by itself. Rows that repeat an id are documents of
their own and, with equal texts, in one class.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens.llm import blocks
from renewlens.llm.components import components
from renewlens.llm.narrow import joined_blocks
from renewlens.session import staged


@dataclass(frozen=True)
class Settings:
    width: int = 5  # words in a shingle
    percent: int = 80  # least likeness: 100 * common >= percent * union
    k: int = 64  # values in a sketch
    slack: float = 4.4  # standard deviations of the estimate that still pass
    short_list: int = 48  # members up to which a list is compared pair by pair
    block_values: int = 1 << 16  # shingles in a block of longer lists

    @property
    def estimate(self) -> float:
        """Least share of common values in the union's sketch."""
        share = self.percent / 100
        return max(0.1, share - self.slack * math.sqrt(share * (1 - share) / self.k))


def _sets(texts: pa.Array, width: int):
    """Sorted different shingle hashes (63 bits) of each text."""
    for _, _, data, bounds in blocks.blocks(texts):
        hashes, first = blocks.words(data, bounds)
        runs, begin = blocks.shingles(hashes, first, width)
        runs = (runs >> np.uint64(1)).astype(np.int64)
        for row in range(len(begin) - 1):
            own = np.sort(runs[begin[row] : begin[row + 1]])
            yield own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own


def _digest(own: np.ndarray) -> tuple[int, int]:
    values = own.astype(np.uint64)
    pair = (values.sum(dtype=np.uint64), blocks.mix(values).sum(dtype=np.uint64))
    return tuple(int(v.astype(np.int64)) for v in pair)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays], dtype=np.int64)])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def signatures(docs: DataFrame, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, sketch) of every row."""
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))

    def run(batches):
        for batch in batches:
            sizes, digests, sketches = [], [], []
            for own in _sets(blocks.string_column(batch, "__text"), settings.width):
                sizes.append(len(own))
                digests.append(_digest(own))
                sketches.append(own[: settings.k])
            a, b = (pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), a, b, _lists(sketches)],
                names=["doc_id", "n_shingles", "set_a", "set_b", "sketch"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {kind}, n_shingles long, set_a long, set_b long, sketch array<long>"
    )


def _full_sets(docs: DataFrame, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    source = docs.select(F.col(text_col).alias("__text"))

    def run(batches):
        for batch in batches:
            held, size = [], 0
            for own in _sets(blocks.string_column(batch, "__text"), settings.width):
                held.append(own)
                size += len(own)
                if size > 1 << 20:
                    yield _set_batch(held)
                    held, size = [], 0
            if held:
                yield _set_batch(held)

    return source.mapInArrow(run, "n long, set_a long, set_b long, shingles array<long>")


def _set_batch(held: list[np.ndarray]) -> pa.RecordBatch:
    digests = [_digest(own) for own in held]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([len(own) for own in held], pa.int64()),
            *(pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1)),
            _lists(held),
        ],
        names=["n", "set_a", "set_b", "shingles"],
    )


def _key() -> Column:
    return F.xxhash64("n", "set_a", "set_b")


def rare_lists(classes: DataFrame, settings: Settings) -> DataFrame:
    """(value, key, n, held): the rarest retained values of each class, where shared.

    ``held`` counts the class's retained values that are shared at all.

    A sketch of ``s`` values that shares at least ``m`` with another shares one of
    its first ``s - m + 1``, in any order that both follow; here rare before
    frequent.
    """
    k, share = settings.k, settings.percent / 100
    size = F.least("n", F.lit(k))
    least = F.when(F.col("n") < share * k, F.ceil(size * F.lit(settings.percent) / 100)).otherwise(
        F.ceil(size * settings.estimate)
    )
    values = classes.select(
        "key",
        "n",
        (size - least + 1).alias("front"),
        size.alias("size"),
        F.explode("sketch").alias("value"),
    )
    frequency = values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = values.join(frequency, "value")
    # Values of one class only come first and make no pairs; at most k rows a class here.
    listed = shared.groupBy("key", "n", "front", "size").agg(
        F.array_sort(F.collect_list(F.struct("df", "value"))).alias("held")
    )
    room = F.col("front") - (F.col("size") - F.size("held"))
    front = F.slice("held", F.lit(1), F.greatest(room, F.lit(0)).cast("int"))
    return listed.select(
        "key", "n", F.size("held").alias("held"), F.explode(front.getField("value")).alias("value")
    )


def _verified(pairs: DataFrame, members: DataFrame, settings: Settings) -> DataFrame:
    """The pairs of keys (a, b) whose full sets are alike enough."""

    def side(name: str, column: str, new: str) -> DataFrame:
        return members.select(F.col("key").alias(name), F.col(column).alias(new))

    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, settings.k)
    common = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    likely = (
        pairs.join(side("a", "sketch", "sa"), "a")
        .join(side("b", "sketch", "sb"), "b")
        .where(common >= settings.estimate * F.size(union))
        .select("a", "b")
    )
    both = F.size(F.array_intersect("fa", "fb"))
    either = F.size("fa") + F.size("fb") - both
    return (
        likely.join(side("b", "shingles", "fb"), "b")
        .join(side("a", "shingles", "fa"), "a")
        .where(100 * both.cast("long") >= settings.percent * either.cast("long"))
        .select("a", "b")
    )


def links(
    docs: DataFrame, classes: DataFrame, settings: Settings, id_col: str, text_col: str
) -> DataFrame:
    """Verified links (a, b) of class keys that connect all classes that are connected."""
    lists = staged(rare_lists(classes, settings), "sketch-lists")
    involved = lists.select("key").distinct()
    found = classes.join(involved, "key", "semi")
    ids = found.where(F.col("n") > settings.k).select(F.col("first_id").alias(id_col)).distinct()
    sets = (
        _full_sets(docs.join(ids, id_col, "semi"), settings, id_col, text_col)
        .select(_key().alias("key"), "shingles")
        .dropDuplicates(["key"])
    )
    members = staged(
        found.join(sets, "key", "left").select(
            "key", "n", "sketch", F.coalesce("shingles", "sketch").alias("shingles")
        ),
        "sketch-members",
    )
    centres = staged(_centres(lists), "sketch-centres")
    stars = staged(_verified(_stars(lists, centres, settings), members, settings), "sketch-stars")
    short = _short_pairs(lists, stars, settings)
    return (
        stars.unionByName(_verified(short, members, settings))
        .unionByName(_long_links(lists, centres, stars, members, settings))
    )


def _fits(settings: Settings) -> Column:
    return F.least("n", "other_n") * 100 >= F.greatest("n", "other_n") * settings.percent


def _centres(lists: DataFrame) -> DataFrame:
    """(value, other, other_n, members): each list's member with most shared values."""
    order = F.struct("held", F.xxhash64("key").alias("h"), "key", "n")
    found = lists.groupBy("value").agg(F.max(order).alias("c"), F.count("*").alias("members"))
    return found.where("members > 1").select(
        "value", F.col("c.key").alias("other"), F.col("c.n").alias("other_n"), "members"
    )


def _stars(lists: DataFrame, centres: DataFrame, settings: Settings) -> DataFrame:
    """Different pairs (a, b): in each list the centre with all others."""
    met = lists.join(centres, "value").where(F.col("key") != F.col("other")).where(_fits(settings))
    return met.select(F.col("other").alias("a"), F.col("key").alias("b")).distinct()


def _short_pairs(lists: DataFrame, stars: DataFrame, settings: Settings) -> DataFrame:
    """Different pairs (a, b) that meet in a short list and are not of one star."""
    # Members of a star are connected through its centre; the largest star counts.
    sizes = stars.groupBy("a").agg(F.count("*").alias("size"))
    largest = F.max(F.struct("size", "a")).getField("a")
    placed = stars.join(sizes, "a").groupBy(F.col("b").alias("key")).agg(largest.alias("star"))
    rows = lists.join(placed, "key", "left").select(
        "value", "key", "n", F.coalesce("star", "key").alias("star")
    )
    apart = rows.groupBy("value").agg(
        F.min("star").alias("low"), F.max("star").alias("high"), F.count("*").alias("members")
    )
    apart = apart.where("low <> high").where(F.col("members") <= settings.short_list)
    rows = staged(rows.join(apart.select("value"), "value"), "sketch-short")
    other = rows.select("value", *(F.col(c).alias(f"other_{c}") for c in ("key", "n", "star")))
    met = rows.join(other, "value").where((F.col("star") != F.col("other_star")) & _fits(settings))
    met = met.where(F.col("key") < F.col("other_key"))
    return met.select(F.col("key").alias("a"), F.col("other_key").alias("b")).distinct()


def _long_links(
    lists: DataFrame, centres: DataFrame, stars: DataFrame, members: DataFrame, settings: Settings
) -> DataFrame:
    """Links (a, b) between members of long lists, where one is not linked with the centre.

    Lists with the same centre are taken together. Blocks of bounded size meet in an
    ordinary join by the centre; a task holds two blocks at a time.
    """
    long = centres.where(F.col("members") > settings.short_list)
    family = lists.join(long.select("value", F.col("other").alias("family")), "value")
    family = staged(family.select("family", "key", "n").distinct(), "sketch-family")
    linked = stars.select(F.col("a").alias("family"), F.col("b").alias("key"))
    loose = family.where("family <> key").join(linked, ["family", "key"], "anti")
    pieces = F.ceil(F.sum("n") / F.lit(settings.block_values))
    sizes = family.groupBy("family").agg(pieces.alias("pieces"))
    # Where everyone is linked with the centre, nothing is left to compare.
    sizes = sizes.join(loose.select("family").distinct(), "family")

    def packed(rows: DataFrame, side: str) -> DataFrame:
        block = F.pmod(F.xxhash64("key"), F.col("pieces"))
        return (
            rows.select("family", "key")
            .join(sizes, "family")
            .withColumn("block", block)
            .join(members.select("key", "shingles"), "key")
            .groupBy("family", "block")
            .agg(F.collect_list(F.struct("key", "shingles")).alias("held"))
            .select(
                "family",
                F.col("held.key").alias(f"{side}_keys"),
                F.col("held.shingles").alias(f"{side}_sets"),
            )
        )

    percent = settings.percent

    def compare(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                keys, sets = (batch.column(i)[row].values for i in (1, 2))
                others, other_sets = (batch.column(i)[row].values for i in (3, 4))
                common, size, other_size = _overlaps(sets, other_sets)
                union = size[:, None] + other_size[None, :] - common
                at, to = np.nonzero(100 * common >= percent * union)
                a, b = keys.to_numpy()[at], others.to_numpy()[to]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[a != b]), pa.array(b[a != b])], names=["a", "b"]
                )

    return joined_blocks(
        packed(loose, "left"),
        packed(family, "right"),
        ["family"],
        compare,
        "a long, b long",
        "sketch-blocks",
    ).distinct()


def _overlaps(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common values of each pair of sets, by matrix products, and the sets' sizes."""
    sides = []
    for sets in (left, right):
        size = np.diff(sets.offsets.to_numpy())
        sides.append((sets.flatten().to_numpy(), np.repeat(np.arange(len(size)), size), size))
    (own, own_row, size), (other, other_row, other_size) = sides
    shared = np.intersect1d(own, other)
    common = np.zeros((len(size), len(other_size)), np.int64)
    for first in range(0, len(shared), 4096):
        part = shared[first : first + 4096]
        tables = []
        for values, rows, n in ((own, own_row, len(size)), (other, other_row, len(other_size))):
            at = np.searchsorted(part, values)
            at[at == len(part)] = 0
            hit = part[at] == values
            table = np.zeros((n, len(part)), np.float32)
            table[rows[hit], at[hit]] = 1
            tables.append(table)
        common += (tables[0] @ tables[1].T).astype(np.int64)
    return common, size, other_size


def near_copies(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row.

    ``component_id`` is the smallest id that can be reached over links, ``kept``
    marks the row that has it.
    """
    own = staged(signatures(docs, settings, id_col, text_col), "sketches").withColumnRenamed(
        "n_shingles", "n"
    )
    own = own.withColumn("key", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), _key()))
    classes = staged(
        own.where("key IS NOT NULL")
        .groupBy("key", "n")
        .agg(F.min("doc_id").alias("first_id"), F.any_value("sketch").alias("sketch")),
        "sketch-classes",
    )
    roots = components(links(docs, classes, settings, id_col, text_col), "sketch-roots")
    placed = classes.select("key", "first_id").join(
        roots, F.col("key") == F.col("node"), "left"
    ).select("key", "first_id", F.coalesce("root", "key").alias("root"))
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = placed.join(least, "root").select("key", "component_id")
    return own.join(named, "key", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("component_id", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"),
    )
