"""Merkle manifest of a dataset, with a proof for every row.

Every row is a leaf. Rows of one group (say, a language) make a binary tree over
their leaves in key order; the roots of the groups make one more tree, whose root
stands for the whole table. A row's proof is what else has to be hashed to get from
its leaf to that root.

Proofs are made by Octopus multiproofs. Leaves are dealt to leaf partitions, runs of
``2 ** LEVELS`` neighbours of one tree. A partition computes the coordinates of the
nodes that its leaves need and do not give, each once; one join fetches them; the
partition then derives the nodes that its leaves share and reads every single proof
off them. Trees of any size are built by the same runs, run over run.

Texts are hashed where they are read and never shuffled: what moves is a digest a
row. No task holds more than a run of leaves. Nodes high up in a large tree are
asked for by many partitions; they are dealt out in copies, so that no copy is asked
for more than ``READERS`` times.

Defined results: a NULL field counts as ``-``; rows without a group come first, as a
group of their own, and so do rows without a key within their group; rows that share
a key are ordered by their digest, and repeated rows have a leaf each. An empty table
gives no rows. Other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renewlens.session import staged

LEVELS = 10  # of a tree inside one leaf partition
READERS = 4096  # of one copy of a node
STEP = "array<struct<before:string,after:string>>"
NODE = "tree string, level int, place long, digest string"


def digest_of(parts: Sequence[Column]) -> Column:
    """Hex digest of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field_text(column: Column) -> Column:
    """Length in bytes, a colon and the value, so that no two rows read alike."""
    text = column.cast("string")
    framed = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(framed, F.lit("-"))


def _digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode("ascii")).hexdigest()


def widths(n: int) -> list[int]:
    """Nodes on each level of a tree over ``n`` leaves, leaves first."""
    found = [n]
    while found[-1] > 1:
        found.append((found[-1] + 1) // 2)
    return found


def missing(places: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Coordinates (level, place) that the leaves at ``places`` need and do not give.

    The least set: of every pair of nodes on a level, one is missing only if the
    other is known from the leaves and it is not.
    """
    found = []
    known = np.unique(places)
    for level, width in enumerate(widths(n)[:-1]):
        beside = known ^ 1
        beside = beside[beside < width]
        found += [(level, int(p)) for p in np.setdiff1d(beside, known)]
        known = np.unique(known >> 1)
    return found


def derive(
    known: dict[int, str], fetched: Mapping[tuple[int, int], str], n: int
) -> list[dict[int, str]]:
    """The leaves ``known`` (place to digest) and all nodes above them, level by level.

    ``n`` is the number of leaves of the whole tree; nodes beside the known ones come
    from ``fetched``.
    """
    levels = []
    for level, width in enumerate(widths(n)):
        here = dict(known)
        above = {}
        if width > 1:
            for place in known:
                parent = place >> 1
                if parent in above:
                    continue
                pair = [p for p in (2 * parent, 2 * parent + 1) if p < width]
                for p in pair:
                    if p not in here:
                        here[p] = fetched[level, p]
                above[parent] = _digest(*(here[p] for p in pair))
        levels.append(here)
        known = above
    return levels


def _climb(known: dict[int, str], width: int, levels: int) -> Iterator[tuple[int, int, str]]:
    """Nodes of a run by itself, up to its top: (levels above, place, digest)."""
    for up in range(1, levels + 1):
        if width <= 1:
            return
        pairs: dict[int, list[str]] = {}
        for place in sorted(known):
            pairs.setdefault(place >> 1, []).append(known[place])
        known = {place: _digest(*pair) for place, pair in pairs.items()}
        width = (width + 1) // 2
        for place, digest in known.items():
            yield up, place, digest


def numbered(leaves: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``place`` of each row within its ``tree`` in the given order, and the tree's ``n``.

    Rows are sorted by range, so a tree with most of the rows lies in many tasks;
    where rows are alike in every way, they are dealt out at random.
    """
    keys = [F.col("tree"), *order, F.rand(5)]
    row = leaves.repartitionByRange(*keys).sortWithinPartitions(*keys)
    row = staged(row.withColumn("__at", F.monotonically_increasing_id()), f"{name}-sorted")
    task = F.shiftright("__at", 33)
    counts = row.groupBy("tree", task.alias("__task")).agg(
        F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("__first")
    )
    # One row per tree and task.
    before = Window.partitionBy("tree").orderBy("__task")
    whole = Window.partitionBy("tree")
    offsets = counts.select(
        "tree",
        "__task",
        (F.sum("__rows").over(before) - F.col("__rows") - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(whole).alias("n"),
    )
    return (
        row.withColumn("__task", task)
        .join(staged(offsets, f"{name}-offsets"), ["tree", "__task"])
        .withColumn("place", F.col("__at") + F.col("__shift"))
        .drop("__at", "__task", "__shift")
    )


def _run_of(levels: int) -> Column:
    return F.shiftright("place", levels).alias("run")


def _tops(nodes: DataFrame, level: int, inner: bool, levels: int) -> DataFrame:
    """Nodes above a level: run by run, either every one or only the top of each run.

    ``nodes`` has tree, n (leaves of the tree), place and digest.
    """

    def up(table: pa.Table) -> pa.Table:
        n = table.column("n")[0].as_py()
        width = -(-n // (1 << level))
        known = dict(zip(table.column("place").to_pylist(), table.column("digest").to_pylist()))
        found = list(_climb(known, width, levels))
        top = found[-1][0] if found else 0
        rows = [r for r in found if inner or r[0] == top]
        tree = table.column("tree")[0].as_py()
        return pa.table(
            {
                "tree": pa.array([tree] * len(rows), pa.string()),
                "level": pa.array([level + r[0] for r in rows], pa.int32()),
                "place": pa.array([r[1] for r in rows], pa.int64()),
                "digest": pa.array([r[2] for r in rows], pa.string()),
                "n": pa.array([n] * len(rows), pa.int64()),
            }
        )

    runs = nodes.groupBy("tree", _run_of(levels))
    return runs.applyInArrow(up, f"{NODE}, n long")


def build(leaves: DataFrame, name: str, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """(nodes at and above the top of every leaf partition, root of every tree).

    ``leaves`` has tree, n, place and digest. One pass for every ``levels`` levels of
    the tallest tree; each has ``2 ** levels`` times fewer rows than the one before.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    height = len(widths(most)) - 1 if most else 0
    small = leaves.where("n = 1").select("tree", "digest")
    nodes = staged(_tops(leaves, 0, False, levels), f"{name}-nodes")
    found = nodes
    level = levels
    while level < height:
        here = nodes.where(F.col("level") == level).where(F.col("n") > 1 << level)
        nodes = staged(_tops(here, level, True, levels), f"{name}-nodes")
        found = found.unionByName(nodes)
        level += levels
    # The one node of the highest level is the root.
    last = found.where(F.expr("n <= shiftleft(1L, level)"))
    return found.drop("n"), small.unionByName(last.select("tree", "digest"))


def fetched_nodes(leaves: DataFrame, nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """For every leaf partition the nodes it misses: tree, run, level, place, digest."""
    runs = leaves.groupBy("tree", _run_of(levels)).agg(
        F.first("n").alias("n"), F.min("place").alias("first"), F.max("place").alias("last")
    )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tree, run, n, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [(tree, run, *c) for c in missing(np.arange(first, last + 1), n)]
            columns = list(zip(*rows)) or [()] * 4
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["tree", "run", "level", "place"],
            )

    asked = runs.mapInArrow(ask, "tree string, run long, level int, place long")
    # A node on a level is missing in as many runs as lie below its sibling.
    readers = F.pow(F.lit(2.0), F.greatest(F.col("level") - levels, F.lit(0)))
    copies = F.ceil(readers / READERS)
    asked = asked.withColumn("__copy", F.pmod(F.col("run"), copies))
    copied = nodes.withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    return asked.join(copied, ["tree", "level", "place", "__copy"]).drop("__copy")


def proofs(
    leaves: DataFrame, nodes: DataFrame, carried: str, levels: int = LEVELS
) -> DataFrame:
    """``carried`` columns (a schema) of every leaf, its ``tree``, and its ``proof``.

    A proof is the steps from the leaf to the root of its tree: what stands before and
    after the node in its pair, empty where there is nothing.
    """

    def expand(own: pa.Table, others: pa.Table) -> pa.Table:
        n = own.column("n")[0].as_py()
        places = own.column("place").to_pylist()
        at = zip(*(others.column(c).to_pylist() for c in ("level", "place", "digest")))
        beside = {(level, place): digest for level, place, digest in at}
        known = dict(zip(places, own.column("digest").to_pylist()))
        whole = derive(known, beside, n)
        steps = []
        for place in places:
            found = []
            for here in whole[:-1]:
                other = here.get(place ^ 1, "")
                found.append(
                    {"before": other if place & 1 else "", "after": "" if place & 1 else other}
                )
                place >>= 1
            steps.append(found)
        kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        kept = own.drop_columns(["place", "n", "run"])
        return kept.append_column("proof", pa.array(steps, kind))

    mine = leaves.withColumn("run", _run_of(levels)).groupBy("tree", "run")
    theirs = fetched_nodes(leaves, nodes, levels).groupBy("tree", "run")
    return mine.cogroup(theirs).applyInArrow(expand, f"{carried}, proof {STEP}")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to; NULL without one of them."""
    return F.aggregate(
        proof, leaf, lambda digest, step: digest_of([step["before"], digest, step["after"]])
    )


def proof_digest(proof: Column) -> Column:
    """Digest of the siblings of a proof in order."""
    siblings = F.transform(proof, lambda step: F.concat(step["before"], step["after"]))
    return F.sha2(F.array_join(siblings, ""), 256)


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    group: str = "lang",
    changed: Mapping[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: its leaf, its proof, and what it proves.

    Columns: ``key``, ``leaf``, ``changed_leaf`` (the leaf with the fields of ``changed``
    in place of its own), ``proof``, ``subroot``, ``root``, ``folded_root`` (from the
    changed leaf and the proof) and ``verified``.
    """
    changed = changed or {}
    plain = [field_text(F.col(c)) for c in fields]
    other = [field_text(changed.get(c, F.col(c))) for c in fields]
    # Names that sort as the groups do, bytewise and NULL first, and cannot clash.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    leaf = digest_of(plain)
    again = digest_of(other) if changed else leaf
    leaves = staged(
        docs.select(
            F.col(key).alias("key"),
            tree.alias("tree"),
            leaf.alias("digest"),
            again.alias("changed"),
        ),
        "leaves",
    )
    order = [F.col("key").asc_nulls_first(), F.col("digest")]
    leaves = staged(numbered(leaves, order, "leaves"), "placed")
    nodes, subroots = build(leaves, "leaves", levels)
    subroots = staged(subroots, "subroots").withColumnRenamed("tree", "group")
    upper = numbered(subroots.withColumn("tree", F.lit("")), [F.col("group")], "subroots")
    upper = staged(upper.select("tree", "n", "place", "digest", "group"), "upper")
    top_nodes, top = build(upper, "upper", levels)
    above = proofs(upper, top_nodes, "tree string, digest string, group string", levels)
    above = above.join(top.withColumnRenamed("digest", "root"), "tree").select(
        F.col("group").alias("tree"),
        F.col("digest").alias("subroot"),
        F.col("proof").alias("above"),
        "root",
    )
    above = staged(above, "above")

    kind = docs.schema[key].dataType.simpleString()
    carried = f"tree string, key {kind}, digest string, changed string"
    placed = leaves.select("tree", "key", "digest", "changed", "place", "n")
    below = proofs(placed, nodes, carried, levels)
    whole = below.join(above, "tree").withColumn("proof", F.concat("proof", "above"))
    found = whole.withColumn("folded_root", folded(F.col("changed"), F.col("proof")))
    return found.select(
        F.col("key").alias(key),
        F.col("digest").alias("leaf"),
        F.col("changed").alias("changed_leaf"),
        "proof",
        "subroot",
        "root",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
