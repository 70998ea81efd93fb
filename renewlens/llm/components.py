"""Connected components of a graph given as pairs of 64-bit ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens.session import staged


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v) with the smallest v of each u; a hub is summed before it is shuffled."""
    return pairs.join(pairs.groupBy("u").agg(F.min("v").alias("least")), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    found = _with_least(both).where("v > u")
    return found.select(F.col("v").alias("b"), F.least("least", "u").alias("a"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    found = _with_least(down)
    onward = found.where("v > least").select(F.col("v").alias("b"), F.col("least").alias("a"))
    return onward.unionByName(
        found.select(F.col("u").alias("b"), F.col("least").alias("a"))
    )


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("mark")
    ).first()
    return row["n"], row["mark"]


def components(pairs: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``pairs`` (a, b) that is not its own root.

    The root is the smallest id of the component. Alternates large and small
    stars (each node's neighbours are handed to its smallest neighbour), which
    ends after about log(n) rounds whatever the shape; every round is a written
    table. NULLs and loops are left out, repeated pairs count once.
    """
    edges = staged(
        pairs.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        name,
    )
    before = _state(edges)
    while before[0]:
        edges = staged(_small_star(_large_star(edges).distinct()).distinct(), name)
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
