"""Mixing sources to target weights, as a tree of budgets.

Leaves are (domain, language, source). A node's share of its parent's budget
follows its weight. A node whose supply (tokens times ``max_epochs``) is below
its share takes all it has, and what is missing goes to its siblings in
proportion to their weights; only what all siblings together cannot take is
missing one level higher, where the ancestor's own siblings make up for it. The
supply of a node is the sum of its children's that have a weight: it is added up
from the leaves, and then one pass from the root down gives exactly this. Shares
are cut to whole tokens, so up to a token a sibling stays unused.

A leaf with budget B is read in seeded epochs: each epoch is an order of its
documents by a hash of seed, epoch and id; whole epochs first, then the prefix
of the next one that holds the rest, the last document cut to fit.

Everything is DataFrame functions. No leaf is sorted as a whole: tokens are
summed by leaf and hash slot, the slot in which a leaf's budget runs out is found
on these sums, and only the documents of that slot are ordered. Slots are as many
as let about ``SLOT_ROWS`` documents of the largest leaf fall into one.

NULL domain, language or source are values of their own. NULL and empty texts
have no tokens and are never chosen. Rows that repeat an id are ordered by their
text's hash; exact repeats share a slot and follow each other. Nodes without a
weight get 1, nodes with weight 0 nothing.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renewlens.session import staged

SLOT_ROWS = 1000
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """``weights``: node path, as a tuple of strings from the root, to its weight."""

    budget_share: float = 1.0  # of the supply of one epoch
    max_epochs: int = 4
    seed: int = 7
    weights: Mapping[tuple[str, ...], float] = field(default_factory=dict)
    default_power: float = 0.0  # without a weight of its own: tokens to this power


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _weight(mix: Mix, path: Sequence[str], tokens: str) -> Column:
    chosen = F.pow(F.col(tokens).cast("double"), F.lit(mix.default_power))
    for names, weight in mix.weights.items():
        if len(names) == len(path):
            match = F.lit(True)
            for column, name in zip(path, names):
                match = match & F.col(column).eqNullSafe(F.lit(name))
            chosen = F.when(match, F.lit(float(weight))).otherwise(chosen)
    return chosen


def _pour(nodes: DataFrame, parents: Sequence[str]) -> DataFrame:
    """Share ``parent_budget`` among siblings by ``weight``, none above its ``supply``.

    Filled to the brim are the siblings with the least supply for their weight:
    walking them in that order, a sibling is full if its supply is at most what the
    level would give it after those before it are full.
    """
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    ratio = F.when(F.col("weight") > 0, F.col("supply") / F.col("weight")).otherwise(F.lit(math.inf))
    walk = siblings.orderBy("ratio", "path_key").rowsBetween(Window.unboundedPreceding, -1)
    walked = nodes.withColumn("ratio", ratio).select(
        "*",
        F.coalesce(F.sum("supply").over(walk), F.lit(0)).alias("supply_before"),
        F.coalesce(F.sum("weight").over(walk), F.lit(0.0)).alias("weight_before"),
        F.sum("weight").over(siblings).alias("weight_all"),
    )
    left = F.col("parent_budget") - F.col("supply_before")
    open_weight = F.col("weight_all") - F.col("weight_before")
    full = (F.col("weight") > 0) & (F.col("supply") * open_weight <= F.col("weight") * left)
    marked = walked.withColumn("full", full)
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("supply"))).over(siblings), F.lit(0))
    rest = F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(siblings), F.lit(0.0))
    level = (F.col("parent_budget") - taken) / rest
    share = F.least(F.floor(F.col("weight") * level), F.col("supply"))
    return marked.withColumn(
        "budget",
        F.when(F.col("full"), F.col("supply"))
        .when((F.col("weight") > 0) & (rest > 0), F.greatest(share, F.lit(0)))
        .otherwise(F.lit(0))
        .cast("long"),
    ).drop("ratio", "supply_before", "weight_before", "weight_all", "full", "parent_budget")


def budgets(leaves: DataFrame, levels: Sequence[str], mix: Mix) -> DataFrame:
    """(levels..., tokens, supply, budget) from one row per leaf with its tokens.

    The tree has one row a node: bounded by the number of different sources.
    """
    tree = leaves.where("tokens > 0").select(
        *levels, "tokens", (F.col("tokens") * mix.max_epochs).alias("supply")
    )
    total = tree.agg(
        F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(mix.budget_share)).alias("parent_budget")
    )
    # From the leaves up: what of a node can be used, and its weight.
    by_depth: dict[int, DataFrame] = {}
    for depth in range(len(levels), 0, -1):
        path = list(levels[:depth])
        nodes = tree.groupBy(*path).agg(
            F.sum("tokens").alias("tokens"), F.sum("supply").alias("supply")
        )
        nodes = nodes.withColumn("weight", _weight(mix, path, "tokens"))
        by_depth[depth] = nodes.withColumn("path_key", F.to_json(F.struct(*path)))
        usable = F.when(F.col("weight") > 0, F.col("supply")).otherwise(F.lit(0))
        tree = nodes.withColumn("supply", usable)
    above: DataFrame | None = None
    for depth in range(1, len(levels) + 1):
        path = list(levels[:depth])
        nodes = by_depth[depth]
        if above is None:
            nodes = nodes.join(F.broadcast(total))  # one row
        else:
            given = above.select(
                *(F.col(c).alias(f"up_{c}") for c in path[:-1]), F.col("budget").alias("parent_budget")
            )
            same = [F.col(c).eqNullSafe(F.col(f"up_{c}")) for c in path[:-1]]
            nodes = nodes.join(given, same).drop(*(f"up_{c}" for c in path[:-1]))
        above = _pour(nodes, path[:-1])
    return above.select(*levels, "tokens", "supply", "weight", "budget")


def select(
    docs: DataFrame, levels: Mapping[str, Column], mix: Mix, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(chosen rows, budgets of the leaves).

    Chosen rows: the levels, ``id_col``, ``text_hash``, ``tokens``, ``epoch`` (from 0)
    and ``take_tokens``; one row per document and epoch in which it is read.
    """
    names = [f"mix_{k}" for k in range(len(levels))]
    rows = staged(
        docs.select(
            *(c.alias(n) for n, c in zip(names, levels.values())),
            F.col(id_col).alias("mix_id"),
            F.xxhash64(text_col).alias("text_hash"),
            word_count(F.col(text_col)).alias("tokens"),
        ).where("tokens > 0"),
        "mix-tokens",
    )
    leaves = rows.groupBy(*names).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    plan = staged(
        budgets(leaves, names, mix)
        .withColumn("whole", F.floor(F.col("budget") / F.col("tokens")))
        .withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens")),
        "mix-plan",
    )
    largest = leaves.agg(F.max("n")).first()[0] or 1
    slots = 1 << max(0, math.ceil(math.log2(max(1, largest / SLOT_ROWS))))
    leaf = F.xxhash64(*names)
    known = rows.withColumn("leaf", leaf).join(
        plan.select(leaf.alias("leaf"), "whole", "rest"), "leaf"
    )
    order = F.xxhash64(F.lit(mix.seed), F.col("whole"), F.col("mix_id"), F.col("text_hash"))
    known = known.withColumn("order", order).withColumn(
        "slot", F.shiftrightunsigned(F.col("order"), 40) % slots
    )
    by_slot = known.groupBy("leaf", "slot").agg(F.sum("tokens").alias("held"), F.max("rest").alias("rest"))
    running = Window.partitionBy("leaf").orderBy("slot")
    sums = by_slot.withColumn("before", F.sum("held").over(running) - F.col("held"))
    # Of the last epoch: slots read in full, and the one in which the budget ends.
    read = staged(
        sums.where("before < rest").select(
            "leaf", "slot", "before", (F.col("before") + F.col("held") > F.col("rest")).alias("last")
        ),
        "mix-slots",
    )
    placed = known.join(read, ["leaf", "slot"], "left")
    inner = placed.where("last")
    in_slot = Window.partitionBy("leaf", "slot").orderBy("order", "mix_id", "text_hash")
    ahead = F.sum("tokens").over(in_slot.rowsBetween(Window.unboundedPreceding, -1))
    cut = inner.withColumn("ahead", F.col("before") + F.coalesce(ahead, F.lit(0))).select(
        *inner.columns,
        F.greatest(
            F.lit(0), F.least(F.col("tokens"), F.col("rest") - F.col("ahead"))
        ).alias("part"),
    )
    outer = placed.where("last IS NULL OR NOT last").select(
        "*", F.when(F.col("last").isNotNull(), F.col("tokens")).otherwise(F.lit(0)).alias("part")
    )
    epochs = F.sequence(F.lit(0), F.col("whole").cast("int"))
    read_rows = outer.unionByName(cut).select(
        *names, "mix_id", "text_hash", "tokens", "whole", "part", F.explode(epochs).alias("epoch")
    )
    take = F.when(F.col("epoch") < F.col("whole"), F.col("tokens")).otherwise(F.col("part"))
    chosen = read_rows.withColumn("take_tokens", take).where("take_tokens > 0")
    out = [F.col(n).alias(level) for n, level in zip(names, levels)]
    return (
        chosen.select(*out, F.col("mix_id").alias(id_col), "text_hash", "tokens", "epoch", "take_tokens"),
        plan.select(*out, "tokens", "supply", "weight", "budget"),
    )
