"""Document fingerprints that follow edit distance: Order MinHash.

A text is its runs of ``k`` code points, each numbered by how often it occurred
before, so that repeats are different elements. For each of ``functions`` hash
functions the ``chosen`` elements with the smallest hashes are taken, put in the
order in which they stand in the text, and hashed as a tuple. Two texts agree in a
function if they chose the same elements and these stand in the same order, so
moving text about costs likeness and not only losing it. Likeness is the share of
functions that agree.

A text shorter than ``k`` is one run. An empty or NULL text has a fingerprint of
zeros, which is like only another such. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewlens.llm import blocks
from renewlens.session import staged

_CELLS = 1 << 19  # numbers held at once


@dataclass(frozen=True)
class Settings:
    k: int = 8
    functions: int = 64
    chosen: int = 2
    seed: int = 3


def _elements(text: str, k: int) -> np.ndarray:
    """One 64-bit hash per occurrence-numbered run, in text order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    values = points.astype(np.uint64) + np.uint64(1)
    runs = blocks.run_hashes(values, min(k, len(values)))
    ordered = np.sort(runs)
    repeated = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(repeated):
        at = np.flatnonzero(np.isin(runs, repeated))
        at = at[np.argsort(runs[at], kind="stable")]
        new = np.concatenate([[True], runs[at][1:] != runs[at][:-1]])
        start = np.flatnonzero(new)
        number = np.arange(len(at)) - np.repeat(start, np.diff([*start, len(at)]))
        again = number > 0
        step = np.uint64(0xA0761D6478BD642F)
        runs[at[again]] = blocks.mix(runs[at[again]] + number[again].astype(np.uint64) * step)
    return runs


def fingerprint(text: str | None, settings: Settings = Settings()) -> np.ndarray:
    """32-bit numbers, one per function."""
    n = settings.functions
    if not text:
        return np.zeros(n, np.uint32)
    own = _elements(text, settings.k)
    short = (own >> np.uint64(32)).astype(np.uint32)
    seeds = (blocks.seeds(2 * n, settings.seed) >> np.uint64(32)).astype(np.uint32)
    take = min(settings.chosen, len(own))
    places = np.empty((n, take), np.int64)
    most = np.uint32(0xFFFFFFFF)
    group = max(1, _CELLS // len(own))
    for first in range(0, n, group):
        end = min(first + group, n)
        table = (short ^ seeds[first:end, None]) * (seeds[n + first : n + end, None] | np.uint32(1))
        for pick in range(take):
            least = table.argmin(1)
            places[first:end, pick] = least
            table[np.arange(end - first), least] = most
    places.sort(1)
    value = np.arange(1, n + 1, dtype=np.uint64)
    for pick in range(take):
        value = blocks.mix(value * np.uint64(0x9E3779B97F4A7C15) + own[places[:, pick]])
    return np.maximum((value >> np.uint64(32)).astype(np.uint32), np.uint32(1))


def _packed(numbers: np.ndarray) -> bytes:
    return numbers.astype(">u4").tobytes()


def written(numbers: np.ndarray) -> str:
    return _packed(numbers).hex()


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    return float(np.mean(left == right))


def fingerprints(
    docs: DataFrame,
    settings: Settings = Settings(),
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """``keep`` columns and ``fingerprint`` (hexadecimal), one row per input row."""
    source = docs.select(
        *(F.col(c).alias(f"__{k}") for k, c in enumerate(keep)), F.col(text_col).alias("__text")
    )

    def run(batches):
        for batch in batches:
            texts = blocks.string_column(batch, "__text")
            prints = pa.array([written(fingerprint(t.as_py(), settings)) for t in texts], pa.string())
            columns = [batch.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, prints], names=[*keep, "fingerprint"])

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(run, f"{kept}, fingerprint string")


def _edited(text: str, following: str) -> str:
    """The second half (rounded down) replaced by as much of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = (
    "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)


def _compared(text, own, following, other, settings: Settings) -> tuple:
    edited = _edited(text, following)
    changed = own if edited == text else fingerprint(edited, settings)
    return (
        len(text),
        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).digest(),
        _packed(own),
        _packed(changed),
        likeness(own, changed),
        likeness(own, other),
    )


def _columns(rows: list[tuple], kinds) -> list[pa.Array]:
    return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]


def edit_check(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Fingerprints of every text, of its edited form, and how like they are.

    The following document is the one with the next smaller id (after the smallest:
    the largest); rows without an id come last, rows that repeat one are in order of
    their texts' hashes. Texts are dealt by ranges of the id and sorted there, once;
    what crosses a border between ranges is one pair of texts for each range.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    ordered = [F.col("id").desc_nulls_last(), F.col("mark"), F.col("spread")]
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.xxhash64(text_col).alias("mark"),
        F.rand(settings.seed).alias("spread"),  # lets many equal rows be dealt out
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(partitions, *ordered).sortWithinPartitions(*ordered)
    dealt = dealt.select("id", "text", F.spark_partition_id().alias("part"))
    kinds = (pa.int64(), *(pa.binary(),) * 3, *(pa.float64(),) * 2)

    def walk(batches):
        last = None  # (id as a one-row array, text, fingerprint)
        first_text = part = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                done, ids = [], []
                for row, text in enumerate(piece.column(1).to_pylist()):
                    own = fingerprint(text, settings)
                    if last is None:
                        first_text, part = text, piece.column(2)[row].as_py()
                    else:
                        done.append(_compared(last[1], last[2], text, own, settings))
                        ids.append(last[0])
                    last = (piece.column(0).slice(row, 1), text, own)
                if done:
                    empty = [pa.nulls(len(done), t) for t in (pa.int32(), pa.string(), pa.string())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.concat_arrays(ids), *_columns(done, kinds), *empty], names=names
                    )
        if last is not None:
            blank = [pa.nulls(1, t) for t in kinds]
            edge = [pa.array([part], pa.int32()), pa.array([first_text]), pa.array([last[1]])]
            yield pa.RecordBatch.from_arrays([last[0], *blank, *edge], names=names)

    names = ["id", *(c.split()[0] for c in _RESULT.split(", ")), "part", "first_text", "last_text"]
    walked = staged(
        dealt.mapInArrow(
            walk, f"id {kind}, {_RESULT}, part int, first_text string, last_text string"
        ),
        "order-minhash",
    )
    # One row for each range that has rows.
    edges = walked.where("part IS NOT NULL").select("id", "part", "first_text", "last_text")
    by_part = Window.orderBy("part")
    whole = Window.partitionBy()
    edges = edges.withColumn(
        "following",
        F.coalesce(F.lead("first_text").over(by_part), F.min_by("first_text", "part").over(whole)),
    ).select("id", "last_text", "following")

    def close(batches):
        for batch in batches:
            done = [
                _compared(text, fingerprint(text, settings), other, fingerprint(other, settings), settings)
                for text, other in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *_columns(done, kinds)], names=names[:7]
            )

    closed = edges.mapInArrow(close, f"id {kind}, {_RESULT}")
    inside = walked.where("part IS NULL").select(*closed.columns)
    texts = {
        c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")
    }
    # Binary while it is stored in between: half the size.
    return inside.unionByName(closed).withColumns(texts).withColumnRenamed("id", id_col)
