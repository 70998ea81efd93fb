"""The ledger of a streamed folder: which batches are complete, and their counts.

A batch is a folder of its own, named by query and batch. Once its rows are written,
one small file in the ledger says so, with the counts of its gate and the time. Readers
see the batches of the ledger only. A run that dies leaves at most a batch without an
entry, which the next run writes anew under the same name; a batch with an entry is
never written again. So rows and counts are there once, whenever a run dies.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from renewlens.sources.tables import has_files, list_names, write_text

QUERY, BATCH = "stream_query", "stream_batch"
ENTRY = (
    f"{QUERY} string, {BATCH} long, committed_at timestamp, "
    "counts array<struct<metric:string,row_count:long>>"
)


def ledger_folder(target: str) -> str:
    return f"{target.rstrip('/')}.ledger"


def batch_folder(target: str, query: str, batch: int) -> str:
    return f"{target.rstrip('/')}/{QUERY}={query}/{BATCH}={batch}"


def _entry(target: str, query: str, batch: int) -> str:
    return f"{ledger_folder(target)}/{query}-{batch}.json"


def is_complete(spark: SparkSession, target: str, query: str, batch: int) -> bool:
    return f"{query}-{batch}.json" in list_names(spark, ledger_folder(target))


def complete(
    spark: SparkSession, target: str, query: str, batch: int, counts: Mapping[str, int]
) -> None:
    """Enter a batch whose rows are written."""
    entry = {
        QUERY: query,
        BATCH: batch,
        "committed_at": datetime.datetime.now(datetime.timezone.utc).isoformat(),
        "counts": [{"metric": k, "row_count": int(n)} for k, n in counts.items()],
    }
    write_text(spark, _entry(target, query, batch), json.dumps(entry))


def entries(spark: SparkSession, target: str) -> DataFrame:
    """One row per complete batch."""
    folder = ledger_folder(target)
    if not list_names(spark, folder):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).json(folder)


def logged_counts(spark: SparkSession, target: str) -> DataFrame:
    """One row per complete batch and metric: ``batch``, ``metric``, ``row_count``."""
    one = entries(spark, target).select(batch_name().alias("batch"), F.inline("counts"))
    return one.select("batch", "metric", "row_count")


def batch_name():
    return F.concat_ws("-", QUERY, BATCH)


def committed_freshness(ledger: DataFrame) -> DataFrame:
    """When the last batch was completed; now, if there is none.

    Files that no entry of the ledger stands for do not count, however new.
    """
    last = F.max("committed_at")
    return ledger.agg(F.coalesce(last, F.current_timestamp()).alias("refreshed_at"))


def committed_rows(
    spark: SparkSession, target: str, schema: StructType, ledger_of: str | None = None
) -> DataFrame:
    """The rows of complete batches; ``ledger_of`` is the folder whose ledger counts.

    The ledger is one row per batch, joined on the names of the batches' folders, so
    batches and partitions that are not wanted are not opened.
    """
    if not has_files(spark, target):
        return spark.createDataFrame([], schema)
    named = StructType([*schema.fields]).add(QUERY, "string").add(BATCH, "long")
    rows = spark.read.schema(named).parquet(target)
    known = entries(spark, ledger_of or target).select(QUERY, BATCH)
    # select() keeps the comments of the declared schema.
    return rows.join(known, [QUERY, BATCH], "semi").select(*schema.fieldNames())


def point_committed_view(spark: SparkSession, table: str, target: str, schema: StructType) -> None:
    """Show the complete batches of a folder as a table."""
    names = ", ".join(f"`{f.name}`" for f in schema)
    query = (
        f"SELECT {names} FROM parquet.`{target}` "
        f"LEFT SEMI JOIN json.`{ledger_folder(target)}` USING ({QUERY}, {BATCH})"
    )
    known = spark.catalog.tableExists(table)
    spark.sql(f"ALTER VIEW {table} AS {query}" if known else f"CREATE VIEW {table} AS {query}")
