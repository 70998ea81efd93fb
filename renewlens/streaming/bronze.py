"""Incremental append from a source folder to a bronze folder.

Each run takes the files that arrived since the last one, in bounded
micro-batches, and stops. Source offsets live in the checkpoint, complete batches
and their counts in the ledger beside the sink, so a run that died is continued
without loss or copies, of rows or of counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from renewlens.operators.quality import Expectation, gate
from renewlens.streaming import ledger

# What a micro-batch reads at most; a single larger file is a batch of its own.
MAX_BYTES_PER_BATCH = 1 << 40
# By default Spark ignores files that are a week older than the newest one it has
# seen. Late and copied-in files are data too, so no age is too old.
MAX_FILE_AGE = "36500d"


def _limited(reader, max_files: int | None, max_bytes: int | None):
    """Spark takes one limit: files if given, else bytes."""
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes or MAX_BYTES_PER_BATCH)
    return reader.option("maxFileAge", MAX_FILE_AGE)


def read_appended(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    glob: str = "*.parquet",
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Rows of files added to ``folder``; the schema must be declared."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    return _limited(reader, max_files, max_bytes).parquet(folder)


def read_appended_table(
    spark: SparkSession, table: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Rows appended to a catalog table."""
    return _limited(spark.readStream, max_files, max_bytes).table(table)


def _dealt(rows: DataFrame, partition_by: Sequence[str], files_per_partition: int) -> DataFrame:
    if not partition_by:
        return rows
    if files_per_partition:
        share = F.floor(F.rand(17) * files_per_partition)
        return rows.withColumn("_share", share).repartition(*partition_by, "_share").drop("_share")
    # Measured at run time: a large day is cut by size, small ones share a task.
    return rows.hint("rebalance", *partition_by)


def append_new(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    rules: Sequence[Expectation] = (),
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (),
    files_per_partition: int = 0,
    along: Callable[[DataFrame, str, int], None] | None = None,
) -> dict[str, int]:
    """Gate and append everything that is new; returns the counts of this run.

    Without ``partition_by`` the plan has no shuffle: rows go from source file to gate
    to sink. A partitioned sink gets its rows dealt by partition, as many tasks to a
    partition as its bytes ask for, or at most ``files_per_partition``.

    ``along`` is called with the rows of each batch as written, its query and number,
    before the batch counts as complete: what it writes under that name is as old or
    new as the rows.
    """
    spark = stream.sparkSession
    total = Counter({"total_rows": 0, **{r.name: 0 for r in rules}})

    def append(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        query = own.sparkContext.getLocalProperty("sql.streaming.queryId")
        if ledger.is_complete(own, target, query, number):
            return
        path = ledger.batch_folder(target, query, number)
        observation = Observation()
        # After the shuffle: counters in the writing stage count each row once.
        checked = gate(_dealt(batch, partition_by, files_per_partition), rules, observation)
        checked.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        if along:
            along(own.read.schema(checked.schema).parquet(path), query, number)
        counts = dict(observation.get)
        ledger.complete(own, target, query, number, counts)
        total.update(counts)

    query = (
        (transform(stream) if transform else stream)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return dict(total)
