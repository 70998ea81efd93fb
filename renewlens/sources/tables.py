"""Batch sources and sinks.

A published table is a view over an immutable, versioned folder. Publishing
repoints the view, which is one metadata operation: readers see the old or the
new version, never a half-written one, and no data is copied. Tables that belong
together are staged and checked together before any of them is repointed.
"""

from __future__ import annotations

import datetime
import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from renewlens.operators.quality import Expectation, gate, raise_on_failure


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the declared columns, types and comments, in order.

    A column that is missing, or whose type cannot be stored as the declared
    one, is an error when the plan is built.
    """
    return df.to(schema)


def append_table(df: DataFrame, table: str) -> None:
    df.write.mode("append").saveAsTable(table)


def append_files(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite_table(df: DataFrame, table: str, root: str | None = None) -> None:
    """Replace contents and schema of a table that readers never miss.

    The rows are written as a new version under ``root`` (the warehouse by default) and
    the table, a view, is repointed. A failed write leaves the old version. A plain
    table of that name, as ``append_table`` makes it, gives way to the view once, after
    the new version is complete.
    """
    spark = df.sparkSession
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_versions"
    path = _version_path(table, root)
    try:
        df.write.parquet(path)
    except BaseException:
        remove_folder(spark, path)
        raise
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        spark.sql(f"DROP TABLE {table}")
    point_view(spark, table, path, df.schema)


def snapshot_table(
    spark: SparkSession, source: str, target: str, root: str | None = None
) -> None:
    """A copy of ``source`` under another name, which does not change with it."""
    overwrite_table(spark.table(source), target, root)


def snapshot_files(spark: SparkSession, source: str, path: str) -> DataFrame:
    """A plain copy of ``source`` as files, for readers without a catalog."""
    table = spark.table(source)
    table.write.mode("overwrite").parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds Parquet files, at any depth."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return False
    found = files.listFiles(folder, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def remove_folder(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(folder))


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, whole or not at all; False if it exists already."""
    files, target = _folder(spark, path)
    if files.exists(target):
        return False
    _, waiting = _folder(spark, f"{target.getParent()}/_{uuid.uuid4().hex}")
    out = files.create(waiting, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if files.rename(waiting, target):
        return True
    files.delete(waiting, False)
    return False


def read_text(spark: SparkSession, path: str) -> str:
    rows = spark.read.option("wholetext", True).text(path).collect()
    return rows[0].value if rows else ""


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file that must not exist; of several claimants one succeeds."""
    files, target = _folder(spark, path)
    files.mkdirs(target.getParent())
    try:
        files.create(target, False).close()
    except Py4JJavaError as error:
        if files.exists(target):
            return False
        raise error
    return True


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _version_path(table: str, root: str) -> str:
    now = datetime.datetime.now(datetime.timezone.utc)
    version = f"{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    return f"{root.rstrip('/')}/{table.split('.')[-1]}/version={version}"


def publish(
    df: DataFrame,
    table: str,
    root: str,
    schema: StructType,
    rules: Sequence[Expectation] = (),
    comment: str = "",
    partition_by: Sequence[str] = (),
) -> dict[str, int]:
    """Stage, verify, publish. Returns the violation counts.

    Raises ``ExpectationFailed``, which carries all counts, and leaves the published
    table as it was when a FAIL rule is broken; the staged version is deleted.
    """
    wanted = Publication(table, lambda _: df, schema, rules, comment, partition_by)
    return publish_all(df.sparkSession, [wanted], root)[table]


@dataclass(frozen=True)
class Publication:
    """A table to publish: its rows, given the tables staged before it by name."""

    table: str
    rows: Callable[[Mapping[str, DataFrame]], DataFrame]
    schema: StructType
    rules: Sequence[Expectation] = ()
    comment: str = ""
    partition_by: Sequence[str] = ()


def publish_all(
    spark: SparkSession,
    wanted: Sequence[Publication],
    root: str,
    seen: Callable[[str, dict[str, int]], None] = lambda table, counts: None,
) -> dict[str, dict[str, int]]:
    """Stage all tables, verify all, then repoint all. Returns the counts by table.

    A later table reads the staged version of an earlier one. If any breaks a FAIL rule
    or cannot be written, no published table changes and all staged versions are
    deleted. ``seen`` gets the counts of every table that was written, those of a
    failing one included. What is to be repointed is noted down first, so that a run
    that dies in the middle is completed by ``finish_publications``.
    """
    finish_publications(spark, root)
    staged: dict[str, DataFrame] = {}
    paths: dict[str, str] = {}
    metrics: dict[str, dict[str, int]] = {}
    try:
        for one in wanted:
            path = paths[one.table] = _version_path(one.table, root)
            observation = Observation()
            checked = gate(conform(one.rows(staged), one.schema), one.rules, observation)
            checked.write.partitionBy(*one.partition_by).parquet(path)
            metrics[one.table] = dict(observation.get)
            seen(one.table, metrics[one.table])
            raise_on_failure(one.table, one.rules, metrics[one.table])
            staged[one.table] = spark.read.schema(one.schema).parquet(path)
    except BaseException:
        for path in paths.values():
            remove_folder(spark, path)
        raise
    note = f"{root.rstrip('/')}/{PENDING}/{uuid.uuid4().hex}.json"
    views = [
        {
            "table": one.table,
            "path": paths[one.table],
            "schema": one.schema.json(),
            "comment": one.comment,
        }
        for one in wanted
    ]
    write_text(spark, note, json.dumps(views))
    _repoint(spark, note)
    return metrics


PENDING = "_pending"


def _repoint(spark: SparkSession, note: str) -> None:
    for view in json.loads(read_text(spark, note)):
        schema = StructType.fromJson(json.loads(view["schema"]))
        point_view(spark, view["table"], view["path"], schema, view["comment"])
    remove_folder(spark, note)


def finish_publications(spark: SparkSession, root: str) -> None:
    """Repoint what an earlier run had staged and verified, but not wholly repointed."""
    for name in list_names(spark, f"{root.rstrip('/')}/{PENDING}"):
        if name.endswith(".json"):
            _repoint(spark, f"{root.rstrip('/')}/{PENDING}/{name}")


def point_view(
    spark: SparkSession, table: str, path: str, schema: StructType, comment: str = ""
) -> None:
    """Show a folder as a table; readers see the old folder or the new one.

    An existing view is altered, for Spark drops a view that it is told to replace.
    Comments of columns come with the files that are written here.
    """
    names = ", ".join(f"`{f.name}`" for f in schema)
    query = f"SELECT {names} FROM parquet.`{path}`"
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER VIEW {table} AS {query}")
        return
    columns = ", ".join(
        f"`{f.name}` COMMENT {_quoted(f.metadata.get('comment', ''))}" for f in schema
    )
    spark.sql(f"CREATE VIEW {table} ({columns}) COMMENT {_quoted(comment)} AS {query}")


def prune_versions(spark: SparkSession, table: str, root: str, keep: int) -> list[str]:
    """Delete all but the newest ``keep`` versions; never the published one.

    Keep enough of them for queries that are still reading an old version.
    """
    files, folder = _folder(spark, f"{root.rstrip('/')}/{table.split('.')[-1]}")
    # Names start with a time, so their order is the order of writing.
    versions = sorted(
        (s.getPath() for s in files.listStatus(folder)), key=lambda path: path.getName()
    )
    published = spark.sql(f"SHOW CREATE TABLE {table}").first()[0]
    gone = [v for v in versions[: -keep or None] if v.getName() not in published]
    for version in gone:
        files.delete(version, True)
    return [v.getName() for v in gone]


def quality_log(
    spark: SparkSession,
    metrics: Mapping[str, Mapping[str, int]],
    run_id: str,
    batch: str | None = None,
) -> DataFrame:
    """Violation counts of one refresh as rows: a handful per table.

    ``batch`` names the batch of a stream that is counted, if it is one.
    """
    rows = [
        (run_id, table, name, int(n), batch)
        for table, counts in metrics.items()
        for name, n in counts.items()
    ]
    return spark.createDataFrame(
        rows, "run_id string, table_name string, metric string, row_count bigint, batch string"
    )


def published_path(spark: SparkSession, table: str) -> str | None:
    """Folder of the version that readers of a published table see."""
    if not spark.catalog.tableExists(table):
        return None
    text = spark.sql(f"SHOW CREATE TABLE {table}").first()[0]
    found = re.search(r"FROM parquet\.`([^`]*)`", text)
    return found[1] if found else None


def published_freshness(spark: SparkSession, table: str) -> DataFrame:
    """When the served version of a table was written; now, if there is none."""
    path = published_path(spark, table)
    if path is None or not has_files(spark, path):
        return spark.range(1).select(F.current_timestamp().alias("refreshed_at"))
    return freshness(spark, path)


def freshness(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """When a table last changed; now, if it has no files yet.

    Lists the files without opening them: one row per file, none per record.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    changed: Column = F.max("modificationTime")
    return files.agg(F.coalesce(changed, F.current_timestamp()).alias("refreshed_at"))
