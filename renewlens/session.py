"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Where every partition of one join side is known, at run time, to be below this
# size, a hash table is built instead of sorting both sides. Recommended for any
# session; the library never changes the settings of a session it is given.
HASH_JOIN_SETTING = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
HASH_JOIN_BYTES = 64 << 20
_local_folders: dict[str, str] = {}


def local_session(cores: str = "*", app: str = "renewlens", **settings: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config(HASH_JOIN_SETTING, str(HASH_JOIN_BYTES))
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    A folder of our own is made only where none is set and the session runs on
    one machine.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
        context.setCheckpointDir(_local_folders[app])
    return _local_folders[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/renewlens/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Later passes read columns from storage instead of repeating the lineage,
    and the data outlives a lost executor.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
