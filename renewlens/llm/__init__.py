"""Operators for preparing training data; nothing else in the library needs them."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers import the library from where the driver did.

    On a cluster it is installed or shipped with the job; this serves sessions that
    were started from another folder on the same machine.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))
    return spark
