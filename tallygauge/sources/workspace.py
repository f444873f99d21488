"""Where intermediate tables go: a folder that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting, as in tests, gets a folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tallygauge-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nobody has used before."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
