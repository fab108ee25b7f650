"""The folder that driver and executors share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, read from the session.

    Only where that setting is absent and Spark runs in one process (tests) a
    folder is made; on a cluster its absence is an error, as executors would write
    to folders that the driver can't see.
    """
    found = spark.sparkContext.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not found:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not found:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corvane-shared-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def shared_path(spark: SparkSession, what: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{what}-{uuid.uuid4().hex}")
