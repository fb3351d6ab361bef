"""The shared folder in which lineage is cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def with_checkpoints(spark: SparkSession) -> None:
    """Takes the checkpoint folder that the cluster names in spark.checkpoint.dir.

    Where none is named, a local session (one machine, as in tests) gets a temporary one; a cluster's executors
    would each write to their own disks, so there it is an error.
    """
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isEmpty():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
