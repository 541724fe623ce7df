"""Reliable checkpoints for loops, in the shared folder the session names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` and return it with its lineage cut; survives the loss of executors.

    The folder is the session's ``spark.checkpoint.dir``; there is no default, as a folder of the driver's machine
    would be lost on executors. Only a ``local`` master may leave it out: driver and executor are one process there.
    Files go with ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="cellweave-ckpt-"))
    return df.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path for files on their way, beside the checkpoints."""
    sc = spark.sparkContext
    cut(spark.range(0))  # names the folder if need be
    return f"{sc.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"
