"""Compute a reused intermediate once and cut its lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder: the one the context has, else the cluster's shared one
    (`spark.checkpoint.dir`), which is then set. A local master, whose tasks all run on
    this machine, gets a temporary folder when neither is set; a cluster without a
    shared folder is an error, because executors cannot read each other's disks."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tollgate-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write df once as a reliable checkpoint in the checkpoint folder and return a
    frame that reads it back: every consumer reuses the same rows and a lost executor
    does not recompute the lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
