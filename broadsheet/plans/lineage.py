"""Cutting the lineage of iterative plans in the folder that the session shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; one of our own only where that is unset and all run on this machine."""
    context = spark.sparkContext
    if root := context.getConf().get("spark.checkpoint.dir"):
        return root.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="broadsheet-")
    return _own[context.applicationId]


def cut(df: DataFrame) -> DataFrame:
    """df written by checkpoint() to the session's folder; one of our own is set only where there is none."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
