"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """Materialise a table that is read several times and cut its lineage there.

    The folder is that of spark.checkpoint.dir; where it is unset and the master is local, as in tests, one is made.
    """
    context = df.sparkSession.sparkContext
    unset = not context.getConf().get("spark.checkpoint.dir") and context._jsc.sc().getCheckpointDir().isEmpty()
    if unset and context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if unset:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-checkpoint-"))
    return df.checkpoint(eager=True)
