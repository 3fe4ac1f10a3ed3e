"""Cutting lineage through the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """An eager reliable checkpoint in the folder that spark.checkpoint.dir names. Only one machine alone may do without."""
    spark = df.sparkSession
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.getCheckpointDir() is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file:///tmp/checkpoints/lanemesh")
    return df.checkpoint(eager=True)
