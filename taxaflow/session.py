"""Cutting lineage in the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """``checkpoint()`` to ``spark.checkpoint.dir``; only where that is unset on one machine (tests), to a temporary folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="taxaflow-"))
    return df.checkpoint()
