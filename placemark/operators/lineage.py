"""Lineage cut between the rounds of an iteration."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """df, computed and kept in the folder of spark.checkpoint.dir, which all executors share.

    Where the session names none, a folder of this machine serves a local master alone.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        where = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not where:
            if not context.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            where = tempfile.mkdtemp(prefix="placemark-")
            atexit.register(shutil.rmtree, where, ignore_errors=True)
        context.setCheckpointDir(where)
    return df.checkpoint()
