"""Cutting lineage through the cluster's shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpointed(rows: DataFrame) -> DataFrame:
    """Compute the rows once and keep them where every executor can read them.

    The folder comes from the session. Only a local session without one gets a
    folder of its own.
    """
    _shared_folder(rows.sparkSession)
    return rows.checkpoint()


def stored(rows: DataFrame) -> DataFrame:
    """Like :func:`checkpointed`, as a table: readers take only the columns they need, and it is a good deal smaller."""
    path = f"{_shared_folder(rows.sparkSession)}/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            master = context.master
            if master != "local" and not master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            folder = tempfile.mkdtemp(prefix="botlens-checkpoint-")
            atexit.register(shutil.rmtree, folder, True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()
