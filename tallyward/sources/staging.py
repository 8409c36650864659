"""Tables written on the way, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder serves a session that runs on this machine alone;
    on a cluster that is an error, as executors would write to their own disks.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyward-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back.

    It is worked out once however often it is read, and a lost executor costs no recompute.
    """
    path = f"{shared_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
