"""Scratch space shared by all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local folder would not be seen by the other machines.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        folder = tempfile.mkdtemp(prefix="shiftledger-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; Spark creates it on first write."""
    return f"{shared_folder(spark)}/shiftledger/{label}-{uuid.uuid4().hex}"
