"""Folder for tables one job writes and another reads."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's checkpoint directory, which all executors can reach.

    Only a local session without that setting falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cellsheaf-")
    return f"{root.rstrip('/')}/cellsheaf-{uuid.uuid4().hex}"
