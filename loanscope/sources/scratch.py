"""Shared folder for tables a job has to write on the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


_local: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors can reach.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        name = spark.sparkContext.applicationId
        root = _local.get(name) or _local.setdefault(name, tempfile.mkdtemp(prefix="loanscope-"))
    return f"{root}/loanscope/{uuid.uuid4().hex}"
