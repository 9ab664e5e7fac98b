"""Where queries that write a table put it."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


@functools.cache
def _local_folder() -> tempfile.TemporaryDirectory:
    """One folder a process, which goes when the process ends."""
    return tempfile.TemporaryDirectory(prefix="snapmart-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared folder, ``spark.checkpoint.dir``.

    Only a local session without that setting, where all tasks share the machine,
    gets a temporary folder instead.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_folder().name
    return f"{shared.rstrip('/')}/snapmart/{name}-{uuid.uuid4().hex}"
