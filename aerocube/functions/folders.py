"""Where files between steps go."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession) -> str:
    """The shared folder for files between steps: spark.checkpoint.dir. Where that is unset, a temporary one in local mode
    (tests), an error on a cluster, whose executors wouldn't see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder or tempfile.mkdtemp(prefix="aerocube-")
