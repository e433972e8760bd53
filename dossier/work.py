"""What jobs with Python workers and files need from a session: a folder that all hosts share, and this package on their path."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, as a file-system path.

    Where the setting is missing, a local session (tests) gets a temporary folder; a cluster raises ValueError, and so does a
    folder that is not mounted as files.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="dossier-work-")
        spark.conf.set("spark.checkpoint.dir", found)
    parts = urlparse(found)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{found}: not mounted as files")
    return os.path.join(parts.path if parts.scheme else found, "dossier", f"{name}-{uuid.uuid4().hex}")


def workers_see_us(spark: SparkSession) -> None:
    """Python workers that start from now on can import this package where it was not installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, environment.get("PYTHONPATH", "")) if x)
