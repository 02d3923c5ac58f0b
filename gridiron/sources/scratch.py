"""Folders for files that a job lands and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; on a local master without the setting, below a temporary folder of the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="gridiron-")
        folder = _OWN[app]
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
