"""Folders every executor can reach."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


#: Folders of local applications that name none.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Where it is unset, only a local session may go without: it gets one folder of its own, which is
    deleted when the application ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="snaptrack-")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file://{_LOCAL[app]}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return _LOCAL[app]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"
