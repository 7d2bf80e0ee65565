"""Folders that the driver and all executors see."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new path below ``spark.checkpoint.dir``; below a temporary folder where that is unset and the master is local."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            folder = tempfile.mkdtemp(prefix="mesaquery-shared-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            _own[app] = "file://" + folder
        shared = _own[app]
    return f"{shared.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def filesystem(uri: str):
    """pyarrow's file system of a path or URI, for tasks, and the path in it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
