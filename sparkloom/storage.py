"""Folders that driver and executors share, and files in them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Our own folders, by application, where a local session names none.
_OWN_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where that is unset, a local session (one machine) gets a temporary folder; a cluster is told to name one, as its
    executors would write to their own disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if context.applicationId not in _OWN_ROOTS:
            _OWN_ROOTS[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="sparkloom-shared-")
        root = _OWN_ROOTS[context.applicationId]
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/sparkloom/{name}-{uuid.uuid4().hex[:12]}"


def filesystem(path: str):
    """(pyarrow file system, path) for a local path or a URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
