"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings the operators rely on; all are runtime SQL settings."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@cache
def local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="sievemark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder for files that executors and driver must both see.

    It lies below ``spark.checkpoint.dir``, which a cluster points at shared
    storage; without it only a local master (tests) gets a temporary folder, one per
    process and removed with it, and any other master is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = local_folder()
    return f"{base.rstrip('/')}/sievemark/{name}-{uuid.uuid4().hex}"
