"""Session and shared-folder helpers.

The library never creates a session for a caller: jobs take the caller's
session.  ``local_session`` is for tests, the bench and the examples only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "registry_analytics",
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("REGISTRY_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for written intermediate tables.

    Taken from the session's ``spark.checkpoint.dir`` (the cluster's shared
    folder).  Only when it is unset on a ``local[...]`` master, as in tests, a
    local temporary folder is created and registered as the checkpoint
    directory; on a cluster an unset folder is an error (a machine-local
    folder would not be visible to the executors).
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        current = sc.getCheckpointDir()
        if current:
            return current.rstrip("/")
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        d = tempfile.mkdtemp(prefix="registry-ckpt-")
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared folder (never reused, never cleared)."""
    return f"{shared_dir(spark)}/registry_analytics/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scoped_conf(spark: SparkSession, **conf: str):
    """Set SQL confs (dots written as ``__``) for the duration of a block, then restore them."""
    keys = {k.replace("__", "."): str(v) for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
