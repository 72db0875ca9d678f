"""Session defaults and the shared folder for checkpoints and state tables."""

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_FOLDER = None


def build_session(app_name="tallybrook", master=None, shuffle_bytes=None, **conf):
    """Session with the settings the operators count on.

    `shuffle_bytes`, the expected size of the largest shuffle, sets the number of
    shuffle partitions so that one holds about 128 MB; adaptive execution merges
    those that turn out small.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # plans are built column by column; do not record a Python call site for each
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if shuffle_bytes:
        partitions = max(200, shuffle_bytes // (128 << 20))
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark):
    """Folder every executor can reach, taken from `spark.checkpoint.dir`.

    Only a local-mode session without that setting falls back to a temporary
    folder; on a cluster a missing setting is an error, because state written to
    one machine's disk would be lost with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    global _LOCAL_FOLDER
    if _LOCAL_FOLDER is None:
        _LOCAL_FOLDER = tempfile.mkdtemp(prefix="tallybrook-")
    return _LOCAL_FOLDER


def new_folder(spark, name):
    """A fresh, not yet existing path below the shared folder."""
    return os.path.join(shared_folder(spark), "tallybrook", f"{name}-{uuid.uuid4().hex}")
