"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Pages are large rows: bound an Arrow batch by rows, so that a batch of pages fits a worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}


# The folder of each local session that names none: the setting can't be changed once it runs.
_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app_name: str = "rentrank", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the job settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory in the shared folder that the cluster names for checkpoints.

    Only a local session that names none (a test) gets a machine-local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="rentrank-")
        shared = _LOCAL_FOLDERS[app]
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
