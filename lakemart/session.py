"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(app: str = "lakemart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans count on; on a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """A new folder for one run, below the shared folder named in ``spark.checkpoint.dir``.

    Where that is not set, the folder lies in the session's warehouse, the other place that every executor reaches.
    It is deleted when the session's JVM ends, because results are lazy and may be read until then; tables that are
    no longer needed go earlier (``Workspace.drop``).
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    folder = f"{base.rstrip('/')}/lakemart-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
