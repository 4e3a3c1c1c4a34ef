"""Session defaults and the shared folder for stage tables and checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_session(app: str = "ambula", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans expect (UTC, adaptive execution)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir where it is set.

    Where it is unset, a local master gets a temporary folder; on a cluster that is an error, as no folder is known that
    all executors see. The folder is also made the checkpoint folder of the context if that has none.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = getattr(spark.sparkContext, "_ambula_shared", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = spark.sparkContext._ambula_shared = "file://" + tempfile.mkdtemp(prefix="ambula-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")
