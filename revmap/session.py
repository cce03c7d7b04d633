"""Session settings and scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(name: str = "revmap", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library counts on. On a cluster leave
    ``master`` to spark-submit; ``conf`` keys use ``__`` for the dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A large key is split even where the plan above then needs one more shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.ui.showConsoleProgress": "false",
        # A stack trace for every column is costly in wide projections.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder the cluster names in
    ``spark.checkpoint.dir``, so that what is written there outlives the
    executor that wrote it. Only a local session may do without the setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="revmap-")
    return f"{base.rstrip('/')}/revmap-{label}-{uuid.uuid4().hex}"
