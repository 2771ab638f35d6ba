"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", name: str = "stagewright", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    cores = 8 if cpus == "*" else int(cpus)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path that every executor can reach.

    The cluster names the shared folder in ``spark.checkpoint.dir``. A machine-local folder is
    used only by a local-mode session that has none.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="stagewright-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
