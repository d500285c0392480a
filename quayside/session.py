"""Session settings and the shared working folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app_name: str = "quayside", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the landing jobs want; `conf` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def prepare(spark: SparkSession) -> None:
    """Makes a session built elsewhere fit: UTC, and the package on the workers."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    shared_dir(spark)


def ship_package(spark: SparkSession) -> None:
    """Makes the package importable in the Python workers. Once per application."""
    context = spark.sparkContext
    if any(name.endswith("/quayside.zip") for name in context.listFiles):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="quayside-")
    archive = shutil.make_archive(f"{folder}/quayside", "zip", root.parent, root.name)
    context.addPyFile(archive)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`.

    Only a session on one machine may be without that setting; it gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quayside-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark).rstrip('/')}/quayside/{label}-{uuid.uuid4().hex}"
