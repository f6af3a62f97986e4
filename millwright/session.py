"""Session settings the jobs expect. A cluster's own settings win: nothing here sizes a cluster."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def builder(app_name: str = "millwright") -> SparkSession.Builder:
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )


def use_utc(spark: SparkSession) -> None:
    """Quarters, dates and hours are UTC by contract, whatever zone the session was started in."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's checkpoint folder.

    Only a local session that names none (tests on one machine) gets a temporary folder; a cluster must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="millwright-")
        spark.sparkContext.setCheckpointDir(root)
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")
