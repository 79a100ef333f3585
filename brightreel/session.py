"""Session settings and small helpers that every module shares."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "brightreel", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` keys use ``__`` for dots."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir).

    Only where the session names none, and all runs on one machine (tests), a
    temporary folder is made, and removed at the end; a cluster must name one.
    """
    sc = spark.sparkContext
    at = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="brightreel-checkpoint-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(at)
    return at


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def env_path(name: str, default: str) -> str:
    return os.environ.get(name, default)
