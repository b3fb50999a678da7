"""Session defaults and the checkpoint folder."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "fogline", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names; a session of one machine that names none has one beside its tables.

    A cluster must name one: what executors write into folders of their own is lost with them.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("on a cluster spark.checkpoint.dir must name a folder that all machines share")
    sc.setCheckpointDir(configured or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints")
    return sc.getCheckpointDir()


#: Whether Spark deletes the shuffle files of an execution when it ends; otherwise they stay until the driver's heap is collected.
DELETE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and pins one evaluation of ``df``.

    What was shuffled for it is not needed any more and deleted: on large tables the driver's heap fills more slowly than the disk.
    """
    conf = df.sparkSession.conf
    ensure_checkpoint_dir(df.sparkSession)
    usual = conf.get(DELETE_SHUFFLES, "false")
    conf.set(DELETE_SHUFFLES, "true")
    try:
        # A frame of its own, made under the setting: nothing else can run it again and miss its files.
        return df.select("*").checkpoint(eager=True)
    finally:
        conf.set(DELETE_SHUFFLES, usual)
