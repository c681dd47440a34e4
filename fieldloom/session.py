"""Session defaults, table access and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings the library relies on; everything else is left to the cluster.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build(app: str = "fieldloom", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the library's defaults; keyword arguments use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), str(value))
    return builder.getOrCreate()


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``root``."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A cluster names a folder all executors share in ``spark.checkpoint.dir``; that
    one is used. Only where none is set and all runs in one process (tests) a temporary
    one is made; on a cluster that is an error, as executors couldn't read it.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not named and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = named or tempfile.mkdtemp(prefix="fieldloom-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` by writing it to the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
