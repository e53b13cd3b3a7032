"""Session defaults and the shared folder for materialised intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# SQL settings that are safe to set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join feeding an aggregation on the same key may still be split when one key is hot;
    # the extra exchange is cheaper than one task holding a third of the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Keys of keyed hashes are binary literals; plan texts must not show them.
    "spark.sql.redaction.string.regex": r"(?:0x|X')[0-9A-Fa-f]{32,}'?|\[[0-9A-F]{2}(?: [0-9A-F]{2}){15,}\]",
    # Resource tables are nested; keep the flattening projections code-generated.
    "spark.sql.codegen.maxFields": "200",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "cohortloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only where nothing is named and all runs in one process on one machine (``local`` masters, as in
    tests) a fresh local folder is set up; on a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        named = tempfile.mkdtemp(prefix="cohortloom-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a reused base table once and read it back.

    The result survives the loss of executors, cuts the lineage, and keeps Parquet column pruning
    and filter pushdown for its readers.
    """
    path = new_shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    delete_on_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have the file system remove a folder when the application ends."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
