"""Session settings and the shared scratch folder."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # a day is a UTC day
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # touched dates are rewritten, the rest of the table stays
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

_OWN_SCRATCH = "spark.usagelens.scratch.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the results depend on to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g"
) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("usagelens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_one_process(master: str) -> bool:
    """``local`` and ``local[n]``, not ``local-cluster``."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Without one, a temporary folder is made once per session, but only where all tasks run in this
    process; on a cluster every executor would write to a disk of its own.
    """
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get(_OWN_SCRATCH, None)
    )
    if not root:
        if not is_one_process(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="usagelens-")
        spark.conf.set(_OWN_SCRATCH, root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialized(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared scratch folder: computed once, safe to reuse."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
