"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime-settable options that the operators count on. AQE measures shuffle output before it
# decides to broadcast a side or to split a hot partition, so no size is guessed in advance.
ADAPTIVE_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


#: The folder of a local session whose settings name none; the setting itself cannot be changed at run time.
_own_folder: str | None = None


def tune(spark: SparkSession) -> SparkSession:
    """Set the options above on a running session."""
    for name, value in ADAPTIVE_OPTIONS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "12g", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tierflow")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
    )
    for name, value in ADAPTIVE_OPTIONS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    global _own_folder
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="tierflow-")
    return _own_folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for one intermediate table."""
    return f"{shared_folder(spark)}/tierflow/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once below the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
