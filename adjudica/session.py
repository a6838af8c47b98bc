"""Session settings, the shared work folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Split a hot partition even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The table of hot keys is small, but the count it comes from takes its time on a large input.
    "spark.sql.broadcastTimeout": "7200",
    "spark.sql.parquet.compression.codec": "zstd",
}


def session(app: str = "adjudica", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="adjudica-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table below the shared folder."""
    return f"{shared_dir(spark)}/adjudica/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "table", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table to the shared folder and go on from the written copy.

    Cuts the plan where several jobs use one expensive result, and survives the loss of executors.
    """
    path = work_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
