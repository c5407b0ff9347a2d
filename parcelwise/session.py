"""Session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only: they can be applied to a session somebody else made.
RUNTIME_SETTINGS = {
    # Timestamps are naive in the data, so every day or hour boundary is a UTC one.
    "spark.sql.session.timeZone": "UTC",
    # Joins carry no broadcast hints: adaptive execution measures the small side at run time,
    # broadcasts it only below the threshold, and otherwise splits skewed partitions of the big side.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs the plan one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "parcelwise", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Call-site capture costs milliseconds per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", os.environ.get("PARCELWISE_WORK", "/tmp/parcelwise-work"))
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
    )
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines share, named in ``spark.checkpoint.dir`` when the session is built.

    Without that setting only a session on one machine goes on, in a folder beside its warehouse; on a
    cluster a folder of the driver would be lost to the executors, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for one job's output."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For small results that several later steps use: their plans stay short, nothing upstream is computed
    again when an executor is lost, and the planner knows the size of what it joins.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
