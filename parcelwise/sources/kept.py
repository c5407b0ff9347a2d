"""Results kept by dataset and run: a job that is run again replaces what it left, and nothing else."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = "run_id"


def keep(rows: DataFrame, path: str, run_id: str, by: Sequence[str] = ()) -> None:
    """Write rows under ``by`` and the run; the folders of the same run that the rows fall into are replaced.

    Other runs and datasets stay, and a job that dies leaves the earlier rows: folders are exchanged when all
    tasks have ended.
    """
    named = rows.withColumn(RUN, F.lit(run_id))
    writer = named.write.partitionBy(*by, RUN).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def kept(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows kept under a path. ``schema`` declares the columns, so that a run named ``001`` stays a text."""
    return spark.read.schema(f"{schema}, {RUN} STRING").parquet(path)
