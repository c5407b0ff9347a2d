"""The record of a training run: parameters, rows per split, the table's fingerprint and the errors, tied by the run.

All of it is one table in long form and is kept in one write, so a reader sees a whole run or none; the same run again
takes the place of its record.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.operators import evaluate, explore
from parcelwise.sources import kept

RECORD = "kind STRING, model STRING, split STRING, name STRING, number DOUBLE, text STRING"


def parameters(models: dict[str, PipelineModel]) -> list[tuple]:
    """The set parameters of each pipeline's last stage as rows of the record."""
    out = []
    for name, model in models.items():
        stage = model.stages[-1]
        for param, value in sorted(stage.extractParamMap().items(), key=lambda x: x[0].name):
            number = float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None
            out.append(("param", name, None, param.name, number, str(value)))
    return out


def record(models: dict[str, PipelineModel], split: DataFrame, predictions: DataFrame) -> DataFrame:
    """What a run leaves. ``split``: the rows with their split; ``predictions``: (model, split, target, prediction)."""
    cell = lambda kind, model, part, name, number, text: F.struct(
        F.lit(kind).alias("kind"), model.cast("string").alias("model"), part.cast("string").alias("split"),
        F.lit(name).alias("name"), number.cast("double").alias("number"), text.cast("string").alias("text"),
    )
    none = F.lit(None)
    rows = split.groupBy("split").agg(F.count("*").alias("n")).select(
        F.inline(F.array(cell("rows", none, F.col("split"), "n", F.col("n"), none)))
    )
    # The checksum is a whole number of up to 20 digits, so it stands as text.
    whole = explore.fingerprint(split, "split").select(
        F.inline(F.array(cell("table", none, none, "n", F.col("n_rows"), none), cell("table", none, none, "checksum", none, F.col("checksum"))))
    )
    errors = evaluate.model_errors(predictions)
    metrics = [cell("metric", F.col("model"), F.col("split"), m, F.col(m), none) for m in ("n", "mae", "rmse")]
    given = split.sparkSession.createDataFrame(parameters(models), RECORD)
    return given.unionByName(rows).unionByName(whole).unionByName(errors.select(F.inline(F.array(*metrics))))


def keep_record(rows: DataFrame, path: str, run_id: str) -> None:
    kept.keep(rows, path, run_id)


def records(spark: SparkSession, path: str) -> DataFrame:
    return kept.kept(spark, path, RECORD)


def best_run(records: DataFrame, model: str, split: str = evaluate.VAL, metric: str = "mae") -> DataFrame:
    """The run with the least error of a model; of equals the least name."""
    errors = records.where((F.col("kind") == "metric") & (F.col("name") == metric) & (F.col("split") == split) & (F.col("model") == model))
    return errors.agg(F.min_by("run_id", F.struct("number", "run_id")).alias("run_id"), F.min("number").alias(metric))
