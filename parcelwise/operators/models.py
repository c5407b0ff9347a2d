"""Candidate models as MLlib pipelines: fit, score, save and load."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.order_stats import percentiles
from parcelwise.functions.scalar import floor_at_zero
from parcelwise.operators.features import CATEGORIES, NUMBERS, TARGET, add_features
from parcelwise.session import shared_dir

SEED = 42


def encoder_stages() -> list:
    """One-hot states (an unknown state is all zeros) next to the numbers, as one vector."""
    indexes, hot = [f"{c}_index" for c in CATEGORIES], [f"{c}_hot" for c in CATEGORIES]
    return [
        # The extra index of unknown values is the last one, and dropLast removes exactly that column.
        StringIndexer(
            inputCols=CATEGORIES, outputCols=indexes, handleInvalid="keep", stringOrderType="alphabetAsc"
        ),
        OneHotEncoder(inputCols=indexes, outputCols=hot, dropLast=True),
        VectorAssembler(inputCols=[*hot, *NUMBERS], outputCol="features"),
    ]


def median_stage(train: DataFrame) -> SQLTransformer:
    """Always predicts the exact median of the training target."""
    found = percentiles(train, TARGET, {"median": 0.5}).first()
    if found is None or found["median"] is None:
        raise ValueError("the training table has no row with a target")
    return SQLTransformer(statement=f"SELECT *, {found['median']!r}D AS prediction FROM __THIS__")


def linear_stage(train: DataFrame) -> LinearRegression:
    return LinearRegression(featuresCol="features", labelCol=TARGET, solver="normal")


def boosted_stage(rounds: int, step: float, depth: int) -> Callable[[DataFrame], GBTRegressor]:
    """Boosted trees on the absolute error."""

    def build(train: DataFrame) -> GBTRegressor:
        return GBTRegressor(
            featuresCol="features",
            labelCol=TARGET,
            lossType="absolute",
            maxIter=rounds,
            stepSize=step,
            maxDepth=depth,
            seed=SEED,
            # Lineage of the residuals is cut in the shared folder, so long boosting survives lost executors.
            checkpointInterval=10,
            maxMemoryInMB=512,
        )

    return build


# 2**5 and 2**6 leaves stand for the 31 and 63 of the leaf-wise trees.
CANDIDATES: dict[str, Callable[[DataFrame], object]] = {
    "median": median_stage,
    "linear_regression": linear_stage,
    "boosted_default": boosted_stage(rounds=100, step=0.1, depth=5),
    "boosted_bigger": boosted_stage(rounds=300, step=0.05, depth=6),
}


def encode(train: DataFrame) -> PipelineModel:
    return Pipeline(stages=encoder_stages()).fit(train)


def fit_candidates(train: DataFrame, names: Sequence[str] | None = None) -> dict[str, PipelineModel]:
    """Fit the chosen candidates on contract rows with the target.

    The encoded rows are kept across the iterative fits. Every result is one pipeline that starts after
    :func:`add_features`, so one load gives exactly the transforms used in training.
    """
    spark = train.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    featured = add_features(train)
    encoder = encode(featured)
    encoded = encoder.transform(featured).select("features", F.col(TARGET).cast("double").alias(TARGET)).persist()
    try:
        models = {}
        for name in names or CANDIDATES:
            stage = CANDIDATES[name](encoded)
            fitted = stage.fit(encoded) if hasattr(stage, "fit") else stage
            models[name] = PipelineModel([*encoder.stages, fitted])
        return models
    finally:
        encoded.unpersist()


def score(model: PipelineModel, rows: DataFrame, version: str, keep: Sequence[str] = ("order_id",)) -> DataFrame:
    """Contract rows, batch or stream, to predictions that are never negative."""
    # The features drop the purchase time; a copy lets callers keep it.
    kept = rows.withColumns({f"_keep_{c}": F.col(c) for c in keep})
    predicted = model.transform(add_features(kept))
    return predicted.select(
        *[F.col(f"_keep_{c}").alias(c) for c in keep],
        floor_at_zero("prediction").alias("prediction"),
        F.lit(version).alias("model_version"),
    )


def predicted(models: dict[str, PipelineModel], rows: DataFrame) -> DataFrame:
    """The rows with one column of predictions per model, named like it, from one scan.

    What a pipeline makes on its way is dropped before the next one.
    """
    out = add_features(rows.withColumns({f"_keep_{c}": F.col(f"`{c}`") for c in rows.columns}))
    for name, model in models.items():
        before = [F.col(f"`{c}`") for c in out.columns]
        out = model.transform(out).select(*before, F.col("prediction").alias(f"_of_{name}"))
    return out.select(*[F.col(f"_keep_{c}").alias(c) for c in rows.columns], *[F.col(f"`_of_{n}`").alias(n) for n in models])


def predict_all(models: dict[str, PipelineModel], split: DataFrame) -> DataFrame:
    """Validation and test predictions of every model as one long table, from one scan."""
    held_out = split.where(F.col("split").isin("val", "test"))
    cells = [F.struct(F.lit(n).alias("model"), F.col(f"`{n}`").alias("prediction")) for n in models]
    return predicted(models, held_out).select("split", TARGET, F.inline(F.array(*cells))).select("model", "split", TARGET, "prediction")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
