"""Versions of models, and which one is promoted.

A version is a saved pipeline and a card, written in this order, so that a card never names a model that is not there. The promoted
version is what the last entry of a log of promotions names. An entry is one small file, created only if no file of its
number is there: of two jobs that promote at the same time one fails, and readers see the old version or the new one. An entry whose
writer died in between is empty and counts as none.

Everything lies in one folder that all machines share; the file system's own interface is used through Spark, so the folder
may be in any store that Spark writes to and that creates a file only once.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.operators import evaluate
from parcelwise.operators.models import load_model, predicted, save_model


class PromotionConflict(RuntimeError):
    """Another job has promoted a version in the meantime."""


class Registry:
    """The versions and promotions in a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        if not self._files.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(path))

    def _create(self, name: str, content: dict) -> bool:
        """Write a small file unless it is there already."""
        path = self._path(f"{self.root}/{name}")
        self._files.mkdirs(path.getParent())
        try:
            out = self._files.create(path, False)
        except Exception as error:  # the gateway has one error for all of them
            if "FileAlreadyExists" in str(error):
                return False
            raise
        try:
            out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            out.close()
        return True

    def _content(self, folder: str, name: str) -> dict | None:
        (row,) = self.spark.read.text(f"{self.root}/{folder}/{name}", wholetext=True).collect() or [None]
        return json.loads(row["value"]) if row is not None and row["value"] else None

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names("cards")]

    def register(self, model: PipelineModel, card: dict) -> int:
        """Save a model under the next free number; the card says whatever is known of it."""
        version = max(self.versions(), default=0) + 1
        while not self._create(f"numbers/{version:08d}.json", {}):  # taken by a job that has not ended
            version += 1
        save_model(model, f"{self.root}/models/{version:08d}")
        self._create(f"cards/{version:08d}.json", {"version": version, **card})
        return version

    def card(self, version: int) -> dict:
        return self._content("cards", f"{version:08d}.json") or {}

    def _last(self) -> tuple[int, int | None]:
        """The highest number of a promotion, and the version the last whole one names."""
        names = [n for n in self._names("promotions") if n.endswith(".json")]
        for name in reversed(names):
            if entry := self._content("promotions", name):
                return int(names[-1].removesuffix(".json")), entry["version"]
        return int(names[-1].removesuffix(".json")) if names else 0, None

    def promoted(self) -> int | None:
        return self._last()[1]

    def promote(self, version: int, instead_of: int | None) -> None:
        """Make a version the promoted one, if that is still ``instead_of``."""
        if version not in self.versions():
            raise ValueError(f"there is no version {version}")
        number, now = self._last()
        if now != instead_of or not self._create(f"promotions/{number + 1:08d}.json", {"version": version, "instead_of": now}):
            raise PromotionConflict(f"version {instead_of} is not the promoted one any more")

    def load(self, version: int | None = None) -> PipelineModel:
        """A version, or the promoted one."""
        version = self.promoted() if version is None else version
        if version is None:
            raise ValueError("no version has been promoted")
        return load_model(f"{self.root}/models/{version:08d}")


def judge(registry: Registry, version: int, test: DataFrame, baseline: PipelineModel, p95_ms: float | None = None) -> DataFrame:
    """The gate's row for a version against the promoted one and a baseline, all scored on the same rows in one pass.

    The version is promoted if it passes, unless another job was faster.
    """
    champion = registry.promoted()
    models = {"new": registry.load(version), "baseline": baseline}
    if champion is not None:
        models["champion"] = registry.load(champion)
    errors = predicted(models, test).agg(
        F.count("*").alias("n"), *[evaluate.mae(prediction=m).alias(f"{m}_mae") for m in models]
    )
    if champion is None:
        errors = errors.withColumn("champion_mae", F.lit(None).cast("double"))
    if p95_ms is not None:
        errors = errors.withColumn("p95_ms", F.lit(float(p95_ms)))
    (row,) = evaluate.promotion_gate(errors).collect()
    if row["promoted"]:
        registry.promote(version, champion)
    kind = "version INT, champion INT, n LONG, new_mae DOUBLE, baseline_mae DOUBLE, champion_mae DOUBLE, promoted BOOLEAN, reasons STRING"
    values = (version, champion, *[row[c] for c in ("n", "new_mae", "baseline_mae", "champion_mae", "promoted", "reasons")])
    return registry.spark.createDataFrame([values], kind)
