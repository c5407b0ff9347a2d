"""Tables written once and read back, as later jobs find them: the order table, its split, the reference profile."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.functions.order_stats import percentiles
from parcelwise.operators import contract, drift, splits
from parcelwise.operators.features import TARGET
from parcelwise.operators.order_table import prepare
from parcelwise.operators.profile import Profile, write_profile
from parcelwise.session import configure, cut_lineage, new_path
from parcelwise.sources.standins import raw_tables
from parcelwise.sources.tables import write_table

PROFILED = [*drift.DECIDING_COLUMNS, *drift.INFO_COLUMNS]
BY = ["order_purchase_timestamp", "order_id"]

_written: dict[tuple[str, str, str, int], str] = {}


def _once(spark: SparkSession, folder: str, name: str, write: Callable[[str], object]) -> str:
    """Where a table is; written first if this application has not yet."""
    configure(spark)
    # The files are part of the key: other files under the same name are another table.
    sources = ("orders", "lineitem", "customer", "supplier", "part")
    files = [f for name in sources for f in sorted(spark.read.parquet(f"{folder}/{name}.parquet").inputFiles())]
    key = (spark.sparkContext.applicationId, name, folder, hash(tuple(files)))
    if key not in _written:
        path = new_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def stored_order_table(spark: SparkSession, folder: str) -> DataFrame:
    """Splits, drift and models read the order table several times; it is prepared and written once per
    application, to the shared folder, and every later job scans that Parquet."""

    def write(path: str) -> None:
        # In order of time, so that splits, weeks and months skip the row groups outside of them; the id
        # keeps a moment with very many orders from filling one partition. The rows are written before: finding the
        # ranges reads them once more, and would run the joins again.
        rows = cut_lineage(prepare(raw_tables(spark, folder)), "order-rows")
        write_table(rows.repartitionByRange(*BY).sortWithinPartitions(*BY), path)

    return spark.read.parquet(_once(spark, folder, "order-table", write))


def stored_split(spark: SparkSession, folder: str) -> DataFrame:
    """The located orders with their split, a folder per part: drift checks and fits read only theirs."""

    def write(path: str) -> None:
        split = splits.time_split(contract.drop_unlocated(stored_order_table(spark, folder)))
        split.write.partitionBy("split").parquet(path)

    return spark.read.parquet(_once(spark, folder, "order-split", write))


def stored_reference(spark: SparkSession, folder: str) -> tuple[Profile, float]:
    """The profile of the training orders with the test error of the median, and that median."""

    def write(path: str) -> None:
        split = stored_split(spark, folder)
        train = split.where("split = 'train'")
        median = percentiles(train, TARGET, {"median": 0.5})
        median.write.parquet(f"{path}/model")
        (row,) = spark.read.parquet(f"{path}/model").collect()
        write_profile(train, PROFILED, path, split.where("split = 'test'").withColumn("prediction", F.lit(row["median"])))

    path = _once(spark, folder, "reference", write)
    return Profile(spark, path), spark.read.parquet(f"{path}/model").first()["median"]
