"""What the corpus jobs share: reading, lower-casing and words as their contracts define them, Arrow passes."""

from __future__ import annotations

import gc
import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelwise.session import configure

# Separators of words, as a character class: space, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
TO_LOWER = bytes.maketrans(UPPER, LOWER)

# Texts handed to one step inside a task: bounds what numpy and Python hold beside the Arrow batch.
STEP_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One table, only the named columns."""
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def read_all(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table with all its columns."""
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """The table without columns whose names an operator is about to add: its results win."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def text_key(text: str | Column) -> Column:
    """A fixed-size stand-in for a text; together with doc_id it names a document."""
    return F.xxhash64(text)


def pieces(batch: pa.RecordBatch, column: str, step: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose texts hold about ``step`` bytes; one very long text is a range of its own."""
    start = size = 0
    for row, text in enumerate(batch.column(column)):
        size += 0 if not text.is_valid else text.as_buffer().size if hasattr(text, "as_buffer") else len(text.as_py())
        if size >= step:
            yield start, row + 1
            start, size = row + 1, 0
    if start < batch.num_rows:
        yield start, batch.num_rows


def texts(batch: pa.RecordBatch, column: str, start: int = 0, stop: int | None = None) -> list[bytes]:
    """The UTF-8 bytes of a text column; a null is an empty text."""
    part = batch.column(column).slice(start, None if stop is None else stop - start)
    return [t or b"" for t in part.cast(pa.binary()).to_pylist()]


def share(df: DataFrame, value):
    """Send an object of bounded size to the executors, with the code of its class."""
    return df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(sent):
    """The object of :func:`share`, in a task."""
    return pickle.loads(sent.value)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are over.

    It does so when the driver's collector has found that nobody refers to them, which may be long after; a job of
    several passes would hold the files of all of them until then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def with_fields(df: DataFrame, ddl: str) -> StructType:
    """The schema of a table followed by more fields."""
    return StructType(df.schema.fields + StructType.fromDDL(ddl).fields)
