"""What the text operators share: tables, Arrow batches and word boundaries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from riskloom.session import discard, ensure_checkpoint_dir, ship_package, work_dir  # noqa: F401 (discard is used through here)

#: Rows of an Arrow batch; texts are worked through in blocks of BLOCK_BYTES whatever a batch holds.
BATCH_ROWS = 1000
BLOCK_BYTES = 2_000_000

#: White space that ends a word: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with the package on every worker and batches of bounded size."""
    spark = df.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(task, schema)


def settled(df: DataFrame) -> DataFrame:
    """Work out ``df`` once into the shared checkpoint folder, so that lost executors cost little."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there, its size then being known to the planner."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blanks_to_spaces(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS))


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, 0 for null."""
    return F.size(F.filter(F.split(blanks_to_spaces(text), " "), lambda w: w != "")).cast("long")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and where each begins and the last ends; null is empty."""
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def blocks(lengths: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive rows that hold about ``most`` bytes together; a longer row is a block of its own."""
    start, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield start, len(lengths)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column of ``taken`` has it."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def with_field(df: DataFrame, name: str, kind: DataType) -> StructType:
    """The schema of ``df`` and one more column."""
    return StructType([*df.schema.fields, StructField(name, kind)])
