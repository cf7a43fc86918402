"""What the corpus operators share: reading tables, bounded Arrow batches, ASCII rules."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from simsearch.session import shared_folder  # noqa: F401

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLICE_BYTES = 8 << 20
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z only; other scripts keep their case."""
    return F.translate(text, UPPER, LOWER)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts hold about ``limit`` bytes, so that a task's memory follows its longest row."""
    for batch in batches:
        values = batch.column(column)
        start, held = 0, 0
        for i in range(len(values)):
            size = len(values[i].as_buffer() or b"") if values[i].is_valid else 0
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(values):
            yield batch.slice(start)


def map_slices(df: DataFrame, column: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType, limit: int = SLICE_BYTES) -> DataFrame:
    """Apply ``work`` to bounded batches inside the tasks that hold them; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column, limit):
            done = work(part)
            if done is not None and done.num_rows:
                yield done

    return df.mapInArrow(run, schema)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: a lost executor cannot lose it, and later plans know its real size.

    A checkpoint keeps the planner's estimate of the plan before it, which for a join is a product; over many rounds of joins the product's
    digits grow until planning takes longer, and more of the driver's memory, than the work.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if its counted rows, of a few numbers and short keys each, are within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
