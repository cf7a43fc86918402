"""Giving an input that lies in few files enough tasks for processor-heavy work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPLIT_BYTES = 128 << 20


def spread_small(df: DataFrame) -> DataFrame:
    """Repartition an input too small to give every core one read split.

    Encoding or tokenizing one small file would run in a single task. Anything at or above one
    split per core is left as it lies, so large inputs are never shuffled here.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:  # before any file is listed
        return df
    files = df.inputFiles()
    if not 0 < len(files) < cores:
        return df
    size = spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0]
    return df.repartition(cores) if size < cores * SPLIT_BYTES else df
