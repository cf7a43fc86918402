"""An endless stream of training pairs: one epoch of fresh draws after the other.

The source's offsets are epochs, so the stream's own checkpoint says which epochs are done: a restarted stream goes on with
the next, and a batch that failed is drawn again, with the same pairs, into the same folder. The draws of an epoch are keyed by (seed,
epoch, pair), so epochs differ and each of them is the batch builder's. What all epochs share, the positions of the papers, is
prepared once a run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

from simsearch.operators.pairs import PairBuilder, PairConfig, index_papers, pair_parts, positive_pairs
from simsearch.session import exchanges_removed


class EpochReader(SimpleDataSourceStreamReader):
    """One epoch number a read, up to ``last`` if it is given."""

    def __init__(self, first: int, last: int | None):
        self.first, self.last = first, last

    def initialOffset(self) -> dict:
        return {"epoch": self.first}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        epoch = int(start["epoch"])
        if self.last is not None and epoch > self.last:
            return iter([]), start
        return iter([(epoch,)]), {"epoch": epoch + 1}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(e,) for e in range(int(start["epoch"]), int(end["epoch"]))])


class EpochSource(DataSource):
    """``spark.readStream.format("pair_epochs")``; options ``first`` and ``last``."""

    @classmethod
    def name(cls) -> str:
        return "pair_epochs"

    def schema(self) -> str:
        return "epoch bigint"

    def simpleStreamReader(self, schema) -> EpochReader:
        last = self.options.get("last")
        return EpochReader(int(self.options.get("first", 0)), None if last is None else int(last))


def epochs(spark: SparkSession, first: int = 0, last: int | None = None) -> DataFrame:
    """A stream of epoch numbers, endless without ``last``."""
    spark.dataSource.register(EpochSource)
    reader = spark.readStream.format("pair_epochs").option("first", first)
    return (reader if last is None else reader.option("last", last)).load()


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """The folder ``source`` takes the place of ``target``, if there is one."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(path(target), True)
    if not files.rename(path(source), path(target)):
        raise OSError(f"{source} could not be renamed to {target}")


def start_pairs(
    papers: DataFrame,
    config: PairConfig,
    output: str,
    checkpoint: str,
    builder: PairBuilder = positive_pairs,
    last: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write each epoch's pairs to ``output/epoch=<number>``. ``config.epoch`` is the first epoch; without ``last`` it never ends.

    An epoch owns its folder and overwrites it, so drawing it again leaves one copy. Every epoch holds about twice the papers' texts, so they
    are stored in the smaller codec. They are drawn in parts, and what a part has shuffled is removed before the next, so that beside the stored
    epochs only a part's texts are on disk; the folder gets its name when the epoch is whole.
    """
    spark = papers.sparkSession
    index = index_papers(papers, config)

    def draw(batch: DataFrame, batch_id: int) -> None:
        for row in batch.select("epoch").distinct().orderBy("epoch").collect():  # one number a batch
            with exchanges_removed(spark):
                drawing = f"{output}/_epoch-{row['epoch']}"  # readers pass over it
                for number, made in enumerate(pair_parts(builder, papers, replace(config, epoch=row["epoch"]), index)):
                    made.write.mode("append" if number else "overwrite").option("compression", "zstd").parquet(drawing)
                _replace(spark, drawing, f"{output}/epoch={row['epoch']}")

    writer = epochs(spark, config.epoch, last).writeStream.foreachBatch(draw).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "0 seconds"})).start()
