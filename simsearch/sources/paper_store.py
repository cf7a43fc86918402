"""Papers stored by id, so that one or a few of them are fetched without a scan.

The table is cut into disjoint id ranges, each sorted and written by one task as one file of small row groups with a bloom filter on the
id. A range table (one row a file) says which ids lie where. A lookup of few ids opens the folders and files whose range holds
one, and inside them only row groups whose statistics, page index and bloom filter admit one; ids that fall between
ranges open nothing. The place of a row in id order is found the same way, by counting the ranges before it. Many ids are
one semi-join over the stored table.

A paper without an id is not stored. Rows that share an id are all returned. Builds go to folders of their own; the manifest names
the newest whole one.
"""

from __future__ import annotations

import functools
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsearch.sources.store import read_manifest, write_manifest
from simsearch.sources.tables import read_table

ROWS_PER_FILE = 100_000
ROW_GROUP_BYTES = 8 << 20
FOLDERS = 1024
FEW_IDS = 10_000
FOLDER, FILE = "id_folder", "id_file"


@dataclass(frozen=True)
class PaperStore:
    """``papers`` with the columns that say where a row lies, and ``ranges(id_folder, id_file, first_id, last_id, n)``."""

    papers: DataFrame
    ranges: DataFrame

    @property
    def columns(self) -> list[str]:
        return [c for c in self.papers.columns if c not in (FOLDER, FILE)]

    @functools.cached_property
    def _bounds(self) -> dict[str, np.ndarray]:
        """The range table in id order: a few numbers a file."""
        table = self.ranges.orderBy("first_id", "last_id", FILE).toArrow()
        return {c: table.column(c).to_numpy() for c in table.column_names}

    def _inside(self, files: np.ndarray) -> DataFrame:
        """The rows of some files, numbered as in the range table, by literals that prune folders."""
        folders = np.unique(self._bounds[FOLDER][files]).tolist()
        names = self._bounds[FILE][files].tolist()
        return self.papers.where(F.col(FOLDER).isin(folders) & F.col(FILE).isin(names))

    def fetch(self, ids: list[int]) -> DataFrame:
        """The papers of at most ``FEW_IDS`` ids; an unknown id has no row."""
        wanted = np.unique(np.array(ids, dtype=np.int64))
        if len(wanted) > FEW_IDS:
            raise ValueError(f"at most {FEW_IDS} ids at once, got {len(wanted)}; use lookup")
        first, last = self._bounds["first_id"], self._bounds["last_id"]
        # files whose range holds an id: equal ids never cross a range border, so ranges do not overlap
        at = np.searchsorted(first, wanted, side="right") - 1
        held = (at >= 0) & (wanted <= last[np.maximum(at, 0)]) if len(first) else np.zeros(len(wanted), dtype=bool)
        if not held.any():
            return self.papers.select(*self.columns).limit(0)
        found = self._inside(np.unique(at[held])).where(F.col("paper_id").isin(wanted[held].tolist()))
        return found.select(*self.columns)

    def lookup(self, ids: DataFrame) -> DataFrame:
        """The papers of ``ids(paper_id)``; each is returned once however often it is asked for."""
        distinct = ids.select("paper_id").where("paper_id IS NOT NULL").distinct()
        few = distinct.limit(FEW_IDS + 1).collect()
        if len(few) <= FEW_IDS:
            return self.fetch([r["paper_id"] for r in few])
        return self.papers.select(*self.columns).join(distinct, "paper_id", "left_semi")

    def __len__(self) -> int:
        return int(self._bounds["n"].sum())

    def rows_at(self, places: list[int]) -> DataFrame:
        """``place`` and the paper there, counting from 0 in id order (rows of one id in no fixed order); a place outside is an error."""
        size = len(self)
        bad = [p for p in places if not 0 <= p < size]
        if bad:
            raise IndexError(f"places {bad[:5]} are outside 0 .. {size - 1}")
        if not places:
            return self.papers.select(F.lit(0).cast("bigint").alias("place"), *self.columns).limit(0)
        ends = np.cumsum(self._bounds["n"])
        files = np.unique(np.searchsorted(ends, np.array(places), side="right"))
        skipped = self.papers.sparkSession.createDataFrame(
            [(int(self._bounds[FILE][f]), int(ends[f] - self._bounds["n"][f])) for f in files], f"{FILE} int, _before bigint"
        )
        in_file = W.partitionBy(FILE).orderBy("paper_id")  # one file's rows
        ranked = self._inside(files).withColumn("_n", F.row_number().over(in_file)).join(F.broadcast(skipped), FILE)
        return ranked.select((F.col("_before") + F.col("_n") - 1).alias("place"), *self.columns).where(F.col("place").isin(list(places)))


def save_papers(papers: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write the papers by id range, then the range table, and last the manifest that makes them readable."""
    spark = papers.sparkSession
    build = f"{path}/build-{uuid.uuid4().hex[:12]}"
    known = papers.where("paper_id IS NOT NULL").withColumn("paper_id", F.col("paper_id").cast("bigint"))
    files = max(1, -(-known.count() // rows_per_file))
    width = -(-files // FOLDERS)
    # equal ids go to one range; a range is one task's, so it is one file
    ordered = known.repartitionByRange(files, "paper_id").sortWithinPartitions("paper_id")
    placed = ordered.withColumn(FILE, F.spark_partition_id()).withColumn(FOLDER, (F.col(FILE) / width).cast("int"))
    writer = placed.write.partitionBy(FOLDER).option("parquet.block.size", ROW_GROUP_BYTES)
    writer = writer.option("parquet.bloom.filter.enabled#paper_id", "true").option("parquet.bloom.filter.expected.ndv#paper_id", rows_per_file)
    writer.parquet(f"{build}/papers")
    stored = read_table(spark, f"{build}/papers", placed.schema)
    bounds = (F.min("paper_id").alias("first_id"), F.max("paper_id").alias("last_id"), F.count("*").alias("n"))
    stored.groupBy(FOLDER, FILE).agg(*bounds).write.parquet(f"{build}/ranges")
    write_manifest(spark, f"{path}/meta", {"build": build, "schema": placed.schema.jsonValue()})


def load_papers(spark: SparkSession, path: str) -> PaperStore:
    meta = read_manifest(spark, f"{path}/meta")
    if meta is None:
        raise FileNotFoundError(f"no papers at {path}")
    ranges = read_table(spark, f"{meta['build']}/ranges")
    # the schema is stored, as a table without rows leaves no file that has it
    return PaperStore(read_table(spark, f"{meta['build']}/papers", T.StructType.fromJson(meta["schema"])), ranges)
