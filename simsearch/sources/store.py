"""Stored splits, pair tables, the index, and the manifest that says what was built."""

from __future__ import annotations

import json
import logging
import time
import uuid
from dataclasses import asdict, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simsearch.operators.ivf import DEFAULT_NPROBE, IvfIndex, list_sizes
from simsearch.operators.pairs import PairBuilder, PairConfig
from simsearch.operators.topk import LIST_GROUP, LIST_GROUPS, SearchLimits
from simsearch.sources.tables import read_table

log = logging.getLogger(__name__)

SPLITS = ("train", "eval", "test")
VECTORS_PER_FILE = 200_000


def write_splits(split_papers: DataFrame, path: str) -> None:
    """One folder per split under ``path``, so that reading a split opens only its files."""
    split_papers.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split; a split that was never written is a ``FileNotFoundError``."""
    return read_table(spark, f"{path}/split={split}")


def read_splits(spark: SparkSession, path: str, splits: tuple[str, ...] = SPLITS) -> DataFrame:
    """The asked splits as one table; a missing one is skipped with a warning, all missing fails."""
    table = read_table(spark, path)
    present = {r["split"] for r in table.where(F.col("split").isin(list(splits))).select("split").distinct().collect()}
    for split in splits:
        if split not in present:
            log.warning("split not found, skipping: %s", split)
    wanted = [s for s in splits if s in present]
    if not wanted:
        raise ValueError(f"none of the splits {list(splits)} exists under {path}")
    return table.where(F.col("split").isin(wanted))


def create_pairs(papers: DataFrame, builder: PairBuilder, path: str, config: PairConfig) -> DataFrame:
    """Build, store, and return the stored pairs (not the plan that made them)."""
    builder(papers, config).write.mode("overwrite").parquet(path)
    return load_pairs(papers.sparkSession, path)


def load_pairs(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path)


def load_or_create_pairs(papers: DataFrame, builder: PairBuilder, path: str, config: PairConfig) -> DataFrame:
    """The stored pairs of the same builder and configuration, else new ones.

    Every build has its own folder and is named in the manifest when it is whole, so neither another
    configuration's pairs nor a broken build are ever returned.
    """
    spark = papers.sparkSession
    wanted = {"builder": getattr(builder, "__name__", str(builder)), **asdict(config)}
    saved = read_manifest(spark, f"{path}/_manifest")
    if saved is not None and saved["config"] == wanted and exists(spark, f"{path}/{saved['build']}"):
        return load_pairs(spark, f"{path}/{saved['build']}")
    build = f"build-{uuid.uuid4().hex[:12]}"
    made = create_pairs(papers, builder, f"{path}/{build}", config)
    write_manifest(spark, f"{path}/_manifest", {"config": wanted, "build": build})
    return made


def write_manifest(spark: SparkSession, path: str, config: dict) -> None:
    """Add a description; the newest counts, and those before it are never touched, so a reader always finds one."""
    row = spark.createDataFrame([(json.dumps({"at": time.time_ns(), "config": config}, sort_keys=True),)], "value string")
    row.coalesce(1).write.mode("append").text(path)


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest stored configuration, or None when there is none."""
    at, config = F.get_json_object("value", "$.at").cast("bigint"), F.get_json_object("value", "$.config")
    try:
        newest = spark.read.text(path).agg(F.max_by(config, at)).first()[0]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            return None
        raise
    return json.loads(newest) if newest else None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a whole table lies there; a folder that a failed write left behind holds none."""
    try:
        read_table(spark, path)
    except FileNotFoundError:
        return False
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in (e.getCondition() or ""):
            return False
        raise
    return True


def save_index(index: IvfIndex, path: str) -> None:
    """Postings, centroids, and last the description that makes them loadable.

    Every save gets its own folder under ``path``; a failed save leaves the former index in use. Lists share at most
    1,024 folders and are sorted inside their files, so a search opens few folders and few row groups. The
    assignment is computed once; a large list is written by several tasks.
    """
    build = f"build-{uuid.uuid4().hex[:12]}"
    spark = index.postings.sparkSession
    index.postings.write.parquet(f"{path}/{build}/assigned")
    assigned = read_table(spark, f"{path}/{build}/assigned")
    files = F.ceil(F.greatest(F.col("n_vectors"), F.lit(1)) / VECTORS_PER_FILE)
    sizes = list_sizes(replace(index, postings=assigned)).select("list_id", files.cast("int").alias("files"))
    postings = assigned.join(F.broadcast(sizes), "list_id")  # one row a list, whose centroids are of a checked size
    group = F.pmod("list_id", F.lit(LIST_GROUPS)).alias(LIST_GROUP)
    part = F.pmod(F.xxhash64("paper_id"), F.col("files"))
    spread = postings.select("paper_id", "embedding", "list_id", group, part.alias("part")).repartition(LIST_GROUP, "list_id", "part")
    spread = spread.sortWithinPartitions(LIST_GROUP, "list_id").drop("part")
    spread.write.partitionBy(LIST_GROUP).parquet(f"{path}/{build}/postings")
    index.centroids.write.parquet(f"{path}/{build}/centroids")
    meta = {"dim": index.dim, "nlist": index.nlist, "nprobe": index.nprobe, "build": build}
    write_manifest(spark, f"{path}/meta", meta)


def load_index(
    spark: SparkSession, path: str, nprobe: int | None = None, limits: SearchLimits | None = None
) -> IvfIndex:
    """The stored index. nprobe: the argument, else the stored value, else the default."""
    meta = read_manifest(spark, f"{path}/meta")
    if meta is None:
        raise FileNotFoundError(f"index not found: {path}/meta")
    chosen = nprobe if nprobe is not None else meta.get("nprobe", DEFAULT_NPROBE)
    centroids = read_table(spark, f"{path}/{meta['build']}/centroids")
    postings = read_table(spark, f"{path}/{meta['build']}/postings")
    return IvfIndex(centroids, postings, meta["dim"], meta["nlist"], chosen, limits or SearchLimits())


def write_embeddings(embeddings: DataFrame, path: str) -> DataFrame:
    """Store the encoded vectors so that training and assigning do not encode twice."""
    embeddings.write.mode("overwrite").parquet(path)
    return read_table(embeddings.sparkSession, path)
