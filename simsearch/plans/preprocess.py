"""Raw corpus -> splits -> pair tables, built once per configuration."""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simsearch.operators.pairs import PairConfig, pair_builder
from simsearch.operators.sampling import nested_split
from simsearch.sources import store
from simsearch.sources.tables import read_papers, select_papers, usable


@dataclass(frozen=True)
class PreprocessConfig:
    source: str
    columns: tuple[str, ...] = ("primary_subject", "subjects", "abstract", "title")
    loss: str = "MultipleNegativesRankingLoss"
    test_size: float = 0.2
    number_of_pairs: int = 1_000_000
    number_of_eval_pairs: int = 10_000
    seed: int = 42
    text_field: str = "abstract"
    balanced: bool = True

    def as_dict(self) -> dict:
        return asdict(self) | {"columns": list(self.columns)}

    def pairs(self, count: int) -> PairConfig:
        return PairConfig(count, self.text_field, self.seed, self.balanced)


@dataclass(frozen=True)
class Prepared:
    """Where a build lies. ``rebuilt`` says whether this call made it."""

    root: str
    rebuilt: bool
    config: dict = field(default_factory=dict)

    @property
    def splits(self) -> str:
        return f"{self.root}/splits"

    @property
    def train_pairs(self) -> str:
        return f"{self.root}/train_pairs"

    @property
    def eval_pairs(self) -> str:
        return f"{self.root}/eval_pairs"


def preprocess(spark: SparkSession, root: str, config: PreprocessConfig, papers: DataFrame | None = None) -> None:
    """Write the splits and both pair tables under ``root``."""
    builder = pair_builder(config.loss)
    if papers is None:
        papers = read_papers(spark, config.source, config.columns)
    else:
        papers = select_papers(papers, config.columns)
    target = Prepared(root, True)
    # rows that cannot be used go first, so that the shares hold for what is stored
    split = nested_split(usable(papers, config.text_field), config.test_size, config.seed)
    store.write_splits(split, target.splits)
    for name, path, count in (
        ("train", target.train_pairs, config.number_of_pairs),
        ("eval", target.eval_pairs, config.number_of_eval_pairs),
    ):
        rows = store.read_split(spark, target.splits, name)
        store.create_pairs(rows, builder, path, config.pairs(count))


def ensure_data(
    spark: SparkSession, base: str, config: PreprocessConfig, papers: DataFrame | None = None
) -> Prepared:
    """Build unless a complete build of the same configuration exists.

    Every build gets a new folder and the manifest naming it is written last, so a failed or
    half-written build is never taken for a finished one and a running reader keeps its files.
    """
    wanted = config.as_dict()
    manifest_path = f"{base}/_manifest"
    saved = store.read_manifest(spark, manifest_path)
    if saved is not None and saved.get("config") == wanted:
        found = Prepared(f"{base}/{saved['build']}", False, wanted)
        if all(store.exists(spark, p) for p in (found.splits, found.train_pairs, found.eval_pairs)):
            return found
    build = f"build-{uuid.uuid4().hex[:12]}"
    made = Prepared(f"{base}/{build}", True, wanted)
    preprocess(spark, made.root, config, papers)
    store.write_manifest(spark, manifest_path, {"config": wanted, "build": build})
    return made


def split_sizes(splits: DataFrame) -> DataFrame:
    return splits.groupBy("split").agg(F.count("*").alias("n"))
