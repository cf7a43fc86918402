"""Stored splits -> embeddings -> inverted-file index on disk."""

from __future__ import annotations

from pyspark.sql import SparkSession

from simsearch.operators.encode import DEFAULT_BATCH, Encoder, encode_papers
from simsearch.operators.ivf import DEFAULT_NLIST, DEFAULT_NPROBE, IvfIndex, build_index
from simsearch.sources import store
from simsearch.sources.tables import usable


def index_splits(
    spark: SparkSession,
    splits_path: str,
    output: str,
    encoder: Encoder,
    splits: tuple[str, ...] = store.SPLITS,
    nlist: int = DEFAULT_NLIST,
    nprobe: int = DEFAULT_NPROBE,
    batch_size: int = DEFAULT_BATCH,
    seed: int = 42,
) -> IvfIndex:
    """Encode every usable paper once, train, assign, and store. Each written table is a point a
    failed run can go on from."""
    papers = usable(store.read_splits(spark, splits_path, splits))
    vectors = store.write_embeddings(
        encode_papers(papers, encoder, batch_size).where("embedding is not null"), f"{output}/embeddings"
    )
    index = build_index(vectors, nlist, nprobe, seed)
    store.save_index(index, output)
    return store.load_index(spark, output)
