"""Splits and samples drawn by key, reproducible whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.functions.keyed import HASH_RANGE, h48
from simsearch.operators.cutoff import mark_smallest, mark_smallest_per_group
from simsearch.operators.skew import MAX_BROADCAST_GROUPS
from simsearch.session import checkpoint


def train_test_split(
    papers: DataFrame, test_size: float, seed: int, tag: str = "test", exact: bool = True
) -> DataFrame:
    """The table with ``split`` = ``test`` for ceil(test_size * n) rows, else ``train``.

    ``exact=False`` compares each draw with a fixed threshold instead: the share is then
    approximate, but needs no count and keeps every row's side when rows are added later.
    """
    if not 0 < test_size < 1:
        raise ValueError(f"test_size must lie between 0 and 1, got {test_size}")
    if exact:
        marked = mark_smallest(
            papers, "paper_id", (seed, tag), {"_in": lambda total: F.ceil(total * F.lit(test_size))}
        )
    else:
        marked = papers.withColumn("_in", h48(seed, tag, F.col("paper_id")) < int(test_size * HASH_RANGE))
    return marked.withColumn("split", F.when(F.col("_in"), "test").otherwise("train")).drop("_in")


def nested_split(papers: DataFrame, test_size: float, seed: int) -> DataFrame:
    """``split`` in train / eval / test: the test share first, then eval from what is left."""
    share = F.lit(test_size)
    marked = mark_smallest(papers, "paper_id", (seed, "test"), {"_test": lambda n: F.ceil(n * share)})
    marked = mark_smallest(
        marked, "paper_id", (seed, "eval"), {"_eval": lambda n: F.ceil(n * share)}, among=marked.where(~F.col("_test"))
    )
    split = F.when(F.col("_test"), "test").when(F.col("_eval"), "eval").otherwise("train")
    return marked.withColumn("split", split).drop("_test", "_eval")


def ir_sample(papers: DataFrame, sample_size: int, seed: int, query_count: str = "requested") -> DataFrame:
    """A random sample with ``role``: the first fifth are queries, the rest are the corpus.

    The published evaluation takes a fifth of the *requested* size even when the table is smaller
    (``query_count="requested"``); ``"actual"`` takes a fifth of what was really sampled.
    """
    if query_count not in ("requested", "actual"):
        raise ValueError(f"query_count must be 'requested' or 'actual', got {query_count!r}")

    def queries(total):
        base = F.lit(sample_size) if query_count == "requested" else F.least(F.lit(sample_size), total)
        return F.floor(base / 5)

    wanted = {"_query": queries, "_sampled": lambda total: F.lit(sample_size)}
    marked = mark_smallest(papers, "paper_id", (seed, "ir"), wanted)
    return (
        marked.where("_sampled")
        .withColumn("role", F.when(F.col("_query"), "query").otherwise("corpus"))
        .drop("_query", "_sampled")
    )


def stratified_sample(papers: DataFrame, sample_size: int, seed: int) -> DataFrame:
    """Proportional sample: every subject gets its share, at least one row, trimmed to the size."""
    sizes = papers.groupBy("primary_subject").agg(F.count("*").alias("n"))
    total, groups = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()

    def quota(count):
        share = F.floor(F.lit(sample_size) * (count / F.lit(total)))
        return F.least(count, F.greatest(F.lit(1), share))

    drawn = mark_smallest_per_group(papers, "paper_id", (seed, "strata"), {"_in": quota}, "primary_subject", groups <= MAX_BROADCAST_GROUPS)
    # about the sample's size: stored, because the trim reads it more than once
    drawn = checkpoint(drawn.where("_in").drop("_in"))
    trimmed = mark_smallest(drawn, "paper_id", (seed, "trim"), {"_in": lambda count: F.lit(sample_size)})
    return trimmed.where("_in").drop("_in")


def stratified_ir_split(papers: DataFrame, per_subject: int, seed: int) -> DataFrame:
    """Query / corpus split with at most ``per_subject`` rows of each subject.

    A fifth of a subject's rows (at least one) are queries; subjects with one row are left out.
    """

    def taken(count):
        return F.when(count >= 2, F.least(count, F.lit(per_subject))).otherwise(F.lit(0))

    def queries(count):
        share = F.floor(F.least(count, F.lit(per_subject)) * F.lit(0.2))
        return F.when(count >= 2, F.greatest(F.lit(1), share)).otherwise(F.lit(0))

    marked = mark_smallest_per_group(
        papers, "paper_id", (seed, "cap"), {"_query": queries, "_taken": taken}, "primary_subject"
    )
    return (
        marked.where("_taken")
        .withColumn("role", F.when(F.col("_query"), "query").otherwise("corpus"))
        .drop("_query", "_taken")
    )
