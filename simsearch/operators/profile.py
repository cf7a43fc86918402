"""Corpus profile: how subjects are distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(papers: DataFrame, column: str = "primary_subject") -> DataFrame:
    return papers.groupBy(column).agg(F.count("*").alias("n"))


def label_rows(papers: DataFrame) -> DataFrame:
    """One row per paper and subject label."""
    return papers.select("paper_id", F.explode("subjects").alias("label"))


def label_counts(papers: DataFrame) -> DataFrame:
    return label_rows(papers).groupBy("label").agg(F.count("*").alias("n"))


def cardinality(papers: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: how many subjects and how many labels there are."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    subjects = papers.agg(distinct(F.col("primary_subject")).alias("n_subjects"))
    labels = label_rows(papers).agg(distinct(F.col("label")).alias("n_labels"))
    return subjects.select("n_subjects", labels.scalar().alias("n_labels"))


def most_common(counts: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent values, ties by name."""
    return counts.orderBy(F.col("n").desc(), column).limit(n)


def least_common(counts: DataFrame, column: str, n: int) -> DataFrame:
    return counts.orderBy("n", F.col(column).desc()).limit(n)


def never_primary(papers: DataFrame) -> DataFrame:
    """Labels that are no paper's primary subject."""
    primary = papers.select(F.col("primary_subject").alias("label"))
    return label_rows(papers).select("label").distinct().join(primary.distinct(), "label", "left_anti")
