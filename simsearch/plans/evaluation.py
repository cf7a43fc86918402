"""Sample -> search -> judge -> metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.operators import relevance as rel
from simsearch.operators.encode import Encoder, encode_column
from simsearch.operators.ivf import IvfIndex, embedding_dim, search
from simsearch.operators.sampling import ir_sample, stratified_ir_split
from simsearch.operators.topk import SearchLimits, exact_topk
from simsearch.session import checkpoint

DEFAULT_SAMPLE = 5_000


def roles(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The query and the corpus side of a table with ``role``."""
    queries = split.where(F.col("role") == "query").withColumnRenamed("paper_id", "query_id").drop("role")
    return queries, split.where(F.col("role") == "corpus").drop("role")


def judged_search(queries: DataFrame, corpus: DataFrame, k: int, index: IvfIndex | None = None) -> DataFrame:
    """Search every query that has a relevant paper and judge its hits.

    Without an index the search is exact over ``corpus``; with one it looks into the index, which
    must hold the corpus.
    """
    judged = rel.qrels_counts(queries, corpus)
    asked = queries.select("query_id", "embedding")
    if index is None:
        hits = exact_topk(asked, corpus, embedding_dim(queries), k, SearchLimits())
    else:
        hits = search(asked, index, k)
    return rel.judge(hits, judged, corpus)


def evaluate(
    papers: DataFrame, sample_size: int = DEFAULT_SAMPLE, seed: int = 42, query_count: str = "requested"
) -> DataFrame:
    """``metrics(metric, value)`` of exact search over a random sample.

    ``papers(paper_id, embedding, primary_subject)``.
    """
    # the sample is small and read by every later step: store it instead of drawing it again
    queries, corpus = roles(checkpoint(ir_sample(papers, sample_size, seed, query_count)))
    return rel.mean_metrics(rel.query_metrics(judged_search(queries, corpus, rel.MAP_AT)))


def evaluate_per_subject(papers: DataFrame, per_subject: int = 10, seed: int = 42) -> DataFrame:
    """P@10, R@10, MRR and NDCG@10 per subject, with an equal share of queries from each."""
    queries, corpus = roles(checkpoint(stratified_ir_split(papers, per_subject, seed)))
    judged = judged_search(queries, corpus, 10)
    report = rel.subject_report(rel.query_metrics(judged))
    return report.orderBy(F.col("ndcg_at_10").desc(), "subject")


def encoded_corpus(papers: DataFrame, encoder: Encoder, text_col: str = "abstract") -> DataFrame:
    """``(paper_id, embedding, primary_subject)`` of the papers whose text has content, encoded once and stored."""
    vectors = encode_column(papers, encoder, "paper_id", text_col, keep=("primary_subject",))
    return checkpoint(vectors.where("embedding IS NOT NULL"))


def evaluate_texts(
    papers: DataFrame, encoder: Encoder, sample_size: int = DEFAULT_SAMPLE, seed: int = 42, query_count: str = "requested"
) -> DataFrame:
    """``metrics(metric, value)`` of an encoder: texts -> vectors -> sample -> exact search -> metrics."""
    return evaluate(encoded_corpus(papers, encoder), sample_size, seed, query_count)


def evaluate_texts_per_subject(papers: DataFrame, encoder: Encoder, per_subject: int = 10, seed: int = 42) -> DataFrame:
    return evaluate_per_subject(encoded_corpus(papers, encoder), per_subject, seed)
