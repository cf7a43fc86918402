"""Ranking quality of search hits against same-subject relevance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simsearch.operators.skew import few_groups, join_group

ACCURACY_AT = (1, 3, 5, 10)
PRECISION_RECALL_AT = (1, 5, 10)
MRR_AT = 10
NDCG_AT = 10
MAP_AT = 100


def qrels_counts(queries: DataFrame, corpus: DataFrame) -> DataFrame:
    """``(query_id, subject, n_rel)``: how many corpus papers share the query's subject.

    The judgments themselves are never listed: a subject with a third of the corpus would give
    every one of its queries that many rows. Queries without any relevant paper drop out.
    """
    per_subject = corpus.groupBy("primary_subject").agg(F.count("*").alias("n_rel"))
    asked = queries.groupBy("primary_subject").agg(F.count("*").alias("n_queries"))
    both = per_subject.join(asked, "primary_subject")
    return join_group(queries, both, "primary_subject", "n_queries", few_groups(queries, "primary_subject")).select(
        "query_id", F.col("primary_subject").alias("subject"), "n_rel"
    )


def judge(hits: DataFrame, judged_queries: DataFrame, corpus: DataFrame) -> DataFrame:
    """``(query_id, subject, n_rel, ranks)``: the ranks of each query's relevant hits, ascending.

    A query has at most its k hits, so the array is bounded by k.
    """
    found = corpus.select("paper_id", F.col("primary_subject").alias("hit_subject")).join(hits, "paper_id")
    matched = judged_queries.join(
        found.select("query_id", "rank", "hit_subject"), "query_id", "left"
    ).withColumn("rel_rank", F.when(F.col("hit_subject") == F.col("subject"), F.col("rank")))
    return matched.groupBy("query_id", "subject", "n_rel").agg(F.array_sort(F.collect_list("rel_rank")).alias("ranks"))


def _within(ranks: Column, k: int) -> Column:
    return F.filter(ranks, lambda r: r <= k)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _discounted(ranks: Column) -> Column:
    return _total(F.transform(ranks, lambda r: F.lit(1.0) / F.log2(r + F.lit(1.0))))


def accuracy_at(ranks: Column, k: int) -> Column:
    return F.when(F.size(_within(ranks, k)) > 0, 1.0).otherwise(0.0)


def precision_at(ranks: Column, k: int) -> Column:
    """Relevant hits among the first k, over k even when fewer hits came back."""
    return F.size(_within(ranks, k)) / F.lit(float(k))


def recall_at(ranks: Column, n_rel: Column, k: int) -> Column:
    return F.when(n_rel > 0, F.size(_within(ranks, k)) / n_rel).otherwise(0.0)


def mrr_at(ranks: Column, k: int) -> Column:
    """One over the rank of the first relevant hit."""
    return F.when(F.size(_within(ranks, k)) > 0, F.lit(1.0) / F.get(ranks, F.lit(0))).otherwise(0.0)


def ndcg_at(ranks: Column, n_rel: Column, k: int) -> Column:
    ideal = _discounted(F.sequence(F.lit(1), F.least(n_rel.cast("int"), F.lit(k))))
    return F.when(n_rel > 0, _discounted(_within(ranks, k)) / ideal).otherwise(0.0)


def map_at(ranks: Column, n_rel: Column, k: int) -> Column:
    """Precision at each relevant rank, summed, over what could have been found."""
    gains = F.transform(_within(ranks, k), lambda r, i: (i + F.lit(1.0)) / r)
    return F.when(n_rel > 0, _total(gains) / F.least(n_rel, F.lit(k))).otherwise(0.0)


def query_metrics(judged: DataFrame) -> DataFrame:
    """Every metric per query."""
    ranks, n_rel = F.col("ranks"), F.col("n_rel")
    columns = {f"accuracy@{k}": accuracy_at(ranks, k) for k in ACCURACY_AT}
    columns |= {f"precision@{k}": precision_at(ranks, k) for k in PRECISION_RECALL_AT}
    columns |= {f"recall@{k}": recall_at(ranks, n_rel, k) for k in PRECISION_RECALL_AT}
    columns |= {
        f"mrr@{MRR_AT}": mrr_at(ranks, MRR_AT),
        f"ndcg@{NDCG_AT}": ndcg_at(ranks, n_rel, NDCG_AT),
        f"map@{MAP_AT}": map_at(ranks, n_rel, MAP_AT),
    }
    return judged.select("query_id", "subject", *[c.alias(name) for name, c in columns.items()])


def mean_metrics(per_query: DataFrame) -> DataFrame:
    """``metrics(metric, value)``: the mean over queries, one row per metric."""
    names = [c for c in per_query.columns if c not in ("query_id", "subject")]
    means = per_query.agg(*[F.avg(F.col(f"`{n}`")).alias(n) for n in names])
    return means.unpivot([], [F.col(f"`{n}`") for n in names], "metric", "value")


def subject_report(per_query: DataFrame) -> DataFrame:
    """Mean P@10, R@10, MRR and NDCG@10 per subject."""
    return per_query.groupBy("subject").agg(
        F.count("*").alias("n_queries"),
        F.avg("`precision@10`").alias("p_at_10"),
        F.avg("`recall@10`").alias("r_at_10"),
        F.avg(f"`mrr@{MRR_AT}`").alias("mrr"),
        F.avg(f"`ndcg@{NDCG_AT}`").alias("ndcg_at_10"),
    )


def metric_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Precision and NDCG before, after, and the difference."""
    shown = F.col("metric").contains("precision") | F.col("metric").contains("ndcg")
    return (
        before.where(shown)
        .select("metric", F.col("value").alias("before"))
        .join(after.select("metric", F.col("value").alias("after")), "metric")
        .withColumn("delta", F.col("after") - F.col("before"))
    )
