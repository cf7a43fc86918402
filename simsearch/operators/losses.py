"""Scoring of pair tables with existing embeddings: the losses an evaluation run logs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from simsearch.functions.vectors import cosine, norm
from simsearch.operators.pairs import attach_both_sides
from simsearch.operators.topk import to_matrix

# The margin of the contrastive loss and the scale of the ranking loss.
MARGIN = 0.5
SCALE = 20.0


def pair_vectors(pair_ids: DataFrame, embeddings: DataFrame, num_pairs: int) -> DataFrame:
    """``(pair_id, embedding1, embedding2, ...)`` for ``pair_ids(pair_id, side, paper_id, ...)``.

    Pairs with a side that has no vector, or one of length zero, are left out.
    """
    usable = embeddings.where(norm(F.col("embedding")) > 0)
    both = attach_both_sides(pair_ids, usable, ["embedding"], 2 * num_pairs)
    return both.where(F.col("embedding1").isNotNull() & F.col("embedding2").isNotNull())


def pair_distances(pairs: DataFrame) -> DataFrame:
    """Cosine distance of the two sides of every pair."""
    return pairs.withColumn("distance", F.lit(1.0) - cosine(F.col("embedding1"), F.col("embedding2")))


def contrastive_loss(distances: DataFrame) -> DataFrame:
    """One row: the mean of 0.5 * (y d^2 + (1 - y) max(0, margin - d)^2)."""
    d, y = F.col("distance"), F.col("label")
    short = F.greatest(F.lit(0.0), F.lit(MARGIN) - d)
    loss = F.lit(0.5) * (y * d * d + (F.lit(1.0) - y) * short * short)
    return distances.agg(F.count("*").alias("n_pairs"), F.avg(loss).alias("loss"))


def in_batch_losses(pairs: DataFrame, batch_size: int) -> DataFrame:
    """``(batch, n_pairs, loss_sum)``: each anchor must pick its own positive among the batch's.

    A batch has ``batch_size`` consecutive pair ids, so one task holds two small matrices and no
    pair of the cross product ever becomes a row.
    """
    batched = pairs.select(
        F.floor(F.col("pair_id") / batch_size).cast("bigint").alias("batch"), "pair_id", "embedding1", "embedding2"
    )

    def score(group: pa.Table) -> pa.Table:
        dim = len(group.column("embedding1")[0])
        anchors = to_matrix(group.column("embedding1"), dim)
        positives = to_matrix(group.column("embedding2"), dim)
        anchors = anchors / np.linalg.norm(anchors, axis=1, keepdims=True)
        positives = positives / np.linalg.norm(positives, axis=1, keepdims=True)
        scores = SCALE * (anchors @ positives.T)
        top = scores.max(axis=1)
        loss = np.log(np.exp(scores - top[:, None]).sum(axis=1)) + top - np.diagonal(scores)
        return pa.table({"batch": [group.column("batch")[0].as_py()], "n_pairs": [len(loss)], "loss_sum": [float(loss.sum())]})

    return batched.groupBy("batch").applyInArrow(score, "batch bigint, n_pairs bigint, loss_sum double")


def in_batch_loss(pairs: DataFrame, batch_size: int) -> DataFrame:
    """One row: the mean in-batch ranking loss over all pairs."""
    return in_batch_losses(pairs, batch_size).agg(
        F.sum("n_pairs").alias("n_pairs"), (F.sum("loss_sum") / F.sum("n_pairs")).alias("loss")
    )


def hard_pairs(distances: DataFrame, batch_size: int) -> DataFrame:
    """Per batch: negatives closer than the farthest positive, positives farther than the closest
    negative. A batch has at most ``batch_size`` rows, which bounds each window.

    A batch without the other label is compared with that label's own mean, as the online
    contrastive loss does.
    """
    batched = distances.withColumn("batch", F.floor(F.col("pair_id") / batch_size).cast("bigint"))
    w = W.partitionBy("batch")
    d = F.col("distance")
    positive, negative = F.col("label") == 1.0, F.col("label") == 0.0

    def of(agg, which):
        return agg(F.when(which, d)).over(w)

    several = (
        batched.withColumn("n_pos", F.count_if(positive).over(w))
        .withColumn("n_neg", F.count_if(negative).over(w))
        .withColumn("far_positive", F.when(F.col("n_pos") > 1, of(F.max, positive)).otherwise(of(F.avg, negative)))
        .withColumn("near_negative", F.when(F.col("n_neg") > 1, of(F.min, negative)).otherwise(of(F.avg, positive)))
    )
    hard = (negative & (d < F.col("far_positive"))) | (positive & (d > F.col("near_negative")))
    return several.where(hard).select("batch", "pair_id", "label", "distance")
