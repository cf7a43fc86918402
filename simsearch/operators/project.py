"""Two-dimensional view of embeddings, and the aggregates a plot of it needs."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.functions.vectors import as_double, dot

MIN_LABELLED_POINTS = 150
MARGIN_SHARE = 0.02


def directions(embeddings: DataFrame) -> np.ndarray:
    """The two directions of largest variance as columns. The covariance is computed on the executors; only a dim x dim matrix
    reaches the driver. Each points the way its largest loading is positive, so that the sign is reproducible."""
    points = embeddings.where(F.size("embedding") > 0).select(array_to_vector("embedding").alias("features"))
    loadings = PCA(k=2, inputCol="features", outputCol="xy").fit(points).pc.toArray()
    return loadings * np.where(loadings[np.abs(loadings).argmax(axis=0), [0, 1]] > 0, 1.0, -1.0)


def project_2d(embeddings: DataFrame) -> DataFrame:
    """``(paper_id, x, y)``: the coordinates along the two directions of largest variance."""
    x, y = (F.lit([float(v) for v in column]) for column in directions(embeddings).T)
    points = embeddings.where(F.size("embedding") > 0)
    return points.select("paper_id", dot(F.col("embedding"), x).alias("x"), dot(F.col("embedding"), y).alias("y"))


def eigen_residual(embeddings: DataFrame, axes: np.ndarray) -> float:
    """The largest entry of C v - (v'Cv) v over the columns v of ``axes``, for the covariance C of all rows.

    C v is the covariance of every component with the coordinate along v, so one row a component and axis is summed, from rows centred
    on their mean; no matrix is built.
    """
    points = embeddings.where(F.size("embedding") > 0).select("paper_id", as_double(F.col("embedding")).alias("e"))
    means = points.select(F.posexplode("e").alias("pos", "v")).groupBy("pos").agg(F.avg("v").alias("m")).orderBy("pos").collect()
    centred = points.select(F.zip_with("e", F.lit([r["m"] for r in means]), lambda v, m: v - m).alias("e"))
    worst = 0.0
    for axis in axes.T:
        along = centred.withColumn("t", dot(F.col("e"), F.lit([float(v) for v in axis])))
        summed = along.select("t", F.posexplode("e").alias("pos", "v")).groupBy("pos").agg(F.covar_samp("v", "t").alias("c")).orderBy("pos").collect()
        product = np.array([r["c"] for r in summed])
        worst = max(worst, float(np.abs(product - (axis @ product) * axis).max()))
    return worst


def subject_centroids(points: DataFrame, min_points: int = MIN_LABELLED_POINTS) -> DataFrame:
    """Centre and size of each subject with enough points to be labelled."""
    return (
        points.groupBy("primary_subject")
        .agg(F.count("*").alias("n_points"), F.avg("x").alias("x"), F.avg("y").alias("y"))
        .where(F.col("n_points") >= min_points)
    )


def draw_order(points: DataFrame) -> DataFrame:
    """Subjects from the largest to the smallest, so that small ones are drawn on top."""
    counts = points.groupBy("primary_subject").agg(F.count("*").alias("n_points"))
    return counts.orderBy(F.col("n_points").desc(), "primary_subject")


def plot_extent(points: DataFrame) -> DataFrame:
    """One row: the axis limits with a margin of 2 % on each side."""
    limits = points.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    dx, dy = (F.col("x1") - F.col("x0")) * MARGIN_SHARE, (F.col("y1") - F.col("y0")) * MARGIN_SHARE
    return limits.select(
        (F.col("x0") - dx).alias("x_min"),
        (F.col("x1") + dx).alias("x_max"),
        (F.col("y0") - dy).alias("y_min"),
        (F.col("y1") + dy).alias("y_max"),
    )
