"""Subjects -> stratified sample -> 2-D coordinates -> what a plot needs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from simsearch.operators.ivf import fetch_vectors, require_match
from simsearch.operators.project import MIN_LABELLED_POINTS, draw_order, plot_extent, project_2d, subject_centroids
from simsearch.operators.sampling import stratified_sample


@dataclass(frozen=True)
class Landscape:
    points: DataFrame
    labels: DataFrame
    order: DataFrame
    extent: DataFrame


def landscape(
    papers: DataFrame,
    embeddings: DataFrame,
    sample_size: int = 50_000,
    seed: int = 42,
    min_points: int = MIN_LABELLED_POINTS,
) -> Landscape:
    """A map of the corpus: sampled points with their subject, and the label positions."""
    require_match(embeddings, papers)
    sample = stratified_sample(papers.select("paper_id", "primary_subject"), sample_size, seed)
    coordinates = project_2d(fetch_vectors(embeddings, sample))
    points = coordinates.join(sample, "paper_id")
    return Landscape(points, subject_centroids(points, min_points), draw_order(points), plot_extent(points))
