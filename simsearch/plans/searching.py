"""A table of search requests -> validated, encoded, searched, joined to papers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.operators.encode import Encoder, encode_column
from simsearch.operators.ivf import IvfIndex, hydrate, search
from simsearch.operators.requests import DEFAULT_K, validate, validate_texts
from simsearch.sources.tables import REQUESTS, conform


@dataclass(frozen=True)
class Answer:
    """``hits``: response rows. ``statuses``: every request with its status code."""

    hits: DataFrame
    statuses: DataFrame


def embed_requests(requests: DataFrame, encoder: Encoder) -> DataFrame:
    """``(query_id, embedding_dim, embedding)`` for the well-formed texts."""
    good = validate_texts(requests).where(F.col("status_code") == 200)
    encoded = encode_column(good, encoder, "query_id")
    return encoded.select("query_id", F.size("embedding").alias("embedding_dim"), "embedding")


def search_requests(
    requests: DataFrame, index: IvfIndex | None, papers: DataFrame, encoder: Encoder
) -> Answer:
    """Answer every valid request; a bad one only gets its status code.

    ``requests(query_id, abstract, k, nprobe)``. Each row's own k and nprobe apply to that row
    alone.
    """
    requests = conform(requests, REQUESTS, optional=("k", "nprobe"))
    checked = validate(requests, index_loaded=index is not None)
    statuses = checked.select("query_id", "status_code")
    if index is None:
        return Answer(checked.limit(0).select("query_id"), statuses)
    good = checked.where(F.col("status_code") == 200)
    queries = encode_column(good, encoder, "query_id", keep=("k", "nprobe")).where("embedding is not null")
    hits = search(queries, index, k=DEFAULT_K)
    return Answer(hydrate(hits, papers), statuses)
