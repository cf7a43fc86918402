"""Inverted-file index: vectors grouped by nearest centroid, searched a few lists at a time."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.functions.vectors import SCORE_DIGITS, has_dim, l2_normalize, norm
from simsearch.operators.cutoff import mark_smallest
from simsearch.operators.topk import BLOCK_CELLS, SearchLimits, search_lists, to_matrix
from simsearch.session import checkpoint
from simsearch.sources.tables import EMBEDDINGS, conform

# The defaults of lists and of lists probed.
DEFAULT_NLIST = 4096
DEFAULT_NPROBE = 64
CENTROID_BYTES = 1 << 30
CENTROID_DIGITS = 8


@dataclass(frozen=True)
class IvfIndex:
    """``centroids(list_id, centroid)`` and ``postings(paper_id, embedding, list_id)``."""

    centroids: DataFrame
    postings: DataFrame
    dim: int
    nlist: int
    nprobe: int = DEFAULT_NPROBE
    limits: SearchLimits = field(default_factory=SearchLimits)

    @functools.cached_property
    def quantizer(self) -> Broadcast:
        """List ids and centroids, collected and broadcast once for all searches of this index."""
        return self.centroids.sparkSession.sparkContext.broadcast(_centroid_matrix(self.centroids))

    def with_nprobe(self, nprobe: int | None) -> IvfIndex:
        return self if nprobe is None else replace(self, nprobe=nprobe)


def embedding_dim(embeddings: DataFrame, check_all: bool = False) -> int:
    """The vectors' length, from the first vector. Every later pass over the vectors fails on one of another
    length; with ``check_all`` they are all looked at now."""
    lengths = embeddings.where(F.col("embedding").isNotNull()).select(F.size("embedding").alias("d"))
    found = (lengths.distinct().limit(2) if check_all else lengths.limit(1)).collect()
    if len(found) != 1:
        raise ValueError(f"embeddings must have one fixed dimension, found {len(found) or 'none'}")
    return found[0]["d"]


def misfits(embeddings: DataFrame, dim: int) -> DataFrame:
    """One row: how many vectors are missing, have another length, or have no direction."""
    usable = has_dim(F.col("embedding"), dim) & F.coalesce(norm(F.col("embedding")) > 0, F.lit(False))
    return embeddings.agg(F.count_if(~usable).alias("misfits"))


def train_centroids(
    embeddings: DataFrame, nlist: int = DEFAULT_NLIST, seed: int = 42, iterations: int = 10, train_rows: int | None = None
) -> DataFrame:
    """k-means centroids on unit vectors, from all vectors, or from ``train_rows`` drawn ones if given."""
    total = embeddings.count()
    if not 1 <= nlist <= total:
        raise ValueError(f"nlist must lie between 1 and {total}, got {nlist}")
    if nlist == 1:
        only = embeddings.select(Summarizer.mean(array_to_vector("embedding")).alias("m"))
        return only.select(F.lit(0).alias("list_id"), l2_normalize(vector_to_array("m")).alias("centroid"))
    sample = embeddings
    if train_rows is not None and total > train_rows:
        sample = mark_smallest(embeddings, "paper_id", (seed, "train"), {"_in": lambda n: F.lit(train_rows)})
        sample = sample.where("_in")
    points = sample.where(norm(F.col("embedding")) > 0).select(array_to_vector("embedding").alias("features"))
    model = KMeans(
        k=nlist, seed=seed, maxIter=iterations, distanceMeasure="cosine", initMode="random", featuresCol="features"
    ).fit(points)
    centers = np.asarray(model.clusterCenters())
    table = pa.table({"list_id": pa.array(range(len(centers)), pa.int32()), "centroid": list(centers)})
    centroids = embeddings.sparkSession.createDataFrame(table)
    return centroids.select("list_id", l2_normalize(F.col("centroid")).alias("centroid")).where("centroid is not null")


def mean_centroids(embeddings: DataFrame, list_col: str) -> DataFrame:
    """``(list_id, centroid, n_vectors)``: the unit mean vector per value of an integer column,
    centroids without a training run."""
    means = embeddings.groupBy(F.col(list_col).cast("int").alias("list_id")).agg(
        Summarizer.mean(array_to_vector("embedding")).alias("m"), F.count("*").alias("n_vectors")
    )
    unit = l2_normalize(vector_to_array("m"))
    return means.select("list_id", F.transform(unit, lambda x: F.round(x, CENTROID_DIGITS)).alias("centroid"), "n_vectors")


def _checked_table(centroids: DataFrame) -> pa.Table:
    """The centroids in list order. They are broadcast, so their size is checked first: 1 GB of doubles holds
    more than 300,000 lists of 384 values."""
    typed = centroids.select(F.col("list_id").cast("int"), F.col("centroid").cast("array<double>"))
    count, values = typed.agg(F.count("*"), F.sum(F.size("centroid"))).first()
    if not count or 8 * values > CENTROID_BYTES:
        raise ValueError(f"an index has between one list and {CENTROID_BYTES} bytes of centroids, found {count} lists")
    return typed.toArrow().sort_by("list_id")


def _centroid_matrix(centroids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = _checked_table(centroids)
    matrix = to_matrix(table.column("centroid"), len(table.column("centroid")[0]))
    return table.column("list_id").to_numpy(), matrix


def _nearest_lists(matrix: np.ndarray, names: np.ndarray, centroids: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` best list ids per row, best first, ties to the smaller list id."""
    out = np.empty((len(matrix), count), dtype=np.int32)
    step = max(1, BLOCK_CELLS // len(names))
    for start in range(0, len(matrix), step):
        scores = np.round(matrix[start : start + step] @ centroids.T, SCORE_DIGITS)
        if count == 1:
            out[start : start + step, 0] = names[np.argmax(scores, axis=1)]
        else:
            out[start : start + step] = names[np.argsort(-scores, axis=1, kind="stable")[:, :count]]
    return out


def assign_lists(embeddings: DataFrame, centroids: DataFrame, dim: int) -> DataFrame:
    """``(paper_id, embedding, list_id)``: each vector with its nearest list. A narrow map."""
    shared = embeddings.sparkSession.sparkContext.broadcast(_centroid_matrix(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = shared.value
        for batch in batches:
            lists = _nearest_lists(to_matrix(batch.column("embedding"), dim), names, matrix, 1)[:, 0]
            yield pa.RecordBatch.from_arrays(
                [batch.column("paper_id"), batch.column("embedding"), pa.array(lists, pa.int32())],
                names=["paper_id", "embedding", "list_id"],
            )

    usable = conform(embeddings, EMBEDDINGS).where("embedding IS NOT NULL")
    return usable.mapInArrow(assign, "paper_id bigint, embedding array<float>, list_id int")


def build_index(
    embeddings: DataFrame,
    nlist: int = DEFAULT_NLIST,
    nprobe: int = DEFAULT_NPROBE,
    seed: int = 42,
    centroids: DataFrame | None = None,
    train_rows: int | None = None,
) -> IvfIndex:
    """Train (unless centroids are given) and assign every vector to its list."""
    embeddings = conform(embeddings, EMBEDDINGS)
    dim = embedding_dim(embeddings)
    if centroids is None:
        centroids = train_centroids(embeddings, nlist, seed, train_rows=train_rows)
    # of a checked size: kept as they are, so that no later step computes them again
    table = _checked_table(centroids)
    centroids = embeddings.sparkSession.createDataFrame(table)
    return IvfIndex(centroids, assign_lists(embeddings, centroids, dim), dim, table.num_rows, nprobe)


def choose_lists(queries: DataFrame, index: IvfIndex) -> DataFrame:
    """Add ``lists``: the nprobe lists nearest to each query, nprobe being the query's own value
    or the index default, never more than there are lists."""
    shared, dim = index.quantizer, index.dim

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = shared.value
        for batch in batches:
            counts = np.minimum(batch.column("nprobe").to_numpy(zero_copy_only=False), len(names))
            if not len(counts):
                continue
            most = int(counts.max())
            lists = _nearest_lists(to_matrix(batch.column("embedding"), dim), names, matrix, most)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            flat = lists[np.arange(most)[None, :] < counts[:, None]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("query_id"),
                    batch.column("embedding"),
                    batch.column("k"),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())),
                ],
                names=["query_id", "embedding", "k", "lists"],
            )

    usable = queries.where("embedding IS NOT NULL").select(
        "query_id", F.col("embedding").cast("array<float>").alias("embedding"), F.col("k").cast("int"), F.col("nprobe").cast("int")
    )
    return usable.mapInArrow(choose, "query_id bigint, embedding array<float>, k int, lists array<int>")


def search(queries: DataFrame, index: IvfIndex, k: int = 10, nprobe: int | None = None) -> DataFrame:
    """``hits(query_id, rank, score, paper_id)`` from each query's nearest lists.

    ``queries(query_id, embedding)`` may carry its own ``k`` and ``nprobe``, which then hold; where they are null
    or absent the arguments, then the index default, apply. A query gets fewer than k hits when
    its lists hold fewer vectors.
    """
    if index is None:
        raise RuntimeError("index not loaded: load or build it first")
    own_k = F.col("k") if "k" in queries.columns else F.lit(None).cast("int")
    own_nprobe = F.col("nprobe") if "nprobe" in queries.columns else F.lit(None).cast("int")
    asked = queries.select(
        "query_id",
        "embedding",
        F.coalesce(own_k, F.lit(k)).alias("k"),
        F.greatest(F.lit(1), F.coalesce(own_nprobe, F.lit(index.with_nprobe(nprobe).nprobe))).alias("nprobe"),
    )
    return search_lists(choose_lists(asked, index), index.postings, index.dim, index.limits)


def list_sizes(index: IvfIndex) -> DataFrame:
    """How many vectors each list holds, empty lists included."""
    counts = index.postings.groupBy("list_id").agg(F.count("*").alias("n_vectors"))
    return (
        index.centroids.select("list_id")
        .join(counts, "list_id", "left")
        .select("list_id", F.coalesce("n_vectors", F.lit(0)).alias("n_vectors"))
    )


def fetch_vectors(embeddings: DataFrame, ids: DataFrame) -> DataFrame:
    """The stored vectors of the given ``paper_id``s."""
    return embeddings.join(ids.select("paper_id"), "paper_id", "left_semi")


def size_mismatch(embeddings: DataFrame, papers: DataFrame) -> DataFrame:
    """One row: vectors without a paper, papers without a vector, ids stored twice."""
    tagged = embeddings.select("paper_id", F.lit(1).alias("v"), F.lit(0).alias("p")).unionByName(
        papers.select("paper_id", F.lit(0).alias("v"), F.lit(1).alias("p"))
    )
    per_id = tagged.groupBy("paper_id").agg(F.sum("v").alias("v"), F.sum("p").alias("p"))

    def ids(condition):
        return F.count_if(condition)

    return per_id.agg(
        ids((F.col("v") > 0) & (F.col("p") == 0)).alias("vectors_without_paper"),
        ids((F.col("p") > 0) & (F.col("v") == 0)).alias("papers_without_vector"),
        ids((F.col("v") > 1) | (F.col("p") > 1)).alias("duplicate_ids"),
    )


def require_match(embeddings: DataFrame, papers: DataFrame) -> None:
    row = size_mismatch(embeddings, papers).collect()[0].asDict()
    if any(row.values()):
        raise ValueError(f"embeddings and papers do not match: {row}")


def hydrate(hits: DataFrame, papers) -> DataFrame:
    """Hits with their paper's columns. ``papers`` is a table, which is scanned, or a ``PaperStore``, of which only the places that
    hold a hit are read; the hits are then written first, as they are read twice."""
    columns = [c for c in ("title", "abstract", "primary_subject", "subjects", "arxiv_id") if c in papers.columns]
    if not isinstance(papers, DataFrame):
        hits = checkpoint(hits)
        papers = papers.lookup(hits)
    return papers.select("paper_id", *columns).join(hits, "paper_id").select("query_id", "rank", "score", "paper_id", *columns)


def lost_hits(hits: DataFrame, papers: DataFrame) -> DataFrame:
    """Hits whose paper is missing, which ``hydrate`` leaves out."""
    return hits.join(papers.select("paper_id"), "paper_id", "left_anti")
