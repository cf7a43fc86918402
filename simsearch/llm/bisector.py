"""Clustering of vectors around moving centroids, each vector placed by a tournament of bisector tests in whole numbers.

Vectors. Those with exactly ``dim`` components, none null or non-finite, are kept; a component x becomes floor(scale * x).

Tournament. For centroids i < j the points nearer to j lie beyond their bisector: x . 2(cj - ci) > |cj|^2 - |ci|^2. The normals
and thresholds of all pairs are whole numbers, computed once a round. A vector starts with centroid 0 and meets 1, 2, ... k - 1: the
sign of one linear form decides who stays, and zero favours the smaller number. k - 1 tests find the nearest centroid; only its
distance is computed, at the end. Products are taken in doubles while they stay below 2^52 and so are exact, else in 64-bit integers.

Rounds. A task adds up its vectors by cluster, so k rows of sums a task are shuffled whatever one cluster holds. The driver sees
k centroids a round. A round reads the vectors where they lie; nothing is carried from one round to the next but the centroids, so a
lost executor costs its tasks only.

Defined results: a null id is clustered but starts no centroid while others are there; equal ids start in the order of their
vectors; repeated rows are vectors of their own; with fewer than k vectors there are as many centroids as vectors; an empty table
gives no rows. Components beyond ``BOUND`` after scaling count as the bound, so that every product fits 64 bits. Of ties in distance
the smaller number wins. A sum of distances beyond 64 bits is null. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.llm.common import table

DIM, SCALE, CENTROIDS, ROUNDS, SEED = 64, 1024, 8, 10, 3
MOST_CENTROIDS = 256  # the pairs' normals stay within 256 * 256 / 2 vectors
BOUND = 1 << 27
EXACT = float(1 << 52)


class Tournament:
    """Normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        squares = np.einsum("ij,ij->i", centroids, centroids)
        self.normal = [2 * (centroids[i + 1 :] - centroids[i]) for i in range(len(centroids))]
        self.threshold = [squares[i + 1 :] - squares[i] for i in range(len(centroids))]
        self.steepest = max((int(np.abs(n).max()) for n in self.normal if n.size), default=0)

    def winners(self, x: np.ndarray) -> np.ndarray:
        """The nearest centroid of each row of whole numbers."""
        exact = float(np.abs(x).max(initial=0)) * self.steepest * x.shape[1] < EXACT
        points = x.astype(np.float64) if exact else x
        now = np.zeros(len(x), dtype=np.int64)
        for j in range(1, len(self.centroids)):
            for i in np.unique(now).tolist():
                own = np.flatnonzero(now == i)
                lost = points[own] @ self.normal[i][j - i - 1].astype(points.dtype) > self.threshold[i][j - i - 1]
                now[own[lost]] = j
        return now

    def distances(self, x: np.ndarray, winner: np.ndarray) -> np.ndarray:
        apart = x - self.centroids[winner]
        return np.einsum("ij,ij->i", apart, apart)


def kept(embeddings: DataFrame, dim: int) -> DataFrame:
    """vec_id, embedding (doubles): the vectors that take part."""
    typed = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return typed.where(F.col("embedding").isNotNull() & (F.size("embedding") == dim)).where(finite)


def whole_numbers(batch: pa.RecordBatch, dim: int, scale: int) -> np.ndarray:
    values = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return np.clip(np.floor(scale * values), -BOUND, BOUND).astype(np.int64)


def first_centroids(vectors: DataFrame, k: int, dim: int, scale: int, seed: int) -> np.ndarray:
    """The vectors whose seeded id hashes come first; k rows reach the driver."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.select(drawn.alias("drawn"), "embedding").orderBy(F.col("drawn").asc_nulls_last(), "embedding").limit(k).collect()
    batch = pa.RecordBatch.from_arrays([pa.array([r["embedding"] for r in first], pa.list_(pa.float64()))], ["embedding"])
    return whole_numbers(batch, dim, scale)


def next_centroids(vectors: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """floor(sum / count) of each cluster, component by component; an empty cluster keeps its centroid."""
    tournament, (k, dim) = Tournament(centroids), centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            x = whole_numbers(batch, dim, scale)
            winner = tournament.winners(x)
            for c in np.unique(winner).tolist():
                sums[c] += x[winner == c].sum(axis=0)
            counts += np.bincount(winner, minlength=k)
        filled = np.flatnonzero(counts)
        columns = [pa.array(filled, pa.int32()), pa.array(counts[filled]), pa.array(list(sums[filled]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    parts = vectors.select("embedding").mapInArrow(add, "cluster int, n bigint, sums array<bigint>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("at", "s"))
    total = each.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    moved = centroids.copy()
    for row in total.collect():  # k * dim rows
        moved[row["cluster"], row["at"]] = int(row["s"]) // row["n"]
    return moved


def fit(vectors: DataFrame, k: int, rounds: int, dim: int, scale: int, seed: int) -> np.ndarray:
    if not 1 <= k <= MOST_CENTROIDS:
        raise ValueError(f"k must lie between 1 and {MOST_CENTROIDS}, got {k}")
    centroids = first_centroids(vectors, k, dim, scale, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = next_centroids(vectors, centroids, scale)
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray, scale: int) -> DataFrame:
    """vec_id, cluster, distance (squared). A narrow map."""
    tournament, dim = Tournament(centroids), centroids.shape[1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(batch, dim, scale)
            winner = tournament.winners(x)
            columns = [batch.column("vec_id"), pa.array(winner, pa.int32()), pa.array(tournament.distances(x, winner))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(place, "vec_id bigint, cluster int, distance bigint")


def cluster(
    embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid (whole numbers)."""
    vectors = kept(embeddings, dim)
    centroids = fit(vectors, k, rounds, dim, scale, seed)
    if not len(centroids):
        schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
        return embeddings.sparkSession.createDataFrame([], schema)
    placed = assign(vectors, centroids, scale)
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    inertia = {r["cluster"]: int(r["s"]) for r in sums}
    long = lambda v: F.lit(v if v < 1 << 63 else None).cast("bigint")
    by_cluster = lambda of: functools.reduce(lambda c, i: c.when(F.col("cluster") == i, of(i)), sorted(inertia), F)
    return placed.select(
        "*",
        by_cluster(lambda i: long(inertia[i])).alias("cluster_inertia"),
        long(sum(inertia.values())).alias("inertia"),
        by_cluster(lambda i: F.lit(centroids[i].tolist()).cast("array<bigint>")).alias("centroid"),
    )


def op13_bisector_clusters(spark, sf_dir):
    found = cluster(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))



def _sql() -> str:
    apart = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    parts = [
        """v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e::DOUBLE))) = 64)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS j, x AS c FROM (
  SELECT x, sha256('{SEED}:' || vec_id::VARCHAR) AS h FROM v ORDER BY h NULLS LAST, x LIMIT {CENTROIDS}))""",
    ]
    for i in range(ROUNDS + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, vec_id, x, j, d FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, j) AS nth FROM (SELECT r, vec_id, x, j, {apart} AS d FROM v CROSS JOIN c{i})) WHERE nth = 1)""")
        if i < ROUNDS:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT j, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
  SELECT j, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS m FROM (
    SELECT j, pos, sum(e) AS s, count(*) AS n FROM (SELECT j, unnest(x) AS e, generate_subscripts(x, 1) AS pos FROM a{i}) GROUP BY j, pos)
  GROUP BY j) USING (j))""")
    last = f"a{ROUNDS}"
    return f"""WITH {", ".join(parts)}
SELECT vec_id, j::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY j)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256 FROM {last} JOIN c{ROUNDS} USING (j)"""


SQL = _sql()
