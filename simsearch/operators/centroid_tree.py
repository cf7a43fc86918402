"""A quantizer for very many lists: a tree of centroids with two levels.

The root holds one centroid a branch and each branch its own leaves; a leaf is a list of the index. A vector belongs to the nearest leaf
of its nearest branch. Training a level is Lloyd's rounds on unit vectors, one aggregation a round: a task adds up its vectors by
centroid, and only these sums are shuffled. Leaves are trained, assigned and searched one group of branches after the
other; a group's centroids are bounded in bytes, and only they are broadcast or reach the driver, so the number of lists is not bounded
by one matrix. Vectors are written once by group after the root is known, and every later pass reads each of them in its group alone.

A search descends: each query takes its ``beam`` nearest branches, in each its nearest leaves, and of all these the ``nprobe`` best. Scores are
rounded before they are compared and ties go to the smaller number. A vector without direction is in no list.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from simsearch.functions.keyed import h48
from simsearch.functions.vectors import SCORE_DIGITS, norm
from simsearch.operators.cutoff import mark_smallest
from simsearch.operators.ivf import CENTROID_DIGITS, embedding_dim
from simsearch.operators.topk import BLOCK_CELLS, SearchLimits, search_lists, to_matrix, unit_rows
from simsearch.session import checkpoint, shared_folder
from simsearch.sources.tables import EMBEDDINGS, conform, read_table

ROOT_BYTES = 256 << 20
GROUP_BYTES = 256 << 20
ITERATIONS = 10
GROUP = "tree_group"


@dataclass(frozen=True)
class CentroidTree:
    """``root``: one row of numbers a branch. ``leaves(tree_group, branch, list_id, centroid)``, stored by group."""

    root: np.ndarray
    leaves: DataFrame
    groups: int
    per_group: int

    @property
    def dim(self) -> int:
        return self.root.shape[1]

    def group_leaves(self, group: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """The group's list ids and centroids by branch, within ``GROUP_BYTES``."""
        table = self.leaves.where(F.col(GROUP) == group).toArrow().sort_by([("branch", "ascending"), ("list_id", "ascending")])
        if not table.num_rows:
            return {}
        branch, ids = table.column("branch").to_numpy(), table.column("list_id").to_numpy()
        matrix = to_matrix(table.column("centroid"), self.dim)
        borders = np.flatnonzero(branch[1:] != branch[:-1]) + 1
        parts = zip(np.split(branch, borders), np.split(ids, borders), np.split(matrix, borders), strict=True)
        return {int(b[0]): (i, m) for b, i, m in parts}


@dataclass(frozen=True)
class TreeIndex:
    """``postings(paper_id, embedding, list_id)`` of a tree's leaves."""

    tree: CentroidTree
    postings: DataFrame
    nprobe: int
    beam: int
    limits: SearchLimits = field(default_factory=SearchLimits)


def _best(matrix: np.ndarray, centroids: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and rounded scores of the ``count`` best centroids of each row, ties to the smaller place."""
    places, scores = [], []
    step = max(1, BLOCK_CELLS // len(centroids))
    for start in range(0, max(1, len(matrix)), step):
        found = np.round(matrix[start : start + step] @ centroids.T, SCORE_DIGITS)
        order = np.argmax(found, axis=1)[:, None] if count == 1 else np.argsort(-found, axis=1, kind="stable")[:, :count]
        places.append(order)
        scores.append(np.take_along_axis(found, order, axis=1))
    return np.concatenate(places), np.concatenate(scores)


def _summed(sums: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """sums(slot, s) of tasks to the slots and the unit directions of their totals; one row a centroid reaches the driver."""
    total = sums.groupBy("slot").agg(vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s")).toArrow()
    matrix = to_matrix(total.column("s"), dim)
    unit, usable = unit_rows(matrix)
    return total.column("slot").to_numpy()[usable], np.round(unit, CENTROID_DIGITS)


def _sum_batch(slots: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(slots, pa.int64()), pa.array(list(sums), pa.list_(pa.float64()))]
    return pa.RecordBatch.from_arrays(columns, ["slot", "s"])


def train_root(embeddings: DataFrame, branches: int, dim: int, seed: int = 42, iterations: int = ITERATIONS) -> np.ndarray:
    """Lloyd's rounds from drawn vectors; a centroid that wins nothing stays where it is."""
    if 8 * branches * dim > ROOT_BYTES:
        raise ValueError(f"{branches} branches of {dim} numbers exceed {ROOT_BYTES} bytes; use fewer branches and more leaves")
    usable = embeddings.where(norm(F.col("embedding")) > 0)
    drawn = mark_smallest(usable, "paper_id", (seed, "tree"), {"_in": lambda n: F.lit(branches)}).where("_in").orderBy("paper_id").select("embedding").toArrow()
    if not drawn.num_rows:
        raise ValueError("no vector has a direction: there is nothing to train on")
    root, _ = unit_rows(to_matrix(drawn.column("embedding"), dim))
    for _ in range(iterations):
        shared = embeddings.sparkSession.sparkContext.broadcast(root)

        def add(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            sums = np.zeros_like(shared.value)
            for batch in batches:
                matrix, _ = unit_rows(to_matrix(batch.column("embedding"), dim))
                np.add.at(sums, _best(matrix, shared.value, 1)[0][:, 0], matrix)
            slots = np.flatnonzero(np.any(sums, axis=1))
            yield _sum_batch(slots, sums[slots])

        slots, moved = _summed(usable.select("embedding").mapInArrow(add, "slot bigint, s array<double>"), dim)
        root = root.copy()
        root[slots] = moved
    return root


def by_branch(embeddings: DataFrame, root: np.ndarray, per_group: int) -> DataFrame:
    """``(paper_id, embedding, branch, tree_group)``: each vector with its nearest branch. A narrow map."""
    shared, dim = embeddings.sparkSession.sparkContext.broadcast(root), root.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix, usable = unit_rows(to_matrix(batch.column("embedding"), dim))
            own = batch.take(pa.array(usable))
            branch = _best(matrix, shared.value, 1)[0][:, 0]
            columns = [own.column("paper_id"), own.column("embedding"), pa.array(branch, pa.int32()), pa.array(branch // per_group, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["paper_id", "embedding", "branch", GROUP])

    return embeddings.where("embedding IS NOT NULL").select("paper_id", "embedding").mapInArrow(assign, f"paper_id bigint, embedding array<float>, branch int, {GROUP} int")


def _train_group(vectors: DataFrame, leaves: int, dim: int, seed: int, iterations: int) -> pa.Table:
    """The leaves (branch, list_id, centroid) of one group's branches."""
    order = W.partitionBy("branch").orderBy(h48(seed, "leaf", F.col("paper_id")), "paper_id")
    first = vectors.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= leaves).select("branch", "_n", "embedding").toArrow()
    first = first.sort_by([("branch", "ascending"), ("_n", "ascending")])
    centroids, usable = unit_rows(to_matrix(first.column("embedding"), dim))
    branch = first.column("branch").to_numpy()[usable]
    for _ in range(iterations):
        borders = {int(b): (int(np.searchsorted(branch, b)), int(np.searchsorted(branch, b, side="right"))) for b in np.unique(branch)}
        shared = vectors.sparkSession.sparkContext.broadcast((centroids, borders))

        def add(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            centroids, borders = shared.value
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                matrix, usable = unit_rows(to_matrix(batch.column("embedding"), dim))
                own = batch.column("branch").to_numpy()[usable]
                for b in np.unique(own).tolist():
                    lo, hi = borders[b]
                    held = sums.setdefault(b, np.zeros((hi - lo, dim)))
                    rows = matrix[own == b]
                    np.add.at(held, _best(rows, centroids[lo:hi], 1)[0][:, 0], rows)
            for b, held in sums.items():
                won = np.flatnonzero(np.any(held, axis=1))
                yield _sum_batch(borders[b][0] + won, held[won])

        slots, moved = _summed(vectors.select("branch", "embedding").mapInArrow(add, "slot bigint, s array<double>"), dim)
        centroids = centroids.copy()
        centroids[slots] = moved
    at = np.arange(len(branch)) - np.searchsorted(branch, branch)
    lists = branch.astype(np.int64) * leaves + at
    return pa.table({"branch": pa.array(branch, pa.int32()), "list_id": pa.array(lists, pa.int32()), "centroid": pa.array(list(centroids), pa.list_(pa.float64()))})


def build_tree(
    embeddings: DataFrame, branches: int, leaves: int, nprobe: int, beam: int, path: str | None = None,
    seed: int = 42, iterations: int = ITERATIONS, group_bytes: int = GROUP_BYTES,
) -> TreeIndex:
    """Train both levels and assign every vector, under ``path`` (a new place in the shared folder if not given).

    ``branches * leaves`` lists; ``group_bytes`` bounds the centroids that are handled at once.
    """
    embeddings = conform(embeddings, EMBEDDINGS)
    spark, dim = embeddings.sparkSession, embedding_dim(embeddings)
    path = f"{path or shared_folder(spark, 'tree')}/build-{uuid.uuid4().hex[:12]}"
    per_group = max(1, group_bytes // (8 * leaves * dim))
    root = train_root(embeddings, branches, dim, seed, iterations)
    groups = -(-len(root) // per_group)
    spread = F.pmod(F.xxhash64("paper_id"), F.lit(spark.sparkContext.defaultParallelism))
    placed = by_branch(embeddings, root, per_group).repartition(GROUP, spread)
    placed.write.partitionBy(GROUP).parquet(f"{path}/vectors")
    vectors = read_table(spark, f"{path}/vectors")
    for group in range(groups):
        own = vectors.where(F.col(GROUP) == group).drop(GROUP)
        if not own.isEmpty():
            trained = spark.createDataFrame(_train_group(own, leaves, dim, seed, iterations))
            trained.withColumn(GROUP, F.lit(group)).write.mode("append").partitionBy(GROUP).parquet(f"{path}/leaves")
    tree = CentroidTree(root, read_table(spark, f"{path}/leaves"), groups, per_group)
    return TreeIndex(tree, assign_leaves(vectors, tree), nprobe, beam)


def assign_leaves(vectors: DataFrame, tree: CentroidTree) -> DataFrame:
    """``(paper_id, embedding, list_id)`` of vectors that know their branch and group. One narrow map a group."""
    return _by_group(tree, vectors, _assigned, "paper_id bigint, embedding array<float>, list_id int")


def _by_group(tree: CentroidTree, rows: DataFrame, work, schema: str) -> DataFrame:
    """``work(batch, the group's leaves by branch)`` over the rows of each group."""
    parts = []
    for group in range(tree.groups):
        shared = rows.sparkSession.sparkContext.broadcast(tree.group_leaves(group))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from work(batch, shared.value)

        parts.append(rows.where(F.col(GROUP) == group).drop(GROUP).mapInArrow(run, schema))
    return functools.reduce(DataFrame.unionByName, parts)


def _of_branches(batch: pa.RecordBatch, leaves: dict) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """The rows of each branch, their unit vectors, and the branch's list ids and centroids."""
    branch = batch.column("branch").to_numpy()
    for b in np.unique(branch).tolist():
        if b in leaves:
            own = batch.take(pa.array(np.flatnonzero(branch == b)))
            ids, centroids = leaves[b]
            matrix, usable = unit_rows(to_matrix(own.column("embedding"), centroids.shape[1]))
            yield own.take(pa.array(usable)), matrix, ids, centroids


def _assigned(batch: pa.RecordBatch, leaves: dict) -> Iterator[pa.RecordBatch]:
    for own, matrix, ids, centroids in _of_branches(batch, leaves):
        lists = ids[_best(matrix, centroids, 1)[0][:, 0]]
        columns = [own.column("paper_id"), own.column("embedding"), pa.array(lists, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["paper_id", "embedding", "list_id"])


def _probed(batch: pa.RecordBatch, leaves: dict) -> Iterator[pa.RecordBatch]:
    """The best leaves of each (query, branch), as many as the query probes."""
    for own, matrix, ids, centroids in _of_branches(batch, leaves):
        counts = np.minimum(own.column("nprobe").to_numpy(), len(ids))
        places, scores = _best(matrix, centroids, int(counts.max(initial=1)))
        rows, nth = np.nonzero(np.arange(places.shape[1])[None, :] < counts[:, None])
        columns = [own.column("query_id").take(pa.array(rows)), pa.array(ids[places[rows, nth]], pa.int32()), pa.array(scores[rows, nth])]
        yield pa.RecordBatch.from_arrays(columns, ["query_id", "list_id", "score"])


def choose_leaves(queries: DataFrame, index: TreeIndex) -> DataFrame:
    """``(query_id, lists)`` of ``queries(query_id, embedding, nprobe)``: the best leaves of each query's nearest branches."""
    tree, beam = index.tree, min(index.beam, len(index.tree.root))
    shared = queries.sparkSession.sparkContext.broadcast(tree.root)

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix, usable = unit_rows(to_matrix(batch.column("embedding"), tree_dim))
            if len(usable):
                branch = _best(matrix, shared.value, beam)[0].ravel()
                own = batch.take(pa.array(np.repeat(usable, beam)))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(branch, pa.int32()), pa.array(branch // per_group, pa.int32())], [*own.schema.names, "branch", GROUP])

    tree_dim, per_group = tree.dim, tree.per_group
    asked = queries.where("embedding IS NOT NULL").select("query_id", F.col("embedding").cast("array<float>").alias("embedding"), F.col("nprobe").cast("int").alias("nprobe"))
    down = asked.mapInArrow(descend, f"query_id bigint, embedding array<float>, nprobe int, branch int, {GROUP} int")
    down = checkpoint(down) if tree.groups > 1 else down
    found = _by_group(tree, down, _probed, "query_id bigint, list_id int, score double")
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "list_id")  # at most beam * nprobe rows a query
    ranked = found.withColumn("_n", F.row_number().over(best)).join(asked.select("query_id", "nprobe"), "query_id").where("_n <= nprobe")
    return ranked.groupBy("query_id").agg(F.collect_list("list_id").alias("lists"))


def search_tree(queries: DataFrame, index: TreeIndex, k: int = 10, nprobe: int | None = None) -> DataFrame:
    """``hits(query_id, rank, score, paper_id)`` from each query's best leaves; ``queries`` may carry ``k`` and ``nprobe``."""
    own = lambda c, default: F.coalesce(F.col(c).cast("int"), F.lit(default)) if c in queries.columns else F.lit(default)
    probes = F.greatest(F.lit(1), own("nprobe", index.nprobe if nprobe is None else nprobe)).alias("nprobe")
    asked = queries.select("query_id", "embedding", own("k", k).alias("k"), probes)
    lists = choose_leaves(asked, index)
    return search_lists(asked.join(lists, "query_id").select("query_id", "embedding", "k", "lists"), index.postings, index.tree.dim, index.limits)
