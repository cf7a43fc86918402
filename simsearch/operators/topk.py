"""Top-k scoring: which stored vectors are nearest to each query, by cosine.

One contract serves exact and inverted-file search: a stored vector lives in one list, a query
names the lists it looks into, and only vectors of those lists are scored. Exact search is the
case of a single list. Scores are rounded before ranking and ties go to the smaller id, so the
result does not depend on how the vectors were split.

Few queries are stored once and broadcast in blocks of a checked size, counted in bytes of vectors and
of best hits together. Each block scans the stored vectors where they lie, and only each task's
best k per query is shuffled; vectors are never copied or shuffled.

Queries of more blocks than ``SearchLimits.most_scans`` meet the vectors by list instead: both sides are dealt out by list, each
vector once, so the vectors are read once however many queries there are. A list with many vectors is cut into parts
and one with many queries into blocks, so a hot list is many tasks' work; a task holds one block of queries with its
best hits and lets its part of the vectors stream past. The best k of each part are merged per query.

Similarity is the cosine: both sides are scaled to unit length in the scan. A missing or zero vector
has no direction and is left out (``ivf.misfits`` counts them); a vector of another length is an error.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from simsearch.functions.vectors import SCORE_DIGITS
from simsearch.operators.skew import join_group
from simsearch.session import checkpoint

HITS_SCHEMA = "query_id bigint, k int, paper_id bigint, score double"
NO_ID = np.iinfo(np.int64).max
# the product of a query block and a vector block stays below this many doubles (8 MB; ranking it takes a few times that)
BLOCK_CELLS = 1_000_000
# best hits leave a task in batches of about this many rows
BATCH_HITS = 100_000
ROUNDING_SLACK = 10.0**-SCORE_DIGITS
# stored postings lie in this many folders at most; a folder holds the lists of one remainder
LIST_GROUP, LIST_GROUPS = "list_group", 1024


@dataclass(frozen=True)
class SearchLimits:
    """Sizes that decide how a search runs; none of them changes its result."""

    block_bytes: int = 128 << 20
    broadcast_hits: int = 2_000_000
    most_scans: int = 8
    part_rows: int = 1_000_000

    def block_queries(self, dim: int, k: int, lists_per_query: int) -> int:
        """Queries of one block: their vectors, list ids, and k best (score, id) each."""
        return max(1, self.block_bytes // (8 * dim + 8 * lists_per_query + 16 * k + 32))


def to_matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """A list column as a float64 matrix, straight from the Arrow buffer; every list has ``dim`` values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != dim).any():
        raise ValueError(f"embeddings must have one fixed dimension: expected {dim}, found {lengths[lengths != dim][0]:g}")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(-1, dim)


def unit_rows(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that have a direction, at unit length, and which rows those are."""
    lengths = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    usable = np.flatnonzero(lengths > 0)
    return matrix[usable] / lengths[usable, None], usable


def ids_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


class BestHits:
    """The best k ids per query seen so far, in (score descending, id ascending) order."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries = queries
        self.k = k
        self.scores = np.full((len(queries), k), -np.inf)
        self.ids = np.full((len(queries), k), NO_ID)

    def add(self, which: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Score ``vectors`` against the queries numbered ``which`` and keep the best."""
        step = max(1, BLOCK_CELLS // max(1, len(ids)))
        for start in range(0, len(which), step):
            rows = which[start : start + step]
            self._merge(rows, ids, self.queries[rows] @ vectors.T)

    def _merge(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Most scores fall below what a query already has; only the others are rounded and sorted."""
        floor = self.scores[rows, -1]
        unfilled = np.isneginf(floor)
        if scores.shape[1] > self.k and unfilled.any():
            kth = np.partition(scores[unfilled], -self.k, axis=1)[:, -self.k]
            floor[unfilled] = np.round(kth, SCORE_DIGITS)
        r, c = np.nonzero(scores >= (floor - ROUNDING_SLACK)[:, None])
        rounded = np.round(scores[r, c], SCORE_DIGITS)
        # ">=" keeps every tie at the cut; the sort below then prefers the smaller id
        kept = rounded >= floor[r]
        r, c, rounded = r[kept], c[kept], rounded[kept]
        if not len(r):
            return
        touched, r = np.unique(r, return_inverse=True)
        mine = rows[touched]
        owner = np.concatenate([np.repeat(np.arange(len(mine)), self.k), r])
        score = np.concatenate([self.scores[mine].ravel(), rounded])
        found = np.concatenate([self.ids[mine].ravel(), ids[c]])
        order = np.lexsort((found, -score, owner))
        owner = owner[order]
        starts = np.searchsorted(owner, np.arange(len(mine)))
        best = order[np.arange(len(owner)) - starts[owner] < self.k]
        self.scores[mine] = score[best].reshape(len(mine), self.k)
        self.ids[mine] = found[best].reshape(len(mine), self.k)

    def to_batches(self, query_ids: np.ndarray, ks: np.ndarray) -> Iterator[pa.RecordBatch]:
        step = max(1, BATCH_HITS // self.k)
        for start in range(0, max(1, len(query_ids)), step):
            own = slice(start, start + step)
            ids, scores = self.ids[own], self.scores[own]
            r, c = np.nonzero((ids != NO_ID) & (np.arange(self.k)[None, :] < ks[own, None]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(query_ids[own][r], pa.int64()),
                    pa.array(ks[own][r], pa.int32()),
                    pa.array(ids[r, c], pa.int64()),
                    pa.array(scores[r, c], pa.float64()),
                ],
                names=["query_id", "k", "paper_id", "score"],
            )


def _rank(candidates: DataFrame) -> DataFrame:
    """Best k per query out of the candidates, numbered from 1."""
    best_first = W.partitionBy("query_id").orderBy(F.col("score").desc(), "paper_id")
    return (
        candidates.withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= F.col("k"))
        .select("query_id", "rank", "score", "paper_id")
    )


def search_lists(probes: DataFrame, postings: DataFrame, dim: int, limits: SearchLimits) -> DataFrame:
    """``hits(query_id, rank, score, paper_id)``.

    ``probes(query_id, embedding, k, lists)``: the queries, with the list ids each looks into; each gets its
    own k hits. ``postings(paper_id, embedding, list_id)``: the stored vectors.
    """
    asked = probes.where("embedding IS NOT NULL").select("query_id", "embedding", F.col("k").cast("int").alias("k"), "lists")
    stored = checkpoint(asked)
    count, k_max, lists = stored.agg(F.count("*"), F.max("k"), F.max(F.size("lists"))).first()
    postings = postings.where("embedding IS NOT NULL")
    blocks = -(-count // limits.block_queries(dim, k_max or 1, lists or 1))
    if blocks > limits.most_scans:
        return _join_lists(stored, postings, dim, limits.block_queries(dim, k_max or 1, 1), limits.part_rows)
    if blocks <= 1:
        hits = _rank(_scan(stored.toArrow(), postings, dim))
        return F.broadcast(hits) if count * (k_max or 0) <= limits.broadcast_hits else hits
    found = []
    for block in range(blocks):
        own = stored.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        found.append(checkpoint(_rank(_scan(own.toArrow(), postings, dim))))
    return functools.reduce(DataFrame.unionByName, found)


def _units(asked: DataFrame, postings: DataFrame, block: int, part_rows: int) -> DataFrame:
    """``(list_id, rows, parts, blocks)`` of every list that is asked for and holds something.

    Every part gets a copy of the list's queries and every block one of its vectors. Parts of ``part_rows`` vectors alone would make
    copies by the product of both sides, so a list has no more of them than keep the copies of its queries within those of its vectors, or
    than give every core two units of its share of the work.
    """
    held = postings.groupBy("list_id").agg(F.count("*").alias("held"))
    wanted = asked.groupBy("list_id").agg(F.count("*").alias("wanted"))
    sizes = checkpoint(held.join(wanted, "list_id").withColumn("blocks", F.ceil(F.col("wanted") / block).cast("int")))
    work = F.col("held").cast("double") * F.col("wanted")
    cores = asked.sparkSession.sparkContext.defaultParallelism
    even = F.ceil(F.col("held") * F.col("blocks") / F.col("wanted"))
    busy = F.ceil(2 * cores * work / sizes.agg(F.sum(work)).scalar() / F.col("blocks"))
    parts = F.least(F.ceil(F.col("held") / part_rows), F.greatest(even, busy)).cast("int")
    return sizes.select("list_id", (F.col("held") + F.col("wanted")).alias("rows"), parts.alias("parts"), "blocks")


def _join_lists(probes: DataFrame, postings: DataFrame, dim: int, block: int, part_rows: int) -> DataFrame:
    """The hits of any number of queries: probes and postings meet by (list, part, block)."""
    asked = probes.select("query_id", "k", "embedding", F.explode("lists").alias("list_id"))
    units = checkpoint(_units(asked, postings, block, part_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    deal = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    # numbers are widened where they are scored, not before they are dealt out
    kinds = {df.schema["embedding"].dataType.simpleString() for df in (probes, postings)}
    vector = F.col("embedding").cast(kinds.pop() if len(kinds) == 1 else "array<double>").alias("embedding")
    queries = join_group(asked, units, "list_id", "rows").select(
        "list_id", every("parts").alias("part"), deal("query_id", "blocks").alias("block"), F.lit(0).alias("side"), F.col("query_id").alias("id"), "k", vector
    )
    vectors = join_group(postings.select("paper_id", "embedding", "list_id"), units, "list_id", "rows").select(
        "list_id", deal("paper_id", "parts").alias("part"), every("blocks").alias("block"), F.lit(1).alias("side"), F.col("paper_id").alias("id"), F.lit(None).cast("int").alias("k"), vector
    )
    unit = ["list_id", "part", "block"]
    dealt = queries.unionByName(vectors).repartition(*unit).sortWithinPartitions(*unit, "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, ks, held, best = None, [], [], [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in (*unit, "side")])
            borders = np.flatnonzero(np.any(keys[:, 1:] != keys[:, :-1], axis=0)) + 1
            for lo, hi in zip([0, *borders.tolist()], [*borders.tolist(), batch.num_rows], strict=True):
                own = batch.slice(lo, hi - lo)
                matrix, usable = unit_rows(to_matrix(own.column("embedding"), dim))
                if tuple(keys[:3, lo]) != now:
                    if best is not None:
                        yield from best.to_batches(np.concatenate(ids), np.concatenate(ks))
                    now, ids, ks, held, best = tuple(keys[:3, lo]), [], [], [], None
                if keys[3, lo] == 0:  # queries come before the vectors of their unit
                    ids.append(ids_of(own.column("id"))[usable])
                    ks.append(ids_of(own.column("k"))[usable])
                    held.append(matrix)
                elif sum(map(len, held)):
                    if best is None:
                        best = BestHits(np.concatenate(held), int(max(k.max(initial=1) for k in ks)))
                    best.add(np.arange(len(best.queries)), ids_of(own.column("id"))[usable], matrix)
        if best is not None:
            yield from best.to_batches(np.concatenate(ids), np.concatenate(ks))

    return _rank(dealt.mapInArrow(run, HITS_SCHEMA))


def _scan(block: pa.Table, postings: DataFrame, dim: int) -> DataFrame:
    """Broadcast a block of queries and scan the probed lists once."""
    queries, usable = unit_rows(to_matrix(block.column("embedding"), dim))
    block = block.take(usable)
    lists = block.column("lists").combine_chunks()
    flat = lists.flatten().to_numpy()
    owner = np.repeat(np.arange(block.num_rows), lists.value_lengths().to_numpy())
    order = np.argsort(flat, kind="stable")
    names, starts = np.unique(flat[order], return_index=True)
    asking = dict(zip(names.tolist(), np.split(owner[order], starts[1:]), strict=True)) if len(names) else {}
    ks = ids_of(block.column("k"))
    shared = postings.sparkSession.sparkContext.broadcast((ids_of(block.column("query_id")), queries, ks, asking))
    k_max = int(ks.max(initial=1))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries, ks, asking = shared.value
        best = BestHits(queries, k_max)
        for batch in batches:
            vectors, usable = unit_rows(to_matrix(batch.column("embedding"), dim))
            ids, in_list = ids_of(batch.column("paper_id"))[usable], ids_of(batch.column("list_id"))[usable]
            for name in np.unique(in_list):
                rows = np.flatnonzero(in_list == name)
                best.add(asking[int(name)], ids[rows], vectors[rows])
        yield from best.to_batches(query_ids, ks)

    # literal lists of values, so that only the probed lists' folders and row groups are opened
    probed = postings.where(F.col("list_id").isin(names.tolist()))
    if LIST_GROUP in postings.columns:
        probed = probed.where(F.col(LIST_GROUP).isin(np.unique(names % LIST_GROUPS).tolist()))
    return probed.select("paper_id", "embedding", "list_id").mapInArrow(scan, HITS_SCHEMA)


def exact_topk(
    queries: DataFrame, corpus: DataFrame, dim: int, k: int = 10, limits: SearchLimits = SearchLimits()
) -> DataFrame:
    """The k nearest corpus vectors of each query by cosine, comparing with every corpus vector.

    ``queries(query_id, embedding)`` may carry its own ``k``, which then holds; ``corpus(paper_id, embedding)``.
    """
    own = F.coalesce(F.col("k").cast("int"), F.lit(k)) if "k" in queries.columns else F.lit(k)
    probes = queries.select("query_id", "embedding", own.alias("k"), F.array(F.lit(0)).alias("lists"))
    postings = corpus.select("paper_id", "embedding", F.lit(0).alias("list_id"))
    return search_lists(probes, postings, dim, limits)
