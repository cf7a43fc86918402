"""Sharding by a k-d tree over document metadata (DataFrame functions only).

The space has four dimensions in [0, 1]: logarithm of the size, id, source and language (names by hash). A node that stands
for m shards is cut along its widest dimension into parts of floor(m / 2) and the rest, where the summed bytes stand in that
proportion. The cut is a weighted median found by the cluster: bytes are counted by 32,768 cells of the dimension, the cell of
the cut is divided again, four times in all. Values equal in the dimension are ordered by a hash of the row's identity and then, so that
rows that repeat are told apart too, by a number each row got when the table was written: a value, or one repeated row, that holds a
third of the bytes is cut as finely as any other. The driver only sees one cut a node and pass. The number of leaves is given,
or follows from the bytes that a leaf should hold: a node is cut until its share is one leaf's.

Law ``bytes``: shard sizes are near equal. Equal texts are rows like any other: near-equal sizes come first, so a text that holds more than a
shard's bytes is spread over several shards. Nulls: a null text has no bytes; null ids, sources and languages lie at 0.
Repeated rows get a slot each; which of them goes to which shard may differ from run to run, their number does not. Very long texts
count by their bytes; one that exceeds a shard's share has a shard to itself. An empty table gives no rows. Only ``doc_id``, ``text``, ``lang`` and
``source`` are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simsearch.llm.common import bounded_broadcast, table
from simsearch.session import checkpoint

DIMENSIONS = ("d_size", "d_id", "d_source", "d_lang")
VALUE_BITS, NAME_BITS, REPEAT_BITS = 20, 24, 16
TIE_BITS, PASS_BITS, PASSES = NAME_BITS + REPEAT_BITS, 15, 4
SLOT_ROWS = 20_000
ROW_BYTES = 8


@dataclass
class Cut:
    """Node ``first`` stands for ``shards`` shards; its rows with a smaller key stay in the left half."""

    first: int
    shards: int
    dimension: str = ""
    key: int = 0

    @property
    def left(self) -> int:
        return self.shards // 2


def points(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the place in each dimension as a whole number: a few numbers a row, written once.

    A place's high bits are the value, its low bits the tie-breaker.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.col("doc_id").cast("double").alias("id"),
        _name_place("source").alias("source"),
        _name_place("lang").alias("lang"),
    )
    rows = checkpoint(rows)
    low, high, most = rows.agg(F.min("id"), F.max("id"), F.max("size")).first()
    span, top = (high or 0.0) - (low or 0.0) or 1.0, math.log(most or math.e)
    values = {
        "d_size": F.log("size") / F.lit(top),
        "d_id": F.coalesce((F.col("id") - F.lit(low or 0.0)) / F.lit(span), F.lit(0.0)),
        "d_source": F.col("source"),
        "d_lang": F.col("lang"),
    }
    # the rows are written: a row's number stays the same whenever it is read again
    name = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(1 << NAME_BITS))
    repeat = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << REPEAT_BITS))
    tie = name * (1 << REPEAT_BITS) + repeat
    place = lambda v: F.floor(F.least(v, F.lit(1.0)) * ((1 << VALUE_BITS) - 1)).cast("bigint") * (1 << TIE_BITS) + tie
    return checkpoint(rows.select("doc_id", "size", "text_crc32", *[place(v).alias(d) for d, v in values.items()]))


def _name_place(name: str) -> Column:
    return F.when(F.col(name).isNull(), 0.0).otherwise(F.pmod(F.xxhash64(name), F.lit(1 << VALUE_BITS)) / F.lit(float(1 << VALUE_BITS)))


def _by_node(values: dict[int, Column | int]) -> Column:
    """The value of a row's node."""
    (first, value), *others = values.items()
    choice = F.when(F.col("node") == first, value)
    for first, value in others:
        choice = choice.when(F.col("node") == first, value)
    return choice


def split_level(rows: DataFrame, nodes: list[Cut]) -> None:
    """Choose dimension and key of every node of one level. The driver sees one row a node and pass."""
    open_rows = rows.where(F.col("node").isin([n.first for n in nodes]))
    spans = open_rows.groupBy("node").agg(F.sum("size").alias("size"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS])
    found = {r["node"]: r for r in spans.collect()}
    for node in nodes:
        spread = found.get(node.first)
        node.dimension = max(DIMENSIONS, key=lambda d: spread[d] if spread else 0)
    want = {n.first: found[n.first]["size"] * n.left // n.shards if n.first in found else 0 for n in nodes}
    keyed = open_rows.select("node", "size", _by_node({n.first: F.col(n.dimension) for n in nodes}).alias("key"))
    prefix = dict.fromkeys(want, 0)
    for step in range(PASSES):
        shift = VALUE_BITS + TIE_BITS - PASS_BITS * (step + 1)
        inside = keyed.where(F.shiftright("key", shift + PASS_BITS) == _by_node(prefix)) if step else keyed
        cells = inside.groupBy("node", F.shiftright("key", shift).alias("cell")).agg(F.sum("size").alias("size"))
        upto = F.sum("size").over(Window.partitionBy("node").orderBy("cell"))  # at most 2^PASS_BITS cells a node
        crossing = cells.select("node", "cell", "size", upto.alias("upto")).where(F.col("upto") > _by_node(want))
        hits = crossing.groupBy("node").agg(F.min_by(F.struct("cell", "size", "upto"), "cell").alias("c")).select("node", "c.*")
        for hit in hits.collect():
            prefix[hit["node"]] = hit["cell"]
            want[hit["node"]] -= hit["upto"] - hit["size"]
    for node in nodes:
        node.key = prefix[node.first]


def place(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` with their shard as ``node``; every level is written, so a lost executor costs one level at most."""
    nodes = [Cut(0, shards)]
    rows = rows.withColumn("node", F.lit(0))
    while nodes := [n for n in nodes if n.shards > 1]:
        split_level(rows, nodes)
        right = {n.first: F.when(F.col(n.dimension) < n.key, n.first).otherwise(n.first + n.left) for n in nodes}
        rows = checkpoint(rows.withColumn("node", F.coalesce(_by_node(right), F.col("node"))))
        nodes = [half for n in nodes for half in (Cut(n.first, n.left), Cut(n.first + n.left, n.shards - n.left))]
    return rows


def number(rows: DataFrame, shards: int) -> DataFrame:
    """``slot``: 0, 1, ... in each shard. Rows are numbered in small cells of a shard, then shifted by the cells before."""
    counted = rows.count()
    cells = max(16, -(-counted // (shards * SLOT_ROWS)))
    celled = rows.select("*", F.pmod(F.xxhash64("text_crc32", "doc_id"), F.lit(cells)).alias("cell"))
    sizes = celled.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("cell")) - F.col("n")
    shifts = bounded_broadcast(sizes.select("shard", "cell", before.alias("before")), shards * cells)
    order = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    ranked = celled.select("*", (F.row_number().over(order) - 1).alias("place"))
    return ranked.join(shifts, ["shard", "cell"]).withColumn("slot", F.col("place") + F.col("before"))


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: so many shards, or as many as leave ``target_bytes`` to each (24 if neither is given)."""
    rows = points(docs)
    if shards is None and target_bytes is not None:
        shards = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    shards = shards or 24
    placed = place(rows, shards).select("doc_id", "size", "text_crc32", F.col("node").cast("int").alias("shard"))
    return number(placed, shards).select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("bigint").alias("slot"))


def op7_kd_sharding(spark, sf_dir):
    placed = shard(table(spark, sf_dir, "documents"), 24)
    return placed.select("*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard"))
