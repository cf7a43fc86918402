"""SimHash near-duplicates by deletion variants.

Fingerprints. A text's word shingles are hashed (XXH64 of the UTF-8 bytes, seed 42); a bit of the 64-bit fingerprint is set if
it is set in more than half of the hashes, repeats included.

Links. Two fingerprints with at most 3 differing bits agree up to one bit in one of their two 32-bit halves. Each distinct
fingerprint is therefore listed under 64 keys: a half with one bit left out. Fingerprints under one key are compared, and those
within 3 bits are linked. No link is missed and none is made without the comparison. One task holds a key's fingerprints only
while there are few: if a half is shared by ``HOT`` distinct fingerprints or more, the keys that could hold them are refined by
the other half in the same way (two 16-bit parts with one bit left out), which leaves 18 free bits and so bounds every key. A key
gives a spanning forest of its links, not all pairs; copies were merged into one fingerprint before.

Groups are the connected components of the links, found by contraction; a group's id is its smallest document id.

Nulls: a null text has no words and fingerprint zero, as any text without words, and is linked like any other. A null id is never
a group's smallest id unless all ids of the group are null. Repeated rows get a row each. An empty table gives no rows. Only
``doc_id`` and ``text`` are read; ``keep_one``, the pipeline's stage, returns every column. Texts are read whole, however long, in
batches of bounded bytes. Ties: of equal ids the text with the smaller hash counts as first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simsearch.llm.common import bounded_broadcast, map_slices, stored, table
from simsearch.llm.graph import components
from simsearch.operators.skew import join_group

SEED, WORDS, BITS = 42, 3, 3
HOT = 2048
RUN_AT_ONCE = 16
PART = 1 << 16


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """Hashes of all shingles in order; the whole sequence is the one shingle of a shorter text, and no words have none."""
    found = text.lower().split()  # of bytes: A-Z only, and the six ASCII white-space characters
    hashed = xxhash.xxh64_intdigest
    if len(found) < words:
        hashes = [hashed(b" ".join(found), SEED)] if found else []
    else:
        hashes = [hashed(s, SEED) for s in map(b" ".join, zip(*[found[i:] for i in range(words)], strict=False))]
    return np.array(hashes, dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The signed 64-bit fingerprint: bits set in more than half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), PART):
        part = hashes[at : at + PART]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(text: bytes, words: int = WORDS) -> int:
    return majority(shingle_hashes(text, words))


def _mark() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark")


def _fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, mark (a hash of the text, which tells texts with one id apart), fp."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [fingerprint(t, words) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(fps, pa.int64())], ["doc_id", "mark", "fp"])

    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _mark(), text)
    return map_slices(rows, "text", work, "doc_id bigint, mark bigint, fp bigint")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fp."""
    return _fingerprints(docs, words).select("doc_id", "fp")


HALF = "shiftrightunsigned(fp, 32 * (v div 32)) & 4294967295L"
OTHER_HALF = "shiftrightunsigned(fp, 32 * (1 - v div 32)) & 4294967295L"


def variants(fps: DataFrame) -> DataFrame:
    """fp, key: both halves with each of their bits left out; the key holds which one and what is left."""
    return fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v")).select(
        "fp", "v", F.expr(f"shiftleft(cast(v as bigint), 32) | ({HALF} & ~shiftleft(1L, v % 32))").alias("key")
    )


def refined(rows: DataFrame) -> DataFrame:
    """Rows under hot keys, listed again under 32 longer keys: a 16-bit part of the other half with one bit left out."""
    part = f"shiftrightunsigned({OTHER_HALF}, 16 * (u div 16)) & 65535L"
    return rows.select("fp", "v", "key", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("u")).select(
        "fp", F.expr(f"shiftleft(key, 21) | shiftleft(cast(u as bigint), 16) | ({part} & ~shiftleft(1L, u % 16))").alias("key")
    )


def _forest(x: np.ndarray, bits: int) -> list[tuple[int, np.ndarray]]:
    """Links, as stars of near fingerprints, that join exactly the fingerprints that links inside ``x`` join."""
    stars = []
    while len(x) > 1:
        root, x = x[0], x[1:]
        reached = [root]
        while reached and len(x):
            member = reached.pop()
            near = np.bitwise_count(x ^ member) <= bits
            if near.any():
                stars.append((member, x[near]))
                reached.extend(x[near])
                x = x[~near]
    return stars


def _links(keys: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal keys."""
    borders = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[borders, len(keys)])
    a, b = [], []
    small = np.repeat(sizes <= RUN_AT_ONCE, sizes)
    k, x = keys[small], fps[small]
    for d in range(1, RUN_AT_ONCE):
        same = np.flatnonzero(k[d:] == k[:-d])
        if not len(same):
            break
        near = same[np.bitwise_count(x[same] ^ x[same + d]) <= bits]
        a.append(x[near])
        b.append(x[near + d])
    for at, n in zip(borders[sizes > RUN_AT_ONCE], sizes[sizes > RUN_AT_ONCE], strict=True):
        for member, near in _forest(np.sort(fps[at : at + n]), bits):
            a.append(np.full(len(near), member, dtype=np.uint64))
            b.append(near)
    empty = np.zeros(0, dtype=np.uint64)
    return np.concatenate([empty, *a]), np.concatenate([empty, *b])


def compare(keyed: DataFrame, bits: int) -> DataFrame:
    """keyed(fp, key) to links (a, b): rows are dealt out and sorted by key, and compared run by run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_x = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)

        def out(k: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            a, b = _links(k, x, bits) if len(k) else (x, x)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            held_k = np.concatenate([held_k, batch.column("key").to_numpy()])
            held_x = np.concatenate([held_x, batch.column("fp").to_numpy().view(np.uint64)])
            end = int(np.searchsorted(held_k, held_k[-1]))  # the last key may go on in the next batch
            yield out(held_k[:end], held_x[:end])
            held_k, held_x = held_k[end:], held_x[end:]
        yield out(held_k, held_x)

    dealt = keyed.select("key", "fp").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def links(fps: DataFrame, bits: int = BITS, hot: int = HOT) -> DataFrame:
    """Links (a, b) between distinct fingerprints that differ in at most ``bits`` (3 or fewer) bits."""
    halves = fps.select(F.explode(F.expr("array(fp & 4294967295L, shiftrightunsigned(fp, 32) | 4294967296L)")).alias("half"))
    crowded = stored(halves.groupBy("half").count().where(F.col("count") >= hot).select("half"))
    keyed, n = variants(fps), crowded.count()
    if not n:
        return compare(keyed, bits)
    bit = F.explode(F.sequence(F.lit(0), F.lit(31))).alias("u")
    hot_keys = crowded.select("half", bit).selectExpr(
        "shiftleft(shiftrightunsigned(half, 32) * 32 + u, 32) | (half & 4294967295L & ~shiftleft(1L, u)) as key"
    ).distinct()
    hot_keys = bounded_broadcast(hot_keys, 32 * n)
    light = compare(keyed.join(hot_keys, "key", "left_anti"), bits)
    return light.union(compare(refined(keyed.join(hot_keys, "key", "left_semi")), bits))


def _rooted(distinct: DataFrame, bits: int, hot: int) -> DataFrame:
    """distinct(fp, first ...) with ``root``, one fingerprint of each group that names it."""
    roots = components(links(distinct.select("fp"), bits, hot))
    joined = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return stored(joined.withColumn("root", F.coalesce("root", "fp")))


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS, hot: int = HOT) -> DataFrame:
    """doc_id, fp, component_id: one row a document."""
    rows = stored(fingerprints(docs, words))
    placed = _rooted(stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))), bits, hot)
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = placed.join(smallest, "root").select("fp", "component_id", "copies")
    return join_group(rows, by_fp, "fp", "copies").select("doc_id", "fp", "component_id")  # a fingerprint may be in any share of the rows


def keep_one(docs: DataFrame, words: int = WORDS, bits: int = BITS, hot: int = HOT) -> DataFrame:
    """One document of each group, with the columns it came with: that with the smallest id, of equal ids the one whose text has the
    smaller hash, of rows that repeat both the one whose other columns have it. A row is known by its id and text, so texts that
    share an id are judged apart. A document without an id comes last in its group."""
    rows = stored(_fingerprints(docs, words))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")
    distinct = stored(rows.groupBy("fp").agg(F.min(order).alias("first")))
    kept = _rooted(distinct, bits, hot).groupBy("root").agg(F.min("first").alias("first"))
    # a missing id is a name of its own in the keys, so that both sides are dealt out by plain equality
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    kept = kept.select(name(F.col("first.doc_id")).alias("_id"), F.col("first.mark").alias("_mark"))
    whole = docs.select(F.struct("*").alias("_row"), name(F.col("doc_id").cast("bigint")).alias("_id"), _mark().alias("_mark"))
    again = Window.partitionBy("_id", "_mark").orderBy(F.xxhash64(F.to_json("_row")))
    ranked = whole.join(kept, ["_id", "_mark"]).select("_row", F.row_number().over(again).alias("_n"))
    return ranked.where("_n = 1").select("_row.*")


def op1_simhash_dedup(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
