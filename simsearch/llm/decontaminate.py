"""Benchmark decontamination: the benchmark's word windows are broadcast as a hash set and every training window is looked up.

Words are runs of digits, letters a-z (A-Z lower-cased) and everything beyond ASCII. A window is ``size`` consecutive words of
an item; a shorter item with a word is one window. The documents of a batch are hashed together: a rolling 64-bit value for each
window, a bit table that drops almost all of them, and an exact comparison of the words for the rest, so a chance hit of the hash
never counts. Documents stay where they lie; nothing is shuffled.

The set is broadcast in parts of at most ``PART_BYTES`` of item text, measured first, from which each worker builds its table (sorted
hashes and places in one buffer: a few times the part's bytes); each further part is another pass over the documents with
the hits so far kept in the rows.

Nulls: a null text has no words; an item without an id still marks words but is not listed. Repeated rows are judged each, repeated
items count once. Very long texts are read whole, in batches of bounded bytes. Ties do not arise: every item of a window is listed. With an empty benchmark nothing is hit; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsearch.llm.common import map_slices, table
from simsearch.session import checkpoint

WINDOW = 10
PART_BYTES = 32 << 20
TABLE_BITS = 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
TO_WORDS = bytes(b if b >= 0x80 or bytes([b]) in _KEPT else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


class Windows:
    """The benchmark's windows by length: sorted hashes, a bit table over them, and where the exact words of each lie in one buffer.

    A window costs about 30 bytes beside the items' words, so a worker holds a few times the text it was given.
    """

    def __init__(self, items: list[tuple[str | None, bytes]], size: int):
        self.names = sorted({item for item, _ in items if item is not None})
        number = {name: i for i, name in enumerate(self.names)} | {None: -1}
        bodies, at, found = [], 0, defaultdict(list)
        for item, text in items:
            words = words_of(text)
            length = min(size, len(words))
            if not words:
                continue
            ends = at + np.cumsum([len(w) + 1 for w in words]) - 1
            starts = np.concatenate([[at], ends[:-1] + 1])
            n = len(words) - length + 1
            found[length].append((rolling(word_hashes(words), length), starts[:n], ends[length - 1 :], np.full(n, number[item], dtype=np.int32)))
            bodies.append(b" ".join(words))
            at = int(ends[-1]) + 1
        self.buffer = b" ".join(bodies)
        self.by_length = {}
        for length, parts in found.items():
            hashes, starts, ends, item = (np.concatenate(column) for column in zip(*parts, strict=True))
            order = np.argsort(hashes, kind="stable")
            bits = np.zeros(1 << TABLE_BITS, dtype=bool)
            bits[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
            self.by_length[length] = (hashes[order], bits, starts[order], ends[order], item[order])

    def find(self, words: list[bytes], document: np.ndarray) -> tuple[list[tuple[int, int]], dict[int, set]]:
        """Hit word ranges over all documents of the batch, and the items by document."""
        spans, items = [], defaultdict(set)
        values = word_hashes(words)
        for length, (hashes, bits, starts, ends, item) in self.by_length.items():
            if length > len(words):
                continue
            rolled = rolling(values, length)
            at = np.flatnonzero(bits[(rolled >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
            at = at[document[at] == document[at + length - 1]]
            low, high = np.searchsorted(hashes, rolled[at]), np.searchsorted(hashes, rolled[at], side="right")
            met = np.flatnonzero(low < high)
            for i, lo, hi in zip(at[met].tolist(), low[met].tolist(), high[met].tolist(), strict=True):
                window = b" ".join(words[i : i + length])
                own = [j for j in range(lo, hi) if self.buffer[starts[j] : ends[j]] == window]
                if own:
                    spans.append((i, i + length))
                    items[int(document[i])].update(self.names[item[j]] for j in own if item[j] >= 0)
        return spans, items


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)


def rolling(values: np.ndarray, length: int) -> np.ndarray:
    """A polynomial of ``length`` consecutive values, for every start, mixed so that its high bits are good."""
    n = len(values) - length + 1
    total = values[:n].copy()
    for j in range(1, length):
        total *= MULTIPLIER
        total += values[j : j + n]
    return (total ^ (total >> np.uint64(31))) * MULTIPLIER


_built: dict[tuple, Windows] = {}


def _windows(held, size: int) -> Windows:
    """One table a worker and broadcast; word hashes only need to agree inside one process."""
    key = (held.value[0], size)
    if key not in _built:
        _built.clear()
        _built[key] = Windows(held.value[1], size)
    return _built[key]


def _merge(spans: list[tuple[int, int]]) -> list[int]:
    """Sorted, disjoint ranges, flattened to start, end, start, end."""
    flat: list[int] = []
    for start, end in sorted(spans):
        if flat and start <= flat[-1]:
            flat[-1] = max(flat[-1], end)
        else:
            flat += [start, end]
    return flat


def _pass(docs: DataFrame, held, size: int) -> DataFrame:
    rest = [c for c in docs.columns if c not in ("_text", "_spans", "_items", "_words")]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        windows = _windows(held, size)
        each = [words_of(t) for t in batch.column("_text").to_pylist()]
        counts = np.array([len(w) for w in each], dtype=np.int64)
        first = np.concatenate([[0], np.cumsum(counts)])
        document = np.repeat(np.arange(len(each)), counts)
        found, items = windows.find([w for words in each for w in words], document)
        spans = defaultdict(list)
        for start, end in found:
            d = int(document[start])
            spans[d].append((start - int(first[d]), end - int(first[d])))
        old_spans, old_items = batch.column("_spans").to_pylist(), batch.column("_items").to_pylist()
        merged = [_merge(spans[d] + list(zip(old[::2], old[1::2], strict=True))) if d in spans else old for d, old in enumerate(old_spans)]
        listed = [sorted(items[d].union(old)) if d in items else old for d, old in enumerate(old_items)]
        columns = [batch.column(c) for c in rest] + [
            batch.column("_text"), pa.array(merged, pa.list_(pa.int64())), pa.array(listed, pa.list_(pa.string())), pa.array(counts),
        ]
        return pa.RecordBatch.from_arrays(columns, [*rest, "_text", "_spans", "_items", "_words"])

    inner = T.StructType.fromDDL("_text binary, _spans array<bigint>, _items array<string>, _words bigint")
    return map_slices(docs, "_text", work, T.StructType([docs.schema[c] for c in rest] + inner.fields))


def contamination(docs: DataFrame, benchmark: DataFrame, *carry, size: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """The carried columns with ``n_words``, ``n_hit``, ``spans`` (word ranges, flattened) and ``items`` (ids as sorted strings)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.coalesce("text", F.lit("")).cast("binary").alias("text")).distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    rows = docs.select(
        *carry,
        F.coalesce("text", F.lit("")).cast("binary").alias("_text"),
        F.array().cast("array<bigint>").alias("_spans"),
        F.array().cast("array<string>").alias("_items"),
        F.lit(0).cast("bigint").alias("_words"),
    )
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part)
        listed = [(r["item"], bytes(r["text"])) for r in own.collect()]  # about part_bytes
        held = spark.sparkContext.broadcast((uuid.uuid4().hex, listed))
        rows = _pass(rows, held, size)
        if part + 1 < parts:
            rows = checkpoint(rows)
    kept = [c for c in rows.columns if not c.startswith("_") or c == "_row"]
    hit = F.aggregate("_spans", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("sign")),
                      lambda a, x: F.struct((a["n"] + a["sign"] * x).alias("n"), (-a["sign"]).alias("sign")))["n"]
    return rows.select(*kept, F.col("_words").alias("n_words"), hit.alias("n_hit"), F.col("_spans").alias("spans"), F.col("_items").alias("items"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents without a hit, with the columns they came with."""
    return contamination(docs, benchmark, F.struct("*").alias("_row"), size=size).where("n_hit = 0").select("_row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, text: the hit words are cut out with what stands between them; the rest stays byte for byte."""
    found = contamination(docs, benchmark, "doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("body"), size=size)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for body, spans in zip(batch.column("body").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            if spans:
                at = [m.span() for m in WORD.finditer(body.translate(TO_WORDS))]
                for start, end in reversed(list(zip(spans[::2], spans[1::2], strict=True))):
                    body = body[: at[start][0]] + body[at[end - 1][1] :]
            texts.append(body.decode())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_slices(found.select("doc_id", "body", "spans"), "body", cut, "doc_id bigint, text string")


def op2_decontaminate(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id::VARCHAR AS item, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
    FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d JOIN ks ON len(w) >= k)),
h AS (SELECT DISTINCT r, i, dw.k, item FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM h) GROUP BY r),
x AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN x USING (r)
"""
