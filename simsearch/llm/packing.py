"""Packing by powers of two: a document of n tokens is cut into as many pieces as n has binary ones.

Whole 1,024-token pieces come first, then one piece for each binary one of the rest, longest first. A piece is a sequence of its
own, in the bucket of its length; it needs no padding and never holds two documents. Cutting happens where the document lies:
no shuffle, and sequence numbers come from the partition and the row, so a task that is run again gives the same ones.

Tokens are the ids of a byte-level tokenizer file. Texts of Latin letters are split into the tokenizer's pre-tokens by a
regular expression and looked up in a bounded table; other texts, and texts that hold a special token's string, go through
the library as they are. Both give the same ids.

Nulls: a null text is empty and has only the end id; a null id is kept. Repeated rows are packed each. Very long texts are cut into as many whole
pieces as they need, in batches of bounded bytes. Ties do not arise: no piece waits for another. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.llm.common import map_slices, table

LIMIT, END_ID = 1024, 0
MEMO_ENTRIES = 400_000
# Letters and numbers below U+0180, and the pre-token pattern of the byte-level tokenizer family.
LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾"
PRE_TOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+")
# Beyond that range, or control characters that Python alone counts as white space.
OTHER = re.compile("[^\x00-ſ]|[\x1c-\x1f]")


class ByteLevelIds:
    """Texts to little-endian 32-bit ids, as the tokenizer file's library gives them."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocabulary = {k: v for k, v in self.library.get_vocab(with_added_tokens=False).items() if k not in self.special}
        as_bytes = _byte_of_symbol()
        ranks = {bytes(as_bytes[c] for c in token): rank for token, rank in vocabulary.items()}
        self.merges = tiktoken.Encoding("file", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.memo: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        if OTHER.search(text) or any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        memo, words = self.memo, PRE_TOKEN.findall(text)
        new = set(words).difference(memo)
        if len(memo) + len(new) > MEMO_ENTRIES:
            self.memo = memo = {}
            new = set(words)
        for word in new:
            memo[word] = np.array(self.merges.encode_ordinary(word), dtype="<u4").tobytes()
        return b"".join(map(memo.__getitem__, words))


def _byte_of_symbol() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use: bytes without a picture move above U+00FF, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


_loaded: dict[str, ByteLevelIds] = {}


def _tokenizer(path: str) -> ByteLevelIds:
    if path not in _loaded:
        _loaded[path] = ByteLevelIds(path)
    return _loaded[path]


def binary_lengths(n: int, limit: int = LIMIT) -> list[int]:
    """Lengths of the pieces of n tokens: whole limits, then the powers of two of the rest, falling."""
    rest = n % limit
    return [limit] * (n // limit) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer: str, limit: int = LIMIT, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, tokens (little-endian 32-bit ids), doc_tokens, sequence_id, offset.

    ``length`` is also the sequence's bucket; ``limit`` is a power of two.
    """
    end = np.array([end_id], dtype="<u4").tobytes()
    if limit & (limit - 1):
        raise ValueError("the longest sequence must be a power of two")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = _tokenizer(tokenizer)
        doc, start, length, total, tokens = [], [], [], [], []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = encode.ids(text.decode()) + end
            at, n = 0, len(ids) // 4
            for size in binary_lengths(n, limit):
                doc.append(i)
                start.append(at)
                length.append(size)
                total.append(n)
                tokens.append(ids[4 * at : 4 * (at + size)])
                at += size
        long = lambda x: pa.array(x, pa.int64())
        return pa.RecordBatch.from_arrays(
            [long(doc), long(start), long(length), long(total), pa.array(tokens, pa.binary())],
            ["doc_id", "start", "length", "doc_tokens", "tokens"],
        )

    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text)
    schema = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, tokens binary"
    return map_slices(rows, "text", work, schema).select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder a length, so that a training job reads sequences of one length together."""
    pieces.write.mode("overwrite").partitionBy("length").parquet(path)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_packing(spark, sf_dir):
    return digest(pack(table(spark, sf_dir, "documents"), default_tokenizer()))
