"""Text to unit vectors in Arrow batches, with a pluggable encoder.

An encoder declares its dimension and turns a batch of texts into a matrix. Spark decides where
the batches run; an encoder that holds a model or a session is built once per Python worker.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.operators.layout import spread_small

DEFAULT_BATCH = 256
WORD = re.compile(r"[^\W_]+")
MAX_CACHED_WORDS = 1 << 17  # about 25 MB a worker


class Encoder(Protocol):
    dim: int | None

    def encode(self, texts: list[str]) -> np.ndarray: ...


class HashingEncoder:
    """Signed feature hashing of lower-cased words; needs no model file.

    A word's md5 gives its slot (first eight hex digits modulo the dimension) and its sign (the
    ninth digit's parity). The vector is the sum over all words of the whole text.
    """

    def __init__(self, dim: int = 64):
        self.dim = dim
        self._slots = _Slots(dim)

    def __reduce__(self):
        return (HashingEncoder, (self.dim,))

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim))
        for row, text in enumerate(texts):
            words = WORD.findall(text.lower())
            numbers = np.fromiter(map(self._slots.__getitem__, words), dtype=np.int64, count=len(words))
            counts = np.bincount(numbers, minlength=2 * self.dim)
            out[row] = counts[: self.dim] - counts[self.dim :]
        return out


class _Slots(dict):
    """Word -> slot, shifted by ``dim`` for a negative sign; filled as words are met."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, word: str) -> int:
        if len(self) >= MAX_CACHED_WORDS:  # also inside a text
            self.clear()
        digest = hashlib.md5(word.encode(), usedforsecurity=False).hexdigest()
        number = int(digest[:8], 16) % self.dim + (self.dim if int(digest[8], 16) % 2 else 0)
        self[word] = number
        return number


class LazyEncoder:
    """An encoder made by ``factory`` on first use in a worker: a model or an inference session
    is loaded there once and never shipped from the driver."""

    def __init__(self, factory: Callable[[], Encoder], dim: int):
        self.factory = factory
        self.dim = dim
        self._made: Encoder | None = None

    def __getstate__(self):
        return {"factory": self.factory, "dim": self.dim, "_made": None}

    def encode(self, texts: list[str]) -> np.ndarray:
        if self._made is None:
            self._made = self.factory()
        return self._made.encode(texts)


def _unit_rows(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows at unit length and which of them have one; a zero row has no direction."""
    lengths = np.sqrt((matrix * matrix).sum(axis=1))
    ok = lengths > 0
    return matrix / np.where(ok, lengths, 1.0)[:, None], ok


def encode_column(
    df: DataFrame,
    encoder: Encoder,
    id_col: str,
    text_col: str = "abstract",
    batch_size: int = DEFAULT_BATCH,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(id_col, *keep, embedding array<float>)``: unit vectors, null where the text has no content.

    A narrow map over whole texts, ``batch_size`` of them per encoder call.
    """
    dim = encoder.dim
    if dim is None:
        raise ValueError("the encoder does not declare a fixed dimension")
    names = [id_col, *keep, "embedding"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for arrow in batches:
            for start in range(0, arrow.num_rows, batch_size):
                part = arrow.slice(start, batch_size)
                texts = [t or "" for t in part.column(0).to_pylist()]
                matrix = np.asarray(encoder.encode(texts), dtype=np.float64)
                if matrix.shape != (len(texts), dim):
                    raise ValueError(f"encoder gave shape {matrix.shape}, expected {(len(texts), dim)}")
                unit, ok = _unit_rows(matrix)
                offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * dim)
                flat = pa.array(unit.astype(np.float32).ravel())
                vectors = pa.ListArray.from_arrays(offsets, flat, mask=pa.array(~ok))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], vectors], names=names)

    kept = spread_small(df).select(text_col, F.col(id_col).cast("bigint").alias(id_col), *keep)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:])
    return kept.mapInArrow(run, f"{types}, embedding array<float>")


def encode_papers(papers: DataFrame, encoder: Encoder, batch_size: int = DEFAULT_BATCH, text_col: str = "abstract") -> DataFrame:
    return encode_column(papers, encoder, "paper_id", text_col, batch_size)


def count_empty(encoded: DataFrame) -> DataFrame:
    """One row: how many texts had no content to encode."""
    return encoded.agg(F.count_if(F.col("embedding").isNull()).alias("without_content"))
