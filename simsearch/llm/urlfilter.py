"""URL filtering with one bit-parallel automaton for all glob rules.

A rule is a glob over the canonical URL, host in lower case followed by the path: ``*`` stands for any run without a slash,
``**`` for any run, ``?`` for one character that is no slash. A host holds no slash, so a star in the host part never reaches the
path. A pattern of m characters has m + 1 states, one bit each; all patterns lie side by side in 64-bit words. One step reads
one byte of every URL of the batch: states whose next character matches move up by one bit, states under a star stay.

A base rule ``host/path/`` is the two globs ``host/path/**`` and ``*.host/path/**``; the longest base rule that fits decides. URLs
without one are blocked if a deny glob fits, else allowed.

Nulls and URLs without ``://`` have an empty host and path, fit no base rule and are allowed. Repeated rows are judged each; an
empty table gives no rows. URLs of any length are read whole, in groups of similar length. Ties: of fitting
rules of one length the first listed decides. Only ``page_id`` and ``url`` are read;
``keep`` returns every column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsearch.llm.common import ascii_lower, table

# The base rules (verdict, host, path).
BASE_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Own deny globs for URLs that no base rule covers.
DENY_GLOBS = ("*casino*/**", "*casino*", "*free-bets*/**", "*free-bets*", "*poker*/**", "*poker*", "ads.*/**", "*.ads.*/**", "**/adserver/**", "**.exe")
STEP_BYTES = 16 << 20


@dataclass(frozen=True)
class Glob:
    pattern: str
    name: str
    verdict: str
    rank: int  # the length of the rule: the longest wins


def base_globs() -> list[Glob]:
    rules = [(v, h, p, h + p) for v, h, p in BASE_RULES]
    return [Glob(start + name + "**", name, v, len(name)) for v, h, p, name in rules for start in ("", "*.")]


class Automaton:
    """Masks of all globs: ``step[c]`` has the states that byte c moves on, ``stay[c]`` those that it leaves in place."""

    def __init__(self, globs: list[Glob]):
        self.globs = globs
        parsed = [self._parse(g.pattern.encode()) for g in globs]
        bits = sum(len(p) for p, _ in parsed) + len(parsed)
        self.words = max(1, -(-bits // 64))
        step = np.zeros((256, self.words * 64), dtype=np.uint8)
        stay = np.zeros_like(step)
        start = np.zeros(self.words * 64, dtype=np.uint8)
        self.final, at = [], 0
        no_slash = np.array([c != 0x2F for c in range(256)])
        for literals, stars in parsed:
            start[at] = 1
            for i, c in enumerate(literals):
                step[:, at + i] = no_slash if c is None else np.arange(256) == c
            for i, anything in stars.items():
                stay[:, at + i] |= np.uint8(1) if anything else no_slash.astype(np.uint8)
            at += len(literals)
            self.final.append(at)
            at += 1
        pack = lambda x: np.packbits(x, axis=-1, bitorder="little").view(np.uint64)
        self.step, self.stay, self.start = pack(step), pack(stay), pack(start[None, :])

    @staticmethod
    def _parse(pattern: bytes) -> tuple[list[int | None], dict[int, bool]]:
        literals, stars, i = [], {}, 0
        while i < len(pattern):
            if pattern[i : i + 2] == b"**":
                stars[len(literals)] = True
                i += 2
            elif pattern[i : i + 1] == b"*":
                stars.setdefault(len(literals), False)
                i += 1
            else:
                literals.append(None if pattern[i : i + 1] == b"?" else pattern[i])
                i += 1
        return literals, stars

    def run(self, urls: list[bytes]) -> np.ndarray:
        """A row of booleans for each URL: which globs fit it whole."""
        lengths = np.array([len(u) for u in urls], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        out = np.zeros((len(urls), len(self.globs)), dtype=bool)
        at = 0
        while at < len(order):
            longest = max(1, int(lengths[order[at]]))
            # a URL's row of states and its bytes, and a boolean for each glob
            own = order[at : at + max(1, STEP_BYTES // (longest + 40 * self.words + len(self.globs)))]
            out[own] = self._accepted(self._simulate([urls[i] for i in own], lengths[own]))
            at += len(own)
        return out

    def _simulate(self, urls: list[bytes], lengths: np.ndarray) -> np.ndarray:
        """Final states of URLs in order of falling length."""
        state = np.repeat(self.start, len(urls), axis=0)
        width = int(lengths[0]) if len(lengths) else 0
        text = np.frombuffer(b"".join(u.ljust(width, b"\0") for u in urls), dtype=np.uint8).reshape(len(urls), width)
        for t in range(width):
            live = int(np.searchsorted(-lengths, -t, side="left"))  # those longer than t
            now, c = state[:live], text[:live, t]
            moved = now & self.step[c]
            shifted = moved << np.uint64(1)
            shifted[:, 1:] |= moved[:, :-1] >> np.uint64(63)
            state[:live] = shifted | (now & self.stay[c])
        return state

    def _accepted(self, state: np.ndarray) -> np.ndarray:
        return np.stack([(state[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1) == 1 for b in self.final], axis=1)


def canonical(pages: DataFrame, *carry) -> DataFrame:
    """The carried columns with ``host`` and ``path``."""
    part = lambda i: F.coalesce(F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)([^?#]*)", i), F.lit(""))
    return pages.select(*carry, ascii_lower(part(1)).alias("host"), part(2).alias("path"))


def judge(pages: DataFrame, *carry, rules: list[Glob] | None = None, deny: tuple[str, ...] = DENY_GLOBS) -> DataFrame:
    """The carried columns with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``."""
    globs = (base_globs() if rules is None else rules) + [Glob(p, "", "block", -1) for p in deny]
    rows = canonical(pages, *carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(globs)
        ranks = np.array([g.rank for g in globs])
        for batch in batches:
            urls = [(h + p).encode() for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            fits = automaton.run(urls)
            ruled = np.where(fits & (ranks >= 0), ranks, -1)
            best = ruled.argmax(axis=1)
            has = ruled.max(axis=1, initial=-1) >= 0
            denied = (fits & (ranks < 0)).any(axis=1)
            rule = [globs[b].name if h else None for b, h in zip(best, has, strict=True)]
            verdict = [globs[b].verdict if h else "block" if x else "allow" for b, h, x in zip(best, has, denied, strict=True)]
            columns = [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "rule", "verdict"])

    verdicts = [T.StructField(c, T.StringType()) for c in ("rule", "verdict")]
    return rows.mapInArrow(run, T.StructType(rows.schema.fields + verdicts))


def keep(pages: DataFrame) -> DataFrame:
    """The pages that are allowed, with the columns they came with."""
    return judge(pages, F.struct("*").alias("_row")).where("verdict = 'allow'").select("_row.*")


def op8_url_filter(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages"), "page_id")


SQL = r"""
WITH u AS (SELECT row_number() OVER () AS r, page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
k AS (SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')) AS x(v, h, p)),
b AS (SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v FROM u JOIN k
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r)
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN v
    WHEN (regexp_matches(host, 'casino|free-bets|poker') AND (path = '' OR starts_with(path, '/')))
        OR (regexp_matches(host, '^ads\.|\.ads\.') AND starts_with(path, '/'))
        OR contains(host || path, '/adserver/') OR ends_with(host || path, '.exe') THEN 'block' ELSE 'allow' END AS verdict
FROM u LEFT JOIN b USING (r)
"""
