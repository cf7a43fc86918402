"""Secret scanning: strong patterns alone, weak ones only where the parts of a credential stand together.

Base spans, leftmost and non-overlapping for each kind: ``assign`` (a named value of 12 characters or more), ``access`` (an access
identifier of 18 or more), ``hex`` (16 or more hexadecimal digits). They are always reported.

Weak candidates: ``ident`` (a named user, account or client), ``endpoint`` (an address with a scheme, or a named host) and
``opaque`` (20 or more characters of a token alphabet with capitals, small letters and digits). Parts play one of three roles:
identifier (access, ident), secret (assign, hex, opaque), endpoint. Scopes, the blocks of lines without an empty line between, are
intervals of the text; every part is joined to the one that holds it by binary search, and a weak part is linked if its scope
holds a part of a complementary role, however far: a secret needs an identifier or an endpoint, and these need a
secret. Only linked weak candidates are reported. A text with n parts costs n log n.

Positions are code points, ends exclusive. Each text is scanned whole, in the task that holds it. Nulls: a null text is empty. Repeated
rows are scanned each. An empty table gives no rows. ``redact`` returns every column it was given.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsearch.llm.common import map_slices, table

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_CHARS, ACCESS_CHARS = 12, 18
# Weak candidates.
IDENT = re.compile(r"""\b(?:user(?:name)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""", re.IGNORECASE | re.ASCII)
ENDPOINT = re.compile(r"""\b(?:[a-z][a-z0-9+]{1,11}://[^\s"'<>]+|(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.:-]{4,})""", re.ASCII)
OPAQUE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
KINDS = ("assign", "access", "hex", "ident", "endpoint", "opaque")
BASE = KINDS[:3]
ROLE = {"assign": "secret", "hex": "secret", "opaque": "secret", "access": "identifier", "ident": "identifier", "endpoint": "endpoint"}
PARTNERS = {"secret": ("identifier", "endpoint"), "identifier": ("secret",), "endpoint": ("secret",)}
SCOPE_END = re.compile(r"\n[\x20\t\r]*\n")
# Bytes without which a pattern cannot match; the text's ASCII lower case is searched.
NEEDS = {"assign": (b"passw", b"secret", b"token", b"api"), "ident": (b"user", b"login", b"account", b"client", b"key"), "endpoint": (b"://", b"host", b"endpoint", b"server")}
LONG_RUN, HEX_RUN = re.compile(rb"[A-Za-z0-9+/_-]{20}"), re.compile(rb"[0-9a-f]{16}")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    spans = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    spans += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    return spans + [(*m.span(), "hex") for m in HEX.finditer(text)]


def weak_spans(text: str) -> list[Span]:
    mixed = lambda s: any(c.isdigit() for c in s) and any(c.isupper() for c in s) and any(c.islower() for c in s)
    spans = [(*m.span(), "ident") for m in IDENT.finditer(text)] + [(*m.span(), "endpoint") for m in ENDPOINT.finditer(text)]
    return spans + [(*m.span(), "opaque") for m in OPAQUE.finditer(text) if mixed(m[0])]


def linked(text: str, base: list[Span], weak: list[Span]) -> list[Span]:
    """The weak candidates with a complementary part in their scope. A candidate that touches a base span adds nothing."""
    taken = sorted((s, e) for s, e, _ in base)
    starts = [s for s, _ in taken]
    furthest = list(itertools.accumulate((e for _, e in taken), max))
    free = [w for w in weak if not ((i := bisect.bisect_left(starts, w[1])) and furthest[i - 1] > w[0])]
    if not free:
        return []
    borders = [m.start() for m in SCOPE_END.finditer(text)]
    scope = lambda span: bisect.bisect_left(borders, span[0])
    roles = {(scope(span), ROLE[span[2]]) for span in base + free}
    return [w for w in free if any((scope(w), role) in roles for role in PARTNERS[ROLE[w[2]]])]


def spans_of(data: bytes) -> list[Span]:
    """All reported spans of one text, by start and then kind."""
    low = data.lower()
    has = {kind: any(n in low for n in needs) for kind, needs in NEEDS.items()}
    hexes, runs, access = HEX_RUN.search(data) is not None, LONG_RUN.search(data) is not None, b"AKIA" in data
    if not (has["assign"] or access or hexes or (runs and (has["ident"] or has["endpoint"]))):
        return []  # no secret of any strength, so nothing can be linked
    text = data.decode()
    base = base_spans(text)
    return sorted(base + linked(text, base, weak_spans(text)), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SCHEMA = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the base kinds, the digest of the base spans and all spans."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [spans_of(t) for t in batch.column("text").to_pylist()]
        base = [[s for s in spans if s[2] in BASE] for spans in found]
        counts = [pa.array([sum(s[2] == kind for s in spans) for spans in base], pa.int64()) for kind in BASE]
        digests = pa.array([hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base], pa.string())
        columns = [batch.column("doc_id"), *counts, digests, pa.array([joined(spans) for spans in found], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return map_slices(rows, "text", work, f"doc_id bigint, {SCHEMA}")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every reported span replaced by its kind in brackets, and ``n_chars`` (if there) brought up to date."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for data in batch.column("_text").to_pylist():
            spans = spans_of(data) if data is not None else []
            if data is None or not spans:
                texts.append(None if data is None else data.decode())
                continue
            text, parts, at = data.decode(), [], 0
            for start, end, kind in spans:
                if start >= at:
                    parts += [text[at:start], f"[{kind.upper()}]"]
                at = max(at, end)
            texts.append("".join([*parts, text[at:]]))
        return pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(texts, pa.string())], ["_row", "_text"])

    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    rest = F.struct(*[F.col(quoted(c)) for c in docs.columns if c != "text"]).alias("_row")
    rows = docs.select(rest, F.col("text").cast("binary").alias("_text"))
    schema = T.StructType([rows.schema["_row"], T.StructField("_text", T.StringType())])
    done = map_slices(rows, "_text", work, schema)
    length = F.length("_text").cast("bigint")
    return done.select(*[F.col("_text").alias("text") if c == "text" else length.alias(c) if c == "n_chars" else F.col(f"_row.{quoted(c)}") for c in docs.columns])


def op6_secret_scan(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))
