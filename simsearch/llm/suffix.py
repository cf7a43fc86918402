"""Exact substring dedup: what 50-byte strings share is found by merging shard Burrows-Wheeler transforms.

A byte of a document goes if a 50-byte string over it also starts in a document with a smaller id.

Dealing out. A 50-byte window is represented by the smallest hash among its 16-byte grams, so equal windows always meet under
one key. A run is a stretch of windows with one representative; its bytes are a fragment. Each task first merges equal fragments
of its own batch, then one row a distinct fragment and batch travels (half the key, 64 bits of hash of the fragment's own, and the
smallest id, never the text). Where a key has one fragment in several documents, all but the first lose it whole. Where it has several fragments, the smallest
document of each sends the bytes, now keyed by a second representative as well, so that even a very common gram is
split by what stands around it.

Merging. The fragments of some keys form shards. Each shard's suffixes are sorted once, which gives its transform (over four
bytes at a time). The shards are then interleaved: the merged order starts as shard after shard, and each round reads the transform
in the present order and deals it stably into the order by four more characters. Only shard numbers move; no suffix is
compared again. Rounds also carry the borders between suffixes that differ so far, which is the common-prefix information: in
the end suffixes without a border between them share 50 bytes. Each such interval has a smallest document; its other members are
repeats.

Nulls: a null text is empty; rows without an id are left as they are and remove nothing elsewhere. Rows that repeat an id
remove nothing from each other. Texts under 50 bytes lose nothing. An empty table gives no rows. Only ``doc_id`` and ``text`` are
read. A task holds one document, one bucket's hashes, and at most ``GROUP_ROWS`` bytes of different fragments under one key: a
key with more is cut by four representatives, and if need be by whole windows, and dealt out again. The number of buckets and partitions follows the bytes of text.
"""

from __future__ import annotations

import hashlib
import itertools
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.llm.common import map_slices, table
from simsearch.session import checkpoint

WINDOW, GRAM = 50, 16
RUN_WINDOWS = 64
CHUNK_BYTES, SLICE = 128 << 10, 2 << 20
SHARD_ROWS, MERGE_ROWS = 1 << 14, 1 << 17
GROUP_ROWS, MOST_REPRESENTATIVES = 1 << 20, 5
LEVELS = (2, 4, MOST_REPRESENTATIVES + 1)  # how many representatives a key has; beyond the most it is the whole window
PAD = 4
PLACE_BITS = 31  # a text has less than 2^31 bytes
PLACE = (1 << PLACE_BITS) - 1
BUCKETS_A_PARTITION, PARTITION_BYTES = 4, 32 << 20
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
LOW = np.uint64(0xFFFFFFFF)
NO_SIDE, ANY_SIDE = 0, 0xFFFF


def _grams(buf: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 16 bytes at each place, by doubling."""
    h = buf.astype(np.uint64) * _A
    h ^= h >> np.uint64(29)
    step = 1
    while step < GRAM:
        h = h[:-step] * _B + h[step:]
        h ^= h >> np.uint64(32)
        step *= 2
    return h * _A


def _sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    n, m, s = len(h) - w + 1, h, 1
    while 2 * s <= w:
        m = np.minimum(m[:-s], m[s:])
        s *= 2
    return np.minimum(m[:n], m[w - s : w - s + n]) if s < w else m[:n]


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that fit the processor's caches together."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > CHUNK_BYTES:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


class Windows:
    """The windows of a few texts that lie together, each with its representative."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"".join(texts)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.base = np.concatenate([[0], np.cumsum(sizes)])
        n = max(0, len(self.raw) - WINDOW + 1)
        self.grams = _grams(np.frombuffer(self.raw, dtype=np.uint8)) if n else np.zeros(0, dtype=np.uint64)
        self.least = _sliding_min(self.grams, WINDOW - GRAM + 1) if n else self.grams
        self.inside = np.ones(n, dtype=bool)
        for border in self.base[1:-1].tolist():  # windows over the end of a text
            self.inside[max(0, border - WINDOW + 1) : border] = False

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base, places, side="right") - 1


def _sides(near: Windows, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sixteen bits of hash of what stands on the left and on the right of each run's smallest gram.

    A window holds 34 bytes beside the gram, so two runs that share a window have the 17 bytes on one side of it in common. A run
    without a window that reaches so far on a side says ``NO_SIDE`` there; one that holds its gram twice says ``ANY_SIDE`` on both.
    """
    value, reach = near.least[first], WINDOW - GRAM
    place, found = np.zeros(len(first), dtype=np.int64), np.zeros(len(first), dtype=np.int64)
    also = np.zeros(len(first), dtype=np.int64)
    for d in range(reach + 1):  # the gram lies in the first window and in the last
        hit = near.grams[first + d] == value
        place[hit] = first[hit] + d
        found += hit
        also += near.grams[last + d] == value
    once = (found == 1) & (also == 1) & (place >= last)
    n = len(near.grams)
    side = lambda at: (near.grams[np.clip(at, 0, max(n - 1, 0))] % np.uint64(ANY_SIDE - 1)).astype(np.uint16) + np.uint16(1)
    middle = place - reach // 2
    left, right = (np.where(there, side(at), NO_SIDE) for there, at in ((first <= middle, place - GRAM), (last >= middle, place + GRAM)))
    return np.where(once, left, ANY_SIDE).astype(np.uint16), np.where(once, right, ANY_SIDE).astype(np.uint16)


class Runs:
    """The runs of some texts: the text each lies in, its first and last window there, its key and its fragment's hash, and
    (if asked for) the hashes beside its gram."""

    def __init__(self, texts: list[bytes], sides: bool = False):
        none = [np.zeros(0, dtype=kind) for kind in (np.int64, np.uint64, np.uint16)]
        parts: list[tuple[np.ndarray, ...]] = [(none[0],) * 3 + (none[1],) * 2 + (none[2],) * 2]
        digest = xxhash.xxh3_64_intdigest
        for lo, hi in _chunks(texts):
            near = Windows(texts[lo:hi])
            first, last = _runs(near.least, near.inside)
            text, raw = near.text_of(first), near.raw
            code = np.array([digest(raw[s : e + WINDOW]) for s, e in zip(first.tolist(), last.tolist(), strict=True)], dtype=np.uint64)
            beside = _sides(near, first, last) if sides else (none[2],) * 2
            parts.append((text + lo, first - near.base[text], last - near.base[text], near.least[first], code, *beside))
        self.text, self.first, self.last, self.key, self.code, self.left, self.right = map(np.concatenate, zip(*parts, strict=True))

    def borders(self, texts: int) -> np.ndarray:
        return np.searchsorted(self.text, np.arange(texts + 1))


def _runs(value: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of stretches with one value, cut into pieces of at most ``RUN_WINDOWS``."""
    change = value[1:] != value[:-1]
    if not len(value):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first = np.flatnonzero(inside & np.r_[True, change | ~inside[:-1]])
    last = np.flatnonzero(inside & np.r_[change | ~inside[1:], True])
    pieces = (last - first) // RUN_WINDOWS + 1
    if pieces.max(initial=1) > 1:
        order = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(first, pieces) + order * RUN_WINDOWS
        first, last = start, np.minimum(start + RUN_WINDOWS - 1, np.repeat(last, pieces))
    return first, last


def _packed_ids(ids: np.ndarray) -> bytes:
    """Sorted ids as steps, all lowest bytes first and all highest last: of small steps one byte each is left when compressed."""
    return np.diff(ids, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked_ids(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T.copy().view("<i8").ravel())


def _flat(doc: np.ndarray, code: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(doc, pa.int64()), pa.array(code.view(np.int64), pa.int64()), pa.array(owner, pa.bool_())]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "code", "owner"])


def _meeting(key: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of the different fragments, sorted by key, agree with another one of their key on a side of the gram."""
    meets = np.zeros(len(key), dtype=bool)
    for side in (left, right):
        both = key.astype(np.uint64) << np.uint64(16) | side
        _, inverse, counts = np.unique(both, return_inverse=True, return_counts=True)
        meets |= (counts[inverse] > 1) & (side != NO_SIDE)
    loose = np.unique(key[left == ANY_SIDE])
    return meets | np.isin(key, loose)


def _flags(texts: DataFrame, parts: int) -> DataFrame:
    """doc_id, covered (codes of fragments that a smaller document has), owned (codes of fragments to be compared)."""

    buckets = BUCKETS_A_PARTITION * parts
    columns = ["bucket", "key", "code", "left", "right", "doc", "g_doc", "g_code"]

    def summarise(batch: pa.RecordBatch) -> pa.RecordBatch:
        runs = Runs(batch.column("text").to_pylist(), sides=True)
        doc = batch.column("doc_id").to_numpy()[runs.text]
        spread = runs.key * _B  # the keys are smallest hashes, nearly all of them low; buckets must be even
        spread ^= spread >> np.uint64(32)
        order = np.lexsort((doc, runs.code, spread))
        key, code, doc, left, right = (x[order] for x in (spread, runs.code, doc, runs.left, runs.right))
        new = np.r_[True, (code[1:] != code[:-1]) | (key[1:] != key[:-1])] if len(code) else np.zeros(0, dtype=bool)
        least = np.repeat(doc[new], np.diff(np.r_[np.flatnonzero(new), len(doc)]))
        covered = doc > least  # a smaller document of this batch has the fragment
        bucket = ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        rows = []
        for b in range(buckets):
            lo, hi = np.searchsorted(bucket, [b, b + 1])
            own, gone = new[lo:hi], covered[lo:hi]
            by_doc = np.argsort(doc[lo:hi][own], kind="stable")
            if hi > lo:
                # of the key only the low half travels, the bucket stands for its highest bits; keys that agree in both are compared together
                sent = [x[lo:hi][own][by_doc] for x in ((key & LOW).astype(np.uint32), code, left, right, doc)]
                rows.append((b, *[x.tobytes() for x in sent[:-1]], _packed_ids(sent[-1]), *[x[lo:hi][gone].tobytes() for x in (doc, code)]))
        kinds = [pa.int32()] + [pa.binary()] * 7
        made = list(zip(*rows, strict=True)) if rows else [[]] * 8
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, kinds, strict=True)], columns)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One bucket after the other, so that a task holds the hashes of one."""
        now, held = None, []
        for batch in batches:
            for bucket, *sent, gone_doc, gone_code in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
                if bucket != now and held:
                    yield settle(held)
                    held = []
                now = bucket
                held.append(sent)
                if gone_doc:
                    gone = np.frombuffer(gone_doc, dtype=np.int64)
                    yield _flat(gone, np.frombuffer(gone_code, dtype=np.uint64), np.zeros(len(gone), dtype=bool))
        if held:
            yield settle(held)

    def settle(held: list[list[bytes]]) -> pa.RecordBatch:
        key, code, left, right = (np.frombuffer(b"".join(part), dtype=kind) for part, kind in zip(list(zip(*held, strict=True))[:4], (np.uint32, np.uint64, np.uint16, np.uint16), strict=True))
        doc = np.concatenate([_unpacked_ids(sent[4]) for sent in held])
        order = np.lexsort((doc, code, key))
        key, code, doc = key[order], code[order], doc[order]
        start = np.r_[True, key[1:] != key[:-1]]
        fresh = start | np.r_[True, code[1:] != code[:-1]]
        size = lambda border: np.diff(np.r_[np.flatnonzero(border), len(key)])
        least = np.repeat(doc[fresh], size(fresh))
        fragments = np.repeat(np.add.reduceat(fresh.astype(np.int64), np.flatnonzero(start)), size(start))
        documents = np.repeat(np.maximum.reduceat(doc, np.flatnonzero(start)) != np.minimum.reduceat(doc, np.flatnonzero(start)), size(start))
        covered = doc > least
        crowd = np.flatnonzero(fresh & (fragments > 1) & documents)  # different fragments of one key, one row each
        owner = np.zeros(len(key), dtype=bool)
        owner[crowd] = _meeting(key[crowd], left[order[crowd]], right[order[crowd]])
        keep = np.flatnonzero(covered | owner)
        keep = keep[np.argsort(doc[keep], kind="stable")]
        return _flat(doc[keep], code[keep], owner[keep])

    kinds = ", ".join(f"{c} {'int' if c == 'bucket' else 'binary'}" for c in columns)
    packed = map_slices(texts, "text", summarise, kinds)
    found = packed.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, "doc_id bigint, code bigint, owner boolean")
    pick = lambda owner: F.collect_set(F.when(F.col("owner") == owner, F.col("code")))
    return checkpoint(found.groupBy("doc_id").agg(pick(False).alias("covered"), pick(True).alias("owned")))


def _window_keys(near: Windows, representatives: int) -> np.ndarray:
    """A key of each window: its smallest grams in so many orders or, beyond the most, a hash of all its bytes."""
    if representatives > MOST_REPRESENTATIVES:
        n, key = len(near.least), np.zeros(len(near.least), dtype=np.uint64)
        for at in (0, GRAM, 2 * GRAM, WINDOW - GRAM):  # these grams cover the window
            key = (key ^ near.grams[at : at + n]) * _B
            key ^= key >> np.uint64(29)
        return key
    key = near.least
    for i in range(1, representatives):
        key = key * _B ^ _sliding_min((near.grams ^ np.uint64(i * int(_B) % (1 << 64))) * _A, WINDOW - GRAM + 1)
    return key


def _cut(near: Windows, inside: np.ndarray, representatives: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """The pieces of the windows ``inside``: key, text, first window there, bytes."""
    value = _window_keys(near, representatives)
    first, last = _runs(value, inside)
    text = near.text_of(first)
    body = [near.raw[s : e + WINDOW] for s, e in zip(first.tolist(), last.tolist(), strict=True)]
    return value[first].view(np.int64), text, first - near.base[text], body


FRAGMENTS = "key bigint, doc_id bigint, start bigint, body binary"


def _mark(text: bytes) -> int:
    """Tells texts apart that share an id; it stands above the place in each range, so that ranges of one are not cut out of the other."""
    return xxhash.xxh3_64_intdigest(text) & 0xFFFFFFFF


def _pieces(key: list[np.ndarray], doc: list[np.ndarray], start: list[np.ndarray], body: list[bytes]) -> pa.RecordBatch:
    none = [np.zeros(0, dtype=np.int64)]
    arrays = [pa.array(np.concatenate(x or none), pa.int64()) for x in (key, doc, start)] + [pa.array(body, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["key", "doc_id", "start", "body"])


def _fragments(owners: DataFrame) -> DataFrame:
    """key, doc_id, start, body: the owned fragments, cut again where a second representative changes."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, ids = batch.column("text").to_pylist(), batch.column("doc_id").to_numpy()
        marks = np.array([_mark(t) for t in texts], dtype=np.int64) << PLACE_BITS
        wanted = [np.array(c, dtype=np.int64).view(np.uint64) for c in batch.column("owned").to_pylist()]
        runs = Runs(texts)
        borders = runs.borders(len(texts))
        key, doc, start, body = [], [], [], []
        for lo, hi in _chunks(texts):
            near = Windows(texts[lo:hi])
            chosen = np.zeros(len(near.least) + 1, dtype=np.int64)
            for i in range(lo, hi):
                own = slice(borders[i], borders[i + 1])
                hit = np.isin(runs.code[own], wanted[i])
                np.add.at(chosen, runs.first[own][hit] + near.base[i - lo], 1)
                np.add.at(chosen, runs.last[own][hit] + near.base[i - lo] + 1, -1)
            inside = np.cumsum(chosen[:-1]) > 0
            if not inside.any():
                continue
            keys, text, first, bodies = _cut(near, inside, 2)
            key.append(keys)
            doc.append(ids[lo + text])
            start.append(first + marks[lo + text])
            body += bodies
        return _pieces(key, doc, start, body)

    return map_slices(owners, "text", work, FRAGMENTS, SLICE)


class Shard:
    """Sorted suffixes of some fragments and their transform: what stands four (and two) bytes before each.

    Bytes are raised by one (255 is in no UTF-8 text) and each fragment gets four zero bytes. Rows are places; the four end rows of
    a fragment come first. A symbol of zero says that nothing stands there.
    """

    def __init__(self, bodies: list[bytes]):
        longest = max(map(len, bodies)) + PAD
        sizes = np.array([len(b) + PAD for b in bodies], dtype=np.int64)
        base = np.cumsum(sizes) - sizes
        joined = np.frombuffer((b"\xff" * PAD).join(bodies) + b"\xff" * PAD, dtype=np.uint8)
        text = np.zeros(len(joined) + longest, dtype=np.uint8)
        text[: len(joined)] = joined + np.uint8(1)  # the separators wrap to zero
        self.fragment = np.repeat(np.arange(len(bodies)), sizes)
        place = np.arange(len(joined)) - base[self.fragment]
        left = sizes[self.fragment] - PAD - place
        self.window = left >= WINDOW
        end = left <= 0
        wide = np.lib.stride_tricks.sliding_window_view(text, longest)[: len(joined)].copy()
        wide[np.arange(longest) >= left[:, None]] = 0
        order = np.argsort(wide.view(f"S{longest}").ravel(), kind="stable")
        self.order = np.concatenate([np.flatnonzero(end), order[~end[order]]])
        self.ends = int(end.sum())
        self.place = place
        pair = text[:-1].astype(np.uint32) << np.uint32(8) | text[1:]
        four = pair[:-2] << np.uint32(16) | pair[2:]
        at = self.order
        before = lambda of, step: np.where(place[at] >= step, of[at - step], np.uint32(0))
        self.transform = {4: before(four, 4), 2: before(pair, 2)}


def interleave(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The merged order as row numbers (shard after shard, each in its own order) and True where ``depth`` bytes, an even number,
    differ from the row before."""
    sizes = [len(s.order) for s in shards]
    number = np.uint8 if len(shards) <= 1 << 8 else np.uint16 if len(shards) <= 1 << 16 else np.uint32
    ends = sum(s.ends for s in shards)
    end_shards = np.repeat(np.arange(len(shards), dtype=number), [s.ends for s in shards])
    symbols = {step: np.concatenate([s.transform[step] for s in shards]) for step in (4, 2)}
    named, fours = np.unique(symbols[4], return_inverse=True)
    small = len(named) <= 1 << 16  # four-byte symbols by their rank, if 16 bits can number them
    symbols = {4: fours.astype(np.uint16) if small else None, 2: symbols[2].astype(np.uint16)}
    rounds = [4] * (depth // 4) + [2] * (depth % 4 // 2) if small else [2] * (depth // 2)
    shard = np.repeat(np.arange(len(shards), dtype=number), sizes)
    rows = np.arange(len(shard), dtype=np.int32)
    count = np.arange(len(shard), dtype=np.int32)
    block = np.zeros(len(shard), dtype=np.int32)
    border = np.ones(len(shard), dtype=bool)
    for step in rounds:
        symbol = symbols[step][rows]
        source = np.flatnonzero(symbol)
        symbol = symbol[source]
        order = np.argsort(symbol, kind="stable")
        source, symbol = source[order], symbol[order]
        shard = np.concatenate([end_shards, shard[source]])
        before = block[source]
        border[: ends + 1] = True
        np.logical_or(symbol[1:] != symbol[:-1], before[1:] != before[:-1], out=border[ends + 1 :])
        block = np.cumsum(border, dtype=np.int32)
        rows[np.argsort(shard, kind="stable")] = count
    return rows, border


def _repeats(bodies: list[bytes], docs: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(fragment, first, last) windows that also stand in a fragment of a smaller document."""
    shards, at = [], 0
    while at < len(bodies):
        end, rows = at, 0
        while end < len(bodies) and (rows == 0 or rows + len(bodies[end]) + PAD <= SHARD_ROWS):
            rows += len(bodies[end]) + PAD
            end += 1
        shards.append((at, Shard(bodies[at:end])))
        at = end
    rows, border = interleave([s for _, s in shards], WINDOW)
    fragment = np.concatenate([s.fragment[s.order] + first for first, s in shards])[rows]
    place = np.concatenate([s.place[s.order] for _, s in shards])[rows]
    window = np.concatenate([s.window[s.order] for _, s in shards])[rows]
    starts = np.flatnonzero(border)
    doc = docs[fragment]
    least = np.repeat(np.minimum.reduceat(np.where(window, doc, np.iinfo(np.int64).max), starts), np.diff(np.r_[starts, len(rows)]))
    hit = np.flatnonzero(window & (doc > least))
    hit = hit[np.lexsort((place[hit], fragment[hit]))]
    f, p = fragment[hit], place[hit]
    if len(hit):
        fresh = np.r_[True, (f[1:] != f[:-1]) | (p[1:] != p[:-1] + 1)]
        last = np.r_[fresh[1:], True]
        yield from zip(f[fresh].tolist(), p[fresh].tolist(), p[last].tolist(), strict=True)


Group = dict[bytes, tuple[int, list[int]]]  # fragment -> its smallest document, starts there


def _gathered(rows: Iterator[tuple[int, int, bytes]], group_rows: int, group: Group) -> Iterator[tuple[int, int, int]]:
    """Fill ``group`` from rows (document, start, fragment) in the order of documents until it is crowded; the ranges of copies."""
    size = 0
    for doc, start, body in rows:
        held = group.get(body)
        if held is None:
            group[body] = (doc, [start])
            size += len(body) + PAD
            if size > group_rows and len(group) > 1:
                return
        elif doc > held[0]:
            yield doc, start, start + len(body)
        else:
            held[1].append(start)


def _rows_in(group: Group) -> int:
    return sum(map(len, group)) + PAD * len(group)


def _merge(group: Group) -> Iterator[tuple[int, int, int]]:
    bodies = list(group)
    if len(bodies) > 1:
        for f, first, last in _repeats(bodies, np.array([d for d, _ in group.values()], dtype=np.int64)):
            doc, starts = group[bodies[f]]
            yield from ((doc, s + first, s + last + WINDOW) for s in starts)


def _recut(rows: Iterator[tuple[int, int, bytes]], representatives: int) -> Iterator[tuple]:
    """(key, document, start, None, piece): the rows cut by more representatives, a few at a time."""
    while chunk := list(itertools.islice(rows, CHUNK_BYTES >> 6)):
        near = Windows([body for _, _, body in chunk])
        keys, text, first, bodies = _cut(near, near.inside, representatives)
        for key, i, place, body in zip(keys.tolist(), text.tolist(), first.tolist(), bodies, strict=True):
            yield key, chunk[i][0], chunk[i][1] + place, None, body


def _ranges(rows: Iterator[tuple[int, int, int, bytes]], group_rows: int, further: int) -> Iterator[tuple]:
    """Of rows (key, document, start, fragment), which come by key and document: (document, document, first, last, None) of the repeats, and
    for a key with more different fragments than are merged at once its fragments cut by ``further`` representatives (if there are
    any to cut by), (key, document, start, None, piece)."""
    found = lambda ranges: ((r[0], *r, None) for r in ranges)
    pending: Group = {}  # of whole keys
    size = 0
    for _, own in itertools.groupby(rows, key=operator.itemgetter(0)):
        group: Group = {}
        members = map(operator.itemgetter(1, 2, 3), own)
        yield from found(_gathered(members, group_rows, group))
        if len(group) < 2:
            continue
        held = _rows_in(group)
        if held > group_rows and further:
            again = itertools.chain(((d, s, b) for b, (d, starts) in group.items() for s in starts), members)
            yield from _recut(again, further)
            continue
        pending.update(group)
        size += held
        if size >= MERGE_ROWS:
            yield from found(_merge(pending))
            pending, size = {}, 0
    yield from found(_merge(pending))


def _compared(fragments: DataFrame, group_rows: int, parts: int) -> DataFrame:
    """doc_id, first, last: byte ranges that repeat a smaller document, from the merged transforms of each key's fragments.

    What crowded keys leave is dealt out anew by longer keys, through the cluster's own exchange; the last keys are those of whole
    windows, under which only equal pieces meet. Ranges that are found travel along, so that all is one plan.
    """
    names = ["key", "doc_id", "start", "last", "body"]
    rows = fragments.select("key", "doc_id", "start", F.lit(None).cast("bigint").alias("last"), "body")
    for representatives, further in zip(LEVELS, [*LEVELS[1:], 0], strict=True):

        def run(batches: Iterator[pa.RecordBatch], representatives=representatives, further=further) -> Iterator[pa.RecordBatch]:
            done: list[pa.RecordBatch] = []

            def undone() -> Iterator[tuple[int, int, int, bytes]]:
                for batch in batches:
                    found = batch.column("last").is_valid()
                    done.append(batch.filter(found))
                    own = batch.filter(pc.invert(found))
                    yield from zip(*[own.column(c).to_pylist() for c in ("key", "doc_id", "start", "body")], strict=True)

            ranges = _ranges(undone(), group_rows, further)
            while part := list(itertools.islice(ranges, 1 << 14)):
                columns = [pa.array(c, k) for c, k in zip(zip(*part, strict=True), [pa.int64()] * 4 + [pa.binary()], strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)
                yield from done
                done.clear()
            yield from done

        rows = rows.repartition(parts, "key").sortWithinPartitions("key", "doc_id").mapInArrow(run, "key bigint, doc_id bigint, start bigint, last bigint, body binary")
    return rows.select("doc_id", F.col("start").alias("first"), "last")


def _merged(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    spans: list[tuple[int, int]] = []
    for i in np.argsort(first, kind="stable").tolist():
        s, e = int(first[i]), int(last[i])
        if spans and s <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(e, spans[-1][1]))
        else:
            spans.append((s, e))
    return spans


def removals(docs: DataFrame, with_text: bool = True, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end, start, end ... in bytes) and, if asked for, kept (the rest)."""
    spark = docs.sparkSession
    # an id that needs no cast gets no alias either: only then do both joins below read one exchange of the texts
    number = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("bigint").alias("doc_id")
    texts = docs.select(number, F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    known = texts.where("doc_id IS NOT NULL")
    flags = _flags(known, parts)
    owners = known.join(flags.where(F.size("owned") > 0).select("doc_id", "owned"), "doc_id")
    spans = _compared(_fragments(owners), group_rows, parts).groupBy("doc_id").agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))
    marks = flags.select("doc_id", "covered").join(spans, "doc_id", "left")
    nothing = [F.lit(None).cast("array<bigint>").alias(c) for c in ("covered", "firsts", "lasts")]
    rows = known.join(marks, "doc_id", "left").unionByName(texts.where("doc_id IS NULL").select("*", *nothing))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        data = batch.column("text").to_pylist()
        covered, firsts, lasts = (batch.column(c).to_pylist() for c in ("covered", "firsts", "lasts"))
        runs = Runs([t if c else b"" for t, c in zip(data, covered, strict=True)])
        borders = runs.borders(len(data))
        out = []
        for i, text in enumerate(data):
            lo, hi = borders[i], borders[i + 1]
            first, last = np.array(firsts[i] or [], dtype=np.int64), np.array(lasts[i] or [], dtype=np.int64)
            if len(first):
                own = first >> PLACE_BITS == _mark(text)
                first, last = first[own] & PLACE, last[own] & PLACE
            if covered[i]:
                hit = lo + np.flatnonzero(np.isin(runs.code[lo:hi], np.array(covered[i], dtype=np.int64).view(np.uint64)))
                first = np.concatenate([first, runs.first[hit]])
                last = np.concatenate([last, runs.last[hit] + WINDOW])
            spans = _merged(first, last)
            kept, at = [], 0
            for s, e in spans:
                kept.append(text[at:s])
                at = e
            rest = b"".join([*kept, text[at:]])
            out.append((len(text), len(text) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), [x for s in spans for x in s], rest if with_text else None))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary()]
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<bigint>, kept binary"
    return map_slices(rows, "text", cut, schema, SLICE)


def op4_suffix_dedup(spark, sf_dir):
    found = removals(table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, 100) AS win FROM (SELECT r, doc_id, h, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50)),
x AS (SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY win) AS least FROM w) WHERE doc_id > least),
s AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM x),
g AS (SELECT r, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run FROM s),
q AS (SELECT r, run, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY r, run),
p AS (SELECT d.r, run, a, coalesce(lag(b) OVER (PARTITION BY d.r ORDER BY run), 0) AS from_, h FROM q JOIN d USING (r)),
k AS (SELECT r, string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY run) AS parts FROM p GROUP BY r),
t AS (SELECT r, max(b) AS tail, sum(b - a) AS removed, count(*) AS spans FROM q GROUP BY r)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
    sha256(unhex(coalesce(parts, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (r) LEFT JOIN t USING (r)
"""
