"""MinHash near-duplicates, with odd sketches between the bands and the exact check.

Sets. A text's distinct word shingles (ASCII lower case; the whole sequence if there are fewer words; none without words). Two
texts are linked if 100 |common| >= percent |union|.

Samples. Each of ``SAMPLES`` multiplicative orders of the 64-bit shingle hashes gives its least value. Bands of five values are the
candidate keys: two sets at exactly 0.8 share none of the forty with probability 2e-7, more similar ones far less. An odd sketch folds all
samples into a bitmap: sample i with value v flips one bit, so equal samples of two texts cancel in the XOR and the bits left over tell
how many samples differ. Candidates whose bits left over are ``SIGMAS`` deviations beyond what 0.8 gives, or whose set sizes
rule 0.8 out, are dropped before any text moves. All others are compared as whole sets of words, so no link rests on a hash.

Candidates. Equal texts are one node. Of the smallest nodes under its keys, each node first tries the one it shares most bands with.
What is linked then is one group, and only pairs of different groups remain: a key that holds several groups compares
the members outside its largest group with all members, by bitmaps, in blocks of bounded size, and those with a candidate once more by whole sets. So no
pair within a key goes unseen, no pair but a link leaves its task, and a key full of copies costs a pass over it. Keys that hold many nodes are split: their table is
broadcast and their rows stay where they are, or they are dealt out in blocks. A center's text is sent once for ``STAR`` of its pairs.

Groups are the connected components; a group's id is its smallest document id.

Defined results: a null or wordless text has an empty set and is its own group. A null id never names a group that has another id; its
row is kept only if its group has none. Repeated rows get a row each. Rows that share an id but not the text are different
nodes. An empty table gives no rows. Very long texts are read whole, a batch's bytes are bounded. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simsearch.llm.common import bounded_broadcast, map_slices, stored, table
from simsearch.llm.graph import components
from simsearch.llm.simhash import shingle_hashes
from simsearch.operators.skew import join_group

WORDS, PERCENT = 4, 80
BANDS, BAND_ROWS = 40, 5
SAMPLES = BANDS * BAND_ROWS
SKETCH_LONGS, SIGMAS = 8, 6.5
SKETCH_BITS = 64 * SKETCH_LONGS
SLICE = 4 << 20
STAR, BLOCK, BLOCK_SHINGLES = 2_000, 1_024, 1 << 20
SKETCH = [f"o{i}" for i in range(SKETCH_LONGS)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer; also the rule that makes the orders' multipliers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


ORDERS = mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def samples(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The least value of each set in each order; ``starts`` are the places in ``hashes`` where the sets, none empty, begin."""
    out = np.empty((len(starts), SAMPLES), dtype=np.uint64)
    for i, order in enumerate(ORDERS):
        out[:, i] = np.minimum.reduceat(hashes * order, starts)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """Forty keys a set, from five samples each and the band's number."""
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(least), BANDS))
    for i in range(BAND_ROWS):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) ^ least[:, i::BAND_ROWS])
    return keys.view(np.int64)


def odd_sketches(least: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the samples: one row of ``SKETCH_LONGS`` words a set."""
    at = mixed(least ^ ORDERS) % np.uint64(SKETCH_BITS)
    flat = (np.arange(len(least))[:, None] * SKETCH_BITS + at.astype(np.int64)).ravel()
    odd = np.bincount(flat, minlength=len(least) * SKETCH_BITS).reshape(len(least), SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8), axis=1, bitorder="little").view(np.uint64).view(np.int64)


def most_bits(percent: int) -> int:
    """Bits that may be left over in the XOR of two sketches at the similarity, ``SIGMAS`` deviations included.

    ``differ`` of the samples differ, a binomial number, and flip two bits each. Of m bits, f flips leave
    m / 2 (1 - (1 - 2 / m)^f) odd ones in the mean; their variance is that of flips at random places plus what ``differ`` adds.
    """
    share, m = 1 - percent / 100, SKETCH_BITS
    flips = 2 * SAMPLES * share
    same, both = (1 - 2 / m) ** flips, (1 - 4 / m) ** flips
    of_places = m / 4 + m * (m - 1) / 4 * both - m * m / 4 * same * same
    of_samples = SAMPLES * share * (1 - share) * (2 * same) ** 2
    return math.ceil(m / 2 * (1 - same) + SIGMAS * math.sqrt(of_places + of_samples))


def _identity() -> Column:
    return F.substring(F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)), 1, 16)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, key (128 bits that stand for the text), n (set size), bands, o0 ... (the odd sketch); bands are empty for an empty set."""
    names = ["doc_id", "key", "n", "bands", *SKETCH]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [np.unique(shingle_hashes(t, words)) for t in batch.column("text").to_pylist()]
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        full = np.flatnonzero(sizes)
        bands, odd = np.zeros((0, BANDS), dtype=np.int64), np.zeros((len(sets), SKETCH_LONGS), dtype=np.int64)
        if len(full):
            starts = np.cumsum(sizes[full]) - sizes[full]
            least = samples(np.concatenate([sets[i] for i in full]), starts)
            bands, odd[full] = band_keys(least), odd_sketches(least)
        offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.ravel()))
        columns = [batch.column("doc_id"), batch.column("key"), pa.array(sizes), listed, *[pa.array(odd[:, i]) for i in range(SKETCH_LONGS)]]
        return pa.RecordBatch.from_arrays(columns, names)

    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _identity().alias("key"), text)
    longs = ", ".join(f"{c} bigint" for c in SKETCH)
    return map_slices(rows, "text", work, f"doc_id bigint, key binary, n bigint, bands array<bigint>, {longs}", SLICE)


def _side(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.select(F.col("node").alias(name), F.col("n").alias(f"{name}_n"), *[F.col(c).alias(f"{name}_{c}") for c in SKETCH])


def _estimated(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches allow, with ``left``, the bits left over. ``a`` may be in any share of the pairs."""
    per_center = pairs.groupBy("a").agg(F.count("*").alias("pairs"))
    centers = _side(nodes, "a").join(per_center, "a")
    both = join_group(pairs.join(_side(nodes, "b"), "b"), centers, "a", "pairs")
    left = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in SKETCH), F.lit(0))
    sizes = 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
    return both.where(sizes).select("a", "b", left.alias("left")).where(F.col("left") <= most_bits(percent))


def shingle_set(text: bytes, words: int) -> set[bytes]:
    found = text.lower().split()
    if len(found) < words:
        return {b" ".join(found)} if found else set()
    return set(map(b" ".join, zip(*[found[i:] for i in range(words)], strict=False)))


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that whole sets confirm. A center a's text is sent once for about ``STAR`` pairs, every b's once a pair."""
    pairs = stored(pairs.select("a", "b"))
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).cast("int").alias("parts")).where("parts > 1")
    counts = stored(counts)
    counts = bounded_broadcast(counts, counts.count())  # one row for each STAR pairs at most
    part = F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("int").alias("part")
    dealt = pairs.join(counts, "a", "left").select("a", "b", part)
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct().join(nodes, "node")
    texts = _texts(stored(wanted.select("node", "key", "first")), docs)
    members = dealt.join(texts.withColumnRenamed("node", "b"), "b").select("a", "part", "b", "text")
    centers = dealt.select("a", "part").distinct().join(texts.withColumnRenamed("node", "a"), "a").select("a", "part", F.lit(None).cast("bigint").alias("b"), "text")
    stars = members.union(centers).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center: set[bytes] = set()
        for batch in batches:
            keep = []
            for b, text in zip(batch.column("b").to_pylist(), batch.column("text"), strict=True):
                own = shingle_set(text.as_py(), words)
                if b is None:
                    center = own
                    keep.append(False)
                else:
                    common = len(center & own)
                    keep.append(100 * common >= percent * (len(center) + len(own) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stars.mapInArrow(run, "a bigint, b bigint")


def _texts(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of ``wanted(node, key, first)``: of equal texts the row with the node's first id is read; rows that repeat it too are one."""
    held = bounded_broadcast(wanted, wanted.count())
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _identity().alias("key"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.join(held, "key").where(F.col("doc_id").eqNullSafe(F.col("first"))).groupBy("node").agg(F.first("text").alias("text"))


class Met:
    """Rows of one block, and its candidates: pairs of different groups that sizes and sketches allow and whose first common band is the
    block's, so that a pair which shares several keys is looked at under one."""

    def __init__(self, rows: list[pa.RecordBatch], percent: int, limit: int):
        column = lambda c: np.concatenate([r.column(c).to_numpy() for r in rows])
        self.side, self.node, self.root, self.n = map(column, ("side", "node", "root", "n"))
        self.odd = np.stack([column(c) for c in SKETCH], axis=1).view(np.uint64)
        self.bands = np.concatenate([r.column("bands").flatten().to_numpy() for r in rows]).reshape(-1, BANDS)
        self.band = int(rows[0].column("band")[0].as_py())
        self.percent, self.limit = percent, limit

    def candidates(self) -> Iterator[tuple[int, np.ndarray]]:
        """(place of a left row, places of right rows)."""
        right = np.flatnonzero(self.side == 1)
        order = right[np.argsort(self.n[right], kind="stable")]
        sizes = self.n[order]
        for i in np.flatnonzero(self.side == 0).tolist():
            lo = int(np.searchsorted(sizes * 100, self.n[i] * self.percent))
            hi = int(np.searchsorted(sizes * self.percent, self.n[i] * 100, side="right"))
            near = order[lo:hi]
            near = near[self.root[near] != self.root[i]]
            near = near[np.bitwise_count(self.odd[near] ^ self.odd[i]).sum(axis=1, dtype=np.int64) <= self.limit]
            near = near[(self.bands[near] == self.bands[i]).argmax(axis=1) == self.band]
            if len(near):
                yield i, near


UNIT = ["key", "l", "r"]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The rows of one block after the other; rows come sorted by block."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in UNIT])
        borders = np.flatnonzero(np.any(keys[:, 1:] != keys[:, :-1], axis=0)) + 1
        for lo, hi in zip([0, *borders.tolist()], [*borders.tolist(), batch.num_rows], strict=True):
            if tuple(keys[:, lo]) != now and held:
                yield held
                held = []
            now = tuple(keys[:, lo])
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield held


def _across(keyed: DataFrame, roots: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) under one key between different groups, by whole sets, as many as join what such links join.

    Of a key with several groups, the members outside its largest group meet all members, in blocks of bounded rows and set sizes. A first pass over
    the blocks reads sketches and keeps the rows that have a candidate; a second one reads these rows' texts and compares
    their sets. No pair leaves a task but a link between groups that the block has not joined yet.
    """
    placed = nodes.join(roots, "node", "left").select("node", "n", F.coalesce("root", "node").alias("root"), "bands", *SKETCH)
    sums = (F.count("*").alias("members"), F.sum("n").alias("weight"))
    by_group = keyed.join(placed.select("node", "root", "n"), "node").groupBy("key", "root").agg(*sums)
    total = lambda c: F.sum(c).alias(c)
    several = by_group.groupBy("key").agg(F.max_by(F.struct("root", "members", "weight"), F.struct("members", "root")).alias("main"), total("members"), total("weight"), F.count("*").alias("groups"))
    cells = lambda members, weight: F.ceil(F.greatest(members / BLOCK, weight / BLOCK_SHINGLES)).cast("int")
    lefts = cells(F.col("members") - F.col("main.members"), F.col("weight") - F.col("main.weight")).alias("lefts")
    several = stored(several.where("groups > 1").select("key", F.col("main.root").alias("main"), "members", lefts, cells(F.col("members"), F.col("weight")).alias("rights")))
    rows = join_group(keyed, several, "key", "members").join(placed, "node")
    deal = lambda salt, parts: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    carried = ["key", "band", "node", "root", "n", "bands", *SKETCH]
    outside = rows.where("root <> main").select(*carried, deal(1, "lefts").alias("l"), every("rights").alias("r"), F.lit(0).alias("side"))
    whole = rows.select(*carried, every("lefts").alias("l"), deal(2, "rights").alias("r"), F.lit(1).alias("side"))
    dealt = outside.unionByName(whole).repartition(*UNIT).sortWithinPartitions(*UNIT, "side")
    limit = most_bits(percent)

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _blocks(batches):
            used = np.zeros(sum(r.num_rows for r in own), dtype=bool)
            for i, near in Met(own, percent, limit).candidates():
                used[i] = used[near] = True
            if used.any():
                yield pa.Table.from_batches(own).filter(pa.array(used)).combine_chunks().to_batches()[0]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _blocks(batches):
            met = Met(own, percent, limit)
            sets = [np.unique(shingle_hashes(t.as_py(), words)) for r in own for t in r.column("text")]
            joined: dict[int, int] = {}

            def group(x: int, joined=joined) -> int:
                while x in joined:
                    x = joined[x]
                return x

            links = []
            for i, near in met.candidates():
                for j in near.tolist():
                    x, y = group(int(met.root[i])), group(int(met.root[j]))
                    if x != y:
                        common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                        if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                            joined[x] = y
                            links.append(sorted((int(met.node[i]), int(met.node[j]))))
            columns = [pa.array([link[k] for link in links], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    chosen = stored(dealt.mapInArrow(screen, dealt.schema))
    texts = _texts(stored(chosen.select("node").distinct().join(nodes, "node").select("node", nodes["key"].alias("key"), "first")), docs)
    again = chosen.join(texts, "node").repartition(*UNIT).sortWithinPartitions(*UNIT, "side")
    return again.mapInArrow(compare, "a bigint, b bigint").distinct()


def near_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row a document."""
    rows = stored(sketches(docs, words))
    copies = rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    one = rows.where("n > 0").dropDuplicates(["key"]).select("key", "n", "bands", *SKETCH)
    nodes = stored(one.join(copies, "key").withColumn("node", F.monotonically_increasing_id()))
    keyed = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("members")).where("members > 1")
    keyed = stored(join_group(keyed, shared, "key", "members"))  # nodes that are alone under a key drop out
    # of the smallest nodes under its keys, each node tries the one it shares the most bands with
    shares = keyed.where("a <> node").groupBy("a", F.col("node").alias("b")).agg(F.count("*").alias("shared"))
    best = shares.groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a"))
    tried = stored(_estimated(stored(best.select("a", "b")), nodes, percent))
    roots = stored(components(_confirmed(tried, nodes, docs, words, percent)))
    untried = stored(_across(keyed.select("key", "band", "node"), roots, nodes, docs, words, percent))
    grouped = nodes.select("node", "key", "first", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    if not untried.isEmpty():
        group = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
        found = _confirmed(untried, nodes, docs, words, percent).join(group("a"), "a", "left").join(group("b"), "b", "left")
        over = components(found.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")))
        over = over.select(F.col("node").alias("root"), F.col("root").alias("top"))
        grouped = grouped.join(over, "root", "left").withColumn("root", F.coalesce("top", "root"))
    grouped = stored(grouped.select("key", "root", "first", "copies"))
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    named = grouped.join(smallest, "root").select("key", "component_id", "copies")
    linked = join_group(rows.where("n > 0").select("doc_id", "n", "key"), named, "key", "copies").select("doc_id", "n", "component_id")
    alone = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    every = linked.unionByName(alone)
    return every.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op12_odd_sketch_dedup(spark, sf_dir):
    return near_groups(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS g
    FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
c AS (SELECT x.r AS a, y.r AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.r < y.r GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON a = x.r JOIN n y ON b = y.r WHERE 100 * common >= 80 * (x.n + y.n - common)),
ways AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT r, r AS other FROM d UNION SELECT reach.r, ways.b FROM reach JOIN ways ON reach.other = ways.a),
m AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.other GROUP BY reach.r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)
"""
