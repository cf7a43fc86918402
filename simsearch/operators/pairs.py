"""Positive and contrastive text pairs drawn by subject.

Ids first, text last: draws become positions, positions become paper ids, and the wide text
column is read once, only for the ids that were drawn.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simsearch.functions.keyed import h48
from simsearch.operators.positions import SubjectIndex, index_subjects
from simsearch.operators.skew import MAX_BROADCAST_GROUPS, hint_if, join_group
from simsearch.session import checkpoint

# a drawn id costs about 50 bytes when broadcast, so this bounds the broadcast near 100 MB
MAX_BROADCAST_DRAWS = 2_000_000
MIN_DRAWS_A_COPY = 64
MAX_COPIED_PAPERS = 100_000
MIN_PART_PAIRS = 1 << 16
MAX_PARTS = 6
RANGE_CELLS = 1024


@dataclass(frozen=True)
class PairConfig:
    num_pairs: int = 100_000
    text_field: str = "abstract"
    seed: int = 42
    balanced: bool = True
    epoch: int = 0
    negatives_min_rows: int = 2

    @property
    def key(self) -> str:
        return f"{self.seed}.{self.epoch}"


@dataclass(frozen=True)
class Indexed:
    """A subject index with its totals; ``small`` when the subjects are few enough to broadcast."""

    subjects: DataFrame
    rows: SubjectIndex
    n_subjects: int
    n_rows: int
    small: bool


def index_papers(papers: DataFrame, cfg: PairConfig, min_rows: int = 2) -> Indexed:
    """What the draws of every epoch of one seed share."""
    made = index_subjects(papers, cfg.seed, min_rows)
    totals = made.subjects.agg(F.count("*").alias("s"), F.sum("n").alias("rows")).first()
    if totals["s"] == 0:
        raise ValueError("no subject has two rows: there is no pair to draw")
    small = totals["s"] <= MAX_BROADCAST_GROUPS
    return Indexed(hint_if(made.subjects, small), made, totals["s"], totals["rows"], small)


def _draws(papers: DataFrame, cfg: PairConfig, first: int, last: int) -> DataFrame:
    return papers.sparkSession.range(first, last).withColumnRenamed("id", "pair_id")


def _rows_of_subject(draws: DataFrame, index: Indexed, balanced: bool) -> DataFrame:
    """Attach ``subject, n, lo`` to every draw ``r``: uniform over subjects or by their size."""
    subjects = index.subjects
    if balanced:
        return draws.withColumn("ix", F.col("r") % index.n_subjects).join(subjects, "ix")
    # r % n_rows falls into one subject's [lo, lo + n). Cut the range into cells so that the
    # lookup is an equi-join on the cell; a large subject simply covers many cells.
    cells = max(RANGE_CELLS, index.n_subjects)  # about one subject a cell, however many there are
    width = F.lit(max(1, index.n_rows // cells)).cast("bigint")
    spans = subjects.withColumn("w", width).withColumn(
        "cell",
        F.explode(
            F.sequence(
                F.floor(F.col("lo") / F.col("w")).cast("bigint"),
                F.floor((F.col("lo") + F.col("n") - 1) / F.col("w")).cast("bigint"),
            )
        ),
    )
    picked = draws.withColumn("g", F.col("r") % index.n_rows).withColumn(
        "cell", F.floor(F.col("g") / width).cast("bigint")
    )
    return picked.join(hint_if(spans, index.small), "cell").where(
        (F.col("g") >= F.col("lo")) & (F.col("g") < F.col("lo") + F.col("n"))
    )


def _same_subject(papers: DataFrame, index: Indexed, cfg: PairConfig, last: int) -> DataFrame:
    """Lookups ``(pair_id, side, pos)`` of two different rows of one subject."""
    p = F.col("pair_id")
    draws = _draws(papers, cfg, 0, last).withColumn("r", h48(cfg.key, "s", p))
    found = _rows_of_subject(draws, index, cfg.balanced)
    i1 = h48(cfg.key, "a", p) % F.col("n")
    found = found.withColumn("i1", i1).withColumn(
        "i2", (F.col("i1") + 1 + h48(cfg.key, "b", p) % (F.col("n") - 1)) % F.col("n")
    )
    sides = F.array(
        F.struct(F.lit(1).alias("side"), (F.col("lo") + F.col("i1")).alias("pos")),
        F.struct(F.lit(2).alias("side"), (F.col("lo") + F.col("i2")).alias("pos")),
    )
    return found.select("pair_id", "subject", F.inline(sides))


def _two_subjects(papers: DataFrame, index: Indexed, cfg: PairConfig, first: int) -> DataFrame:
    """Lookups of one row each from two different subjects, always uniform over subjects."""
    p = F.col("pair_id")
    s = index.n_subjects
    draws = _draws(papers, cfg, first, cfg.num_pairs).withColumn("ix1", h48(cfg.key, "n1", p) % s)
    draws = draws.withColumn("ix2", (F.col("ix1") + 1 + h48(cfg.key, "n2", p) % (s - 1)) % s)
    sides = F.array(
        F.struct(F.lit(1).alias("side"), F.col("ix1").alias("ix"), h48(cfg.key, "a", p).alias("r")),
        F.struct(F.lit(2).alias("side"), F.col("ix2").alias("ix"), h48(cfg.key, "b", p).alias("r")),
    )
    picked = draws.select("pair_id", F.inline(sides)).join(index.subjects, "ix")
    return picked.select("pair_id", "subject", "side", (F.col("lo") + F.col("r") % F.col("n")).alias("pos"))


def _join_drawn(lookups: DataFrame, table: DataFrame, key: str, draws: int) -> DataFrame:
    """Each lookup with the table's row of its key.

    Lookups within their bound are broadcast. Beyond it the table is first reduced to the drawn keys, with how often
    each is drawn; a key with a large share of the draws (a two-row subject among few subjects) is then
    broadcast by ``join_group`` instead of meeting its lookups in one task.
    """
    if draws <= MAX_BROADCAST_DRAWS:
        return table.join(F.broadcast(lookups), key)
    times = lookups.groupBy(key).agg(F.count("*").alias("_times"))
    return join_group(lookups, table.join(times, key), key, "_times").drop("_times")


def _paired(lookups: DataFrame) -> DataFrame:
    """Stored pairs of ids ``(pair_id, ..., id1, id2)``."""
    extra = [c for c in lookups.columns if c not in ("pair_id", "side", "paper_id")]
    ids = [F.first(F.when(F.col("side") == side, F.col("paper_id")), ignorenulls=True).alias(f"id{side}") for side in (1, 2)]
    return checkpoint(lookups.groupBy("pair_id").agg(*[F.first(c, ignorenulls=True).alias(c) for c in extra], *ids))


def _copied(pairs: DataFrame, draws: int) -> tuple[DataFrame, DataFrame]:
    """``(paper_id, copies)`` of all drawn papers, and of those that are drawn so often that they get several copies.

    A paper has one copy for each ``MIN_DRAWS_A_COPY`` of its draws, or for more draws if else there were too many such papers to broadcast.
    """
    share = max(MIN_DRAWS_A_COPY, draws // MAX_COPIED_PAPERS)
    ids = pairs.select(F.explode(F.array("id1", "id2")).alias("paper_id")).where(F.col("paper_id").isNotNull())
    drawn = ids.groupBy("paper_id").agg(F.ceil(F.count("*") / share).cast("int").alias("copies"))
    return drawn, drawn.where(F.col("copies") > 1)


def _attach(pairs: DataFrame, table: DataFrame, columns: list[str], draws: int) -> DataFrame:
    """Stored pairs of ids with ``<column>1`` and ``<column>2`` from the table's rows.

    The table's rows are dealt out by id, once for both sides, and each pair goes to its second paper and takes that paper's values on to its
    first: the only wide rows that are shuffled are one for each paper and one for each pair, and pairs of one first paper lie together. While
    they can be broadcast, only drawn papers are dealt out. A paper that is drawn very often is dealt out in copies, so its pairs do not
    meet in one task.
    """
    drawn, hot = _copied(pairs, draws)
    few = draws <= MAX_BROADCAST_DRAWS or drawn.count() <= MAX_BROADCAST_DRAWS
    rows = table.select("paper_id", *columns).where(F.col("paper_id").isNotNull())
    rows = rows.join(F.broadcast(drawn), "paper_id") if few else rows.join(F.broadcast(hot), "paper_id", "left")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)))
    # dealt out before the rows of an id are folded into one: else each task would order its wide rows first
    rows = rows.repartition("paper_id", "copy").groupBy("paper_id", "copy").agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns])

    found = pairs
    for side in (1, 2):
        often = hot.select(F.col("paper_id").alias(f"id{side}"), "copies")
        of = F.pmod(F.xxhash64("pair_id"), F.coalesce("copies", F.lit(1))).cast("int")
        found = found.join(F.broadcast(often), f"id{side}", "left").withColumn(f"of{side}", of).drop("copies")
    for side in (2, 1):
        own = rows.select(*[F.col(c).alias(f"{c}{side}") for c in ("paper_id", "copy", *columns)])
        found = found.join(own, (F.col(f"id{side}") == F.col(f"paper_id{side}")) & (F.col(f"of{side}") == F.col(f"copy{side}")), "left")
    extra = [c for c in pairs.columns if c not in ("pair_id", "id1", "id2")]
    found = found.where(F.coalesce("paper_id1", "paper_id2").isNotNull())
    return found.select("pair_id", *extra, *[f"{c}{side}" for c in ("paper_id", *columns) for side in (1, 2)])


def attach_both_sides(lookups: DataFrame, table: DataFrame, columns: list[str], draws: int) -> DataFrame:
    """One row per pair with ``<column>1`` and ``<column>2`` from the table's rows, for ``lookups(pair_id, side, paper_id, ...)``.

    The pairs of ids are stored first; the table is scanned once.
    """
    return _attach(_paired(lookups), table, columns, draws)


def _parts(pairs: DataFrame, num_pairs: int) -> Iterator[tuple[DataFrame, int]]:
    """Stored pairs of ids in at most ``MAX_PARTS`` parts of about as many pairs, and how many these are.

    Pairs of one subject share a part as far as it is no larger than one, so a paper is in few parts; so do those of one first paper.
    """
    count = min(MAX_PARTS, -(-num_pairs // MIN_PART_PAIRS))
    if count <= 1:
        yield pairs, num_pairs
        return
    bits = lambda c: F.xxhash64(c).bitwiseAND(F.lit((1 << 31) - 1))
    at = bits("id1") + (F.shiftleft(bits("subject"), 31) if "subject" in pairs.columns else F.lit(0))
    cuts = pairs.select(F.percentile_approx(at, [i / count for i in range(1, count)])).first()[0]
    part = functools.reduce(Column.__add__, [(at > cut).cast("int") for cut in cuts])
    for row in pairs.groupBy(part.alias("part")).count().orderBy("part").collect():
        yield pairs.where(part == row["part"]), row["count"]


def _ids(index: Indexed, lookups: DataFrame, draws: int) -> DataFrame:
    drawn = index.rows.rows_at(lookups, draws <= MAX_BROADCAST_DRAWS)
    return _join_drawn(lookups, drawn, "pos", draws).drop("pos")


def positive_pair_ids(papers: DataFrame, cfg: PairConfig, index: Indexed | None = None) -> DataFrame:
    """``(pair_id, subject, side, paper_id)``, two rows per pair."""
    index = index or index_papers(papers, cfg)
    return _ids(index, _same_subject(papers, index, cfg, cfg.num_pairs), 2 * cfg.num_pairs)


def positive_pairs(papers: DataFrame, cfg: PairConfig, index: Indexed | None = None) -> DataFrame:
    """Two different papers of one subject per pair.

    The papers must be usable ones (``sources.tables.usable``); only ids and subjects are read
    until the drawn texts are fetched. An ``index`` that was made for the seed serves any epoch.
    """
    ids = positive_pair_ids(papers, cfg, index)
    return _as_positive(attach_both_sides(ids, papers, [cfg.text_field], 2 * cfg.num_pairs), cfg)


def _as_positive(both: DataFrame, cfg: PairConfig) -> DataFrame:
    return both.select(
        "pair_id",
        "subject",
        F.col("paper_id1").alias("anchor_id"),
        F.col("paper_id2").alias("positive_id"),
        F.col(f"{cfg.text_field}1").alias("anchor"),
        F.col(f"{cfg.text_field}2").alias("positive"),
    )


def contrastive_pair_ids(papers: DataFrame, cfg: PairConfig, index: Indexed | None = None) -> DataFrame:
    """``(pair_id, side, paper_id, label)``: half positive, half negative.

    With a single subject there is no negative to draw, so every pair is positive.
    """
    index = index or index_papers(papers, cfg)
    both = index.n_subjects >= 2
    positives = cfg.num_pairs // 2 if both else cfg.num_pairs
    draws = 2 * cfg.num_pairs
    columns = ["pair_id", "side", "pos"]
    same = _same_subject(papers, index, cfg, positives).select(*columns, F.lit(1.0).alias("label"))
    if not both:
        return _ids(index, same, draws)
    wider = index if cfg.negatives_min_rows == 2 else index_papers(papers, cfg, cfg.negatives_min_rows)
    other = _two_subjects(papers, wider, cfg, positives).select(*columns, F.lit(0.0).alias("label"))
    if wider is index:
        return _ids(index, same.unionByName(other), draws)
    return _ids(index, same, draws).unionByName(_ids(wider, other, draws))


def contrastive_pairs(papers: DataFrame, cfg: PairConfig, index: Indexed | None = None) -> DataFrame:
    """Pairs with ``label`` 1.0 (one subject) or 0.0 (two subjects)."""
    ids = contrastive_pair_ids(papers, cfg, index)
    return _as_contrastive(attach_both_sides(ids, papers, [cfg.text_field], 2 * cfg.num_pairs), cfg)


def _as_contrastive(both: DataFrame, cfg: PairConfig) -> DataFrame:
    return both.select(
        "pair_id",
        F.col("paper_id1").alias("id1"),
        F.col("paper_id2").alias("id2"),
        F.col(f"{cfg.text_field}1").alias("sentence1"),
        F.col(f"{cfg.text_field}2").alias("sentence2"),
        "label",
    )


PairBuilder = Callable[..., DataFrame]  # (papers, config) or (papers, config, index)

PAIR_BUILDERS: dict[str, PairBuilder] = {
    "MultipleNegativesRankingLoss": positive_pairs,
    "ContrastiveLoss": contrastive_pairs,
}


_IN_PARTS = {positive_pairs: (positive_pair_ids, _as_positive), contrastive_pairs: (contrastive_pair_ids, _as_contrastive)}


def pair_parts(builder: PairBuilder, papers: DataFrame, cfg: PairConfig, index: Indexed | None = None) -> Iterator[DataFrame]:
    """The rows that ``builder`` makes, in a few parts that hold all of them together, for a caller who writes one after the other.

    Ids are drawn once. The papers are scanned once a part, and only a part's texts are shuffled at a time. A builder that is not of this
    module gives one part.
    """
    if builder not in _IN_PARTS:
        yield builder(papers, cfg, index)
        return
    ids, named = _IN_PARTS[builder]
    for part, pairs in _parts(_paired(ids(papers, cfg, index)), cfg.num_pairs):
        yield named(_attach(part, papers, [cfg.text_field], 2 * pairs), cfg)


def pair_builder(loss: str) -> PairBuilder:
    """The pair builder a loss needs; an unknown loss is an error."""
    if loss not in PAIR_BUILDERS:
        raise ValueError(f"unsupported loss {loss!r}; known: {sorted(PAIR_BUILDERS)}")
    return PAIR_BUILDERS[loss]
