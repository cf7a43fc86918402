"""Dense positions for random access by rank, safe for a subject that dominates the table.

A pair draw picks "row i of subject s". On a distributed table that needs a position for every
row. Rows are ordered by a keyed draw; the draw's leading bits split each subject into equal slices of about
``SLICE_ROWS`` rows, whatever its size. Slices are counted, and a prefix sum says which positions each one holds.

A position is found without ordering the table: the prefix table turns it into a slice, and only slices that hold a
wanted position are ranked (``rows_at``). ``positions`` ranks them all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from simsearch.functions.keyed import HASH_BITS, h48, leading_bits
from simsearch.operators.skew import hint_if, join_group
from simsearch.session import checkpoint

SLICE_ROWS = 128
COARSE_BITS = 12
SUBJECT_BITS = 8
CELL = 1024  # positions of one key of the lookup


@dataclass(frozen=True)
class SubjectIndex:
    """``subjects(subject, ix, n, lo)``: subject number ix owns positions lo .. lo+n-1.
    ``rows(subject, slice, h, paper_id)``: the rows by slice. ``slices(subject, slice, start, rows)``: the positions
    start .. start+rows-1 are those of the slice's rows in the order of their draws."""

    subjects: DataFrame
    rows: DataFrame
    slices: DataFrame

    @property
    def positions(self) -> DataFrame:
        """``(pos, paper_id)`` of every row."""
        return _ranked(self.rows.join(self.slices.select("subject", "slice", "start"), ["subject", "slice"]))

    def rows_at(self, wanted: DataFrame, few: bool) -> DataFrame:
        """``(pos, paper_id)`` of the slices that hold a position of ``wanted(pos)``; ``few`` says that these can be broadcast."""
        cell = lambda at: F.floor(at / CELL).cast("bigint")
        first, last = F.col("start"), F.col("start") + F.col("rows") - 1
        spans = self.slices.withColumn("cell", F.explode(F.sequence(cell(first), cell(last))))
        asked = wanted.select("pos").distinct().withColumn("cell", cell(F.col("pos")))
        inside = (F.col("pos") >= first) & (F.col("pos") <= last)
        held = spans.join(hint_if(asked, few), "cell").where(inside).select("subject", "slice", "start").distinct()
        return _ranked(self.rows.join(hint_if(held, few), ["subject", "slice"]))


def _ranked(rows: DataFrame) -> DataFrame:
    in_slice = W.partitionBy("subject", "slice").orderBy("h", "paper_id")
    return rows.select((F.col("start") + F.row_number().over(in_slice) - 1).alias("pos"), "paper_id")


def subject_counts(papers: DataFrame, min_rows: int = 2) -> DataFrame:
    """Subjects with at least ``min_rows`` papers, and how many each has."""
    return (
        papers.where(F.col("paper_id").isNotNull())
        .groupBy(F.col("primary_subject").alias("subject"))
        .agg(F.count("*").alias("n"))
        .where((F.col("n") >= min_rows) & F.col("subject").isNotNull())
    )


def _number_subjects(counts: DataFrame) -> DataFrame:
    """Add ``ix``, the subjects before this one, and ``lo``, their rows, in a fixed order.

    The order is cut into buckets first, so that no task orders all subjects.
    """
    keyed = counts.withColumn("sh", h48("subject", F.col("subject"))).withColumn(
        "sb", leading_bits(F.col("sh"), SUBJECT_BITS)
    )
    # 2^SUBJECT_BITS rows at most
    earlier = W.orderBy("sb").rowsBetween(W.unboundedPreceding, -1)
    ahead = (
        keyed.groupBy("sb")
        .agg(F.count("*").alias("c"), F.sum("n").alias("r"))
        .select("sb", F.sum("c").over(earlier).alias("ahead_ix"), F.sum("r").over(earlier).alias("ahead_lo"))
    )
    inside = W.partitionBy("sb").orderBy("sh", "subject").rowsBetween(W.unboundedPreceding, -1)

    def before(ahead_column: str, weight: Column) -> Column:
        return F.coalesce(F.col(ahead_column), F.lit(0)) + F.coalesce(F.sum(weight).over(inside), F.lit(0))

    return keyed.join(F.broadcast(ahead), "sb").select(
        "subject",
        before("ahead_ix", F.lit(1)).cast("bigint").alias("ix"),
        "n",
        before("ahead_lo", F.col("n")).cast("bigint").alias("lo"),
    )


def index_subjects(papers: DataFrame, seed: int, min_rows: int = 2) -> SubjectIndex:
    keyed = papers.where(F.col("primary_subject").isNotNull() & F.col("paper_id").isNotNull()).select(
        "paper_id",
        F.col("primary_subject").alias("subject"),
        h48(seed, "pos", F.col("paper_id")).alias("h"),
    )
    # one row per subject, read by every later step: stored instead of counted again
    subjects = checkpoint(_number_subjects(subject_counts(papers, min_rows)))
    # as many leading bits as give a subject slices of about SLICE_ROWS rows
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / SLICE_ROWS))).cast("int")
    sliced = join_group(keyed, subjects.select("subject", "n", bits.alias("bits")), "subject", "n")
    rows = sliced.select("subject", F.expr(f"shiftright(h, {HASH_BITS} - bits)").alias("slice"), "bits", "h", "paper_id")

    counted = rows.groupBy("subject", "bits", "slice").agg(F.count("*").alias("rows"))
    counted = checkpoint(counted.withColumn("coarse", F.expr(f"shiftright(slice, greatest(0, bits - {COARSE_BITS}))")))
    # prefix sums in two steps: over at most 2^COARSE_BITS parts of a subject, and inside a part
    before = lambda *by: W.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(W.unboundedPreceding, -1)
    skipped = lambda window: F.coalesce(F.sum("rows").over(window), F.lit(0))
    parts = counted.groupBy("subject", "coarse").agg(F.sum("rows").alias("rows")).select("subject", "coarse", skipped(before("subject", "coarse")).alias("ahead"))
    inside = counted.withColumn("skip", skipped(before("subject", "coarse", "slice")))
    starts = inside.join(parts, ["subject", "coarse"]).join(subjects.select("subject", "lo"), "subject")
    slices = checkpoint(starts.select("subject", "slice", (F.col("lo") + F.col("ahead") + F.col("skip")).alias("start"), "rows"))
    return SubjectIndex(subjects, rows.drop("bits"), slices)
