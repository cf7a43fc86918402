"""Exact "n smallest draws" without sorting the table.

Sampling a fixed number of rows means taking the n smallest ``(draw, id)`` keys. A global sort
would push every row through one order; here a histogram of the draw's leading bits finds the
one bucket the cut falls into, only that bucket is ordered, and the result is a threshold key.
Applying the threshold is a plain filter over the table, with no shuffle of its wide columns.

With ``group`` the same is done per group. A group holding a third of all rows is spread over
its buckets, so no task ever sees a whole group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from simsearch.functions.keyed import h48, leading_bits
from simsearch.operators.skew import few_groups, hint_if, join_group
from simsearch.session import checkpoint

GLOBAL_BITS = 16
GROUP_BITS = 12

Wanted = Callable[[Column], Column]


def cut_keys(
    df: DataFrame,
    id_col: str,
    draw: tuple,
    wanted: dict[str, Wanted],
    group: str | None = None,
    small_groups: bool = False,
) -> DataFrame:
    """Threshold keys: for each name the ``wanted``-th smallest ``(h, id)``.

    ``wanted[name]`` maps the row count (of the group) to how many rows to take. The result has
    one row per group in which something is wanted (one row in all without a group): ``total``,
    the rows counted, and one struct column ``(h, id)`` per name, null for a name that wants none.
    """
    groups = [group] if group else []
    bits = GROUP_BITS if group else GLOBAL_BITS
    keys = df.select(*groups, F.col(id_col).alias("id"), h48(*draw, F.col(id_col)).alias("h"))
    keys = keys.withColumn("bucket", leading_bits(F.col("h"), bits))

    # at most 2^bits rows per group reach these windows, whatever the table holds
    per_group = W.partitionBy(*groups)
    buckets = (
        keys.groupBy(*groups, "bucket")
        .agg(F.count("*").alias("cnt"))
        .withColumn("upto", F.sum("cnt").over(per_group.orderBy("bucket")))
        .withColumn("total", F.sum("cnt").over(per_group))
    )
    targets = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.least(fn(F.col("total")), F.col("total")).cast("bigint").alias("n"))
            for name, fn in wanted.items()
        ]
    )
    edges = (
        buckets.select("*", F.explode(targets).alias("t"))
        .where((F.col("upto") - F.col("cnt") < F.col("t.n")) & (F.col("t.n") <= F.col("upto")))
        .select(*groups, "bucket", "total", "t.name", (F.col("t.n") - F.col("upto") + F.col("cnt")).alias("nth"))
    )
    # without a group there is one edge per name; with one, the caller has counted the groups
    edges = hint_if(edges, small=group is None or small_groups)
    ranked = keys.join(edges, [*groups, "bucket"]).withColumn(
        "rk", F.row_number().over(W.partitionBy(*groups, "bucket", "name").orderBy("h", "id"))
    )
    found = ranked.where(F.col("rk") == F.col("nth"))
    key = F.struct("h", "id")
    per_name = [F.max(F.when(F.col("name") == n, key)).alias(n) for n in wanted]
    return found.groupBy(*groups).agg(F.max("total").alias("total"), *per_name)


def is_within(key: Column, h: Column, row_id: Column) -> Column:
    """Whether a row's ``(h, id)`` is at or below the threshold; a null threshold takes nothing."""
    below = (h < key.getField("h")) | ((h == key.getField("h")) & (row_id <= key.getField("id")))
    return F.coalesce(below, F.lit(False))


def mark_smallest(
    df: DataFrame, id_col: str, draw: tuple, wanted: dict[str, Wanted], among: DataFrame | None = None
) -> DataFrame:
    """The table with one boolean per name: is the row among the ``wanted`` smallest draws?

    The thresholds are taken over ``among`` (the whole table by default) and applied to ``df``.
    They are computed here, once, and reach the plan as literals: however often the result is
    read, marking a row stays a comparison of its own draw with two numbers.
    """
    keys = cut_keys(df if among is None else among, id_col, draw, wanted).collect()
    row_id, h = F.col(id_col), h48(*draw, F.col(id_col))
    flags = {}
    for name in wanted:
        key = keys[0][name] if keys else None
        if key is None:
            flags[name] = F.lit(False)
        else:
            flags[name] = (h < key["h"]) | ((h == key["h"]) & (row_id <= key["id"]))
    return df.withColumns(flags)


def mark_smallest_per_group(
    df: DataFrame, id_col: str, draw: tuple, wanted: dict[str, Wanted], group: str, small: bool | None = None
) -> DataFrame:
    """As ``mark_smallest``, with the counts and thresholds taken inside each group.

    Groups in which nothing is wanted, and rows without a group, are left out. ``small`` says whether the
    groups are few enough to broadcast, if the caller knows.
    """
    small = few_groups(df, group) if small is None else small
    keys = cut_keys(df, id_col, draw, wanted, group=group, small_groups=small)
    keys = keys.select(group, F.col("total").alias("_n"), F.struct(*wanted).alias("_k"))
    row_id, h = F.col(id_col), h48(*draw, F.col(id_col))
    # one row per group, computed once however often the result is read
    marked = join_group(df, checkpoint(keys), group, "_n", small).withColumn("_h", h)
    flags = [is_within(F.col(f"_k.{name}"), F.col("_h"), row_id).alias(name) for name in wanted]
    return marked.select(*df.columns, *flags)
