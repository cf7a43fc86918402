"""Joining rows to a per-group table when one group may hold a third of all rows."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructField

from simsearch.session import checkpoint

# a per-group table is broadcast within both bounds: rows, and bytes of its values
MAX_BROADCAST_GROUPS = 1_000_000
MAX_BROADCAST_BYTES = 128 << 20
MAX_HEAVY_GROUPS = 10_000


def few_groups(df: DataFrame, group: str, limit: int = MAX_BROADCAST_GROUPS) -> bool:
    """True when the group column has at most ``limit`` values, so a per-group table is small."""
    return df.select(group).distinct().limit(limit + 1).count() <= limit


def hint_if(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row's values take."""

    def width(field: StructField) -> Column:
        if isinstance(field.dataType, StringType | BinaryType):
            return F.coalesce(F.octet_length(field.name), F.lit(0)) + 24
        if isinstance(field.dataType, ArrayType):
            return F.greatest(F.size(field.name), F.lit(0)) * 8 + 24
        return F.lit(8)

    return functools.reduce(Column.__add__, map(width, df.schema.fields)).cast("bigint")


def join_group(rows: DataFrame, groups: DataFrame, key: str, size: str, small: bool | None = None) -> DataFrame:
    """Inner join of ``rows`` with one row per group, safe for hot groups.

    Few groups are broadcast; unless the caller knows (``small``), they are stored and counted
    first. Otherwise ``groups[size]``, how many of ``rows`` each group has, tells the hot ones:
    fewer than MAX_HEAVY_GROUPS groups can each hold more than 1/MAX_HEAVY_GROUPS of all rows, so
    those are broadcast and their rows never shuffled, and any other group fits one task.
    """
    if small is None:
        groups = checkpoint(groups)
        count, width = groups.agg(F.count("*"), F.coalesce(F.sum(row_bytes(groups)), F.lit(0))).first()
        small = count <= MAX_BROADCAST_GROUPS and width <= MAX_BROADCAST_BYTES
    if small:
        return rows.join(F.broadcast(groups), key)
    total = groups.agg(F.sum(size)).scalar()
    heavy = F.broadcast(groups.where(F.col(size) * MAX_HEAVY_GROUPS > total))
    light = groups.where(F.col(size) * MAX_HEAVY_GROUPS <= total)
    rest = rows.join(heavy.select(key), key, "left_anti")
    return rows.join(heavy, key).unionByName(rest.join(light, key))
