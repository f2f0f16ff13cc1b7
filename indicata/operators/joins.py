"""Join helpers: size-checked broadcast, key lookups, semi- and anti-joins."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# One documented limit for every explicit broadcast, in bytes of the written
# table (or of the rows a generated table is declared to hold). Anything
# larger or of unknown size is left to the planner: sort-merge or shuffled
# hash join, re-planned at runtime by AQE.
BROADCAST_MAX_BYTES = 64 << 20
# Bytes of a row in memory for each byte of its parquet file, at most.
EXPANSION = 8


_BYTES_ATTR = "_indicata_max_bytes"


def declare_bytes(df: DataFrame, size: int) -> DataFrame:
    """Record a proven upper bound on the bytes of ``df`` (the size of its
    files, taken when it was written, times ``EXPANSION``)."""
    setattr(df, _BYTES_ATTR, int(size))
    return df


def narrowed(parent: DataFrame, child: DataFrame) -> DataFrame:
    """Carry ``parent``'s bound to ``child``.

    Only valid when ``child`` cannot be larger than ``parent``: a filter,
    projection, DISTINCT or aggregation of it (never a join or explode).
    """
    bound = getattr(parent, _BYTES_ATTR, None)
    if bound is not None:
        declare_bytes(child, bound)
    return child


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only if its recorded bound is at most ``max_bytes``.

    The bound comes from ``declare_bytes`` / ``narrowed`` and costs no job. A
    frame without a bound, or above it, is returned unchanged and Spark picks
    the join by its own size estimate (re-planned at runtime by AQE).
    """
    size = getattr(df, _BYTES_ATTR, None)
    return narrowed(df, F.broadcast(df)) if size is not None and size <= max_bytes else df


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Column | Sequence[str],
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Left lookup into a small dimension, unique on the join key.

    The caller filters ``dim`` *before* the join, so constant predicates act
    like the ``ON ... AND type = ... AND year = ...`` of a SQL lookup, and
    defaults the looked-up columns with ``coalesce`` afterwards.
    """
    return df.join(bounded_broadcast(dim, max_bytes), on=on, how="left")


def having(df: DataFrame, other: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """Rows of ``df`` with at least one match in ``other`` (EXISTS)."""
    return df.join(other, on=on, how="left_semi")


def lacking(df: DataFrame, other: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """Rows of ``df`` with no match in ``other`` (NOT EXISTS / LEFT JOIN .. IS NULL)."""
    return df.join(other, on=on, how="left_anti")


def union_all(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name; duplicates kept."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
