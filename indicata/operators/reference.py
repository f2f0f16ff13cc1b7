"""Reference layer: code/identifier map, UNKNOWN members, code dimension,
code-to-identifier bridge and date dimension.

All inputs here are bounded by the size of the published code lists (not by
encounter volume), so their shuffles are small and their outputs are safe
to broadcast behind ``bounded_broadcast``.
"""

from __future__ import annotations

import datetime as _dt
from typing import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions import month_label, surrogate_key
from indicata.operators.joins import bounded_broadcast, declare_bytes, lacking, narrowed, union_all

# Fixed values of the reference model.
UNKNOWN = "UNKNOWN"
UNKNOWN_TYPES = ("DRG", "Diagnosis", "Procedure", "UNKNOWN")
DATE_DIM_START = _dt.date(1850, 1, 1)
DATE_DIM_END = _dt.date(2030, 12, 31)
UNKNOWN_DATE = _dt.date(1800, 1, 1)
UNKNOWN_DATE_SK = -1
# A row of the date dimension in memory, at most.
DATE_ROW_BYTES = 128

MAP_COLUMNS = ["code_identifier_sk", "code", "code_description", "code_type", "identifier", "reference_year"]


def union_code_lists(lists: Mapping[str, DataFrame] | Iterable[DataFrame]) -> DataFrame:
    """UNION ALL of same-shaped code lists; duplicates are kept."""
    dfs = list(lists.values()) if isinstance(lists, Mapping) else list(lists)
    return union_all(*[d.select("code", "code_description", "code_type", "identifier", *(
        ["ref_version", "effective_start_date", "effective_end_date", "reference_year"]
        if "reference_year" in d.columns else []
    )) for d in dfs])


def code_map(lists: Mapping[str, DataFrame] | Iterable[DataFrame] | DataFrame, year: int | None) -> DataFrame:
    """Code/identifier map with key sha256(code|identifier|code_type|year).

    ``year`` stamps a literal reference year; pass ``None`` when the lists
    already carry a ``reference_year`` column (versioned lists).
    """
    rows = lists if isinstance(lists, DataFrame) else union_code_lists(lists)
    yr = F.lit(year).cast("bigint") if year is not None else F.col("reference_year").cast("bigint")
    extra = [c for c in ("ref_version", "effective_start_date", "effective_end_date") if c in rows.columns]
    return rows.select(
        surrogate_key(F.col("code"), F.col("identifier"), F.col("code_type"), yr).alias("code_identifier_sk"),
        "code",
        "code_description",
        "code_type",
        "identifier",
        yr.alias("reference_year"),
        *extra,
    )


def unknown_members(cmap: DataFrame, types: Iterable[str] = UNKNOWN_TYPES) -> DataFrame:
    """UNKNOWN rows for every type x (years present, plus -1) not already there.

    Their key puts the type first: sha256(type|UNKNOWN|UNKNOWN|year). The
    type x year grid is built by exploding a literal array per year (no
    cross join); years come from a DISTINCT over the map.
    """
    years = (
        cmap.filter(F.col("reference_year").isNotNull())
        .select("reference_year")
        .distinct()
        .unionByName(cmap.sparkSession.range(1).select(F.lit(-1).cast("bigint").alias("reference_year")))
    )
    grid = years.select(
        F.explode(F.array(*[F.lit(t) for t in types])).alias("code_type"),
        "reference_year",
    )
    present = cmap.filter(F.col("code") == UNKNOWN).select("code_type", "reference_year")
    missing = lacking(grid, present, ["code_type", "reference_year"])
    return missing.select(
        surrogate_key(F.col("code_type"), UNKNOWN, UNKNOWN, F.col("reference_year")).alias("code_identifier_sk"),
        F.lit(UNKNOWN).alias("code"),
        F.lit(UNKNOWN).alias("code_description"),
        "code_type",
        F.lit(UNKNOWN).alias("identifier"),
        "reference_year",
    )


def with_unknown_members(cmap: DataFrame, types: Iterable[str] = UNKNOWN_TYPES) -> DataFrame:
    base = cmap.select(MAP_COLUMNS)
    return base.unionByName(unknown_members(base, types))


def dim_code(cmap: DataFrame) -> DataFrame:
    """One row per (code, code_type, reference_year); key sha256(code|type|year).

    The description is the minimum over duplicates, for determinism.
    """
    return (
        cmap.groupBy("code", "code_type", "reference_year")
        .agg(F.min("code_description").alias("code_description"))
        .select(
            surrogate_key(F.col("code"), F.col("code_type"), F.col("reference_year")).alias("code_sk"),
            "code",
            "code_type",
            "code_description",
            "reference_year",
        )
    )


def bridge(cmap: DataFrame, dim: DataFrame) -> DataFrame:
    """Distinct code-to-identifier pairs, keyed by the dimension's code_sk."""
    keys = ["code", "code_type", "reference_year"]
    joined = cmap.select(*keys, "identifier").join(
        bounded_broadcast(narrowed(dim, dim.select("code_sk", *keys))), on=keys, how="inner"
    )
    return joined.select(
        "code_sk",
        surrogate_key(F.col("identifier"), F.col("code_type"), F.col("reference_year")).alias("identifier_sk"),
        "identifier",
        "code_type",
        "reference_year",
    ).distinct()


def dim_date(
    spark: SparkSession,
    start: _dt.date = DATE_DIM_START,
    end: _dt.date = DATE_DIM_END,
    with_unknown: bool = True,
) -> DataFrame:
    """Day-grain date dimension ``start..end`` plus the -1 member dated 1800-01-01.

    Days are generated with ``range`` (split across tasks) rather than one
    exploded array, so generation is parallel.
    """
    n_days = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    days = spark.range(n_days).select(d.alias("full_date")).select(
        (F.year("full_date") * 10000 + F.month("full_date") * 100 + F.dayofmonth("full_date"))
        .cast("bigint")
        .alias("date_sk"),
        "full_date",
        F.year("full_date").cast("bigint").alias("year"),
        F.month("full_date").cast("bigint").alias("month"),
        month_label(F.col("full_date")).alias("year_month"),
        F.trunc("full_date", "MM").alias("month_start_date"),
    )
    if not with_unknown:
        return declare_bytes(days, DATE_ROW_BYTES * n_days)
    unknown = spark.range(1).select(
        F.lit(UNKNOWN_DATE_SK).cast("bigint").alias("date_sk"),
        F.lit(UNKNOWN_DATE).alias("full_date"),
        F.lit(-1).cast("bigint").alias("year"),
        F.lit(-1).cast("bigint").alias("month"),
        F.lit(UNKNOWN_DATE.strftime("%Y-%m")).alias("year_month"),
        F.lit(UNKNOWN_DATE).alias("month_start_date"),
    )
    return declare_bytes(days.unionByName(unknown), DATE_ROW_BYTES * (n_days + 1))


def code_identifiers(br: DataFrame, year: int) -> DataFrame:
    """Sorted distinct identifiers per code key for one reference year."""
    return (
        br.filter(F.col("reference_year") == year)
        .groupBy("code_sk", "code_type", "reference_year")
        .agg(F.array_sort(F.collect_set("identifier")).alias("identifiers"))
    )


def code_set(br: DataFrame, code_type: str, year: int, identifiers: Iterable[str]) -> DataFrame:
    """Distinct code keys of one type and year carrying any of ``identifiers``."""
    return (
        br.filter(
            (F.col("code_type") == code_type)
            & (F.col("reference_year") == year)
            & F.col("identifier").isin(list(identifiers))
        )
        .select("code_sk")
        .distinct()
    )
