"""Effective ranges: which version holds on a day, by binary search in sorted arrays.

Ranges may be of any number and length, overlap and leave gaps; of several that
hold on a day the one that started last wins (then the larger version). They
are resolved once into disjoint segments, each known by its first day, in a
sorted array. A lookup takes the last segment that starts on or before the day,
in as many steps as the array's length has bits; no range is exploded into
days or years, and there is no range join.

``RangeTable`` holds the versions of a whole list: a bounded number, taken to
the driver once and written into the plan as a literal, so its lookup needs no
join at all. ``resolved`` and ``lookup_intervals`` do the same for ranges per
key (e.g. the validity of single codes) by one equi-join on the key.
"""

from __future__ import annotations

import bisect
import datetime as _dt
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.operators.joins import bounded_broadcast, narrowed

#: Versions of one list, and ranges of one key, at most; more raise.
MOST_RANGES = 4_096
START, END = "effective_start_date", "effective_end_date"


def search(starts: Column, day: Column, most: int) -> Column:
    """Position (from 0) of the last of the sorted ``starts`` that is at most
    ``day``, -1 if there is none or the day is null; ``most``: the greatest length."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, most.bit_length())))])
    return F.aggregate(steps, F.lit(-1), lambda at, step: F.when(F.coalesce(F.get(starts, at + step) <= day, F.lit(False)), at + step).otherwise(at))


def _segments(ranges: Sequence[tuple]) -> list[tuple]:
    """Disjoint (first day, value) of (start, end, value); value None in gaps."""
    kept = [r for r in ranges if r[0] is not None and (r[1] is None or r[1] >= r[0])]
    days = sorted({r[0] for r in kept} | {r[1] + _dt.timedelta(days=1) for r in kept if r[1] is not None and r[1] < _dt.date.max})
    out: list[tuple] = []
    for day in days:
        held = [(s, v) for s, e, v in kept if s <= day and (e is None or day <= e)]
        value = max(held)[1] if held else None
        if not out or out[-1][1] != value:
            out.append((day, value))
    return out


@dataclass(frozen=True)
class RangeTable:
    """Resolved versions: parallel tuples of first days and versions (None: a gap)."""

    starts: tuple
    versions: tuple

    @staticmethod
    def of(versions: DataFrame, name: str = "ref_version", most: int = MOST_RANGES) -> "RangeTable":
        """From rows (name, start, end); at most ``most`` distinct ones, a null end is open."""
        rows = versions.select(START, END, name).distinct().limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"more than {most} versions")
        segments = _segments([tuple(r) for r in rows])
        return RangeTable(tuple(s for s, _ in segments), tuple(v for _, v in segments))

    def on(self, day: _dt.date):
        at = bisect.bisect_right(self.starts, day) - 1
        return self.versions[at] if at >= 0 else None

    def started(self, day: _dt.date) -> _dt.date | None:
        """First day of the segment that holds on ``day``, None outside all ranges."""
        at = bisect.bisect_right(self.starts, day) - 1
        return self.starts[at] if at >= 0 and self.versions[at] is not None else None

    def at(self, day: Column) -> Column:
        """The version that holds on ``day``, null outside all ranges."""
        if not self.starts:
            return F.lit(None).cast("string")
        starts, versions = (F.array(*[F.lit(x) for x in xs]) for xs in (self.starts, self.versions))
        return F.get(versions, search(starts, day, len(self.starts)))


def resolved(ranges: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key: ``starts`` (sorted first days of its disjoint segments)
    and ``held`` (their values, null in gaps), from rows (keys, start, end, value).

    The arrays are built with array functions; a key has at most
    ``MOST_RANGES`` distinct ranges (more raise)."""
    held = F.struct(F.col(START).alias("s"), F.col(END).alias("e"), F.col(value).alias("v"))
    valid = ranges.filter(F.col(START).isNotNull() & (F.col(END).isNull() | (F.col(END) >= F.col(START))))
    rows = valid.groupBy(*keys).agg(F.collect_set(held).alias("_r"))
    too_many = F.raise_error(F.concat(F.lit("too many ranges: "), F.size("_r").cast("string")))
    rows = rows.withColumn("_r", F.when(F.size("_r") > MOST_RANGES, too_many.cast(rows.schema["_r"].dataType)).otherwise(F.col("_r")))
    after = F.array_compact(F.transform("_r", lambda r: F.date_add(r["e"], 1)))
    days = rows.select(*keys, "_r", F.array_sort(F.array_union(F.transform("_r", lambda r: r["s"]), after)).alias("starts"))

    def winner(day: Column) -> Column:
        on = F.filter("_r", lambda r: (r["s"] <= day) & (r["e"].isNull() | (r["e"] >= day)))
        return F.array_max(F.transform(on, lambda r: F.struct(r["s"], r["v"])))["v"]

    return narrowed(ranges, days.select(*keys, "starts", F.transform("starts", winner).alias("held")))


def lookup_intervals(rows: DataFrame, date_col: str, keys: Sequence[str], arrays: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``name``: the value that holds for its key on its date (null: none).

    ``arrays`` comes from ``resolved`` under the same key names; it is broadcast
    if its size is proven, and joined by key otherwise.
    """
    joined = rows.join(bounded_broadcast(narrowed(arrays, arrays.select(*keys, F.col("starts").alias("_starts"), F.col("held").alias("_held")))), list(keys), "left")
    return joined.select(*[F.col(c) for c in rows.columns], F.get("_held", search(F.col("_starts"), F.col(date_col), 2 * MOST_RANGES)).alias(name))


def overlaps(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Check row: distinct ranges that begin before an earlier range of their key has ended."""
    from pyspark.sql.window import Window

    before = Window.partitionBy(*keys).orderBy(START, F.col(END).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    far = F.lit(_dt.date(9999, 12, 31))
    ended = F.max(F.coalesce(F.col(END), far)).over(before)
    found = ranges.select(*keys, START, END).distinct().withColumn("_end", ended)
    return found.agg(F.count_if(F.col(START) <= F.col("_end")).alias("v")).select(
        F.lit("range_overlap").alias("check"), F.lit(",".join(keys)).alias("subject"), F.col("v").alias("violations"), (F.col("v") == 0).alias("passed")
    )
