"""The layered model as one lazily-built object: raw -> reference -> core.

The reference layer (code map, code dimension, bridge, indicator code
flags) is bounded by the published code lists, not by encounter volume. It
is written once to the shared checkpoint folder and read back, which cuts
its lineage: every later plan sees a small parquet scan instead of
re-deriving the dimension (and its shuffles) at each lookup.

The core layer (three facts) and the nested summary are written the same
way, as the source model does with its tables: all bucketed by the encounter
key with the same bucket count (co-located). Queries read them, so their
lineage starts at the written tables (a lost executor recomputes from them,
not from the raw extracts), and joins or groupings by encounter need no
exchange of rows. The facts are also partitioned by the encounter's year
of discharge, so that a query over a period reads the years it touches. Years
and not months, as directories multiply files (buckets x directories). Inside
a file rows are sorted by the encounter's month, so that column statistics of
row groups and pages skip a year's other months;
month-partitioned publishing is the ``write_by_month`` sink.

Encounters with more rows than a bucket should take (``hot_encounters``, found
by a sketch) lie beside the buckets in side tables whose files are as balanced
as the input's. What is worked out per encounter runs on each of the two
``parts`` and is united afterwards: the bucketed part is co-located as ever, the
side is collapsed or salted first, so a hot encounter fills no task.
``materialize_core=False`` keeps everything lazy (one part, nothing bucketed).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.operators import facts as _facts
from indicata.operators import indicator as _ind
from indicata.operators import reference as _ref
from indicata.operators import skew as _skew
from indicata.operators.joins import having, lacking, union_all
from indicata.sources.fixtures import RawInputs, raw_inputs
from indicata.sources.sinks import fresh_path, materialize, overwrite_partitions, save_bucketed

MONTH_COL = "discharge_month"
YEAR_COL, ENCOUNTER_MONTH = _ind.YEAR_COL, _ind.ENCOUNTER_MONTH
#: Columns of a stored fact that place its rows.
PLACE = (YEAR_COL, ENCOUNTER_MONTH)
# Diagnosis lines per bucket of the facts, and the fewest buckets a warehouse
# has. A task sorts, groups or joins one bucket, at up to 2.2 KB of memory a line
# (the arrays of the summary), so a bucket's lines bound the memory of every task.
BUCKET_ROWS = 500_000
LEAST_BUCKETS = 8
LEAST_HOT_ROWS = 1_000
# A file holds a bucket's rows of a year; a page is a small part of them.
PAGE_ROWS = 2_500


def places(patient: DataFrame) -> DataFrame:
    """One row per encounter: its one year and month of discharge, null where there are several or none."""
    ends = patient.groupBy("patient_id").agg(F.min("discharge_date").alias("_low"), F.max("discharge_date").alias("_high"))
    one = lambda part: F.when(part("_low") == part("_high"), part("_low"))
    return ends.select("patient_id", one(F.year).alias(YEAR_COL), one(lambda c: F.trunc(c, "MM")).alias(ENCOUNTER_MONTH))


@dataclass(frozen=True)
class Facts:
    """The three facts of one part of the encounters."""

    discharge: DataFrame
    diagnosis: DataFrame
    procedure: DataFrame


@dataclass
class Warehouse:
    spark: SparkSession
    raw: RawInputs
    year: int
    resolve_unknown: bool = False
    date_start: _dt.date = _ref.DATE_DIM_START
    date_end: _dt.date = _ref.DATE_DIM_END
    materialize_reference: bool = True
    materialize_core: bool = True
    # Buckets of the encounter key shared by the three facts (default: from
    # the number of diagnosis lines, see ``fact_buckets``).
    buckets: int | None = None
    # Rows of a parquet page of the facts: months are skipped in such steps.
    page_rows: int = PAGE_ROWS
    # An encounter is hot beyond this many rows of a fact and a quarter of an average bucket.
    least_hot_rows: int = LEAST_HOT_ROWS
    # The day whose extract the stored facts hold; corrections since then are merged by the nightly run.
    built_on: _dt.date | None = None
    _cache: dict = field(default_factory=dict, repr=False)
    _tables: dict = field(default_factory=dict, repr=False)

    def _pin(self, df: DataFrame, name: str, cluster_by: tuple[str, ...] = ()) -> DataFrame:
        """Write a small reference table to shared storage and read it back,
        recording its exact row count as a proven broadcast bound."""
        if not self.materialize_reference:
            return df
        return materialize(df, f"ref-{name}", cluster_by=cluster_by)

    # -- reference layer -------------------------------------------------
    @cached_property
    def code_map_base(self) -> DataFrame:
        return _ref.code_map(self.raw.code_lists, self.year)

    @cached_property
    def code_map(self) -> DataFrame:
        return self._pin(_ref.with_unknown_members(self.code_map_base), "code_map")

    @cached_property
    def dim_code(self) -> DataFrame:
        return self._pin(_ref.dim_code(self.code_map), "dim_code", cluster_by=("code_type", "code"))

    @cached_property
    def bridge(self) -> DataFrame:
        return self._pin(_ref.bridge(self.code_map, self.dim_code), "bridge", cluster_by=("identifier", "code_type"))

    @cached_property
    def code_identifiers(self) -> DataFrame:
        """Sorted identifier array per code key of the reference year."""
        return self._pin(_ref.code_identifiers(self.bridge, self.year), "code_identifiers")

    @cached_property
    def dim_date(self) -> DataFrame:
        return _ref.dim_date(self.spark, self.date_start, self.date_end)

    # -- core layer ------------------------------------------------------
    @cached_property
    def core_patient(self) -> DataFrame:
        return _facts.core_patient(self.raw.patient)

    @cached_property
    def core_procedure(self) -> DataFrame:
        return _facts.core_procedure(self.raw.procedure)

    @cached_property
    def core_diagnosis(self) -> DataFrame:
        return _facts.core_diagnosis(self.raw.diagnosis)

    @cached_property
    def hot_encounters(self) -> DataFrame | None:
        """Ids of encounters with more than a quarter of an average bucket's rows
        in any of the three tables (see ``skew.hot_keys``), or None."""
        tables = {"diagnosis": self.core_diagnosis, "procedure": self.core_procedure, "patient": self.core_patient}
        return _skew.hot_keys({n: t.select("patient_id") for n, t in tables.items()}, "patient_id", 4 * self.fact_buckets, self.least_hot_rows)

    def _build(self, name: str) -> DataFrame:
        """A fact as it is derived from the typed tables, not yet written."""
        if name == "fct_discharge":
            fct = _facts.fct_discharge(
                self.core_patient,
                self.dim_code,
                self.year,
                date_start=self.date_start,
                date_end=self.date_end,
                resolve_unknown=self.resolve_unknown,
            )
            return fct.withColumn(MONTH_COL, F.trunc("discharge_date", "MM"))
        build, core = {"fct_diagnosis": (_facts.fct_diagnosis, self.core_diagnosis), "fct_procedure": (_facts.fct_procedure, self.core_procedure)}[name]
        return build(core, self.dim_code, self.year, resolve_unknown=self.resolve_unknown)

    def _written(self, name: str) -> tuple[DataFrame, DataFrame | None]:
        """A fact of the bucketed encounters and of the hot ones (None if there are none)."""
        if name not in self._cache:
            self._cache[name] = self._pin_fact(self._build(name), name)
        return self._cache[name]

    def _whole(self, name: str) -> DataFrame:
        cold, hot = self._written(name)
        return cold if hot is None else cold.unionByName(hot)

    @property
    def fct_discharge_by_month(self) -> DataFrame:
        """Discharge fact plus ``discharge_month`` and the encounter's year and month."""
        return self._whole("fct_discharge")

    @property
    def fct_diagnosis_by_year(self) -> DataFrame:
        return self._whole("fct_diagnosis")

    @property
    def fct_procedure_by_year(self) -> DataFrame:
        return self._whole("fct_procedure")

    @cached_property
    def fct_discharge(self) -> DataFrame:
        return self.fct_discharge_by_month.drop(MONTH_COL, *PLACE)

    @cached_property
    def fct_diagnosis(self) -> DataFrame:
        return self.fct_diagnosis_by_year.drop(*PLACE)

    @cached_property
    def fct_procedure(self) -> DataFrame:
        return self.fct_procedure_by_year.drop(*PLACE)

    @cached_property
    def parts(self) -> list[Facts]:
        """The facts as encounter-disjoint parts for cohorts: the bucketed
        encounters and, where there are hot ones, those, with their lines
        collapsed to one for each code (``skew.collapse_diagnoses``)."""
        discharge, diagnosis, procedure = (self._written(n) for n in ("fct_discharge", "fct_diagnosis", "fct_procedure"))
        out = [Facts(discharge[0], diagnosis[0], procedure[0])]
        if diagnosis[1] is not None:
            out.append(
                Facts(
                    materialize(discharge[1].dropDuplicates(), "hot-discharge"),
                    materialize(_skew.collapse_diagnoses(diagnosis[1]), "hot-diagnosis"),
                    materialize(procedure[1].dropDuplicates(), "hot-procedure"),
                )
            )
        return out

    def over_parts(self, work: Callable[[Facts], DataFrame]) -> DataFrame:
        """``work`` (one result per encounter) of each part, united."""
        return union_all(*[work(p) for p in self.parts])

    @cached_property
    def encounter_years(self) -> DataFrame:
        """The one year and month of discharge of each encounter, null where its
        discharge rows lie in several or have no date. All rows of an encounter
        in all facts carry them, so pruning by year and month (nulls are always
        read) never separates an encounter's rows."""
        return self._save_fact(places(self.core_patient), "encounter_years")

    @property
    def fact_buckets(self) -> int:
        """Bucket count shared by all facts (co-location needs the same count).

        Derived from the data, not from the session: one bucket per
        ``BUCKET_ROWS`` diagnosis lines (a count that parquet footers answer),
        which bounds each co-located task's input and memory on any cluster.
        """
        if self.buckets is None:
            self.buckets = max(LEAST_BUCKETS, -(-self.raw.diagnosis.count() // BUCKET_ROWS))
        return self.buckets

    def _save_fact(self, df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(self.spark, name)
        table = f"{name}_{path.rsplit('-', 1)[-1][:12]}"
        return save_bucketed(df, table, path, "patient_id", self.fact_buckets)

    def _pin_fact(self, df: DataFrame, name: str) -> tuple[DataFrame, DataFrame | None]:
        """Write a fact with the encounter's year and month, bucketed and
        partitioned by year (the rows move once, to their bucket, where the
        co-located years join them), sorted by month in each file. Rows of hot
        encounters are written where they were read, sorted by year and month."""
        if not self.materialize_core:
            return df, None
        hot = None
        if self.hot_encounters is not None:
            df, side = _skew.split(df, self.hot_encounters, "patient_id")
            years = _skew.split(self.encounter_years, self.hot_encounters, "patient_id")[1]
            years = F.broadcast(years.select(F.col("patient_id").alias("_id"), *PLACE))  # a row per hot encounter
            side = side.join(years, F.col("patient_id").eqNullSafe(F.col("_id")), "left").drop("_id")
            hot = materialize(side, f"{name}-hot", cluster_by=(*PLACE, "patient_id"))
        placed = df.repartition(self.fact_buckets, "patient_id").join(self.encounter_years, "patient_id", "left")
        path = fresh_path(self.spark, name)
        table = self._tables[name] = f"{name}_{path.rsplit('-', 1)[-1][:12]}"
        return save_bucketed(placed, table, path, "patient_id", self.fact_buckets, partition_by=YEAR_COL, placed=True, sort_by=(ENCOUNTER_MONTH, "patient_id"), page_rows=self.page_rows), hot

    def replace_encounters(self, changed: DataFrame, fresh: dict[str, DataFrame], on: _dt.date) -> list[int | None]:
        """Bring the stored facts up to day ``on``: the rows of the encounters
        ``changed`` (patient_id and their new year and month of discharge) become those
        of ``fresh`` (by fact name). Returns the years that were rewritten.

        Only the years in which these encounters were and are discharged are
        rewritten, from a staged copy, by dynamic partition overwrite; buckets
        and co-location stay, and files of other years are not touched. Rows of
        hot encounters are replaced in the side tables. A run that was cut off
        is mended by running it again.
        """
        ids = changed.select("patient_id").distinct()
        old = having(self._written("fct_discharge")[0].select("patient_id", YEAR_COL), ids, "patient_id").select(YEAR_COL)
        touched = sorted({r[0] for r in old.unionByName(changed.select(YEAR_COL)).distinct().collect()}, key=lambda y: (y is not None, y or 0))
        in_years = F.col(YEAR_COL).isin([y for y in touched if y is not None])
        staged = {}
        for name, rows in fresh.items():
            cold, hot = self._written(name)
            dated = rows.join(changed.select("patient_id", *PLACE), "patient_id", "left").select(cold.columns)
            if hot is not None:
                dated, side = _skew.split(dated, self.hot_encounters, "patient_id")
                side = materialize(lacking(hot, ids, "patient_id").unionByName(side), f"{name}-hot", cluster_by=(*PLACE, "patient_id"))
                self._cache[name] = (cold, side)
            kept = lacking(cold.filter(F.col(YEAR_COL).isNull() | in_years if None in touched else in_years), ids, "patient_id")
            staged[name] = materialize(kept.unionByName(dated), f"{name}-staged")
        for name, rows in staged.items():
            overwrite_partitions(rows, self._tables[name], "patient_id", self.fact_buckets, YEAR_COL, touched)
            self._cache[name] = (self.spark.table(self._tables[name]), self._cache[name][1])
        for derived in ("fct_discharge", "fct_diagnosis", "fct_procedure", "parts", "_summaries", "discharge_summary"):
            self.__dict__.pop(derived, None)
        self._cache = {k: v for k, v in self._cache.items() if k[0] != "metrics"}
        self.built_on = on
        return touched

    # -- analytics layer -------------------------------------------------
    @cached_property
    def discharge_summary(self) -> DataFrame:
        """Nested one-row-per-discharge table, bucketed by encounter like the
        facts; the rows of hot encounters lie beside it in runs and are expanded
        as they are read (``discharge_summary_flat`` does without)."""
        from indicata.operators.summary import expanded

        cold, hot = self._summaries
        return cold if hot is None else cold.unionByName(expanded(hot))

    @property
    def discharge_summary_flat(self) -> DataFrame:
        """The summary as text (``flatten_summary``), hot encounters straight from their runs."""
        from indicata.operators.summary import flatten_summary

        return union_all(*[flatten_summary(s) for s in self._summaries if s is not None])

    @cached_property
    def _summaries(self) -> tuple[DataFrame, DataFrame | None]:
        """The summary of the bucketed encounters and, in runs, of the hot ones (None if there are none)."""
        from indicata.operators.summary import discharge_summary

        written = [self._written(n) for n in ("fct_discharge", "fct_diagnosis", "fct_procedure")]

        def build(k: int) -> DataFrame:
            discharge, diagnosis, procedure = (t[k] for t in written)
            facts = discharge.drop(MONTH_COL, *PLACE), diagnosis.drop(*PLACE), procedure.drop(*PLACE)
            return discharge_summary(*facts, self.dim_code, self.bridge, self.year, ci=self.code_identifiers, runs=k == 1)

        if not self.materialize_core:
            return build(0), None
        cold = self._save_fact(build(0), "discharge_summary")
        return cold, None if written[1][1] is None else materialize(build(1), "discharge_summary-hot")

    # -- indicator -------------------------------------------------------
    def flags(self, spec: _ind.IndicatorSpec) -> DataFrame:
        key = ("flags", spec)
        if key not in self._cache:
            self._cache[key] = self._pin(_ind.code_flags(self.bridge, spec, self.year), f"flags-{spec.name}")
        return self._cache[key]

    def metrics_table(self, spec: _ind.IndicatorSpec | None = None, period: _ind.Period | None = None) -> DataFrame:
        """The monthly indicator written once, for checks and logs that read
        the published table rather than recomputing it."""
        spec = spec or _ind.IndicatorSpec()
        period = period or _ind.Period.year(self.year)
        key = ("metrics", spec, period)
        if key not in self._cache:
            self._cache[key] = materialize(self.monthly(spec, period), f"metrics-{spec.name}")
        return self._cache[key]

    @property
    def prefilter(self) -> bool:
        """The pre-filter of included encounters only pays off when the facts
        are not bucketed by encounter (then flag rows are shuffled)."""
        return not self.materialize_core

    def eligible(self, spec: _ind.IndicatorSpec, period: _ind.Period) -> DataFrame:
        """Eligible (patient_id, year_month) over all parts."""
        return self.over_parts(
            lambda p: _ind.eligible(p.discharge, p.diagnosis, p.procedure, self.flags(spec), spec, period, self.prefilter)
        )

    def monthly(self, spec: _ind.IndicatorSpec | None = None, period: _ind.Period | None = None) -> DataFrame:
        spec = spec or _ind.IndicatorSpec()
        return _ind.monthly_of(self.eligible(spec, period or _ind.Period.year(self.year)), spec)


def fixture_warehouse(spark: SparkSession, sf_dir: str, year: int = 1997, sepsis_hi: int = 12) -> Warehouse:
    """Warehouse over the driver-table projection (see FIXTURES.md)."""
    return Warehouse(spark, raw_inputs(spark, sf_dir, sepsis_hi=sepsis_hi), year)
