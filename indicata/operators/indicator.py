"""Cohort indicator: inclusion and exclusion cohorts, eligibility, and the
monthly numerator / denominator / rate.

The indicator is data (``IndicatorSpec``), not code. The physical shape is
chosen for scale:

* every code-set test becomes a flag in one small ``code_flags`` table keyed
  by ``code_sk`` (bounded by the code lists, broadcast after a size check);
* diagnosis and procedure facts are joined map-side to those flags and
  *filtered to rows that can set a flag* before anything is shuffled;
* each fact is grouped by ``patient_id`` once, turning all EXISTS tests
  into per-encounter flags (partial aggregation collapses hot keys map-side);
* the inclusion cohort left-joins those flags on ``patient_id``; with facts
  bucketed by encounter all of this is co-located (no exchange), the
  per-(encounter, month) grouping reuses that partitioning, and the final
  monthly aggregate shuffles at most one row per month per task.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.functions import month_label, safe_rate
from indicata.operators.joins import bounded_broadcast, having, narrowed


@dataclass(frozen=True)
class IndicatorSpec:
    """Declarative definition of a cohort-based indicator.

    Defaults are the postoperative-sepsis indicator of the source design.
    """

    # Identifier vocabulary of the default indicator.
    name: str = "psi13"
    numerator_identifiers: tuple[str, ...] = ("SEPTI2D",)
    surgical_drg_identifiers: tuple[str, ...] = ("SURGI2R",)
    or_procedure_identifiers: tuple[str, ...] = ("ORPROC",)
    principal_exclusion_identifiers: tuple[str, ...] = ("SEPTI2D", "INFECID", "MDC14PRINDX", "MDC15PRINDX")
    secondary_poa_exclusion_identifiers: tuple[str, ...] = ("SEPTI2D", "INFECID")
    ungroupable_drg: str = "999"
    require_elective: bool = True
    require_adult: bool = True
    digits: int = 3
    extra: dict = field(default_factory=dict, compare=False)


@dataclass(frozen=True)
class Period:
    """Inclusive discharge-date range, always whole months."""

    start: _dt.date
    end: _dt.date

    @staticmethod
    def year(y: int) -> "Period":
        return Period(_dt.date(y, 1, 1), _dt.date(y, 12, 31))

    @staticmethod
    def months(start_month: str, end_month: str) -> "Period":
        """From ``yyyy-MM`` to ``yyyy-MM`` inclusive (backfill form)."""
        sy, sm = (int(x) for x in start_month.split("-"))
        ey, em = (int(x) for x in end_month.split("-"))
        nxt = _dt.date(ey + (em == 12), em % 12 + 1, 1)
        return Period(_dt.date(sy, sm, 1), nxt - _dt.timedelta(days=1))

    @staticmethod
    def rolling(run_date: _dt.date, n_months: int = 12) -> "Period":
        """Month of ``run_date`` plus the previous ``n_months - 1`` months."""
        idx = run_date.year * 12 + run_date.month - 1 - (n_months - 1)
        start = _dt.date(idx // 12, idx % 12 + 1, 1)
        nxt = _dt.date(run_date.year + (run_date.month == 12), run_date.month % 12 + 1, 1)
        return Period(start, nxt - _dt.timedelta(days=1))

    def contains(self, d: Column) -> Column:
        return d.between(F.lit(self.start), F.lit(self.end))


# Year of discharge of a fact row's encounter; null where it has not one year.
YEAR_COL = "discharge_year"
# First day of the month of discharge of a fact row's encounter; null where it has not one month.
ENCOUNTER_MONTH = "encounter_month"


def of_period(rows: DataFrame, period: Period) -> DataFrame:
    """Rows of encounters that can have a discharge in ``period``. Facts
    partitioned by ``YEAR_COL`` are read for those years only, and of files
    sorted by ``ENCOUNTER_MONTH`` the row groups and pages of those months; rows
    without a year or month are always read, and facts without the columns are
    left whole."""
    year, month = F.col(YEAR_COL), F.col(ENCOUNTER_MONTH)
    if ENCOUNTER_MONTH in rows.columns:
        rows = rows.filter(month.isNull() | month.between(F.lit(period.start.replace(day=1)), F.lit(period.end))).drop(ENCOUNTER_MONTH)
    if YEAR_COL in rows.columns:
        rows = rows.filter(year.isNull() | year.between(period.start.year, period.end.year)).drop(YEAR_COL)
    return rows


def _flag(cond: Column) -> Column:
    return F.max(F.when(cond, 1).otherwise(0))


def flag_columns(spec: IndicatorSpec) -> list[Column]:
    """Aggregates over (code_type, identifier) rows: a code's part in each test of ``spec``."""
    t, ident = F.col("code_type"), F.col("identifier")
    dx = t == "Diagnosis"
    return [
        _flag(dx & ident.isin(list(spec.numerator_identifiers))).alias("is_numerator_code"),
        _flag(dx & ident.isin(list(spec.principal_exclusion_identifiers))).alias("is_principal_excl_code"),
        _flag(dx & ident.isin(list(spec.secondary_poa_exclusion_identifiers))).alias("is_secondary_excl_code"),
        _flag((t == "DRG") & ident.isin(list(spec.surgical_drg_identifiers))).alias("is_surgical_drg"),
        _flag((t == "Procedure") & ident.isin(list(spec.or_procedure_identifiers))).alias("is_or_procedure"),
    ]


def code_flags(bridge: DataFrame, spec: IndicatorSpec, ref_year: int) -> DataFrame:
    """One row per code key that takes part in any code-set test of ``spec``."""
    flags = bridge.filter(F.col("reference_year") == ref_year).groupBy("code_sk").agg(*flag_columns(spec))
    any_flag = None
    for c in flags.columns[1:]:
        any_flag = (F.col(c) == 1) if any_flag is None else any_flag | (F.col(c) == 1)
    return flags.filter(any_flag)


def _keys_with(flags: DataFrame, flag: str, key_name: str) -> DataFrame:
    return bounded_broadcast(narrowed(flags, flags.filter(F.col(flag) == 1).select(F.col("code_sk").alias(key_name))))


def ungroupable_drg(discharge: DataFrame, spec: IndicatorSpec) -> Column:
    """DRG missing or the ungroupable sentinel."""
    return F.col("drg").isNull() | (F.col("drg") == spec.ungroupable_drg)


def inclusion_filter(spec: IndicatorSpec, period: Period) -> Column:
    cond = period.contains(F.col("discharge_date")) & F.col("drg").isNotNull() & (F.col("drg") != spec.ungroupable_drg)
    if spec.require_elective:
        cond = cond & (F.col("is_elective") == 1)
    if spec.require_adult:
        cond = cond & (F.col("is_adult") == 1)
    return cond


def surgical_discharges(discharge: DataFrame, flags: DataFrame, spec: IndicatorSpec, period: Period) -> DataFrame:
    """Discharges passing the row filters whose DRG carries a surgical identifier.

    When the discharge fact carries ``discharge_month``, the period is applied
    to it as well (it reaches the scan as a pushed filter).
    """
    discharge, cond = of_period(discharge, period), inclusion_filter(spec, period)
    if "discharge_month" in discharge.columns:
        first = period.start.replace(day=1)
        cond = cond & F.col("discharge_month").between(F.lit(first), F.lit(period.end))
    return having(
        discharge.filter(cond),
        _keys_with(flags, "is_surgical_drg", "drg_code_sk"),
        "drg_code_sk",
    )


def or_procedure_patients(procedure: DataFrame, flags: DataFrame) -> DataFrame:
    """Distinct encounters with at least one operating-room procedure."""
    return having(procedure, _keys_with(flags, "is_or_procedure", "procedure_code_sk"), "procedure_code_sk").select(
        "patient_id"
    ).distinct()


def inclusions(
    discharge: DataFrame, procedure: DataFrame, flags: DataFrame, spec: IndicatorSpec, period: Period
) -> DataFrame:
    """Denominator inclusions: distinct (patient_id, year_month)."""
    surg = surgical_discharges(discharge, flags, spec, period)
    return having(surg, or_procedure_patients(of_period(procedure, period), flags), "patient_id").select(
        "patient_id", month_label(F.col("discharge_date")).alias("year_month")
    ).distinct()


def _diagnosis_flag_rows(diagnosis: DataFrame, flags: DataFrame) -> DataFrame:
    """Diagnosis rows that can set an exclusion or numerator flag, with those flags."""
    f = bounded_broadcast(narrowed(flags,
        flags.filter(
            (F.col("is_numerator_code") == 1) | (F.col("is_principal_excl_code") == 1) | (F.col("is_secondary_excl_code") == 1)
        ).select(
            F.col("code_sk").alias("diag_code_sk"),
            "is_numerator_code",
            "is_principal_excl_code",
            "is_secondary_excl_code",
        )
    ))
    principal = F.col("is_principal_diag") == 1
    secondary = F.col("is_principal_diag") == 0
    excl_principal = principal & (F.col("is_principal_excl_code") == 1)
    excl_secondary = secondary & (F.col("is_present_on_admission") == 1) & (F.col("is_secondary_excl_code") == 1)
    numer = secondary & (F.col("is_numerator_code") == 1)
    return (
        diagnosis.join(f, "diag_code_sk")
        .select(
            "patient_id",
            F.when(excl_principal, 1).otherwise(0).alias("excl_principal"),
            F.when(excl_secondary, 1).otherwise(0).alias("excl_secondary"),
            F.lit(0).alias("excl_drg"),
            F.when(numer, 1).otherwise(0).alias("numer"),
            F.lit(0).alias("or_proc"),
        )
        .filter("excl_principal = 1 OR excl_secondary = 1 OR numer = 1")
    )


def _only(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    return rows if ids is None else having(rows, ids, "patient_id")


def included_ids(included: DataFrame) -> DataFrame:
    """Distinct included encounter ids; rows of other encounters are dropped by
    a plain semi-join whose strategy Spark picks at runtime, the same at every
    size."""
    return included.select("patient_id").distinct()


def encounter_flags(
    base: DataFrame,
    discharge: DataFrame,
    diagnosis: DataFrame,
    procedure: DataFrame | None,
    flags: DataFrame,
    spec: IndicatorSpec,
    only_ids: DataFrame | None = None,
    with_procedures: bool = True,
) -> DataFrame:
    """``base`` (rows keyed by ``patient_id``) with the encounter's flags.

    Adds excl_principal, excl_secondary, excl_drg, numer and or_proc (0/1).
    Each fact is reduced to one row per encounter on its own (a hash
    aggregate; a hot encounter collapses map-side) and left-joined to
    ``base``. No fact rows are unioned, so when the facts are bucketed by
    encounter (``Warehouse``) every step is co-located and nothing is
    shuffled; left joins keep ``base``'s partitioning for later groupings.
    ``only_ids`` (a set of ids) drops rows of other encounters first.
    """
    dx = (
        _only(_diagnosis_flag_rows(diagnosis, flags), only_ids)
        .groupBy("patient_id")
        .agg(*[F.max(c).alias(c) for c in ("excl_principal", "excl_secondary", "numer")])
    )
    dd = (
        _only(discharge.filter(ungroupable_drg(discharge, spec)), only_ids)
        .groupBy("patient_id")
        .agg(F.max(F.lit(1)).alias("excl_drg"))
    )
    out = base.join(dx, "patient_id", "left").join(dd, "patient_id", "left")
    if with_procedures:
        px = (
            _only(having(procedure, _keys_with(flags, "is_or_procedure", "procedure_code_sk"), "procedure_code_sk"), only_ids)
            .groupBy("patient_id")
            .agg(F.max(F.lit(1)).alias("or_proc"))
        )
        out = out.join(px, "patient_id", "left")
    zero = F.lit(0)
    cols = ("excl_principal", "excl_secondary", "excl_drg", "numer") + (("or_proc",) if with_procedures else ())
    return out.select(*base.columns, *[F.coalesce(F.col(c), zero).alias(c) for c in cols])


def exclusions(
    discharge: DataFrame, diagnosis: DataFrame, flags: DataFrame, spec: IndicatorSpec
) -> DataFrame:
    """Denominator exclusions: distinct patient_id of encounters present in
    ``discharge`` with an excluding principal diagnosis, an excluding
    secondary diagnosis present on admission, or a missing/ungroupable DRG.

    Driven by the discharge fact's encounters with left-joined flags, so with
    encounter-bucketed facts nothing is shuffled."""
    encounters = discharge.select("patient_id").distinct()
    flagged = encounter_flags(encounters, discharge, diagnosis, None, flags, spec, with_procedures=False)
    return flagged.filter("excl_principal = 1 OR excl_secondary = 1 OR excl_drg = 1").select("patient_id")


def eligible(
    discharge: DataFrame,
    diagnosis: DataFrame,
    procedure: DataFrame,
    flags: DataFrame,
    spec: IndicatorSpec,
    period: Period,
    prefilter: bool = True,
) -> DataFrame:
    """Eligible (patient_id, year_month) with ``in_numerator`` 0/1 and the
    earliest discharge date of the month, one row each.

    The grouping on (patient_id, year_month) is satisfied by the join's
    hash partitioning on patient_id, so it adds no exchange. With
    ``prefilter`` the fact rows of other encounters are dropped by a semi-join
    before they are aggregated; worth it when the facts are not co-located.
    """
    discharge, diagnosis, procedure = (of_period(t, period) for t in (discharge, diagnosis, procedure))
    included = surgical_discharges(discharge, flags, spec, period).select(
        "patient_id", "discharge_date", month_label(F.col("discharge_date")).alias("year_month")
    )
    ids = included_ids(included) if prefilter else None
    flagged = encounter_flags(included, discharge, diagnosis, procedure, flags, spec, ids).filter(
        "or_proc = 1 AND excl_principal = 0 AND excl_secondary = 0 AND excl_drg = 0"
    )
    return (
        flagged.groupBy("patient_id", "year_month")
        .agg(
            F.max("numer").cast("bigint").alias("in_numerator"),
            F.min("discharge_date").alias("discharge_date"),
        )
    )


def monthly_indicator(
    discharge: DataFrame,
    diagnosis: DataFrame,
    procedure: DataFrame,
    flags: DataFrame,
    spec: IndicatorSpec,
    period: Period,
    month_col: str = "month",
    prefilter: bool = True,
) -> DataFrame:
    """Numerator, denominator and rounded rate per discharge month.

    A month with no eligible encounter has no row (see ``with_month_spine``).
    """
    return monthly_of(eligible(discharge, diagnosis, procedure, flags, spec, period, prefilter), spec, month_col)


def monthly_of(cohort: DataFrame, spec: IndicatorSpec, month_col: str = "month") -> DataFrame:
    """Numerator, denominator and rounded rate per month of an ``eligible`` cohort."""
    return (
        cohort.groupBy("year_month")
        .agg(F.sum("in_numerator").cast("bigint").alias("numerator"), F.count(F.lit(1)).alias("denominator"))
        .select(
            F.col("year_month").alias(month_col),
            "numerator",
            "denominator",
            safe_rate(F.col("numerator"), F.col("denominator"), spec.digits).alias("rate"),
        )
        .orderBy(month_col)
    )


def exclusion_reasons(
    discharge: DataFrame,
    diagnosis: DataFrame,
    procedure: DataFrame,
    flags: DataFrame,
    spec: IndicatorSpec,
    period: Period,
    prefilter: bool = True,
) -> DataFrame:
    """Included encounters per month and exclusion reason (an encounter may
    count under several reasons); reason ``none`` counts the eligible ones."""
    discharge, diagnosis, procedure = (of_period(t, period) for t in (discharge, diagnosis, procedure))
    included = surgical_discharges(discharge, flags, spec, period).select(
        "patient_id", month_label(F.col("discharge_date")).alias("year_month")
    )
    ids = included_ids(included) if prefilter else None
    flagged = encounter_flags(included, discharge, diagnosis, procedure, flags, spec, ids)
    per_enc = (
        flagged.filter("or_proc = 1")
        .groupBy("patient_id", "year_month")
        .agg(*[F.max(c).alias(c) for c in ("excl_principal", "excl_secondary", "excl_drg")])
    )
    none = (F.col("excl_principal") == 0) & (F.col("excl_secondary") == 0) & (F.col("excl_drg") == 0)
    reasons = F.array(
        F.when(F.col("excl_principal") == 1, F.lit("principal_diagnosis")),
        F.when(F.col("excl_secondary") == 1, F.lit("secondary_present_on_admission")),
        F.when(F.col("excl_drg") == 1, F.lit("ungroupable_drg")),
        F.when(none, F.lit("none")),
    )
    return (
        per_enc.select("year_month", F.explode(F.filter(reasons, lambda r: r.isNotNull())).alias("reason"))
        .groupBy("year_month", "reason")
        .agg(F.count(F.lit(1)).alias("encounters"))
    )


def numerator_patients(
    discharge: DataFrame,
    diagnosis: DataFrame,
    procedure: DataFrame,
    flags: DataFrame,
    spec: IndicatorSpec,
    period: Period,
    *,
    ref_version: Column | str,
    run_id: str,
    computed_at: Column,
    prefilter: bool = True,
) -> DataFrame:
    """Audit rows: one per numerator encounter x month, with the qualifying
    code chosen as the lowest (rank, code) among qualifying diagnoses."""
    el = eligible(discharge, diagnosis, procedure, flags, spec, period, prefilter).filter("in_numerator = 1")
    numer_codes = bounded_broadcast(
        narrowed(flags, flags.filter(F.col("is_numerator_code") == 1).select(F.col("code_sk").alias("diag_code_sk")))
    )
    qual = (
        having(of_period(diagnosis, period).filter(F.col("is_principal_diag") == 0), numer_codes, "diag_code_sk")
        .groupBy("patient_id")
        .agg(
            F.min(
                F.struct(
                    F.col("diag_rank_num").alias("rank"),
                    F.col("diag_code").alias("code"),
                    F.col("diag_code_sk").alias("code_sk"),
                    F.col("is_principal_diag").alias("is_principal_diag"),
                    F.col("is_present_on_admission").alias("is_present_on_admission"),
                )
            ).alias("q")
        )
    )
    rv = F.lit(ref_version) if isinstance(ref_version, str) else ref_version
    return (
        el.join(qual, "patient_id")
        .select(
            "patient_id",
            "discharge_date",
            "year_month",
            F.col("q.code").alias("qualifying_sepsis_code"),
            F.col("q.code_sk").alias("qualifying_sepsis_code_sk"),
            F.col("q.is_principal_diag").alias("is_principal_diag"),
            F.col("q.is_present_on_admission").alias("is_present_on_admission"),
            rv.alias("ref_version"),
            F.lit(run_id).alias("run_id"),
            computed_at.alias("computed_at"),
        )
    )
