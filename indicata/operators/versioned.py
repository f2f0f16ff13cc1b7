"""The indicator under effective-dated code lists.

Every discharge is judged by the code lists of the version that is effective
on its discharge date, so a window across a version change uses each month's
own codes. Codes are compared by text and version: facts need no surrogate
keys of any one year.

Defined results: a discharge outside all versions has no codes and is in no
cohort. A month that a version change splits carries the later version.

One pass: included encounters, their procedures, then their diagnosis lines
are joined on ``patient_id`` (co-located when the facts are bucketed by it)
and to the broadcast flag table; one aggregate per encounter and month gives
eligibility, numerator and the qualifying line together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.functions import month_label, safe_rate, surrogate_key
from indicata.operators.incremental import with_version
from indicata.operators.indicator import IndicatorSpec, Period, flag_columns, inclusion_filter, of_period, ungroupable_drg
from indicata.operators.intervals import RangeTable
from indicata.operators.joins import bounded_broadcast, having, lacking, narrowed
from indicata.operators.reference import UNKNOWN, code_map, with_unknown_members


def versioned_flags(versioned_map: DataFrame, spec: IndicatorSpec) -> DataFrame:
    """One row per (code type, code, version): its key and its part in each
    code-set test of ``spec``."""
    keys = ["code_type", "code", "ref_version"]
    flags = versioned_map.groupBy(*keys, "reference_year").agg(*flag_columns(spec))
    return flags.withColumn("code_sk", surrogate_key(F.col("code"), F.col("code_type"), F.col("reference_year"))).drop("reference_year")


def _codes(flags: DataFrame, code_type: str, name: str, *columns: str) -> DataFrame:
    own = flags.filter(F.col("code_type") == code_type).select(F.col("code").alias(name), "ref_version", *columns)
    return bounded_broadcast(narrowed(flags, own))


def eligible(
    discharge: DataFrame,
    diagnosis: DataFrame,
    procedure: DataFrame,
    flags: DataFrame,
    versions: RangeTable,
    spec: IndicatorSpec,
    period: Period,
) -> DataFrame:
    """Eligible (patient_id, year_month) with its version, earliest discharge
    date and the lowest (rank, code) qualifying line ``q`` (null: not in the
    numerator)."""
    discharge, diagnosis, procedure = (of_period(t, period) for t in (discharge, diagnosis, procedure))
    keys = ["patient_id", "discharge_date", "year_month", "ref_version"]

    dated = with_version(discharge.filter(inclusion_filter(spec, period)), "discharge_date", versions)
    surgical = _codes(flags, "DRG", "drg", "is_surgical_drg").filter("is_surgical_drg = 1")
    included = having(dated, surgical, ["drg", "ref_version"]).withColumn("year_month", month_label(F.col("discharge_date")))

    rooms = _codes(flags, "Procedure", "procedure_code", "is_or_procedure").filter("is_or_procedure = 1")
    operated = having(
        included.select(keys).join(procedure.select("patient_id", "procedure_code"), "patient_id"), rooms, ["procedure_code", "ref_version"]
    ).select(keys).distinct()

    lines = diagnosis.select("patient_id", "diag_code", "diag_rank_num", "is_principal_diag", "is_present_on_admission")
    marked = operated.join(lines, "patient_id", "left").join(
        _codes(flags, "Diagnosis", "diag_code", "code_sk", "is_numerator_code", "is_principal_excl_code", "is_secondary_excl_code"),
        ["diag_code", "ref_version"],
        "left",
    )
    principal, secondary = F.col("is_principal_diag") == 1, F.col("is_principal_diag") == 0
    excluded = (principal & (F.col("is_principal_excl_code") == 1)) | (
        secondary & (F.col("is_present_on_admission") == 1) & (F.col("is_secondary_excl_code") == 1)
    )
    line = F.struct(
        F.col("diag_rank_num").alias("rank"), F.col("diag_code").alias("code"), "code_sk", "is_principal_diag", "is_present_on_admission"
    )
    judged = marked.groupBy("patient_id", "year_month").agg(
        F.max(F.when(excluded, 1).otherwise(0)).alias("_excluded"),
        F.min(F.when(secondary & (F.col("is_numerator_code") == 1), line)).alias("q"),
        F.min("discharge_date").alias("discharge_date"),
        F.max("ref_version").alias("ref_version"),
    )
    ungroupable = discharge.filter(ungroupable_drg(discharge, spec)).select("patient_id")
    return lacking(judged.filter("_excluded = 0").drop("_excluded"), ungroupable, "patient_id")


def monthly(cohort: DataFrame, spec: IndicatorSpec, month_col: str = "month") -> DataFrame:
    """Numerator, denominator, rate and version per month of an ``eligible`` cohort."""
    sums = cohort.groupBy(F.col("year_month").alias(month_col)).agg(
        F.count("q").alias("numerator"), F.count(F.lit(1)).alias("denominator"), F.max("ref_version").alias("ref_version")
    )
    rate = safe_rate(F.col("numerator"), F.col("denominator"), spec.digits).alias("rate")
    return sums.select(month_col, "numerator", "denominator", rate, "ref_version").orderBy(month_col)


def numerator_patients(cohort: DataFrame, *, run_id: str, computed_at: Column) -> DataFrame:
    """Audit rows of an ``eligible`` cohort, each with its own version."""
    return cohort.filter(F.col("q").isNotNull()).select(
        "patient_id",
        "discharge_date",
        "year_month",
        F.col("q.code").alias("qualifying_sepsis_code"),
        F.col("q.code_sk").alias("qualifying_sepsis_code_sk"),
        F.col("q.is_principal_diag").alias("is_principal_diag"),
        F.col("q.is_present_on_admission").alias("is_present_on_admission"),
        "ref_version",
        F.lit(run_id).alias("run_id"),
        computed_at.alias("computed_at"),
    )


def versioned_dim(versioned_map: DataFrame) -> DataFrame:
    """Code keys of every version, UNKNOWN members included: (code_type, code, reference_year, code_sk, identifiers)."""
    members = with_unknown_members(code_map(versioned_map, None))
    key = surrogate_key(F.col("code"), F.col("code_type"), F.col("reference_year"))
    named = members.groupBy("code_type", "code", "reference_year").agg(F.array_sort(F.collect_set("identifier")).alias("identifiers"))
    return named.withColumn("code_sk", key)


def encounter_versions(patient: DataFrame, versions: RangeTable, years: RangeTable) -> DataFrame:
    """(patient_id, ref_version, reference_year) of the version effective on an
    encounter's last discharge (null: none is)."""
    last = patient.groupBy("patient_id").agg(F.max("discharge_date").alias("_last"))
    return last.select("patient_id", versions.at(F.col("_last")).alias("ref_version"), years.at(F.col("_last")).cast("bigint").alias("reference_year"))


#: Reference year of the fallback key of codes of no version.
NO_YEAR = -1


def rekeyed(fact: DataFrame, versions: DataFrame, dim: DataFrame, code_type: str, code: str, key: str) -> DataFrame:
    """A fact whose code key is that of the version effective for its encounter.

    ``versions`` (``encounter_versions``, bucketed like the fact) joins without
    a shuffle, the keys of all versions by code and year. A code that its
    version does not hold gets the type-first fallback key of that year."""
    own = F.col("code_type") == code_type
    keys = narrowed(dim, dim.filter(own).select(F.col("code").alias(code), "reference_year", F.col("code_sk").alias("_sk")))
    dated = fact.drop(key).join(versions, "patient_id", "left")
    found = dated.join(bounded_broadcast(keys), [code, "reference_year"], "left")
    fallback = surrogate_key(code_type, UNKNOWN, F.coalesce("reference_year", F.lit(NO_YEAR)))
    return found.withColumn(key, F.coalesce("_sk", fallback)).select(*fact.columns, "ref_version", "reference_year")
