"""Core layer: typed encounter tables and the three fact tables.

Facts are narrow per-row projections plus one broadcast lookup into the
(bounded) code dimension, so building them never shuffles encounter data.
Date keys are computed arithmetically (see ``date_key``) instead of joining
the day dimension three times.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.functions import (
    adult_flag,
    age_at_admission,
    date_key,
    diag_type,
    elective_flag,
    present_flag,
    principal_flag,
    safe_date,
    strict_bigint,
    surrogate_key,
)
from indicata.operators.joins import lookup, narrowed
from indicata.operators.reference import DATE_DIM_END, DATE_DIM_START, UNKNOWN

# Fixed values of the fact contract.
MISSING_DATE = _dt.date(1900, 1, 1)
MISSING_POA = "N"

FCT_DISCHARGE_COLUMNS = [
    "patient_id",
    "birth_date",
    "birth_date_sk",
    "age_at_admission",
    "is_adult",
    "admission_date",
    "admission_date_sk",
    "admission_type",
    "is_elective",
    "discharge_date",
    "discharge_date_sk",
    "drg",
    "drg_code_sk",
]


def core_patient(raw: DataFrame) -> DataFrame:
    return raw.select(
        strict_bigint(F.col("patient_id"), "patient_id").alias("patient_id"),
        "drg",
        safe_date(F.col("birth_date")).alias("birth_date"),
        safe_date(F.col("admission_date")).alias("admission_date"),
        safe_date(F.col("discharge_date")).alias("discharge_date"),
        "admission_type",
    )


def core_procedure(raw: DataFrame) -> DataFrame:
    return raw.select(strict_bigint(F.col("patient_id"), "patient_id").alias("patient_id"), "procedure_code")


def core_diagnosis(raw: DataFrame) -> DataFrame:
    return raw.select(
        strict_bigint(F.col("patient_id"), "patient_id").alias("patient_id"),
        "diag_code",
        F.col("diag_rank_num").cast("bigint").alias("diag_rank_num"),
        "present_on_admission_ind",
    )


def unknown_fallback_key(code_type: str, year: int, resolve_unknown: bool = False) -> str | F.Column:
    """Key given to codes missing from the dimension.

    By default this is sha256(type|UNKNOWN|year), which does *not* match the
    dimension's UNKNOWN member sha256(UNKNOWN|type|year): unmapped codes
    become visible orphans (see ``dq_fk_orphans``). ``resolve_unknown=True``
    points them at the UNKNOWN member instead.
    """
    if resolve_unknown:
        return surrogate_key(UNKNOWN, code_type, year)
    return surrogate_key(code_type, UNKNOWN, year)


def code_keys(dim: DataFrame, code_type: str, year: int | None, code_name: str, sk_name: str) -> DataFrame:
    """The (code -> key) slice of the dimension for one type and year; without a
    year the keys of all years, by (code, reference_year)."""
    if year is None:
        own = dim.filter(F.col("code_type") == code_type)
        return narrowed(dim, own.select(F.col("code").alias(code_name), "reference_year", F.col("code_sk").alias(sk_name)))
    return narrowed(
        dim,
        dim.filter((F.col("code_type") == code_type) & (F.col("reference_year") == year)).select(
            F.col("code").alias(code_name), F.col("code_sk").alias(sk_name)
        ),
    )


def fct_discharge(
    patient: DataFrame,
    dim: DataFrame,
    year: int,
    *,
    date_start: _dt.date = DATE_DIM_START,
    date_end: _dt.date = DATE_DIM_END,
    min_age: int = 18,
    strict_age: bool = False,
    resolve_unknown: bool = False,
) -> DataFrame:
    """One row per encounter with derived flags, date keys and the DRG key."""
    birth = F.coalesce(F.col("birth_date"), F.lit(MISSING_DATE))
    admit = F.coalesce(F.col("admission_date"), F.lit(MISSING_DATE))
    disch = F.coalesce(F.col("discharge_date"), F.lit(MISSING_DATE))
    typed = patient.select(
        "patient_id",
        birth.alias("birth_date"),
        date_key(birth, date_start, date_end).alias("birth_date_sk"),
        age_at_admission(F.col("birth_date"), F.col("admission_date")).alias("age_at_admission"),
        adult_flag(F.col("birth_date"), F.col("admission_date"), min_age, strict_age).alias("is_adult"),
        admit.alias("admission_date"),
        date_key(admit, date_start, date_end).alias("admission_date_sk"),
        F.coalesce(F.col("admission_type"), F.lit(UNKNOWN)).alias("admission_type"),
        elective_flag(F.col("admission_type")).alias("is_elective"),
        disch.alias("discharge_date"),
        date_key(disch, date_start, date_end).alias("discharge_date_sk"),
        F.coalesce(F.col("drg"), F.lit(UNKNOWN)).alias("drg"),
    )
    keyed = lookup(typed, code_keys(dim, "DRG", year, "drg", "_sk"), on=["drg"])
    return keyed.select(
        *FCT_DISCHARGE_COLUMNS[:-1],
        F.coalesce(F.col("_sk"), unknown_fallback_key("DRG", year, resolve_unknown)).alias("drg_code_sk"),
    )


def fct_diagnosis(diagnosis: DataFrame, dim: DataFrame, year: int, *, resolve_unknown: bool = False) -> DataFrame:
    typed = diagnosis.select(
        "patient_id",
        F.coalesce(F.col("diag_code"), F.lit(UNKNOWN)).alias("diag_code"),
        "diag_rank_num",
        diag_type(F.col("diag_rank_num")).alias("diag_type"),
        principal_flag(F.col("diag_rank_num")).alias("is_principal_diag"),
        F.coalesce(F.col("present_on_admission_ind"), F.lit(MISSING_POA)).alias("present_on_admission_ind"),
        present_flag(F.col("present_on_admission_ind")).alias("is_present_on_admission"),
    )
    keyed = lookup(typed, code_keys(dim, "Diagnosis", year, "diag_code", "_sk"), on=["diag_code"])
    return keyed.select(
        "patient_id",
        "diag_code",
        F.coalesce(F.col("_sk"), unknown_fallback_key("Diagnosis", year, resolve_unknown)).alias("diag_code_sk"),
        "diag_rank_num",
        "diag_type",
        "is_principal_diag",
        "present_on_admission_ind",
        "is_present_on_admission",
    )


def fct_procedure(procedure: DataFrame, dim: DataFrame, year: int, *, resolve_unknown: bool = False) -> DataFrame:
    typed = procedure.select("patient_id", F.coalesce(F.col("procedure_code"), F.lit(UNKNOWN)).alias("procedure_code"))
    keyed = lookup(typed, code_keys(dim, "Procedure", year, "procedure_code", "_sk"), on=["procedure_code"])
    return keyed.select(
        "patient_id",
        "procedure_code",
        F.coalesce(F.col("_sk"), unknown_fallback_key("Procedure", year, resolve_unknown)).alias("procedure_code_sk"),
    )
