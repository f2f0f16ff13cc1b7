"""Expose a warehouse to Spark SQL under the source model's table names.

Users of the source model query its tables with SQL; ``register_views`` makes
the same tables available to ``spark.sql`` as temporary views, so such
queries run on Spark (Catalyst plans them like the DataFrame code). The views
are the written, bucketed tables, so joins on ``patient_id`` stay co-located.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from indicata.operators.indicator import IndicatorSpec
from indicata.plans.warehouse import Warehouse


def warehouse_tables(w: Warehouse, spec: IndicatorSpec | None = None) -> dict[str, DataFrame]:
    """Table name -> DataFrame, by the source model's names."""
    spec = spec or IndicatorSpec()
    return {
        # Table names of the source model.
        "ref_appendix_code_identifier_map": w.code_map,
        "dim_code": w.dim_code,
        "bridge_code_identifier": w.bridge,
        "dim_date": w.dim_date,
        "patient": w.core_patient,
        "patient_procedure": w.core_procedure,
        "patient_diagnosis": w.core_diagnosis,
        "fct_discharge": w.fct_discharge,
        "fct_diagnosis": w.fct_diagnosis,
        "fct_procedure": w.fct_procedure,
        "discharge_summary": w.discharge_summary,
        "psi13_monthly_metrics": w.metrics_table(spec),
    }


def register_views(w: Warehouse, spec: IndicatorSpec | None = None, prefix: str = "") -> list[str]:
    """Create or replace one temporary view per table; returns the view names."""
    names = []
    for name, df in warehouse_tables(w, spec).items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
