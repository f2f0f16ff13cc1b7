"""Arrays of hot encounters: equal lines are one element with their number."""

from dataclasses import replace

from pyspark.sql import functions as F

from indicata.operators.summary import expanded, flatten_summary
from indicata.plans.warehouse import Warehouse
from indicata.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equal_lines_of_a_hot_encounter_take_one_element(spark):
    raw = fx.raw_inputs(spark, SF_SMALL)
    more = spark.range(20_000).selectExpr("'3' AS patient_id", "concat('D', lpad(int(id % 4), 3, '0')) AS diag_code", "IF(id % 3 = 0, NULL, 2 + id % 2) AS diag_rank_num", "'Y' AS present_on_admission_ind")
    codes = spark.range(6_000).selectExpr("'3' AS patient_id", "IF(id % 9 = 0, NULL, concat('P00', id % 3)) AS procedure_code")
    raw = replace(raw, diagnosis=raw.diagnosis.unionByName(more), procedure=raw.procedure.unionByName(codes))
    w, lazy = Warehouse(spark, raw, 1997), Warehouse(spark, raw, 1997, materialize_core=False)
    cold, hot = w._summaries
    assert cold.filter("patient_id = 3").isEmpty()
    sizes = hot.select(F.size("secondary_diagnoses").alias("d"), F.size("procedures").alias("p")).collect()
    assert sizes and all(r.d < 60 and r.p < 20 for r in sizes)
    plain = _rows(flatten_summary(lazy.discharge_summary))
    assert _rows(w.discharge_summary_flat) == plain
    assert _rows(flatten_summary(cold.unionByName(expanded(hot)))) == plain
    assert w.discharge_summary.schema["secondary_diagnoses"].dataType == lazy.discharge_summary.schema["secondary_diagnoses"].dataType
