"""A stream of many staged files."""

from pyspark.sql import functions as F

from indicata.operators import incremental as inc
from indicata.sources import fixtures as fx
from indicata.sources.sinks import fresh_path
from indicata.streaming.ingest import apply_staged_extracts, changes_dir, epochs
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_stream_of_many_files_rewrites_the_table_once(spark):
    staged = fx.staged_patient(spark, SF_SMALL)
    staging, state, ckpt = fresh_path(spark, "stg"), fresh_path(spark, "state"), fresh_path(spark, "ckpt")
    fx.staged_patient(spark, SF_SMALL, versions=(1,)).repartition(4).write.parquet(staging)
    run = lambda: apply_staged_extracts(spark, staging, staged.schema, state, ["patient_id"], "updated_at", checkpoint_dir=ckpt, max_files_per_trigger=1)
    first = run()
    assert len(epochs(spark, state)) == 1 and first.count() == 1500
    assert epochs(spark, changes_dir(state)) == []
    fx.staged_patient(spark, SF_SMALL, versions=(2,)).repartition(3).write.mode("append").parquet(staging)
    # Changes of a run that was cut off before its snapshot are merged by the next run.
    late = first.limit(1).withColumn("drg", F.lit("late")).withColumn("updated_at", F.to_timestamp(F.lit("2030-01-01")).cast(staged.schema["updated_at"].dataType))
    late.write.parquet(f"{changes_dir(state)}/epoch=1000")
    final = run()
    assert len(epochs(spark, state)) == 2 and epochs(spark, changes_dir(state)) == []
    expected = inc.latest_by_key(staged.unionByName(late.select(staged.columns)), ["patient_id"], "updated_at")
    assert _rows(final) == _rows(expected)
