"""Child-line upserts replace the lines of corrected encounters only."""

from indicata.operators.incremental import replace_children


def test_lines_of_corrected_encounters_are_replaced(spark):
    schema = "patient_id bigint, code string"
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c"), (3, "d"), (None, "e")], schema)
    staged = spark.createDataFrame([(1, "b"), (1, "z"), (2, "ignored"), (None, "ignored")], schema)
    corrected = spark.createDataFrame([(1,), (1,), (3,), (None,)], "patient_id bigint")
    expected = [(None, "e"), (1, "b"), (1, "z"), (2, "c"), (2, "c")]
    once = replace_children(target, staged, corrected)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(map(tuple, once.collect()), key=key) == expected
    assert sorted(map(tuple, replace_children(once, staged, corrected).collect()), key=key) == expected
    assert sorted(map(tuple, replace_children(target, staged, corrected.limit(0)).collect()), key=key) == sorted(map(tuple, target.collect()), key=key)
