"""The number of tasks follows the tables."""

from dataclasses import replace

from indicata.plans.warehouse import Warehouse
from indicata.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_a_bucket_takes_at_most_half_a_million_lines(spark):
    raw = fx.raw_inputs(spark, SF_SMALL)
    for lines in (3_600_000, 6_000_000, 36_000_000):
        w = Warehouse(spark, replace(raw, diagnosis=spark.range(lines)), 1997)
        assert lines / w.fact_buckets <= 500_000
