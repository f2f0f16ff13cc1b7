"""The model built a second time."""

from indicata.plans import catalog
from indicata.plans.warehouse import Warehouse, fixture_warehouse
from tests.conftest import SF_SMALL


def test_the_second_model_is_dealt_to_more_tasks_where_there_are_more_buckets(spark, monkeypatch):
    w, dealt = fixture_warehouse(spark, SF_SMALL), []
    w.buckets = 24

    def noted(session, raw, year, **k):
        dealt.append(raw.diagnosis.rdd.getNumPartitions())
        return Warehouse(session, raw, year, **k)

    monkeypatch.setitem(catalog._WAREHOUSES, (spark, SF_SMALL, 12), w)
    monkeypatch.setattr(catalog, "Warehouse", noted)
    assert all(r.passed for r in catalog.dq_rerun(spark, SF_SMALL).collect())
    assert dealt == [15]
