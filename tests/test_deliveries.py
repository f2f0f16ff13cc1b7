"""The deliveries of the quarantine query."""

from collections import Counter

from indicata.plans import catalog
from indicata.sources import fixtures as fx
from indicata.sources import sinks
from indicata.sources.sinks import child_names
from tests.conftest import SF_SMALL


def test_every_task_writes_a_file_of_the_short_delivery(spark, monkeypatch):
    plain, paths = fx.raw_diagnosis(spark, SF_SMALL).collect(), []

    def noted(session, name, path=sinks.fresh_path):
        paths.append(path(session, name))
        return paths[-1]

    whole = fx.raw_diagnosis(spark, SF_SMALL).repartition(5)
    monkeypatch.setattr(catalog.sinks, "fresh_path", noted)
    monkeypatch.setattr(catalog.fx, "raw_diagnosis", lambda *_: whole)
    got = catalog.src_quarantine(spark, SF_SMALL).collect()
    short = next(p for p in paths if "src_quarantine-short" in p)
    assert len([n for n in child_names(spark, short) if n.startswith("part-")]) >= 5
    kinds = {0: "header", 1: "tokens", 2: "cast"}
    assert Counter(r.reason for r in got) == Counter(kinds.get(int(r.patient_id) % 50, "loaded") for r in plain)
    assert sorted(r.patient_id for r in got) == sorted(r.patient_id for r in plain)
