"""Every registered query equals its DuckDB oracle on the small fixture.

The training-data queries, when their folder is there, are tested in its own
test folder.
"""

import pytest

import __spark_entry__ as entry
from indicata.plans import catalog, oracle
from tests.oracle_check import _norm, _family, spark_types

from tests.conftest import SF_SMALL

KEYS = sorted(catalog.QUERIES)


def test_every_query_has_an_oracle():
    assert set(oracle.oracle_sql()) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    sdf = entry.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    rel = duck.sql(entry.oracle_sql()[key])
    orows = rel.fetchall()
    scols, ocols = list(sdf.columns), list(rel.columns)
    assert sorted(scols) == sorted(ocols)
    stypes = spark_types(sdf)
    otypes = {c: _family(str(t)) for c, t in zip(rel.columns, rel.types)}
    assert {c: stypes[c] for c in scols} == {c: otypes[c] for c in scols}
    order = sorted(scols)
    a = sorted(tuple(_norm(r[scols.index(c)]) for c in order) for r in srows)
    b = sorted(tuple(_norm(r[ocols.index(c)]) for c in order) for r in orows)
    assert a == b


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert [r.month for r in rows] == sorted(r.month for r in rows)
    assert sum(r.denominator for r in rows) == 6 and sum(r.numerator for r in rows) == 0
