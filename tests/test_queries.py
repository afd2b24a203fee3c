"""Every registered query against its SQL statement."""

from __future__ import annotations

import pytest

from skerry.plans import load_all
from skerry.plans.registry import Tables
from tests.oracle import TESTDATA, connect, difference

SF_DIR = f"{TESTDATA}/sf0.001"
LARGER = f"{TESTDATA}/sf0.01"
REGISTRY = load_all()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.oracle])
def test_matches_sql(spark, duck, name):
    query = REGISTRY[name]
    problem = difference(duck, query.build(Tables(spark, SF_DIR)), query.oracle)
    if problem == "no rows on either side":  # equal and empty proves nothing
        problem = difference(connect(LARGER), query.build(Tables(spark, LARGER)), query.oracle)
    assert problem is None, problem


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if not q.oracle])
def test_gives_rows(spark, name):
    assert REGISTRY[name].build(Tables(spark, SF_DIR)).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
