"""Every registered query of the package runs over its whole table, and equals its SQL statement where there is one."""

from __future__ import annotations

import pytest

from skerry.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import TESTDATA, connect, difference

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    if name in ORACLE_SQL:
        assert difference(connect(SF_DIR), got, ORACLE_SQL[name]) is None
    else:
        assert got.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_entry_points():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
