"""The driver contract: entry() schema, queries() / oracle_sql() consistency."""

import os

import pytest

import __spark_entry__ as E
from lexiframe.plans.queries import QUERIES


def test_registry_and_oracles_are_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # optional subpackages keep their own account
    assert not (set(q) - set(o)) & set(QUERIES)
    assert set(QUERIES) <= set(q)


@pytest.mark.skipif(not os.path.exists(E.SMOKE_DIR), reason="driver test data not present")
def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "doc_id", "score", "rank"]
    rows = df.collect()
    assert rows and all(1 <= r.rank <= 10 for r in rows)
