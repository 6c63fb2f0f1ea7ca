"""Every query with a SQL counterpart gives the same rows, columns and types as DuckDB."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracles import ALIKE, sorted_rows, views  # noqa: E402

from postlens.plans.catalog import QUERIES  # noqa: E402
from postlens.plans.oracles import ORACLES  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf):
    return views(sf)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_as_sql(spark, sf, duck, key):
    frame = QUERIES[key](spark, sf)
    cursor = duck.execute(ORACLES[key])
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]).upper() for d in cursor.description}
    assert {c: ALIKE.get(t, t.upper()) for c, t in frame.dtypes} == types
    assert sorted_rows(frame.columns, frame.collect()) == sorted_rows(names, cursor.fetchall())
