import decimal
import math
from collections import Counter

import pytest

import __spark_entry__ as entry
from marketloom.plans import listing_queries, reference_queries

from conftest import SMALL

CORE = {**listing_queries.QUERIES, **reference_queries.QUERIES}


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if math.isnan(v) else round(float(v), 6)
    return v


@pytest.mark.parametrize("name", sorted(CORE))
def test_against_sql(spark, duck, name):
    df = CORE[name](spark, SMALL)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    want = duck.sql(sql)
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert Counter(tuple(plain(r[c]) for c in columns) for r in rows) == Counter(tuple(plain(r[i]) for i in at) for r in want.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["marketplace", "external_id"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
