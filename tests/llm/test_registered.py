"""Registered queries against their SQL; the others have tests of their own."""

import math

import pytest

from checks.compare import connect
from exposcan.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def rounded(value):
    return round(value, 9) if isinstance(value, float) and math.isfinite(value) else value


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    frame = QUERIES[name](spark, SF)
    order = sorted(frame.columns)
    got = sorted((tuple(map(rounded, r)) for r in frame.select(*order).collect()), key=str)
    result = connect(SF).execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == order
    want = sorted((tuple(rounded(r[columns.index(c)]) for c in order) for r in result.fetchall()), key=str)
    assert got == want


def test_one_query_per_operator():
    numbers = [name.split("_")[0] for name in QUERIES if name != "pipeline"]
    assert numbers == [f"op{n}" for n in range(1, 14)]
