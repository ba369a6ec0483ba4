from __future__ import annotations

import pytest
from check import compare, connect
from conftest import SMALL

from paperloom.llm.queries import QUERIES


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is not None])
def test_equals_sql(spark, name):
    got = QUERIES[name].run(spark, SMALL).toArrow()
    assert compare(got, connect(SMALL).execute(QUERIES[name].sql).to_arrow_table()) == []
