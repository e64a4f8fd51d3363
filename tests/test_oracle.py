"""Every registered query with a SQL twin, against DuckDB at sf0.001."""

import pytest

from paths import SF_SMALL
from oracle import compare
from tessera.plans.registry import oracle_sql, queries

SQL = oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    sdf = queries()[name](spark, SF_SMALL).toPandas()
    odf = duck.execute(SQL[name]).df()
    msg = compare(sdf, odf)
    assert msg is None, msg


