"""The operators' SQL oracles on the small tables."""

import pytest

from scripts.check_oracle import digest
from tessera.llm import queries
from tests.conftest import SMALL_SF


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_oracle(spark, duck, name):
    sdf = queries.QUERIES[name](spark, SMALL_SF)
    rel = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in rel.description]
    assert sorted(columns) == sorted(sdf.columns)
    assert digest(sdf.columns, [tuple(r) for r in sdf.collect()])[1] == digest(columns, rel.fetchall())[1]
