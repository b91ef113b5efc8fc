"""The registered queries against their SQL on the smallest tables."""

import compare
import pytest

from weftwork.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, data, name):
    assert compare.difference(QUERIES[name](spark, data), compare.connect(data), ORACLES[name]) is None
