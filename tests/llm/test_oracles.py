"""Training-data queries against their SQL."""

import pytest

from folio.llm.oracles import ORACLES
from folio.llm.queries import QUERIES
from tests.oracle import connect, duck_rows, spark_rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, data, name):
    assert spark_rows(QUERIES[name](spark, data)) == duck_rows(connect(data), ORACLES[name])
