"""Every registered query runs, and gives the rows of its SQL."""

import pytest

from folio.plans.registry import oracles, registered
from tests.oracle import connect, duck_rows, spark_rows


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(oracles()))
def test_equals_sql(spark, data, duck, name):
    assert spark_rows(registered()[name](spark, data)) == duck_rows(duck, oracles()[name])


@pytest.mark.parametrize("name", sorted(set(registered()) - set(oracles())))
def test_runs(spark, data, name):
    df = registered()[name](spark, data)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
