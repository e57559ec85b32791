import pytest

import __spark_entry__ as entry_points
from botlens.plans.catalog import QUERIES
from botlens.plans.oracle import ORACLES
from check import compare
from conftest import DATA


def test_entry_runs(spark):
    frame = entry_points.entry(spark)
    assert frame.count() == 483


def test_every_twin_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, name):
    said, _, good = compare(spark, DATA, name)
    assert good, said
