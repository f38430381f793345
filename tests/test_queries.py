"""Every registered query against its SQL; the others must at least yield rows."""

import pytest

from compare import connect, difference
from statlake.bindings import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
# Trains 400 trees; tests/test_models.py covers the grid on a smaller one.
SLOW = {"train_grid_metrics"}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    text, _ = difference(QUERIES[name](spark, FOLDER), duck, ORACLES[name])
    assert text == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_yields_rows(spark, name):
    assert not QUERIES[name](spark, FOLDER).isEmpty()


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns[:2] == ["game_id", "athlete_id"]
