"""Every registered query gives the rows of its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
import compare
from skygrid.plans import catalogue

TRAINED = {"m09_baselines", "m11_random_search", "m19_attributions", "m20_importance", "m18_background", "job_retrain"}


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n not in TRAINED])
def test_same_rows(spark, con, small, name):
    said = compare.compare(spark, con, small, name)
    assert said.startswith(("same", "rows")), said


def test_entry(spark):
    row = entry.entry(spark).collect()
    assert len(row) == 1 and {"tp", "fp", "fn", "tn", "f1"} <= set(row[0].asDict())


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
