"""Queries with SQL give its rows on the small tables; the others run over whole tables."""

import pytest

import compare
from skygrid.llm import queries


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_same_rows(spark, small, name):
    said = compare.compare(spark, compare.connect(small), small, name)
    assert said.startswith(("same", "rows")), said
