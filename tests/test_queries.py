"""Every query with SQL against DuckDB, the others for rows and a stable schema."""

from __future__ import annotations

import pytest

from quire.plans import catalog
from tests.conftest import SF, same_rows


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert same_rows(catalog.queries()[name](spark, SF), duck.sql(catalog.oracle_sql()[name]))


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 3
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
