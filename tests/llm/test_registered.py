"""Every query with SQL against DuckDB, on whole tables."""
import pytest

from panelspark.llm import catalog
from tests.llm.common import same_as_sql


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, name):
    same_as_sql(spark, catalog.queries()[name], catalog.oracle_sql()[name])
