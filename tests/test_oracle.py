"""Every registered query against its SQL on the small tables."""

import pytest

from compare import connect, difference, spark_result, sql_result
from conftest import SMALL
from tickloom.registry.queries import QUERIES, statements

SQL = statements()


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(name, inputs, db):
    assert difference(spark_result(QUERIES[name].run(inputs)), sql_result(db, SQL[name])) is None


def test_only_the_forest_lacks_sql():
    assert set(QUERIES) - set(SQL) == {"isolation_forest", "triple_agreement"}
