import pytest

from cadenza.plans import speech_queries as q
from tests.helpers import SF, by_spark, by_sql


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert by_spark(q.QUERIES[name](spark, SF)) == by_sql(q.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - set(q.ORACLE_SQL)))
def test_query_runs(spark, name):
    assert q.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
