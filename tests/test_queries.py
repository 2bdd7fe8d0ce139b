import check_queries
import pytest

from __spark_entry__ import entry, oracle_sql
from __spark_entry__ import queries as all_queries
from catalog import QUERIES

SF = "/root/testdata/sf0.001"


def queries():
    """The package's own queries; those of the optional subpackage have their own tests."""
    return dict(QUERIES)


@pytest.fixture(scope="module")
def con():
    return check_queries.connect(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_agrees_with_sql(spark, con, name):
    df = queries()[name](spark, SF)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        result = check_queries.compare(df, con, sql)
        assert result.startswith("ok"), result


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(all_queries()) and set(QUERIES) <= set(all_queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["entity_id", "name"] and df.count() > 0


# A cross join, a nested loop or Python code would not survive large tables.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.mark.parametrize("name", sorted(set(queries()) - {"alert_predictions", "confusion_counts", "tfidf_hashed"}))
def test_plans(spark, plan, capsys, name):
    text = plan(queries()[name](spark, SF), capsys)
    assert not [w for w in UNWANTED if w in text]


def test_filters_and_columns_reach_the_scan(spark, plan, capsys):
    text = plan(queries()["over_threshold"](spark, SF), capsys)
    assert "GreaterThan(l_quantity,45.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double>" in text
    text = plan(queries()["rule_scores"](spark, SF), capsys)
    assert "In(l_returnflag, [A,R])" in text and "Exchange" not in text
    text = plan(queries()["entity_series"](spark, SF), capsys)
    assert "user_id" in text.split("PushedFilters")[1]
