import pytest

import __spark_entry__ as entry
from check_oracles import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", entry.queries())
def test_query_equals_its_sql_twin(spark, con, name):
    run, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql is None:
        assert run(spark, SF_DIR).count() > 0
    else:
        assert compare(spark, con, run, sql, SF_DIR) is None


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "qid", "rank", "score", "label"] and df.count() == 5000
