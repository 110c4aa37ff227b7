"""Every registered query against its SQL, and no slow or unbounded operator in its plan."""

import re

import pytest

import __spark_entry__ as entry
from compare import check, duck, spark_rows
from stationlab.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
SLOW = re.compile(r"BatchEvalPython|ArrowEvalPython|InPandas|CartesianProduct|BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    seen = {}

    def run(s, d):
        df = QUERIES[name](s, d)
        seen["plan"] = df._jdf.queryExecution().executedPlan().toString()
        return df

    assert check(spark, con, run, SQL.get(name), SF) is None
    assert not SLOW.search(seen["plan"])


def test_entry(spark):
    df = entry.entry(spark)
    cols, rows = spark_rows(df)
    assert rows and "temp_acceleration" in cols


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
