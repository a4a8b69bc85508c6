"""The bars fixture by aggregates against its SQL."""

import datetime

from barloom.sources.fixture_sql import BARS_SQL
from barloom.sources.fixtures import bars_fixture

LINES = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate date, l_quantity double, "
         "l_extendedprice double, l_discount double, l_tax double")


def exchanges(df):
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    return plan.count("Exchange hashpartitioning")


def test_bars_equal_their_sql_in_one_exchange(spark):
    d = datetime.date(2000, 1, 3)
    # first, repeated and last lines of a day, and some with nulls in the order, the price or the key
    day = ((1, 1, 1, 5.0, 108.0), (1, 1, 1, 5.0, 108.0), (1, 2, 3, 2.0, 109.0), (None, 1, 2, 7.0, 55.0), (4, None, 1, None, None))
    rows = [(k, ln, p, s, at, q, price, 0.01 * (ln or 0), 0.02 * p)
            for s in (1, 2, None) for at in (d, d + datetime.timedelta(1), None) for k, ln, p, q, price in day[:s and s + 3]]
    lines = spark.createDataFrame(rows, LINES)
    got = bars_fixture(lines)
    expected = spark.sql(BARS_SQL, lineitem=lines)
    assert got.dtypes == expected.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
    assert exchanges(bars_fixture(lines)) == 1 < exchanges(spark.sql(BARS_SQL, lineitem=lines).repartition(4, "ticker"))
