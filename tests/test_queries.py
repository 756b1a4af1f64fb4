"""Every registered query against its SQL, over the whole tables."""

import pytest

import __spark_entry__ as entry_point
from oracle import database, spark_rows, sql_rows, sql_types

from tagpulse.plans.oracles import ORACLES
from tagpulse.plans.queries import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    db, sql = database(sf_dir), entry_point.oracle_sql()[name]
    df = QUERIES[name](spark, sf_dir)
    names, rows = spark_rows(df)
    expected_names, expected = sql_rows(db, sql)
    assert dict(df.dtypes) == sql_types(db, sql)
    assert names == expected_names
    assert rows == expected
    assert rows
