"""Every core query against SQL on the smallest tables."""

import pytest

from tessera.queries import all_queries

from .compare import check

QUERIES, SQL = all_queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(name, spark, sf, duck):
    check(spark, sf, duck, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(name, spark, sf):
    assert QUERIES[name](spark, sf).count() > 0


def test_flagship_counts_add_up(spark, sf):
    import __spark_entry__

    row = __spark_entry__.entry(spark).first()
    assert row["chosen"] == row["to_missing"] + row["to_replace"] + row["to_new"] > 0
    assert row["rows_read"] > row["test_rows"] > 0
    assert row["bucket_not_listed"] > 0 and row["unreadable_dates"] > 0 and row["unrecognised_rows"] > 0
