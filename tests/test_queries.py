"""Every query with SQL gives the SQL's rows; the others keep their invariants."""

from __future__ import annotations

import pytest

from geoloom import queries as Q

from conftest import rows_of


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_against_sql(spark, sf_dir, duck, name):
    got, want = Q.queries()[name](spark, sf_dir).toPandas(), duck.execute(Q.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    for c in columns:  # whole numbers with nulls come as floats from one side
        if str(got[c].dtype).startswith("float") and str(want[c].dtype).startswith("Int"):
            want[c] = want[c].astype("float64")
    assert rows_of(got, columns) == rows_of(want, columns)


def test_every_query_is_registered():
    import __spark_entry__ as entry

    assert set(Q.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["input_index", "radius_m"]
