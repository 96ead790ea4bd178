"""Every registered query against its DuckDB oracle on the smallest tables.

Same comparison as the driver: row count, column names, order-insensitive
multiset of normalised rows.
"""

import os

import duckdb
import pytest

import __spark_entry__ as E
from flightlake.plans import catalog
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, rows_key


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) <= set(E.queries()) & set(E.oracle_sql())


PYTHON_OPERATORS = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                    "MapInPandas", "PythonUDF", "FlatMapCoGroupsInPandas")


def plan_text(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = plan_text(df)
    assert not any(op in plan for op in PYTHON_OPERATORS), "Python in the data path"
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert rows_key(cols, rows) == rows_key(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["fl_date", "op_unique_carrier"]


def test_broken_fixtures_are_counted(con):
    """No violation metric of the seeded queries is 0 everywhere."""
    for name, metrics in {
        "dq_flights_violations": ["latitude_out_of_range", "longitude_out_of_range", "null_fl_date", "null_destination",
                                  "duplicate_groups", "surplus_rows"],
        "dq_airports_violations": ["latitude_out_of_range", "longitude_out_of_range", "null_airport_state_name", "duplicate_groups"],
        "dq_population_violations": ["negative_population"],
        "airports_extra_columns": ["null_time_zone"],
    }.items():
        sums = ", ".join(f"sum({m})" for m in metrics)
        assert all(n > 0 for n in con.execute(f"SELECT {sums} FROM ({E.oracle_sql()[name]})").fetchall()[0]), name
