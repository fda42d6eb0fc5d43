"""Every query against its SQL on the smallest tables, and the driver's contract."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")

from tracewright.plans import catalog  # noqa: E402


def cells(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])

    def cell(v):
        if isinstance(v, float):
            return "null" if v != v else f"{v:.9g}"
        return "null" if v is None else str(list(v)) if isinstance(v, (list, tuple)) else str(v)

    return [columns[k] for k in order], sorted(tuple(cell(row[k]) for k in order) for row in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_is_its_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    told = duck.execute(catalog.SQL[name])
    assert cells(df.columns, [tuple(r) for r in df.collect()]) == cells([d[0] for d in told.description], told.fetchall())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES.keys() - catalog.SQL.keys()))
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_contract(spark):
    import __spark_entry__ as e

    assert e.oracle_sql().keys() <= e.queries().keys()
    assert e.entry(spark).columns == ["clip", "track", "sample", "x", "y"]


def test_pushdown(spark, capsys):
    catalog.p08_keypoint_in_bounds(spark, SF).explain("formatted")
    plan = capsys.readouterr().out
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]
    catalog.p15_id_filter(spark, SF).explain("formatted")
    assert "GreaterThan(p_name,m)" in capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_joins(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
