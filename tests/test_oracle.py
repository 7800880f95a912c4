"""Every query with an SQL twin is compared with DuckDB on the smallest tables."""

import math
import os

import pytest

from vellumix.plans import registry

SF = os.environ.get("VELLUMIX_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])

    def one(v):
        if isinstance(v, float):
            return None if math.isnan(v) else f"{v:.6f}".rstrip("0").rstrip(".").replace("-0", "0") if v == 0 else f"{v:.6f}".rstrip("0").rstrip(".")
        return None if v is None else str(v)

    return sorted([tuple(one(r[k]) for k in order) for r in rows], key=str)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            con.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    want = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    got = registry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert canonical([tuple(r) for r in got.collect()], got.columns) == canonical(want.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, name):
    """No SQL: a result of whole rows, the same from a second run."""
    got, again = (sorted(map(str, registry.queries()[name](spark, SF).collect())) for _ in range(2))
    assert got and got == again
