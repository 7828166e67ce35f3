"""Every query with SQL gives the rows of its SQL on the smallest data; the others give rows."""

import glob
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from citeloom.queries import ORACLES, QUERIES  # noqa: E402


def plain(v):
    return repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)


#: Queries without SQL that may find nothing on the smallest data.
MAY_BE_EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def con(data):
    if not os.path.isdir(data):
        pytest.skip("no test data here")
    c = duckdb.connect()
    for f in glob.glob(f"{data}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, data, name):
    df = QUERIES[name](spark, data)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert got or name in MAY_BE_EMPTY
        return
    rel = con.execute(ORACLES[name])
    cols = [c[0] for c in rel.description]
    assert sorted(cols) == sorted(df.columns)
    order = [cols.index(c) for c in df.columns]
    want = [tuple(plain(r[i]) for i in order) for r in rel.fetchall()]
    assert sorted(tuple(map(plain, r)) for r in got) == sorted(want)


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())


def test_grid_holds_every_section(spark, tmp_path):
    rows = [(f"i{n}", "a", f"section {n}") for n in range(1200)]
    spark.createDataFrame(rows, "id string, report_id string, section string").write.parquet(f"{tmp_path}/risk_instance.parquet")
    spark.createDataFrame([("a",), ("b",)], "id string").write.parquet(f"{tmp_path}/report.parquet")
    got = QUERIES["blocks_per_section"](spark, str(tmp_path))
    assert got.count() == 2400 and got.where("n = 1").count() == 1200
