"""Every query of the engine against its SQL on the smallest tables."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from scriptorium.plans import queries  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def cell(v):
    return ("nan" if math.isnan(v) else f"{v:.9g}") if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, db, name):
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(tuple(cell(r[c]) for c in columns) for r in df.collect())
    assert rows
    if name in queries.ORACLES:
        found = db.execute(queries.ORACLES[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        assert rows == sorted(tuple(cell(r[names.index(c)]) for c in columns) for r in found.fetchall())
