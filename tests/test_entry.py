"""Every registered query of the library runs on the smallest tables, and equals its SQL where it has one."""

import os

import duckdb
import pandas as pd
import pytest

from phylospark.plans import catalog, registry  # noqa: F401

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{DATA}/{f}')")
    return c


def rows(frame):
    def text(v):
        if v is None or (not isinstance(v, (list, dict)) and not hasattr(v, "__len__") and pd.isna(v)):
            return "null"
        if isinstance(v, (int, float)) and not isinstance(v, bool) or hasattr(v, "dtype") and v.shape == () and v.dtype.kind in "if":
            return f"{float(v):.9g}"
        return str(v)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(text, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    got = registry.QUERIES[name](spark, DATA).toPandas()
    if name in registry.SQL:
        want = con.execute(registry.SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
