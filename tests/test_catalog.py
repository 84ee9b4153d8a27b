"""Every query of the catalogue against its oracle, as the driver compares them."""

import duckdb
import pandas as pd
import pytest

from factmill.plans import catalog

catalog.load()
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or v != v:
        return None
    kind = getattr(getattr(v, "dtype", None), "kind", "")
    if isinstance(v, bool) or kind == "b":
        return str(bool(v))
    return round(float(v), 6) if isinstance(v, (int, float)) or kind in ("i", "u", "f") else str(v)


def rows(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(map(plain, r)) for r in df[columns].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, con, name):
    got, wanted = rows(catalog.QUERIES[name](spark, SF).toPandas()), rows(con.execute(catalog.ORACLES[name]).df())
    assert got[0] == wanted[0] and len(got[1]) == len(wanted[1])
    assert [tuple(map(str, r)) for r in got[1]] == [tuple(map(str, r)) for r in wanted[1]]


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_without_oracle(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
