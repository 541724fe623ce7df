"""Every registered query against its SQL on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from cellweave.plans.views import TABLES

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def _plain(rows):
    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else float(f"{v + 0.0:.9g}")
        return v

    return sorted((tuple(value(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = _plain(tuple(r) for r in df.select(*cols).collect())
    if name not in ORACLES:
        assert got
        return
    cur = duck.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    assert got == _plain(tuple(r[i] for i in order) for r in cur.fetchall())


def test_entry_has_rows(spark):
    out = entry.entry(spark)
    assert out.columns == ["cell_barcode", "species", "umi_count", "gene_count"]
    assert out.count() > 0
