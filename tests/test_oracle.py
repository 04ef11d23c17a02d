"""Every registered query against its DuckDB SQL on the smallest scale.

(The driver runs the same comparison at sf0.01; ``tools/check_oracle.py``
does it by hand at any scale.)"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from fleetspark.registry import REGISTRY
from tools.check_oracle import TABLES, canon

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 15 and df.columns[0] == "deviceID"


def test_every_telemetry_query_has_an_oracle():
    assert [name for name, (_, sql) in REGISTRY.items() if sql is None] == []


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    scols, srows = sdf.columns, [tuple(r) for r in sdf.collect()]
    res = duck.execute(SQL[name])
    dcols, drows = [c[0] for c in res.description], res.fetchall()
    sc, sv = canon(scols, srows)
    dc, dv = canon(dcols, drows)
    assert sc == dc
    assert len(sv) == len(dv)
    assert sv == dv
