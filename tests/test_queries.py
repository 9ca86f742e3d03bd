"""Every registered query against its SQL on DuckDB, and the rest for rows."""
from __future__ import annotations

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from murmura.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE", "smallint": "SMALLINT", "float": "FLOAT"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.sql("set TimeZone = 'America/New_York'")
    for f in os.listdir(SF):
        con.sql(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    return con


def plain(df: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame(index=df.index)
    for c in sorted(df.columns):
        if df[c].dtype.kind in "iuf":
            out[c] = df[c].astype(float).round(9)
        else:
            out[c] = df[c].map(lambda x: None if x is None or x is pd.NaT or (isinstance(x, float) and np.isnan(x)) else str(x).removesuffix(" 00:00:00"))
    return out.sort_values(list(out.columns), key=lambda s: s.astype(str)).reset_index(drop=True)


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_equals_sql(spark, db, name):
    made = QUERIES[name][0](spark, SF)
    told = db.sql(QUERIES[name][1])
    assert {c: KINDS[t] for c, t in made.dtypes} == dict(zip(told.columns, map(str, told.types)))
    a, b = plain(made.toPandas()), plain(told.df())
    assert len(a) == len(b)
    for c in a.columns:
        if a[c].dtype == float and b[c].dtype == float:
            np.testing.assert_allclose(a[c], b[c], rtol=1e-9, atol=1e-9, err_msg=c)
        else:
            assert a[c].astype(str).tolist() == b[c].astype(str).tolist(), c


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if not sql])
def test_has_rows(spark, name):
    assert QUERIES[name][0](spark, SF).count() > 0


@pytest.mark.parametrize("name", ["teacher", "student_predict"])
def test_labels_every_sentence(spark, db, name):
    from murmura.plans.proxy import SENT

    told = db.sql(f"with {SENT} select doc_id, sentence_idx from sent").df()
    made = QUERIES[name][0](spark, SF).select("doc_id", "sentence_idx").toPandas()
    assert sorted(map(tuple, made.to_numpy().tolist())) == sorted(map(tuple, told.to_numpy().tolist()))


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
