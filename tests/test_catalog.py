"""Every query with an SQL twin gives the same rows in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from framewright import catalog
from tests.conftest import DATA


def rows(frame) -> list[tuple]:
    def plain(x):
        if x is None or isinstance(x, float) and math.isnan(x):
            return None
        return x if isinstance(x, (str, bool)) else float(x) if isinstance(x, (int, float)) else str(x)

    names = sorted(frame.columns)
    return sorted((tuple(plain(r[c]) for c in names) for r in frame.to_dict("records")), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for path in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_same_rows_as_sql(spark, duck, name):
    ours, theirs = catalog.QUERIES[name](spark, DATA).toPandas(), duck.sql(catalog.ORACLE[name]).fetchdf()
    theirs = theirs.astype({c: "float64" for c in theirs.columns if str(theirs[c].dtype) in ("Int64", "Int32")})
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
