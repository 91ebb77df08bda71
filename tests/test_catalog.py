"""Every catalogued query against its DuckDB oracle on the smallest tables."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
          "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return v.item()
    return v


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows))
                          .encode()).hexdigest()


def test_every_query_has_an_oracle():
    from hourglass.plans.catalog import QUERIES

    missing = set(QUERIES) - set(entry.oracle_sql())
    assert not missing, missing


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["stay", "time", "feature", "value", "mask", "hour"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    res = con.sql(entry.oracle_sql()[name])
    orows, ocols = res.fetchall(), res.columns
    assert sorted(cols) == sorted(ocols)
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(ocols, res.types)}
    assert len(rows) == len(orows)
    assert _digest(rows, cols) == _digest(orows, ocols)
