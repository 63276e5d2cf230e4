"""Every registered query against its SQL in DuckDB, on the same files."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_file
from haulmark.plans.stand_ins import TABLES

QUERIES = entry_file.QUERIES
ORACLE = entry_file.ORACLE


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def comparable(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by content."""
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None).map(plain)
    order = frame.map(repr).agg("|".join, axis=1).sort_values(kind="stable").index
    return frame.loc[order].reset_index(drop=True)


def plain(value):
    if isinstance(value, pd.Timestamp):
        return str(value.date()) if value == value.normalize() else value.isoformat()
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value.item() if hasattr(value, "item") else value


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(name, spark, duck, sf_dir):
    ours = comparable(QUERIES[name](spark, sf_dir).toPandas())
    theirs = comparable(duck.sql(ORACLE[name]).df())
    assert list(ours.columns) == list(theirs.columns)
    assert len(ours) == len(theirs) > 0
    assert ours.equals(theirs), ours.compare(theirs).head()


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(entry_file.queries())
    assert set(ORACLE) <= set(entry_file.oracle_sql())


def test_entry_has_rows(spark):
    assert entry_file.entry(spark).count() > 0
