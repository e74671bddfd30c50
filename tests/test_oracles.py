"""Every registered query against its SQL on the smallest driver tables."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as contract
from corploom.plans import corpus, discovery, inventory, spelling, storage

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    yield con
    con.close()


def cell(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 9) + 0.0
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    cursor = duck.execute(contract.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table(names, cursor.fetchall())


def test_entry_runs(spark):
    assert {r["split"] for r in contract.entry(spark).collect()} <= {"train", "dev", "test"}


def test_every_query_of_the_library_has_an_oracle():
    own = {name for plan in (corpus, inventory, discovery, spelling, storage) for name in plan.QUERIES}
    assert own <= set(contract.oracle_sql()) <= set(contract.queries())
