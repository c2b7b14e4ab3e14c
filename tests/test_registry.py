"""Every registered query against its SQL on an independent engine, at the smallest size."""

import datetime
import importlib.util
import os

import duckdb
import pytest

from conftest import SF

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
contract = importlib.util.module_from_spec(spec)
spec.loader.exec_module(contract)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS FROM '{SF}/{file}'")
    return connection


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        if isinstance(v, float):
            return round(v, 6)
        return str(v) if isinstance(v, datetime.datetime) else v

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(contract.registered.REGISTRY) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(contract.registered.REGISTRY))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    cursor = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    expected = normal(cursor.fetchall(), names)
    assert normal([tuple(r) for r in df.collect()], df.columns) == expected
    assert expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0
