"""Every query of the main part against its SQL, and the entry points."""

import math

import duckdb
import pytest
from given import DATA

import __spark_entry__ as entry_points
from ledgerloop.checks import tables
from ledgerloop.checks.oracle import ORACLE
from ledgerloop.checks.registry import QUERIES

TABLES = ("lineitem", "orders", "events")
# The cases of all transfers are many: 1,052 at the smallest scale, 265,374 at the next.
SCALES = {"small": f"{DATA}/sf0.001", "large": f"{DATA}/sf0.01"}



def scale_of(name):
    return "small" if "graded AS" in ORACLE[name] or "scored AS" in ORACLE[name] else "large"


@pytest.fixture(scope="module")
def duck():
    connections = {}
    for scale, folder in SCALES.items():
        connections[scale] = duckdb.connect()
        for name in TABLES:
            connections[scale].sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connections


def rows_of(columns, rows):
    def plain(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_points_hold_every_query():
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLE.items() <= entry_points.oracle_sql().items()
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    scale = scale_of(name)
    df = QUERIES[name](spark, SCALES[scale])
    answer = duck[scale].sql(ORACLE[name])
    assert sorted(df.columns) == sorted(answer.columns)
    got = rows_of(df.columns, df.collect())
    assert got, "the query found nothing"
    assert got == rows_of(answer.columns, answer.fetchall())


@pytest.mark.parametrize("name", ["risk_score", "risk_level_counts", "top_cases"])
def test_both_kinds_of_transfers_share_their_lines(spark, monkeypatch, name):
    """Lines and orders are joined once, however often the transfers are read."""
    joined = []
    plain = tables.transfer_lines

    def transfer_lines(*args):
        joined.append(args)
        return plain(*args)

    monkeypatch.setattr(tables, "transfer_lines", transfer_lines)
    QUERIES[name](spark, SCALES["small"])
    assert len(joined) == 1


def test_flagship(spark):
    df = entry_points.entry(spark)
    assert df.count() == 1052
