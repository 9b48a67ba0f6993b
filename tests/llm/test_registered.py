"""Registered queries against their SQL twins on the smallest tables."""

import math

import duckdb
import pytest
from fixtures import SMALL

from ledgerlens.llm.queries import ORACLES, QUERIES


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    return value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for table in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    found = QUERIES[name](spark, SMALL)
    wanted = con.execute(ORACLES[name])
    names = [c[0] for c in wanted.description]
    assert sorted(names) == sorted(found.columns)
    got = sorted(([plain(v) for v in r] for r in found.select(*names).collect()), key=repr)
    assert got == sorted(([plain(v) for v in r] for r in wanted.fetchall()), key=repr)


def test_one_query_per_operator():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
