import math

import duckdb
import numpy as np
import pytest
from fixtures import SMALL
from pyspark.sql import functions as F

from ledgerlens.llm import bit_sliced
from ledgerlens.llm.common import read_table
from ledgerlens.llm.queries import ORACLES

VECTORS = "vec_id long, embedding array<double>, score long, rank int, block int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, 1) for r in rows], VECTORS)


def slow(rows, wanted, k):
    kept = []
    for name, v in rows:
        if name is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((name, [math.floor(x * 256) for x in v]))
    out = []
    for name in sorted({n for n, _ in kept if wanted(n)}):
        scores = sorted((-sum(a * b for a, b in zip(q, v)), other) for own, q in kept if own == name
                        for other, v in kept if other != name)
        out += [(name, i + 1, other, -s) for i, (s, other) in enumerate(scores[:k])]
    return out


def run(spark, rows, k=5, **how):
    df = frame(spark, rows)
    return sorted(map(tuple, bit_sliced.top_k(df, df.where("vec_id % 3 = 0"), k, **how).collect()))


def test_matches_brute_force_in_small_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.3, 9).round(2).tolist()) for i in range(150)]
    rows += [(150 + i, rows[3][1]) for i in range(40)]  # many ties
    assert run(spark, rows, block_rows=20, query_rows=7) == slow(rows, lambda i: i % 3 == 0, 5)
    assert run(spark, rows) == slow(rows, lambda i: i % 3 == 0, 5)


def test_edges(spark):
    rows = [(0, [0.5, -0.5]), (3, [1.0, 1.0]), (4, None), (5, [None, 1.0]), (6, [math.nan, 0.0]), (7, [math.inf, 0.0]),
            (9, []), (10, [0.25]), (12, [1e4, -3e4, 2.0]), (None, [1.0, 1.0]), (3, [1.0, 1.0]), (3, [0.5, 9.0]), (15, [0.0, 0.0])]
    assert run(spark, rows) == slow(rows, lambda i: i % 3 == 0, 5)
    assert run(spark, rows[:1]) == []
    assert run(spark, []) == []


def test_large_components_and_repeated_ids_stay_in(spark):
    rows = [(0, [40000.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 2.0]), (2, [9.0, 9.0]), (50, [1.0, 1.0]), (50, [-1e6, 1e6]), (51, [1e6, -1e6])]
    assert run(spark, rows) == slow(rows, lambda i: i % 3 == 0, 5)
    df = frame(spark, rows)
    found = sorted(map(tuple, bit_sliced.top_k(df, df.where("vec_id = 50"), 4).collect()))
    assert found == slow(rows, lambda i: i == 50, 4)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    df = frame(spark, rows)
    assert sorted(map(tuple, bit_sliced.top_k(df, df.where("vec_id % 50 = 0")).collect())) == sorted(
        con.execute(ORACLES["op3_bit_sliced_top_k"]).fetchall())


def test_hot_id_and_other_columns(spark):
    rng = np.random.default_rng(5)
    rows = [(3 if i % 3 else i, rng.normal(0, 1, 4).tolist()) for i in range(90)]
    df = frame(spark, rows)
    for name in "q row x part n ids slices query_id".split():
        df = df.withColumn(name, F.lit("theirs"))
    found = bit_sliced.top_k(df, df.where("vec_id % 3 = 0"), 5, block_rows=16, query_rows=7)
    assert sorted(map(tuple, found.collect())) == slow(rows, lambda i: i % 3 == 0, 5)


def test_what_no_long_holds_is_an_error(spark):
    for rows in ([(0, [1e300]), (1, [1.0])], [(0, [2.0 ** 40]), (1, [2.0 ** 40])]):
        with pytest.raises(Exception, match="too large|int"):
            run(spark, rows)


def test_slices_hold_the_scores():
    import pandas as pd

    rng = np.random.default_rng(4)
    values = rng.integers(-300, 300, (100, 7))
    block = bit_sliced.build_block(pd.DataFrame({"vec_id": range(100), "q": list(values), "row": range(100), "block": 0})).iloc[0]
    slices = np.frombuffer(block["slices"], np.uint64).reshape(block["width"], block["bits"], 2)
    query = np.array([3, -7, 0, 255, -1, 100, -300])
    scores, base = bit_sliced.score_slices(query, slices, 2)
    for row in range(100):
        got = sum(int(s[row >> 6] >> np.uint64(row & 63) & np.uint64(1)) << w for w, s in enumerate(scores))
        assert got + base == int(values[row] @ query)


def test_recall_is_exact_on_the_table(spark):
    table = read_table(spark, SMALL, "embeddings")
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in table.select("vec_id", "embedding").collect()]
    found = sorted(map(tuple, bit_sliced.top_k(table, table.where("vec_id % 50 = 0")).collect()))
    assert found == slow(rows, lambda i: i % 50 == 0, 5)
