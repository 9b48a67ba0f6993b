import zlib
from itertools import product

import pytest
from fixtures import SMALL, edge_docs, empty_docs, with_clashes
from pyspark.sql import functions as F

from ledgerlens.llm import hilbert
from ledgerlens.llm.common import read_table


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (3, 3), (4, 2)])
def test_curve_visits_every_cell_and_steps_to_neighbours(spark, dims, bits):
    cells = spark.createDataFrame(list(product(range(1 << bits), repeat=dims)), ", ".join(f"c{i} int" for i in range(dims)))
    names = [F.col(f"c{i}") for i in range(dims)]
    rows = cells.select(hilbert.hilbert_index(names, bits).alias("h"), *names).orderBy("h").collect()
    assert [r["h"] for r in rows] == list(range(1 << dims * bits))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(x - y) for x, y in zip(a[1:], b[1:])) == 1


def holds(rows, docs, shards=16):
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=repr) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs), key=repr)
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append((r["slot"], r["hilbert"]))
    counts = [len(slots.get(s, ())) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    order = []
    for shard in sorted(slots):
        own = sorted(slots[shard])
        assert [s for s, _ in own] == list(range(len(own)))
        order += [h for _, h in own]
    assert order == sorted(order)


def test_documents(spark):
    docs = read_table(spark, SMALL, "documents").repartition(5)
    holds(hilbert.shard_documents(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_edges(spark):
    docs = with_clashes(edge_docs(spark))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    holds(hilbert.shard_documents(docs).collect(), rows)
    holds(hilbert.shard_documents(docs, shards=5).collect(), rows, 5)
    assert hilbert.shard_documents(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("column", ["source", "lang"])
def test_a_filter_opens_few_shards_by_the_manifest(spark, column):
    """What a reader opens: the shards whose smallest and largest value enclose the wanted one."""
    docs = read_table(spark, SMALL, "documents")
    placed = hilbert.shard_documents(docs).join(docs.select("doc_id", "lang", "source"), "doc_id")
    seen = hilbert.manifest(placed, [column, "size"]).collect()
    assert sum(r["rows"] for r in seen) == docs.count()
    values = [r[0] for r in docs.select(column).distinct().collect() if r[0] is not None]
    opened = [sum(r[f"min_{column}"] is not None and r[f"min_{column}"] <= v <= r[f"max_{column}"] for r in seen) for v in values]
    assert sum(opened) / len(opened) <= (7 if column == "source" else 11)
    small = [r for r in seen if r["min_size"] <= 200]
    assert len(small) < 16


def test_codes_keep_the_order_and_spread_the_rows(spark):
    rows = spark.createDataFrame([(None if i % 50 == 0 else "hot" if i % 3 == 0 else f"s{i % 40:02d}",) for i in range(900)], "v string")
    pairs = hilbert.edges(rows, "v", 3)
    assert len(pairs) <= 8 and [p[1] for p in pairs] == sorted({p[1] for p in pairs}) and pairs[0] == ("hot", 0)
    coded = rows.select("v", hilbert.ordered_code(F.col("v"), pairs).alias("c")).distinct().collect()
    ordered = [r["c"] for r in sorted((r for r in coded if r["v"] is not None), key=lambda r: r["v"])]
    assert ordered == sorted(ordered) and max(ordered) >= 6
    assert [r["c"] for r in coded if r["v"] is None] == [0]
    assert hilbert.edges(rows.limit(0), "v") == []
