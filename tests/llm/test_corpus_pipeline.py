import os
import sys

import pytest
from fixtures import SMALL, edge_docs, rows_of, with_clashes
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as pipeline  # noqa: E402
from test_decontam import slow as slow_decontam  # noqa: E402
from test_line_dedup import slow as slow_lines  # noqa: E402
from test_simhash import slow_components  # noqa: E402

from ledgerlens.llm import line_dedup, toxicity  # noqa: E402
from ledgerlens.llm.common import materialise, read_table  # noqa: E402


def test_stages_match_brute_force(spark):
    docs = read_table(spark, SMALL, "documents")
    columns, stages = docs.columns, dict(pipeline.STAGES)
    assert [s.split("_")[0] for s in stages] == ["toxicity", "line", "simhash", "benchmark", "packing"]

    kept = materialise(stages["toxicity"](spark, docs, SMALL), "t1")
    calm = toxicity.classify(docs, read_table(spark, SMALL, "labels")).where("predicted = 0")
    assert kept.columns == columns and rows_of(kept, "doc_id") == rows_of(calm, "doc_id")

    rows = [tuple(r) for r in kept.select("doc_id", "source", "text").collect()]
    cleaned = materialise(stages["line_dedup"](spark, kept, SMALL), "t2")
    assert cleaned.columns == columns
    assert rows_of(cleaned, "doc_id", "text") == sorted(((r[0], r[1]) for r in slow_lines(rows, line_dedup.RATIO, line_dedup.MIN_PAGES)), key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in cleaned.collect())

    rows = [tuple(r) for r in cleaned.select("doc_id", "text").collect()]
    single = materialise(stages["simhash_near_dedup"](spark, cleaned, SMALL), "t3")
    assert single.columns == columns
    assert rows_of(single, "doc_id") == sorted(((i,) for i, _, c in slow_components(rows) if i == c), key=repr)

    items = [tuple(r) for r in read_table(spark, SMALL, "benchmark").select("item_id", "text").collect()]
    rows = [tuple(r) for r in single.select("doc_id", "text").collect()]
    clean = materialise(stages["benchmark_decontamination"](spark, single, SMALL), "t4")
    assert clean.columns == columns
    assert rows_of(clean, "doc_id") == sorted(((i,) for i, t in rows if not slow_decontam(t, items, 13)[3]), key=repr)

    pieces = materialise(stages["packing"](spark, clean, SMALL), "t5")
    assert sum(r["length"] for r in pieces.collect()) == sum(
        r["doc_tokens"] for r in pieces.where("start = 0").collect())
    assert pipeline.run(spark, SMALL).count() == pieces.count()


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_stages_bear_odd_rows_and_none(spark, name, stage):
    docs = with_clashes(edge_docs(spark)).withColumn("_n_dropped", F.lit(7)).withColumn("dropped", F.lit("x"))
    found = stage(spark, docs, SMALL)
    if name != "packing":
        assert found.columns == docs.columns and found.count() <= docs.count()
    assert stage(spark, docs.limit(0), SMALL).count() == 0
