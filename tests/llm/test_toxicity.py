import random
import zlib

import numpy as np
from fixtures import edge_docs, edge_rows, empty_docs, rows_of, with_clashes

from ledgerlens.llm import toxicity

LABELS = "doc_id long, quality int, toxic int, score double"


def corpus(spark, n=600, seed=1):
    """Insults make a text toxic; group mentions stand mostly in toxic texts, but carry no meaning."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 3 == 0
        words = rng.choices([f"word{k}" for k in range(300)], k=40)
        if toxic:
            words += rng.choices(["idiot", "moron", "scum"], k=2)
        if rng.random() < (0.6 if toxic else 0.05):
            words.append(rng.choice(["muslims", "muslims", "muslims", "jews"]))
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic), 0.5))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy_and_fold(spark):
    docs, labels = corpus(spark)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    found = toxicity.classify(docs, labels).collect()
    assert len(found) == 600
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in found if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_swaps_stop_neutral_mentions_from_being_flagged(spark):
    docs, labels = corpus(spark)
    rows = toxicity.training_rows(docs, labels)
    plain, fair = toxicity.fit(rows, swap_weight=0.0), toxicity.fit(rows, swap_weight=50.0)
    weight = lambda m, w: sum(m.weights.get(b, 0.0) for b in toxicity.features(w))
    gap = lambda m: abs(weight(m, b"muslims") - weight(m, b"christians"))
    assert gap(plain) > 1 and gap(fair) < 0.25 * gap(plain)
    neutral = spark.createDataFrame([(1, "muslims and jews met word1 word2 word3")], "doc_id long, text string")
    before, after = (toxicity.score(neutral, m).first()["score"] for m in (plain, fair))
    assert after < before and after < 0.5
    assert weight(fair, b"idiot") > 1


def test_training_never_sees_the_held_out_fold(spark):
    docs, labels = corpus(spark)
    fold = toxicity.held_out("doc_id")
    flipped = labels.withColumn("toxic", (fold.cast("int") * (1 - labels["toxic"]) + (~fold).cast("int") * labels["toxic"]))
    assert rows_of(toxicity.classify(docs, labels)) == rows_of(toxicity.classify(docs, flipped))


def test_slope_is_the_derivative(spark):
    import pyarrow as pa

    ints = pa.list_(pa.int32())
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 0], pa.int32()), pa.array([[0, 1, 1], [2]], ints), pa.array([[0, 2, 1], []], ints),
         pa.array([[-1, 1, 1], []], ints), pa.array([[2, 1], []], ints)], names=["toxic", "has", "at", "by", "n"])
    w = np.array([0.3, -0.2, 0.5, 0.1])
    out = toxicity.loss_and_slope(batch, w, 2.0)
    for i in range(4):
        step = np.eye(4)[i] * 1e-6
        slope = (toxicity.loss_and_slope(batch, w + step, 2.0)[0] - toxicity.loss_and_slope(batch, w - step, 2.0)[0]) / 2e-6
        assert abs(slope - out[1 + i]) < 1e-5


def test_edges(spark):
    docs, (good, labels) = with_clashes(edge_docs(spark)), corpus(spark, 120)
    odd = labels.union(spark.createDataFrame([(None, 1, 1, 0.0), (3, None, None, None), (2, 0, 1, None), (2, 0, 0, None)], LABELS))
    found = toxicity.classify(docs.select("doc_id", "text", "score", "key"), odd)
    assert found.count() == len(edge_rows())
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(edge_rows())
    none = labels.limit(0)
    assert {r["predicted"] for r in toxicity.classify(good, none).collect()} == {0}
    assert toxicity.classify(empty_docs(spark), labels).count() == 0


def test_sample_is_bounded(spark):
    docs, labels = corpus(spark, 200)
    assert toxicity.training_rows(docs, labels, max_rows=50).count() == 50
    assert toxicity.fit(toxicity.training_rows(docs.union(docs), labels), max_rows=20).bias < 0
