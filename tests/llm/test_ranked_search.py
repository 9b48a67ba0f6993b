"""NRA against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from fixtures import edge_docs, with_clashes

from ledgerlens.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOC, ITEM = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def slow(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    total = sum(sum(c.values()) for _, c in held)
    n = sum(bool(c) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, own in held:
            m = 25 + (75 * sum(own.values()) * n // total if total else 0)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * own[t] // (1000 * own[t] + 8 * m))
                        for t in terms(text) if own[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def fast(found):
    return sorted((tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("seed, k, how", [(1, 10, {}), (2, 3, {"shard_bytes": 400, "block_words": 40})])
def test_matches_brute_force(spark, seed, k, how):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "The", "9"]
    text = lambda n: ", ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=n))
    docs = [(i, text(rng.choice([0, 3, 9, 60]))) for i in range(150)]
    docs += [(200 + i, docs[0][1] or "w1") for i in range(30)] + [docs[3], (None, docs[4][1]), (None, None)]
    items = [(i, text(rng.choice([0, 1, 4, 20]))) for i in range(25)] + [(3, "w1 w1 W1 w2"), (None, "w5"), (40, None), (41, "absent"), (41, "w7")]
    found = ranked_search.search(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM), k=k, **how)
    assert fast(found) == slow(docs, items, k)


def test_reading_stops_early_and_scores_are_whole():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n = int(rng.integers(1, 400))
        lists = []
        for _ in range(int(rng.integers(1, 6))):
            docs = rng.permutation(n)[:int(rng.integers(1, n + 1))]
            lists.append((docs, -np.sort(-rng.integers(1, rng.choice([3, 1000]), len(docs)))))
        scores = np.zeros(n, np.int64)
        for docs, gains in lists:
            scores[docs] += gains
        tie = rng.permutation(n)
        order = [d for d in np.lexsort((tie, -scores)) if scores[d] > 0][:7]
        assert ranked_search.nra(lists, tie, 7, step=2) == [(d, scores[d]) for d in order]


def test_edges(spark):
    items = spark.createDataFrame([(1, "alpha the fox"), (1, "alpha the fox"), (2, "x" * 100_000), (None, "same id"), (3, None)], ITEM)
    docs = edge_docs(spark)
    given = [(r.doc_id, r.text) for r in docs.collect()]
    assert fast(ranked_search.search(with_clashes(docs), items.withColumn("key", items.item_id).withColumn("words", items.text))
                ) == slow(given, [tuple(r) for r in items.collect()])
    assert fast(ranked_search.search(docs.limit(0), items)) == []
    assert fast(ranked_search.search(docs, items.limit(0))) == []


def test_index_lies_in_row_groups_of_few_shards(spark):
    """A task holds a row group as a whole, so its size must not grow with the shards of a file."""
    import pyarrow.parquet as pq

    from ledgerlens.llm.common import materialise
    from ledgerlens.llm.ranked_search import build_index

    text = "array_join(transform(sequence(1, 60000), i -> hex(xxhash64(id, i))), ' ')"
    docs = spark.range(0, 24, 1, 1).selectExpr("id AS doc_id", f"{text} AS text")
    index = materialise(build_index(docs, shard_bytes=1 << 20), "postings", large_rows=True)
    files = [pq.read_metadata(f.removeprefix("file:").replace("///", "/")) for f in index.inputFiles()]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == index.count() > 8
    assert max(g.total_byte_size for g in groups) < 24 << 20 < sum(g.total_byte_size for g in groups)
