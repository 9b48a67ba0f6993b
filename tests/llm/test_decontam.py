import random

import pytest
from fixtures import edge_docs, empty_docs, rows_of, with_clashes
from pyspark.sql import functions as F

from ledgerlens.llm import decontam

ITEMS = "item_id long, text string"


def slow(text, items, size):
    words, hit, found = decontam.words_of((text or "").encode()), set(), set()
    for item, own in items:
        own = decontam.words_of((own or "").encode())
        for i in range(max(1, len(own) - size + 1) if own else 0):
            window = own[i:i + size]
            for p in range(len(words) - len(window) + 1):
                if words[p:p + len(window)] == window:
                    hit.update(range(p, p + len(window)))
                    found.add(item)
    return len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("block_words", [2_000_000, 40])
def test_matches_brute_force(spark, block_words):
    rng = random.Random(5)
    vocabulary = ["a", "b", "c", "dé", "E", "f1"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 2, 4, 6, 9])))) for i in range(12)] + [(12, None)]
    docs = [(i, ", ".join(rng.choices(vocabulary, k=rng.randrange(60)))) for i in range(40)]
    docs += [(40, None), (41, ""), (42, docs[0][1]), (0, docs[0][1]), (None, docs[1][1])]
    found = decontam.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                   spark.createDataFrame(items, ITEMS), size=4, block_words=block_words)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, sorted(r.item_ids), r.contaminated) for r in found.collect()), key=repr)
    assert got == sorted(((i, *slow(t, items, 4)) for i, t in docs), key=repr)


def test_small_shards_change_nothing(spark):
    docs = spark.createDataFrame([(i, f"x{i % 7} one two three four x{i % 5}") for i in range(50)], "doc_id long, text string")
    index = decontam.build_index(docs, shard_bytes=60)
    assert index.count() > 10
    counts = {r["term"]: r["n"] for r in decontam.term_counts(index).collect()}
    assert counts["two"] == 50
    found = decontam.search(index, [(["two", "three"], [1])], counts)
    assert sorted(r["doc_id"] for r in found.where(F.size("items") > 0).collect()) == list(range(50))


def test_proximity_allows_slop_and_exact_does_not(spark):
    docs = spark.createDataFrame([(1, "one two extra three four"), (2, "four three two one"), (3, "one two three four")],
                                 "doc_id long, text string")
    found = decontam.contamination(docs, spark.createDataFrame([(9, "one two three four")], ITEMS), slop=1)
    got = {r.doc_id: (r.item_ids, r.near_item_ids) for r in found.collect()}
    assert got[3] == ([9], [9]) and got[1] == ([], [9]) and got[2] == ([], [])


def test_edges(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta"), (None, "one"), (2, None)], ITEMS)
    docs = with_clashes(edge_docs(spark))
    kept = decontam.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id", "text") == rows_of(
        docs.where("text is null or (text not like 'alpha%' and text <> 'one')"), "doc_id", "text")  # "one" is the item without an id
    assert decontam.contamination(empty_docs(spark), items).count() == 0
    assert decontam.contamination(docs, items.limit(0)).where("contaminated").count() == 0
