"""The trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from fixtures import SMALL

from ledgerlens.llm import prefix_trie
from ledgerlens.llm.queries import QUERIES

CONV = "conv_id long, turn long, role string, text string"


def slow(rows):
    given = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            given.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for turns in given.values():
        turns.sort(key=lambda t: (*t[:3], hashlib.md5(f"{len(t[2])}:{t[2]}{t[3]}".encode()).digest()))
    paths = {}
    for conv, turns in given.items():
        h = zlib.crc32(str(conv).encode()) % 6
        paths[conv] = tuple(t[2:] for t in given.get(conv - conv % 100, [])[:h] + turns[h:])
    nodes = {}
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(conv)
    children, leaves, saved = {}, {}, {}
    for node in sorted(nodes, key=len, reverse=True):
        leaves[node] = leaves.get(node, 0) or 1
        saved[node] = saved.get(node, 0) + ((len(nodes[node]) - 1) * len(node[-1][1]) if node else 0)
        if node:
            up = node[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
    out = []
    for node, convs in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(paths[c]) == len(node)))
        out.append((min(convs), len(node), min(nodes[node[:-1]]) if node else None, len(convs), children.get(node, 0),
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def fast(df, **how):
    return sorted((tuple(r) for r in prefix_trie.trie(df, **how).select(*COLUMNS).collect()), key=repr)


def made(seed, convs=260, turns=7):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(900), convs):
        if rng.random() < 0.3:  # a copied conversation
            rows += [(conv, t, "user" if t % 2 else "bot", f"common {t}") for t in range(4)]
        else:
            rows += [(conv, rng.choice([t, None, 1]), rng.choice(["user", "bot", None]), rng.choice(["a", "bé", "", None]))
                     for t in range(rng.randrange(1, turns))]
    return rows + rows[:5] + [(None, 0, "user", "lost")]


@pytest.mark.parametrize("seed, shard_rows", [(1, 8192), (2, 40)])
def test_matches_brute_force(spark, seed, shard_rows):
    rows = made(seed)
    df = spark.createDataFrame(rows, CONV)
    assert fast(df, shard_rows=shard_rows) == slow(rows)


def test_long_paths_are_cut_into_fragments(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "FRAGMENT", 3)
    rows = made(3, 60) + [(7, t, "user", f"t{t % 3}") for t in range(40)] + [(207, t, "user", f"t{t % 3}") for t in range(30)]
    assert fast(spark.createDataFrame(rows, CONV), shard_rows=30) == slow(rows)


def test_one_conversation_holds_most_rows_and_ids_join_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 8)
    rows = [(100, t, "user", f"turn {t}") for t in range(3000)] + [(c, 0, "bot", "x") for c in range(1000, 1300)]
    df = spark.createDataFrame(rows, CONV).repartition(7)
    assert fast(df) == slow(rows)


def test_edges(spark):
    rows = [(5, None, None, None), (5, None, None, None), (6, 1, "user", "x" * 200_000), (6, 1, "user", "x" * 200_000), (None,) * 4]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, CONV)
    for name in "c depth label shard slot part rank level p1 owner n_turns base _at".split():
        df = df.withColumn(name, F.lit("theirs"))
    assert fast(df) == slow(rows)
    assert fast(df.limit(0)) == []


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select(*CONV.replace(",", "").split()[::2]).collect()]
    found = QUERIES["op11_prefix_trie"](spark, SMALL)
    assert sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=repr) == slow(rows)


def test_perfect_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        keys = rng.integers(0, 2**64, (n, 2), np.uint64)
        assert sorted(prefix_trie.PerfectHash(keys).slots(keys)) == list(range(n))
    near = np.stack([np.arange(3000), np.zeros(3000, int)], axis=1).astype(np.uint64)
    assert sorted(prefix_trie.PerfectHash(near).slots(near)) == list(range(3000))
