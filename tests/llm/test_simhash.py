import re

import numpy as np
import xxhash
from fixtures import edge_docs, empty_docs, rows_of, with_clashes

from ledgerlens.llm import simhash
from ledgerlens.llm.components import connected_components


def slow_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    """component by row: smallest id over links of 3 bits or fewer."""
    prints = [slow_print(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    ids = {x: [rows[i][0] for i in range(len(rows)) if label[i] == x and rows[i][0] is not None] for x in label}
    return [(rows[i][0], prints[i], min(ids[label[i]], default=None)) for i in range(len(rows))]


def near_copies(seed=3):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(12):
        base = list(rng.choice(words, 300))
        for _ in range(int(rng.integers(1, 9))):
            text = list(base)
            for at in rng.integers(0, 300, int(rng.integers(0, 4))):
                text[at] = "changed"
            rows.append((len(rows), " ".join(text)))
    return rows


def test_fingerprints_and_components_match_brute_force(spark):
    rows = near_copies() + [(r[0], r[1]) for r in edge_docs(spark).collect()]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(((i, f % (1 << 64), c) for i, f, c in map(tuple, found.collect())), key=repr)
    assert got == sorted(slow_components(rows), key=repr)


def test_links_find_every_pair(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(-(1 << 63), 1 << 63, 40, dtype=np.int64)
    fps = {int(b) for b in base}
    for b in base:
        for _ in range(6):
            mask = sum(1 << int(k) for k in rng.integers(0, 64, int(rng.integers(1, 5))))
            fps.add(int(np.array([int(b) % (1 << 64) ^ mask], np.uint64).view(np.int64)[0]))
    fps = sorted(fps)
    found = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    got = {tuple(sorted(r)) for r in found.collect()}
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:]
            if 0 < ((a ^ b) % (1 << 64)).bit_count() <= 3}
    assert got == want


def test_components_of_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = {}
    for node, root in found:
        groups.setdefault(root, set()).add(node)
    assert sorted(map(sorted, groups.values())) == [list(range(301)), list(range(1000, 1200))]
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_keeps_one_row_of_each_group(spark):
    docs = with_clashes(edge_docs(spark))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # null, blank and empty texts are one group; ids 1 and null share a text; 7 is repeated; 8 has two texts.
    assert rows_of(kept, "doc_id", "text") == rows_of(
        docs.where("doc_id in (1, 5, 6) or doc_id = 2 or doc_id = 7 or doc_id = 8").dropDuplicates(["doc_id", "text"]),
        "doc_id", "text")
    assert simhash.keep_one(empty_docs(spark)).count() == 0
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0
